"""Helpers shared by the operators: scratch tables, table access, batches.

Intermediate tables are Parquet folders under the shared folder named by
``spark.checkpoint.dir``; a lost executor never takes one with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import shared_folder

#: ASCII white space; every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written between the phases of one operator call.

    ``save`` writes a frame as Parquet and reads it back, which cuts the
    lineage and lets later joins see its true size.  ``drop`` deletes a
    table no later phase reads.  ``settle`` asks the driver's JVM for a
    collection, so that Spark's cleaner removes the shuffle files of the
    phases already written out instead of keeping them all to the end.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tidewatch-llm/{name}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.paths.pop(name, None)
        if path:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def settle(self) -> None:
        import gc
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names`` with underscores added until none is the name of a column
    (Spark's names do not tell upper from lower case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def texts_as_bytes(column: pa.ChunkedArray | pa.Array) -> list:
    """UTF-8 bytes of a string column (None stays None)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def batches_of(rows: Iterator[pa.RecordBatch], most_rows: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches to ``most_rows`` rows, so that a batch of very
    long texts stays small once it is unpacked."""
    for b in rows:
        for i in range(0, b.num_rows, most_rows):
            yield b.slice(i, most_rows)


def mix64(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash from two, order-sensitive (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        h = (a + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h += b
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def hamming(a, b):
    """Differing bits of two 64-bit columns."""
    return F.bit_count(a.bitwiseXOR(b))
