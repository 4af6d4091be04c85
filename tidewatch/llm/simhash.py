"""SimHash near-duplicates, by meet-in-the-middle ball hashing.

A document's fingerprint has bit ``i`` set when more than half of its
shingles' 64-bit hashes have it set.  Two fingerprints at distance ``<= d``
have a common point within ``ceil(d / 2)`` and ``floor(d / 2)`` of them, so
every distinct fingerprint emits all its variants within ``ceil(d / 2)``
bits, the variants are shuffled, and fingerprints that meet on a variant are
verified by the exact distance.

Documents with one fingerprint are grouped before any variant is made, so a
group of copies costs one fingerprint however large it is.  For ``d <= 2``
at most 65 distinct fingerprints can meet on one variant, and all of them
lie within ``d`` of each other; a star from the smallest keeps them
connected without emitting pairs.  For larger ``d`` members of a bucket may
be further apart than ``d``, and the members of a bucket (bounded by the
ball's size) are compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, batches_of, hamming, texts_as_bytes
from tidewatch.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
_CHUNK = 1 << 16


def fingerprint_bytes(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text (see :func:`fingerprints`)."""
    words = (text or b"").lower().split()       # bytes: ASCII case and ASCII white space only
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    k = min(shingle, n)
    starts = np.concatenate([[0], ends[:-1] + 1])[:n - k + 1].tolist()
    stops = ends[k - 1:].tolist()
    hash64, total = xxhash.xxh64_intdigest, n - k + 1
    counts = np.zeros(64, np.int64)
    for i in range(0, total, _CHUNK):
        h = np.fromiter([hash64(joined[s:e], SEED) for s, e in zip(starts[i:i + _CHUNK], stops[i:i + _CHUNK])],
                        np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > total).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every row as a signed long.

    A-Z are lower-cased, words are runs of characters other than ASCII white
    space, shingles are ``shingle`` consecutive words joined by one space,
    counted with repeats and hashed by XXH64 with seed 42.  A text with
    fewer words is one shingle; a null or wordless text has fingerprint 0.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(rows, 512):
            fp = np.array([fingerprint_bytes(t, shingle) for t in texts_as_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("t")).mapInArrow(run, f"id {kind}, fp long")


def _masks(radius: int) -> list[int]:
    """Every 64-bit mask of up to ``radius`` bits, as signed longs."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def ball(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, m, v): every variant ``v = fp xor m`` within ``radius`` bits."""
    masks = F.lit(_masks(radius)).cast("array<bigint>")
    return fps.select("fp", F.explode(masks).alias("m")).select("fp", "m", F.col("fp").bitwiseXOR(F.col("m")).alias("v"))


def ball_edges(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` within ``max_bits``.

    Every edge is verified; every pair within ``max_bits`` is joined by a
    path of such edges.  With radius 1 the fingerprints that meet on a
    variant are the variant itself or differ from it in one bit, so a
    bucket is one 64-bit set of bits and aggregates without lists.  For one
    bit a link runs between a variant that is a fingerprint itself and those
    that made it.
    """
    variants = ball(fps, (max_bits + 1) // 2)
    if max_bits == 1:
        own = fps.select(F.col("fp").alias("a"))
        pairs = own.join(variants.filter("m != 0").select(F.col("v").alias("a"), F.col("fp").alias("b")), "a")
    elif max_bits <= 2:
        met = variants.groupBy("v").agg(F.bit_or("m").alias("bits"), F.min(F.col("m") != 0).alias("apart"))
        met = met.filter(F.bit_count("bits") + F.when(F.col("apart"), 0).otherwise(1) > 1)
        flips = F.filter(F.lit(_masks(1)[1:]).cast("array<bigint>"), lambda m: m.bitwiseAND(F.col("bits")) != 0)
        each = F.transform(flips, lambda m: F.col("v").bitwiseXOR(m))
        each = F.when(F.col("apart"), each).otherwise(F.array_append(each, F.col("v")))
        met = met.select(each.alias("all"))
        pairs = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    else:
        met = variants.groupBy("v").agg(F.sort_array(F.collect_list("fp")).alias("all")).filter("size(all) > 1")
        one = met.select("all", F.posexplode("all").alias("i", "a"))
        pairs = one.select("a", F.explode(F.expr("slice(all, i + 2, size(all))")).alias("b"))
    pairs = pairs.filter((F.col("a") != F.col("b")) & (hamming(F.col("a"), F.col("b")) <= max_bits))
    return pairs.distinct()


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row (id, fp, component_id, label) per row of ``docs``.

    ``component_id`` is the smallest id of a row whose fingerprint can be
    reached over links of at most ``max_bits`` differing bits (the row's own
    included), ``label`` the smallest such fingerprint.  Null and wordless texts have fingerprint 0, which links like
    any other.  Rows with a null id are kept and take part in linking; a
    component of null ids only has a null ``component_id``.  Repeated rows
    each keep their row.  Other columns are ignored; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    fp = scratch.save(fingerprints(docs, text, id, shingle), "fp")
    classes = scratch.save(fp.groupBy("fp").agg(F.min("id").alias("lo")), "classes")
    cc = scratch.save(connected_components(spark, ball_edges(classes, max_bits), scratch), "cc")
    named = classes.join(cc.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "lo", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("lo").alias("component_id"))
    label = scratch.save(named.join(least, "label").select("fp", "component_id", "label"), "labels")
    return fp.join(label, "fp").select("id", "fp", "component_id", "label")
