"""Token totals kept up to date by signed deltas.

A rollup is a folder of committed batches.  A batch of document changes is
reduced to additive deltas by source, language and tokenizer version
(``+tokens`` for an insert, ``-tokens`` for a delete, ``new - old`` for a
revised count) and written as one Parquet folder named by its batch id.  The
folder counts once Spark's job commit has put ``_SUCCESS`` into it:

* a batch that was committed before is skipped, so replays add nothing;
* a batch whose writer died is overwritten as a whole by the next attempt;
* totals are sums over committed folders, so batches commute.

``compact`` folds exactly the batches that it listed into a new base; one
committed meanwhile stays beside it.  A base counts once the list of the
batches in it is written.  Folded folders and older bases are kept for
``keep_seconds``, so totals taken before a compaction can be read after it;
then ``expire`` leaves a marker for each batch id and deletes its folder.
The list of a base names only folders that still exist, and whether an id was
committed is asked of its folder or marker, so nothing that is read whole
grows with all batches ever committed.  The deltas are partially aggregated
before the shuffle, so a source with a third of all rows costs one row per
task.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
#: Folded folders stay readable for a day.
KEEP_SECONDS = 86_400
_TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"


def change(docs: DataFrame, op: str, tokenizer: str, tokens: Column, old: Column | None = None) -> DataFrame:
    """Changes (source, lang, tokenizer, op, tokens, old_tokens) of one kind
    (``insert``, ``delete`` or ``revise``) for rows with source and lang."""
    none = F.lit(None).cast("long")
    return docs.select(F.col("source").cast("string"), F.col("lang").cast("string"),
                       F.lit(tokenizer).alias("tokenizer"), F.lit(op).alias("op"),
                       tokens.cast("long").alias("tokens"), (none if old is None else old.cast("long")).alias("old_tokens"))


def deltas(changes: DataFrame) -> DataFrame:
    """Additive (docs, tokens) per key.  Null counts are 0, rows with a null
    or unknown op add nothing, null keys are keys of their own, and every
    repeated row counts."""
    n, o = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    signed = F.when(F.col("op") == "revise", n - o).otherwise(sign * n)
    return changes.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("docs"), F.sum(signed).cast("long").alias("tokens"))


class TokenRollup:
    """Totals in the shared folder ``root`` (see the module text)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(conf)

    def _done(self, kind: str) -> list[str]:
        top = self._path(f"{self.root}/{kind}")
        if not self._fs.exists(top):
            return []
        names = [x.getPath().getName() for x in self._fs.listStatus(top)]
        return sorted(n for n in names if self._fs.exists(self._path(f"{self.root}/{kind}/{n}/_SUCCESS")))

    def _exists(self, *parts: str) -> bool:
        return self._fs.exists(self._path("/".join([self.root, *parts])))

    def _base(self) -> tuple[str | None, set]:
        """Latest base and those batches folded into it whose folders were
        there when it was made (the list is written after the base's data,
        so a base with a list is whole)."""
        lists = self._done("folded")
        if not lists:
            return None, set()
        rows = self.spark.read.schema("batch string").parquet(f"{self.root}/folded/{lists[-1]}").collect()
        return lists[-1], {r.batch for r in rows}

    def committed(self, batch: str) -> bool:
        """Whether a batch of that id was ever committed."""
        return self._exists("batch", batch, "_SUCCESS") or self._exists("done", batch)

    def batches(self) -> set:
        """Ids of all committed batches (a listing for small histories and
        tests; no operation needs it)."""
        done = self._path(f"{self.root}/done")
        gone = {x.getPath().getName() for x in self._fs.listStatus(done)} if self._fs.exists(done) else set()
        return gone | set(self._done("batch"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch once; False if that id was committed before.  Ids are
        made of letters, digits, ``-`` and ``.``."""
        if self.committed(batch):
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.root}/batch/{batch}")
        return True

    def _sum(self, base: str | None, batches: list[str]) -> DataFrame:
        paths = [f"{self.root}/batch/{b}" for b in batches] + ([f"{self.root}/base/{base}"] if base else [])
        rows = (self.spark.read.schema(_TOTALS).parquet(*paths) if paths
                else self.spark.createDataFrame([], _TOTALS))
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs != 0 OR tokens != 0")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over the batches committed
        when this is called; keys whose documents and tokens are all gone
        are left out.  It can be read for ``keep_seconds`` after a later
        compaction."""
        # batches first: one that a compaction folds in between is in the list read after it
        there = self._done("batch")
        base, folded = self._base()
        return self._sum(base, [b for b in there if b not in folded])

    def compact(self, keep_seconds: float = KEEP_SECONDS) -> None:
        """Fold the committed batches into a new base.  A crash at any point
        leaves the old base or the new one; batches committed meanwhile
        count beside either.  Folders folded more than ``keep_seconds`` ago,
        which no compaction may outlast, are deleted (:meth:`expire`)."""
        there = self._done("batch")
        last, folded = self._base()
        new = [b for b in there if b not in folded]
        name = f"{int((last or '0').split('-')[0]) + 1:08d}-{uuid.uuid4().hex}"
        self._sum(last, new).write.parquet(f"{self.root}/base/{name}")
        ids = [(b,) for b in there]         # new ones, and folded ones whose folder is still there
        (self.spark.createDataFrame(ids, "batch string").coalesce(1).write.parquet(f"{self.root}/folded/{name}"))
        self.expire(keep_seconds)

    def expire(self, keep_seconds: float = KEEP_SECONDS) -> None:
        """Delete the folders of batches that the latest base, and every base
        of the last ``keep_seconds``, has folded, and older bases."""
        lists = self._done("folded")
        age = lambda n: time.time() - self._fs.getFileStatus(
            self._path(f"{self.root}/folded/{n}/_SUCCESS")).getModificationTime() / 1000
        old = [n for n in lists if age(n) >= keep_seconds]
        if not old:
            return
        rows = self.spark.read.schema("batch string").parquet(f"{self.root}/folded/{old[-1]}").collect()
        for b in sorted({r.batch for r in rows} & self._base()[1]):
            self._fs.create(self._path(f"{self.root}/done/{b}"), True).close()
            self._fs.delete(self._path(f"{self.root}/batch/{b}"), True)
        for n in old[:-1]:
            self._fs.delete(self._path(f"{self.root}/folded/{n}"), True)
            self._fs.delete(self._path(f"{self.root}/base/{n}"), True)
