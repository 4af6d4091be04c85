"""Ranked lexical search, reversed: the items are indexed, documents stream.

The few items (queries) are turned into an inverted index from term to
(item, repeats).  Blocks of items of bounded size are broadcast one after
another; every document is read once per block:

1. a pass over the texts counts each document's terms, of which those that
   the block knows are kept, as a table of (length, terms, counts) in the
   shared folder;
2. document frequencies are summed from that table per task, then over tasks;
3. a pass over the table sends each document's counts through the index and
   updates one bounded heap per item; the heaps of all tasks are merged by
   two rounds of ranking.

All scores are integers: exact, whatever the order of sums.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, batches_of, texts_as_bytes

#: Bounds of a block: (item, term) pairs and items.  An item is never split.
BLOCK_TERMS = 1 << 18
BLOCK_ITEMS = 1 << 10
_DOCS = 1024
_SLICES = 64
_LAST = (1 << 63) - 1

#: ASCII letters (lower-cased), ASCII digits and all bytes of other
#: characters make up terms; everything else separates them.
_FOLD = bytes(c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c
              if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    """A term's weight from its document frequency."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches_of(batches, 64):
        found = [Counter(terms(t or b"")) for t in texts_as_bytes(b.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [b.column("item_id"), pa.array([[w.decode() for w in c] for c in found], pa.list_(pa.string())),
             pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], ["item_id", "terms", "repeats"])


class Index:
    """Inverted index of a block of items: term -> (items, repeats)."""

    def __init__(self, items: list[tuple[int, list[str], list[int]]]):
        self.uids = [u for u, _, _ in items]
        post: dict[bytes, tuple[list, list]] = {}
        for i, (_, words, repeats) in enumerate(items):
            for w, n in zip(words, repeats):
                at = post.setdefault(w.encode(), ([], []))
                at[0].append(i)
                at[1].append(n)
        self.number = {w: j for j, w in enumerate(post)}
        self.post = [(np.array(i), np.array(n, np.int64)) for i, n in post.values()]


def blocks(items: DataFrame, most_terms: int, most_items: int) -> Iterator[Index]:
    """The items with a term as indexes of bounded size, streamed."""
    held, size = [], 0
    for r in items.filter(F.size("terms") > 0).toLocalIterator():
        if held and (size + len(r.terms) > most_terms or len(held) >= most_items):
            yield Index(held)
            held, size = [], 0
        held.append((r.uid, r.terms, r.repeats))
        size += len(r.terms)
    if held:
        yield Index(held)


def _counts(index):
    """(doc_id, n, t, f): length of a document in terms, the numbers of its
    indexed terms and their occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value.number
        for b in batches_of(batches, 256):
            n, t, f = [], [], []
            for text in texts_as_bytes(b.column("text")):
                words = terms(text or b"")
                count = Counter(words)
                known = [w for w in count if w in number]
                n.append(len(words))
                t.append([number[w] for w in known])
                f.append([count[w] for w in known])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(t, pa.list_(pa.int32())),
                                              pa.array(f, pa.list_(pa.int64()))], ["doc_id", "n", "t", "f"])
    return run


def _document_frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(b.column("t").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], ["t", "df"])
    return run


class Heaps:
    """One heap of at most ``k`` (score, -id, id is known) per item, the
    worst entry at its root."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n)]
        self.score, self.id = np.zeros(n, np.int64), np.full(n, -_LAST - 1)     # what a newcomer must beat

    def offer(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        """Documents of ``scores`` (document, item); null ids come as the
        largest number with ``known`` false."""
        better = (scores > self.score) | ((scores == self.score) & (ids[:, None] < self.id))
        for i in np.flatnonzero(better.any(axis=0)).tolist():
            at, heap = np.flatnonzero(better[:, i]), self.heaps[i]
            if len(at) > self.k:
                at = at[np.lexsort((ids[at], -scores[at, i]))[:self.k]]
            for s, d, ok in zip(scores[at, i].tolist(), ids[at].tolist(), known[at].tolist()):
                (heapq.heappush if len(heap) < self.k else heapq.heappushpop)(heap, (s, -d, ok))
            if len(heap) == self.k:
                self.score[i], self.id[i] = heap[0][0], -heap[0][1]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for i, heap in enumerate(self.heaps):
            for s, d, ok in heap:
                yield i, -d if ok else None, s


def score_documents(post: list, w: np.ndarray, n_items: int, m: np.ndarray, doc: np.ndarray, t: np.ndarray,
                    f: np.ndarray) -> np.ndarray:
    """Scores (document, item) of a batch from its postings (doc, t, f)."""
    out = np.zeros((len(m), n_items), np.int64)
    part = w[t] * (1_000_000_000 * f // (1000 * f + 8 * m[doc]))
    order = np.argsort(t, kind="stable")
    t, doc, part = t[order], doc[order], part[order]
    cut = np.flatnonzero(np.diff(t, prepend=-1, append=-1))
    for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
        items, repeats = post[t[a]]
        out[doc[a:z, None], items] += part[a:z, None] * repeats
    return out


def _rank(index, weights, n_docs: int, length: int, k: int):
    """Best documents per item of a task: (item, doc_id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        post, w = index.value.post, weights.value
        heaps = Heaps(len(index.value.uids), k)
        for b in batches_of(batches, _DOCS):
            n = b.column("n").to_numpy()
            lens = b.column("t").value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(n)), lens)
            m = 25 + 75 * n * n_docs // length
            scores = score_documents(post, w, len(index.value.uids), m, doc, b.column("t").flatten().to_numpy(),
                                     b.column("f").flatten().to_numpy())
            ids = b.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            heaps.offer(scores, ids.fill_null(_LAST).to_numpy(), known)
        rows = list(heaps.rows())
        yield pa.RecordBatch.from_arrays([pa.array([index.value.uids[i] for i, _, _ in rows], pa.int64()),
                                          pa.array([d for _, d, _ in rows], pa.int64()),
                                          pa.array([s for _, _, s in rows], pa.int64())], ["uid", "doc_id", "score"])
    return run


def search(documents: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = 10, block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a
    score above 0, ranked by falling score, then rising id.

    A score sums, over the item's terms with their repeats, the term's weight
    (from document frequency) times its saturated frequency (from occurrences
    and the document's length).  Statistics are of all documents; those
    without a term, null texts among them, count nowhere.  Every row of
    ``items`` is an item of its own, repeated or null ids included; items
    without a term have no rows.  Repeated documents are ranked each; ids are
    integers, a null id comes after all others of the same score.  Other
    columns are ignored; empty tables give an empty result.
    """
    spark = documents.sparkSession
    sc = spark.sparkContext
    scratch = Scratch(spark, "search")
    kind = items.schema[item_id].dataType.simpleString()
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    named = named.mapInArrow(_item_terms, f"item_id {kind}, terms array<string>, repeats array<long>")
    named = scratch.save(named.withColumn("uid", F.monotonically_increasing_id()), "items")
    docs = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found, hits = [], "uid long, doc_id long, score long"
    n_docs = length = None
    for b, index in enumerate(blocks(named, block_terms, block_items)):
        shared = sc.broadcast(index)        # at most block_terms pairs, or one item
        counts = docs.mapInArrow(_counts(shared), "doc_id long, n long, t array<int>, f array<long>")
        counts = scratch.save(counts, f"counts{b}")
        if n_docs is None:
            n_docs, length = counts.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
        used = counts.filter(F.size("t") > 0)
        df = used.select("t").mapInArrow(_document_frequencies(len(index.number)), "t int, df long")
        w = np.zeros(len(index.number), np.int64)
        for r in df.groupBy("t").agg(F.sum("df").alias("df")).toLocalIterator():
            w[r.t] = weight(n_docs, r.df)
        weights = sc.broadcast(w)
        scratch.save(used.mapInArrow(_rank(shared, weights, n_docs, length, k), hits), f"best{b}")
        found.append(scratch.paths[f"best{b}"])
        scratch.drop(f"counts{b}")
        shared.unpersist()
        weights.unpersist()
    best = spark.read.schema(hits).parquet(*found) if found else spark.createDataFrame([], hits)
    best = best.filter("score > 0").withColumn("slice", F.spark_partition_id() % _SLICES)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    for by in (("uid", "slice"), ("uid",)):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    return best.join(named.select("uid", "item_id"), "uid").select("item_id", "rank", "doc_id", "score")
