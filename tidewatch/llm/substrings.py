"""Removal of word passages that repeat across documents, level by level.

A passage of ``window`` words can only repeat where shorter windows inside
it repeat.  Levels double in length (4, 7, 13 for windows of 13 words: a
window of ``2L - 1`` or ``2L`` words is two windows of ``L``), and a window
hash of one level is mixed from two of the level before:

1. *First level.*  Only windows selected by their own content are looked at:
   of every ``window - L + 1`` consecutive windows of ``L`` words the one
   with the least hash (winnowing).  Every passage of ``window`` words holds
   a selected one, and equal passages select the same one, so nothing is
   lost while under a fifth of the positions are shuffled.
2. *Doubling.*  A window that repeats in different texts is extended to the
   next length, once to the right and once to the left; every longer window
   that holds it holds one of the two.  Those that repeat again are extended
   further, the others are dropped, until the level below the full length is
   reached or no candidates survive.
3. *Decision.*  Every ``window``-word window around a survivor of the last
   level is a candidate.  For each of them (96 bits of hash) the smallest
   document id it starts in is aggregated; a window is removed from every
   document with a larger id.

Documents whose whole text equals that of a smaller id are decided by the
text's digest and take no part in the levels.  All aggregates combine
before the shuffle, and joins run between written tables, so a passage that
a third of all documents share is pre-aggregated or split, never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, batches_of, mix64, texts_as_bytes

WINDOW = 13
#: A null id sorts after every other id.
_LAST = (1 << 63) - 1


def levels(window: int, first: int = 4) -> list[int]:
    """Window lengths from the first level to ``window``; each at most
    doubles the one before (13 gives 4, 7, 13)."""
    out = [window]
    while out[0] > first:
        out.insert(0, (out[0] + 1) // 2)
    return out


def word_hashes(words: list, lanes: int = 1) -> np.ndarray:
    """``lanes`` 64-bit hashes of each word, shape (n, lanes)."""
    raw = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)[:, :lanes]


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words from the word hashes, by
    doubling: a window of a level is mixed from two of the level before."""
    if len(h) < length:
        return h[:0]
    steps = levels(length, 1)
    for a, b in zip(steps, steps[1:]):
        h = mix64(h[:-(b - a)], h[b - a:])
    return h


def selected(h: np.ndarray, span: int) -> np.ndarray:
    """Positions that hold the least hash (rightmost of ties) of some run of
    ``span`` consecutive positions."""
    if len(h) < span:
        return np.empty(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(h[::-1], span)
    picks = len(h) - 1 - (np.argmin(runs, axis=1) + np.arange(len(runs)))
    return np.unique(picks)


def _keyed(docs: DataFrame, text: str, id: str) -> DataFrame:
    """(rk, oid, t): row key, ordering id and text."""
    oid = F.coalesce(F.col(id).cast("long"), F.lit(_LAST))
    return docs.select(F.xxhash64(oid, F.col(text)).alias("rk"), oid.alias("oid"), F.col(text).alias("t"))


def _anchors(window: int, length: int, with_place: bool):
    span = window - length + 1

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(rows, 256):
            hs, key, pos = [], [], []
            for k, t in zip(b.column(0).to_pylist(), texts_as_bytes(b.column(1))):
                words = (t or b"").split()
                if len(words) < window:
                    continue
                h = window_hashes(word_hashes(words)[:, 0], length)
                at = selected(h, span)
                if with_place:
                    hs.append(h[at])
                    pos.append(at)
                else:
                    hs.append(np.unique(h[at]))
                    # the text stands for all its copies: a window repeats only across different texts
                    k = xxhash.xxh64_intdigest(t) - (1 << 63)
                key.append(np.full(len(hs[-1]), k, np.int64))
            if not hs:
                continue
            cols = [pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(key))]
            names = ["h", "k"]
            if with_place:
                cols.append(pa.array(np.concatenate(pos).astype(np.int32)))
                names.append("pos")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _extended(length: int, longer: int):
    """Windows of ``longer`` words that begin or end with a repeated window
    of ``length`` words."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(rows, 256):
            hs, key, row, pos = [], [], [], []
            for rk, t, at in zip(b.column("rk").to_pylist(), texts_as_bytes(b.column("t")), b.column("at")):
                h = window_hashes(word_hashes(t.split())[:, 0], longer)
                at = np.asarray(at.values)
                at = np.unique(np.concatenate([at, at + length - longer]))
                at = at[(at >= 0) & (at < len(h))]
                hs.append(h[at])
                key.append(np.full(len(at), xxhash.xxh64_intdigest(t) - (1 << 63)))
                row.append(np.full(len(at), rk))
                pos.append(at)
            if hs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(key).astype(np.int64)),
                     pa.array(np.concatenate(row).astype(np.int64)), pa.array(np.concatenate(pos).astype(np.int32))],
                    names=["h", "k", "rk", "pos"])
    return run


def _candidates(window: int, length: int):
    """Full-length windows that hold a repeated selected window."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(rows, 128):
            out: list[list] = [[], [], [], [], []]
            for rk, oid, t, at in zip(b.column("rk").to_pylist(), b.column("oid").to_pylist(),
                                      texts_as_bytes(b.column("t")), b.column("at")):
                words = t.split()
                n = len(words) - window + 1
                reach = np.asarray(at.values)[:, None] + np.arange(length - window, 1)
                starts = np.unique(reach[(reach >= 0) & (reach < n)])
                lanes = word_hashes(words, 2)
                out[0].append(window_hashes(lanes[:, 0], window)[starts])
                out[1].append(window_hashes(lanes[:, 1], window)[starts])
                out[2].append(np.full(len(starts), oid))
                out[3].append(np.full(len(starts), rk))
                out[4].append(starts)
            if out[0]:
                h1, h2, oid, rk, pos = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                     pa.array(oid), pa.array(rk), pa.array(pos.astype(np.int32))],
                    names=["h1", "h2", "oid", "rk", "pos"])
    return run


def repeated_windows(docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW, first: int = 4,
                     scratch: Scratch | None = None, report: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Windows to remove, by row key ``rk = xxhash64(id, text)``.

    Returns ``(flags, copies)``: ``flags(rk, starts)`` lists the 0-based
    word positions where a removed window starts, ``copies(rk)`` the rows
    whose whole text stands in a row with a smaller id.  ``report``, when
    given, receives ``(length, candidates)`` of every level that was run:
    selected windows of the first that repeat, extended ones of the others.
    """
    scratch = scratch or Scratch(docs.sparkSession, "substrings")
    lengths = levels(window, first)
    rows = _keyed(docs, text, id)
    # whole-text copies
    ids = scratch.save(rows.filter("t IS NOT NULL").select("rk", "oid", F.unhex(F.md5("t")).alias("md5")), "ids")
    least = scratch.save(ids.groupBy("md5").agg(F.min("oid").alias("lo"), F.max("oid").alias("hi"))
                         .filter("lo < hi").select("md5", "lo"), "least")
    copies = scratch.save(ids.join(least, "md5").filter("oid > lo").select("rk").distinct(), "copies")
    scratch.drop("ids")

    def repeated(windows: DataFrame, name: str) -> DataFrame:
        """Hashes of windows that stand in different texts."""
        ends = windows.groupBy("h").agg(F.min("k").alias("a"), F.max("k").alias("b"))
        return scratch.save(ends.filter("a < b").select("h"), name)

    def survivors(windows: DataFrame, again: DataFrame, name: str) -> DataFrame:
        """(rk, at): where the repeated windows of a row start; rows that are
        copies are decided already."""
        at = windows.join(again, "h", "left_semi").groupBy("rk").agg(F.collect_set("pos").alias("at"))
        return scratch.save(at.join(copies, "rk", "left_anti"), name)

    # first level: selected windows that repeat in different texts
    place = rows.select("rk", "t")
    length = lengths[0]
    again = repeated(place.mapInArrow(_anchors(window, length, False), "h long, k long"), "repeated")
    scratch.settle()
    found = survivors(place.mapInArrow(_anchors(window, length, True), "h long, rk long, pos int"), again, "survivors")
    scratch.drop("repeated")
    scratch.settle()
    if report is not None:
        report.append((length, found.agg(F.sum(F.size("at"))).first()[0] or 0))
    # doubling: survivors of one length alone are tried at the next
    for longer in lengths[1:-1]:
        if found.isEmpty():
            break
        tried = place.join(found, "rk").select("rk", "t", "at").mapInArrow(_extended(length, longer), "h long, k long, rk long, pos int")
        tried = scratch.save(tried, "tried")
        if report is not None:
            report.append((longer, tried.count()))
        again = repeated(tried, "repeated")
        scratch.drop("survivors")
        found = survivors(tried, again, "survivors")
        scratch.drop("repeated")
        scratch.drop("tried")
        scratch.settle()
        length = longer
    # the full length
    wide = scratch.save(rows.join(found, "rk").select("rk", "oid", "t", "at")
                        .mapInArrow(_candidates(window, length), "h1 long, h2 int, oid long, rk long, pos int"), "wide")
    if report is not None and length < window:
        report.append((window, wide.count()))
    scratch.drop("survivors")
    scratch.settle()
    owner = scratch.save(wide.groupBy("h1", "h2").agg(F.min("oid").alias("lo"), F.max("oid").alias("hi"))
                         .filter("lo < hi").select("h1", "h2", "lo"), "owner")
    scratch.settle()
    flags = (wide.join(owner, ["h1", "h2"]).filter("oid > lo").groupBy("rk")
             .agg(F.sort_array(F.collect_set("pos")).alias("starts")))
    flags = scratch.save(flags, "flags")
    scratch.drop("wide")
    scratch.drop("owner")
    scratch.settle()
    return flags, copies


def _cut(window: int, keep_layout: bool):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(rows, 256):
            n_words, n_removed, kept = [], [], []
            for t, starts, copy in zip(texts_as_bytes(b.column("t")), b.column("starts"), b.column("copy").to_pylist()):
                words = (t or b"").split()
                n = len(words)
                gone = np.zeros(n + 1, np.int32)
                if copy and n >= window:
                    gone[0], gone[n] = 1, -1
                elif starts.is_valid and len(starts):
                    at = np.asarray(starts.values)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                lost = np.cumsum(gone[:n]) > 0
                n_words.append(n)
                n_removed.append(int(lost.sum()))
                if keep_layout and not n_removed[-1]:
                    kept.append(t)
                else:
                    kept.append(b" ".join([w for w, x in zip(words, lost.tolist()) if not x]))
            rest = [b.column(i) for i in range(b.num_columns) if b.schema.names[i] not in ("t", "starts", "copy")]
            names = [x for x in b.schema.names if x not in ("t", "starts", "copy")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*names, "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW, first: int = 4,
                   keep_layout: bool = False, carry: tuple = ()) -> DataFrame:
    """One row (id, *carry, n_words, n_removed, kept) per row of ``docs``.

    Words are runs of characters other than ASCII white space.  A word is
    removed when a window of ``window`` words that covers it also starts in
    a document with a smaller id; ``kept`` holds the other words joined by
    one space (with ``keep_layout``, the unchanged text where nothing was
    removed).  Windows are judged on the input.  Repeats inside one document
    and between rows of the same id remove nothing.  A null text has no
    words, an empty table gives an empty result, a null id counts as larger
    than every other id.  ``carry`` names further columns to return; other
    columns are ignored, whatever their names.
    """
    flags, copies = repeated_windows(docs, text, id, window, first)
    oid = F.coalesce(F.col(id).cast("long"), F.lit(_LAST))
    cols = [F.col(id).alias("c0"), *[F.col(c).alias(f"c{i + 1}") for i, c in enumerate(carry)]]
    rows = docs.select(*cols, F.xxhash64(oid, F.col(text)).alias("rk"), F.col(text).alias("t"))
    rows = (rows.join(flags, "rk", "left").join(copies.withColumn("copy", F.lit(True)), "rk", "left")
            .withColumn("copy", F.coalesce("copy", F.lit(False))).drop("rk"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name.startswith("c")
                      and f.name != "copy")
    out = rows.mapInArrow(_cut(window, keep_layout), f"{kinds}, n_words long, n_removed long, kept string")
    return out.select(F.col("c0").alias(id), *[F.col(f"c{i + 1}").alias(c) for i, c in enumerate(carry)],
                      "n_words", "n_removed", "kept")
