"""Exact k nearest binary codes, by incremental multi-index hashing.

A 64-bit code is cut into ``m`` segments, each indexed by its value.  If two
codes differ in at most ``m * (r + 1) - 1`` bits, some segment differs in at
most ``r``.  Round ``r`` therefore probes, for every query still open, all
segment values at distance exactly ``r``, verifies the full distance of the
codes found, and keeps the best.  A query is closed when its k-th verified
distance is at most ``m * (r + 1) - 1``: nothing nearer can be missing.

A code that differs in more than ``r`` bits in the first ``a`` segments and
in at least ``r`` in the others is ``m * r + a`` away or farther.  So a query
whose k-th distance is already known to be ``d`` probes only its first
``d - m * r + 1`` segments in round ``r``; the last round, by far the
largest, is seldom probed in full.

``m`` follows the number of distinct codes, so that a segment value selects
about ``CODES_PER_VALUE`` codes: a probe is shuffled and sorted, a code it
finds costs one XOR in the join, so a few codes a probe cost the least.

Rows of one code are folded into one entry with its k + 1 smallest ids
(more can never be among the k nearest), found by a group limit that cuts
before the shuffle: a code that a third of all rows share costs k + 1 rows
per task.  Queries of one code are searched once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, hamming

BITS = 64
#: Codes that one value of a segment selects, about.
CODES_PER_VALUE = 4
#: Patterns and queries of a block; a pair of blocks meets in one group.
BLOCK_FLIPS = 1 << 12
BLOCK_QUERIES = 1 << 12


def sign_codes(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, code): bit ``i`` of the code is set when component ``i`` is
    positive.  The code has 64 bits: shorter vectors leave bits unset,
    components after the 64th are not part of it; null or non-finite
    components count as not positive.  A null vector has a null code."""
    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for pdf in rows:
            out = []
            for v in pdf["v"]:
                if v is None:
                    out.append(None)
                    continue
                x = np.asarray(v[:BITS], dtype=float)
                c = int(weights[:len(x)][np.isfinite(x) & (x > 0)].sum(dtype=np.uint64))
                out.append(c - (1 << 64) if c >> 63 else c)
            yield pd.DataFrame({"id": pdf["id"], "code": pd.array(out, dtype="Int64")})

    kind = vectors.schema[id].dataType.simpleString()
    return vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")).mapInPandas(run, f"id {kind}, code long")


def _segments(distinct: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment: about log2(distinct / CODES_PER_VALUE)
    bits wide."""
    m = min(16, round(BITS / math.log2(max(distinct / CODES_PER_VALUE, 16))))
    cuts = [round(i * BITS / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(code, shift: int, width: int):
    mask = (1 << width) - 1 if width < BITS else -1
    return F.shiftrightunsigned(code, shift).bitwiseAND(F.lit(mask).cast("long"))


def _patterns(table: DataFrame | None, width: int, spark, scratch: Scratch, radius: int) -> DataFrame:
    """(flip, top): all patterns of ``radius`` bits of ``width``, each with
    its highest bit, made from those of one bit less (``table``)."""
    if table is None:
        return scratch.save(spark.range(1).select(F.lit(0).cast("long").alias("flip"), F.lit(-1).alias("top")), "flips0")
    longer = table.filter(F.col("top") < width - 1).select(
        "flip", F.explode(F.sequence(F.col("top") + 1, F.lit(width - 1))).alias("top"))
    return scratch.save(longer.select(F.col("flip").bitwiseOR(F.expr("shiftleft(1L, top)")).alias("flip"), "top"),
                        f"flips{radius}")


def _probes(active: DataFrame, segments, radius: int, flips: DataFrame, n_flips: int, n_active: int) -> DataFrame:
    """(q, kth, seg, val) for all segment values at distance ``radius`` in
    the segments that the k-th distance known so far calls for.  The bit
    patterns to flip are a table that Spark makes; patterns and queries are
    dealt to blocks of bounded size, of which every pair meets once (or the
    patterns are broadcast, where Spark finds their table small)."""
    m = len(segments)
    parts = F.array(*[_segment(F.col("q"), shift, width) for shift, width in segments])
    last = F.least(F.lit(m - 1), F.col("kth") - m * radius)
    needed = active.filter(F.col("kth") >= m * radius).withColumn("seg", F.explode(F.sequence(F.lit(0), last)))
    blocks, groups = max(1, -(-n_flips // BLOCK_FLIPS)), max(1, -(-n_active // BLOCK_QUERIES))
    needed = needed.withColumn("at", parts[F.col("seg")]).withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    needed = needed.withColumn("grp", F.pmod(F.xxhash64("q"), F.lit(groups)).cast("int"))
    # a narrower segment takes only the patterns that fit its width
    fits = F.array(*[F.lit(width) for _, width in segments])
    table = flips.select("flip", "top", F.pmod(F.xxhash64("flip"), F.lit(blocks)).cast("int").alias("blk"))
    table = table.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    out = needed.join(table, ["blk", "grp"]).filter(F.col("top") < fits[F.col("seg")])
    return out.select("q", "kth", "seg", F.col("at").bitwiseXOR(F.col("flip")).alias("val"))


def _first_seen(segments, radius: int):
    """Whether the join row's segment is the first that finds the code: no
    segment is nearer, and none before it is as near."""
    apart = F.col("q").bitwiseXOR(F.col("code"))
    ok = F.lit(True)
    for s, (shift, width) in enumerate(segments):
        d = F.bit_count(_segment(apart, shift, width))
        ok = ok & ((d > radius) | ((d == radius) & (F.col("seg") <= s)))
    return ok


def _best(found: DataFrame, keep: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy("d", "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= keep)


def nearest_codes(base: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, id, distance): for every row of ``queries(id, code)``
    the ``k`` rows of ``base(id, code)`` at least Hamming distance, nearer
    first, ties by smaller id; rows with the query's own id are left out.

    Exact: the result equals a full scan.  Rows of ``base`` with a null id
    or code are not searched; queries with a null code return nothing.
    Repeated rows with one id and code count once, repeated queries return
    once.  Fewer than ``k`` other rows: all of them are returned.  Other
    columns of either table are ignored.  Empty tables give an empty result.
    """
    spark = base.sparkSession
    scratch = Scratch(spark, "hamming")
    keep = k + 1
    ids = base.select("id", "code").filter("id IS NOT NULL AND code IS NOT NULL").distinct()
    ids = ids.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).filter(F.col("n") <= keep)
    codes = scratch.save(ids.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = scratch.save(queries.select("id", F.col("code").alias("q")).filter("q IS NOT NULL").distinct(), "queries")
    segments = _segments(codes.count())
    m, widest = len(segments), max(w for _, w in segments)
    entries = None
    for s, (shift, width) in enumerate(segments):
        e = codes.select(F.lit(s).alias("seg"), _segment(F.col("code"), shift, width).alias("val"), "code", "ids")
        entries = e if entries is None else entries.unionAll(e)
    entries = scratch.save(entries, "index")
    active = scratch.save(asked.select("q").distinct().withColumn("kth", F.lit(BITS)), "active")
    kind = base.schema["id"].dataType.simpleString()
    best = spark.createDataFrame([], f"q long, d int, id {kind}")
    done, flips, n_active = best, None, active.count()
    for r in range(widest + 1):
        flips = _patterns(flips, widest, spark, scratch, r)
        # both sides grow with the data and the exploded side looks smaller than it is: never broadcast
        hits = _probes(active, segments, r, flips, math.comb(widest, r), n_active).join(entries.hint("merge"), ["seg", "val"])
        hits = hits.withColumn("d", hamming(F.col("q"), F.col("code"))).filter((F.col("d") <= F.col("kth")) & _first_seen(segments, r))
        found = hits.select("q", "d", F.explode("ids").alias("id")).unionAll(best)
        ranked = scratch.save(_best(found, keep), f"best{r}")
        reach = m * (r + 1) - 1 if r < widest else BITS
        state = ranked.groupBy("q").agg(F.max("d").alias("far"), F.count("*").alias("n"))
        state = active.select("q").join(state, "q", "left").select(
            "q", F.when(F.col("n") >= keep, F.col("far")).otherwise(BITS).alias("kth"))
        closed = (F.col("kth") <= reach) if r < widest else F.lit(True)
        state = scratch.save(state.withColumn("closed", closed), f"state{r}")
        over = ranked.join(state.filter("closed").select("q"), "q", "left_semi").select("q", "d", "id")
        done = done.unionAll(over)
        active = state.filter("NOT closed").select("q", "kth")
        n_active = active.count()
        if not n_active:
            break
        best = ranked.join(active.select("q"), "q", "left_semi").select("q", "d", "id")
    lists = done.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("d", "id"))).alias("near"))
    lists = scratch.save(lists, "lists")
    own = F.filter("near", lambda x: F.coalesce(x["id"] != F.col("id"), F.lit(True)))
    out = asked.join(lists, "q").select("id", F.posexplode(F.slice(own, 1, k)).alias("i", "x"))
    return out.select(F.col("id").alias("query_id"), (F.col("i") + 1).alias("rank"), F.col("x.id").alias("id"),
                      F.col("x.d").alias("distance"))
