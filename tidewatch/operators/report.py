"""Reports over slice scores and anomaly tables, plus segment-level,
two-stage and hierarchical-rollup detection.

Global statistics are one-row aggregates joined back by broadcast (one row:
a proven size bound).  Quantiles are exact at every size, with linear
interpolation, and come from row ranks rather than from a buffer of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ewma import ewma_detect
from tidewatch.operators.sequence import as_list, join_on, percentiles_by_rank
from tidewatch.session import materialize


def slice_dev_score(vectors: DataFrame, col: str = "x", out: str = "score") -> DataFrame:
    """Baseline slice score: L2 distance of a slice from its own mean."""
    x = F.col(col)
    mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x)
    dev = F.transform(x, lambda v: (v - mean) * (v - mean))
    return vectors.withColumn(out, F.sqrt(F.aggregate(dev, F.lit(0.0), lambda a, v: a + v)))


def score_threshold(scores: DataFrame, percentile: float = 99.0, score: str = "score") -> DataFrame:
    """One row: the interpolated ``percentile`` of all scores."""
    return percentiles_by_rank(scores, [], score, [percentile / 100], ["threshold"])


def with_outlier_flag(scores: DataFrame, percentile: float = 99.0, score: str = "score") -> DataFrame:
    """``is_outlier = score > threshold`` (strict), threshold broadcast."""
    scores = materialize(scores)      # read for the threshold and for the rows
    thr = score_threshold(scores, percentile, score)
    return scores.crossJoin(F.broadcast(thr)).withColumn("is_outlier", F.col(score) > F.col("threshold"))


def score_summary(scores: DataFrame, percentile: float = 99.0, score: str = "score") -> DataFrame:
    """One row: threshold, mean, population std, count, anomalies."""
    flagged = with_outlier_flag(scores, percentile, score)
    return flagged.agg(F.first("threshold").alias("threshold"), F.avg(score).alias("mean"),
                       F.stddev_pop(score).alias("std"), F.count(F.lit(1)).alias("n"),
                       F.count_if("is_outlier").alias("n_anomalies"))


def score_histogram(scores: DataFrame, bins: int = 30, score: str = "score") -> DataFrame:
    """Equal-width histogram of all scores (no sampling): bin, lo, hi, count.
    Equal scores all fall into bin 0, whose edges are then that score."""
    rng = scores.agg(F.min(score).alias("_mn"), F.max(score).alias("_mx"))
    d = scores.select(score).crossJoin(F.broadcast(rng))
    width = (F.col("_mx") - F.col("_mn")) / bins
    b = F.floor(F.try_divide(F.col(score) - F.col("_mn"), F.col("_mx") - F.col("_mn")) * bins)
    d = d.withColumn("bin", F.least(F.coalesce(b, F.lit(0)), F.lit(bins - 1)).cast("int"))
    h = d.groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.first("_mn").alias("_mn"),
                             F.first("_mx").alias("_mx"))
    return h.select("bin", (F.col("_mn") + F.col("bin") * width).alias("lo"),
                    (F.col("_mn") + (F.col("bin") + 1) * width).alias("hi"), "count")


def slice_profile(scores: DataFrame, col: str = "x", flag: str = "is_outlier") -> DataFrame:
    """Per position and class (normal / abnormal): mean, population std and
    10th / 90th percentiles of slice values."""
    d = scores.select(flag, F.posexplode(col).alias("pos", "v"))
    g = d.groupBy(flag, "pos").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count(F.lit(1)).alias("n"))
    g = join_on(g, percentiles_by_rank(d, [flag, "pos"], "v", [0.1, 0.9], ["p10", "p90"]), [flag, "pos"], "left")
    return g.select(flag, "pos", "mean", "std", "p10", "p90", "n")


def sample_slices(scores: DataFrame, n: int, order_key, flag: str | None = None,
                  category: bool | None = None) -> DataFrame:
    """Up to ``n`` slices of a category in a deterministic pseudo-random
    order (``order_key`` is a Column hash); a top-n, so each task keeps
    only ``n`` rows."""
    d = scores if category is None else scores.filter(F.col(flag) == F.lit(category))
    return d.orderBy(order_key).limit(n)


def select_by_score(scores: DataFrame, category, score: str = "score",
                    threshold: str = "threshold") -> DataFrame:
    """``normal`` (<= threshold), ``abnormal`` (>) or an inclusive (lo, hi)."""
    s = F.col(score)
    if category == "normal":
        return scores.filter(s <= F.col(threshold))
    if category == "abnormal":
        return scores.filter(s > F.col(threshold))
    lo, hi = category
    return scores.filter(s.between(lo, hi))


def entity_of_slices(scores: DataFrame, id_col: str = "series_id", out: str = "entity") -> DataFrame:
    return scores.withColumn(out, F.substring_index(F.col(id_col), "_", 1))


# ---------------------------------------------------------------------------
# granularity, two-stage, roll-up
# ---------------------------------------------------------------------------

def segment_series(df: DataFrame, segment_keys, time: str, value: str, how: str = "sum") -> DataFrame:
    """Aggregate entity series into one series per segment (cohort model)."""
    agg = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}[how]
    return df.groupBy(*as_list(segment_keys), time).agg(agg(value).alias(value))


def detect_by_segment(df: DataFrame, segment_keys, time: str, value: str, how: str = "sum",
                      **ewma_kw) -> DataFrame:
    """EWMA detection at segment granularity (``[]`` = global model)."""
    keys = as_list(segment_keys)
    seg = segment_series(df, keys, time, value, how)
    if not keys:
        seg = seg.withColumn("_global", F.lit(0))
        keys = ["_global"]
    out = ewma_detect(seg, keys, time, value, **ewma_kw)
    return out.drop("_global") if "_global" in out.columns else out


def two_stage_detect(df: DataFrame, keys, time: str, value: str, *, stage1: dict, stage2,
                     tiebreak=()) -> DataFrame:
    """Cheap stage 1 (EWMA) picks candidate series; the expensive stage 2
    (a function ``df -> anomalies``) runs only on rows of those series,
    selected by a left-semi join on the candidate keys."""
    keys = as_list(keys)
    cand = ewma_detect(df, keys, time, value, tiebreak=tiebreak, **stage1).select(*keys).distinct()
    # stage 2 reads its rows several times: without the cut each would repeat stage 1
    return stage2(materialize(join_on(df, cand, keys, "left_semi")))


def anomaly_rollup(anomalies: DataFrame, levels) -> DataFrame:
    """Anomaly counts at every level of a hierarchy (``rollup``), e.g.
    region -> nation -> supplier; ``level`` tells how many leading levels
    are set (0 = grand total)."""
    levels = as_list(levels)
    g = anomalies.rollup(*levels).agg(F.count(F.lit(1)).alias("n_anomalies"),
                                      F.grouping_id().alias("_gid"))
    nset = sum(1 for _ in levels)
    lvl = F.lit(nset) - F.bit_count(F.col("_gid"))
    return g.withColumn("level", lvl.cast("int")).drop("_gid")
