"""Per-series statistics: scaling, rolling / weighted std, percentiles,
tail trimming, rolling z-score detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalar import directional_flag
from tidewatch.operators.ewma import ew_std_expr, scaled_expr, scaler_stats
from tidewatch.operators.sequence import (DEFAULT_BLOCK, POS, as_list, join_on,
                                          percentiles_by_rank, rolling_std_runs, series_windowed)


def attach_by_key(df: DataFrame, stats: DataFrame, keys) -> DataFrame:
    """Join a per-series table to rows on the keys.  AQE broadcasts it when
    its runtime size is under the broadcast threshold and splits skewed
    key partitions otherwise."""
    return join_on(df, stats, as_list(keys))


def scale_series(df: DataFrame, keys, time: str, value: str, scaler="standard", *, out: str = "scaled",
                 tiebreak=(), block: int = DEFAULT_BLOCK) -> DataFrame:
    """Per-series scaling (``standard``: population std; ``minmax``; zero
    spread divides by 1).  Stats reach rows through the block table."""
    stats = scaler_stats(value, scaler)
    d = series_windowed(df, keys, [time, *as_list(tiebreak)], 0,
                        lambda w: {out: scaled_expr(value, scaler)}, block=block, stats=stats)
    return d.drop(*stats.keys())


def unscale_series(df: DataFrame, keys, value: str, scaled: str, scaler="standard", *,
                   out: str = "unscaled") -> DataFrame:
    """Inverse of :func:`scale_series` using the stats of ``value``."""
    keys = as_list(keys)
    st = df.groupBy(*keys).agg(*[c.alias(n) for n, c in scaler_stats(value, scaler).items()])
    d = attach_by_key(df, st, keys)
    s = F.col(scaled)
    if scaler == "standard":
        sd = F.col("_sd")
        e = s * F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd) + F.col("_mu")
    elif scaler == "minmax":
        rng = F.col("_mx") - F.col("_mn")
        e = s * F.when(rng == 0, F.lit(1.0)).otherwise(rng) + F.col("_mn")
    else:
        e = scaler.inverse(s)
    return d.withColumn(out, e).drop("_mu", "_sd", "_mn", "_mx")


def rolling_std(df: DataFrame, keys, time: str, value: str, window: int, *, shift: int = 0,
                out: str = "rolling_std", tiebreak=(), block: int = DEFAULT_BLOCK) -> DataFrame:
    """Sample std of the last ``window`` values (ending ``shift`` rows back);
    null unless the frame holds ``window`` non-null values."""
    keys = as_list(keys)
    return series_windowed(df, keys, [time, *as_list(tiebreak)], shift + window - 1, lambda w: {out: F.col(value).cast("double")},
                           block=block, runs=rolling_std_runs(keys, out, window, shift))


def ew_std(df: DataFrame, keys, time: str, value: str, span: int, *, shift: int = 0,
           out: str = "ew_std", tiebreak=(), block: int = DEFAULT_BLOCK) -> DataFrame:
    """Exponentially weighted std over exactly ``span`` values (normalised
    weights, newest heaviest); null for the first ``span`` rows."""
    def build(w):
        frame = w.rowsBetween(-(shift + span - 1), -shift)
        return {out: ew_std_expr(F.col(value), frame, span, F.col(POS))}
    return series_windowed(df, keys, [time, *as_list(tiebreak)], shift + span - 1, build, block=block)


def series_percentiles(df: DataFrame, keys, value: str, qs: Sequence[float],
                       names: Sequence[str] | None = None) -> DataFrame:
    """Exact per-series percentiles with linear interpolation, by rank (see
    :func:`~tidewatch.operators.sequence.percentiles_by_rank`)."""
    names = list(names or [f"p{int(round(q * 100)):02d}" for q in qs])
    return percentiles_by_rank(df, keys, value, qs, names)


def trim_tails(df: DataFrame, keys, value: str, keep_percent: float) -> DataFrame:
    """Keep the central ``keep_percent`` % of each series (inclusive)."""
    if keep_percent >= 100:
        return df
    lo = (100 - keep_percent) / 2 / 100
    st = series_percentiles(df, keys, value, [lo, 1 - lo], ["_lo", "_hi"])
    d = attach_by_key(df, st, keys)
    return d.filter(F.col(value).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def rolling_detect(df: DataFrame, keys, time: str, value: str, *, train: int = 100, k: float = 3.0,
                   direction: str = "both", tiebreak=(), only_anomalies: bool = True,
                   block: int = DEFAULT_BLOCK) -> DataFrame:
    """Disposable sliding model: each row is tested against the mean and
    sample std of the ``train`` rows before it (train i..i+99, test i+100,
    advance one).  Frames replace materialised slices, so there is no
    ``train``-fold blow-up."""
    def build(w):
        frame = w.rowsBetween(-train, -1)
        full = F.count(value).over(frame) == train
        return {"train_mean": F.when(full, F.avg(value).over(frame)),
                "train_std": F.when(full, F.stddev_samp(value).over(frame))}
    d = series_windowed(df, keys, [time, *as_list(tiebreak)], train, build, block=block)
    d = (d.withColumn("lo", F.col("train_mean") - k * F.col("train_std"))
          .withColumn("hi", F.col("train_mean") + k * F.col("train_std")))
    d = d.withColumn("is_outlier", directional_flag(value, "lo", "hi", direction))
    return d.filter("is_outlier") if only_anomalies else d
