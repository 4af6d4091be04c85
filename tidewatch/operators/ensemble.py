"""Detector ensembles and run metrics.

Detectors run on the same series; their decisions are combined per row
(``any`` = logical OR, ``all``, or ``vote >= k``).  When only anomalies
are wanted, the flagged rows of each detector (few) are unioned and
grouped, so the base table is never joined again.  Rows are identified by
``(keys, time, tiebreak)``, never by value equality.
"""

from __future__ import annotations

import json
import time as clock
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.operators.arima import CONSTANT, NO_VALUE, TOO_SHORT, arima_detect, auto_ar_seasonal_detect
from tidewatch.operators.ewma import ewma_detect
from tidewatch.operators.forecast import arma11_forecast_detect, auto_ar_detect
from tidewatch.operators.kde import kde_detect
from tidewatch.operators.reshape import min_points as _min_points
from tidewatch.operators.sequence import CUT, POS, as_list, join_on, with_position
from tidewatch.session import materialize

# Defaults of the two runtimes (KDE+EWMA, KDE+EWMA+ARMA), which
# fit on all rows of a series and test only its newest ones.
KDE_EWMA_DEFAULTS = {
    "min_training_points": 10, "filter_percentile": 99, "threshold_percentile": 99,
    "anomaly_direction": "low", "kde_new": ("tail", 1), "recent_window_size": 1, "window": 100,
    "no_of_stds": 3.0, "n_shift": 1, "scaler": None, "min_std_ratio": 0.01, "use_weighted_std": False,
    "bandwidth": 0.5,
}
ENSEMBLE3_DEFAULTS = dict(KDE_EWMA_DEFAULTS, threshold_percentile=95, arima_level=0.995, arima_horizon=1,
                          arima_direction="low")


def detector_flags(df: DataFrame, keys, time: str, value: str, name: str, *, tiebreak=(),
                   params: dict) -> DataFrame:
    """Anomalous rows of one detector: ``(keys, time, tiebreak, value)``."""
    keys, tb = as_list(keys), as_list(tiebreak)
    p = dict(params)
    if name not in ("kde", "ewma") and CUT in df.columns:
        df = df.drop(POS, CUT)
    if name == "kde":
        d = kde_detect(df, keys, time, value, tiebreak=tb, bandwidth=p.get("bandwidth", 0.5),
                       train=p.get("kde_train", "all"), new=p.get("kde_new", "all"),
                       filter_percentile=p.get("filter_percentile", 99),
                       threshold_percentile=p.get("threshold_percentile", 99),
                       direction=p.get("anomaly_direction", "low"))
    elif name == "ewma":
        d = ewma_detect(df, keys, time, value, tiebreak=tb, window=p.get("window", 100),
                        no_of_stds=p.get("no_of_stds", 3.0), n_shift=p.get("n_shift", 1),
                        direction=p.get("anomaly_direction", "low"), scaler=p.get("scaler"),
                        min_std_ratio=p.get("min_std_ratio", 0.01),
                        use_weighted_std=p.get("use_weighted_std", False),
                        recent=p.get("recent_window_size", "all"))
    elif name == "arma":
        d = arma11_forecast_detect(df, keys, time, value, horizon=p.get("arima_horizon", 1),
                                   level=p.get("arima_level", 0.995),
                                   direction=p.get("arima_direction", p.get("anomaly_direction", "low")),
                                   freq=p.get("arima_freq"), fill_method=p.get("arima_fill", "ffill"),
                                   differences=p.get("arima_differences", 0))
        hit = d.filter("is_anomaly").select(*keys, time).distinct()
        # the forecaster keeps no tie-break: a flagged time flags all its rows
        d = join_on(df, hit, [*keys, time], "left_semi")
    elif name in ("arima", "auto_ar", "auto_seasonal"):
        hit = _forecaster(df, keys, time, value, name, p).filter("is_anomaly").select(*keys, time).distinct()
        d = join_on(df, hit, [*keys, time], "left_semi")
    else:
        raise ValueError(f"unknown detector {name!r}")
    return d.select(*keys, time, *tb, value)


def _forecaster(df: DataFrame, keys, time: str, value: str, name: str, p: dict) -> DataFrame:
    """Test rows of the general or an automatic forecaster: ``arima``,
    ``auto_ar`` (one step, order and differencing by AICc) or
    ``auto_seasonal``."""
    kw = {"level": p.get("auto_level", 0.99), "direction": p.get("auto_direction", "low"), "freq": p.get("auto_freq"),
          "fill_method": p.get("auto_fill", "interpolate")}
    if name == "auto_ar":
        return auto_ar_detect(df, keys, time, value, min_points=p.get("min_training_points", 10), **kw)
    if name == "auto_seasonal":
        return auto_ar_seasonal_detect(df, keys, time, value, season=p.get("auto_season", 24), horizon=p.get("auto_horizon", 1),
                                       min_points=p.get("min_training_points", 10), **kw)
    return arima_detect(df, keys, time, value, order=p.get("arima_order", (1, 1, 1)), horizon=p.get("auto_horizon", 1),
                        steps=p.get("arima_steps", 6), **kw)


def ensemble(df: DataFrame, keys, time: str, value: str, *, detectors: Sequence[str] = ("kde", "ewma"),
             tiebreak=(), rule: str = "any", votes: int = 2, params: dict | None = None,
             only_anomalies: bool = True, min_points: int | None = None) -> DataFrame:
    """Per-row ``is_outlier_<detector>`` flags plus the combined
    ``is_outlier``; ``rule`` is ``any``, ``all`` or ``vote`` (>= ``votes``)."""
    keys, tb = as_list(keys), as_list(tiebreak)
    params = dict(params or {})
    base = df.select(*keys, time, *tb, value).filter(F.col(value).isNotNull())
    placed = bool({"kde", "ewma"} & set(detectors))
    if placed:      # written once for all detectors: these two, and the guard, take series where they lie
        base = with_position(base, keys, [time, *tb], cut=CUT)
    if min_points:
        base = _min_points(base, keys, min_points)
    if not placed:
        base = materialize(base)      # every detector reads it several times
    ids = [*keys, time, *tb]
    parts = [detector_flags(base, keys, time, value, n, tiebreak=tb, params=params)
             .withColumn("_det", F.lit(n)) for n in detectors]
    flagged = parts[0]
    for p in parts[1:]:
        flagged = flagged.unionByName(p)
    need = {"any": 1, "all": len(detectors), "vote": votes}[rule]
    flags = [F.max(F.col("_det") == n).alias(f"is_outlier_{n}") for n in detectors]
    if only_anomalies:
        out = flagged.groupBy(*ids, value).agg(*flags, F.countDistinct("_det").alias("_votes"))
        return out.filter(F.col("_votes") >= need).drop("_votes")
    marks = flagged.groupBy(*ids).agg(*flags, F.countDistinct("_det").alias("_votes"))
    out = join_on(base.drop(POS, CUT), marks, ids, "left")
    out = out.withColumns({f"is_outlier_{n}": F.coalesce(F.col(f"is_outlier_{n}"), F.lit(False))
                           for n in detectors})
    return out.withColumn("is_outlier", F.coalesce(F.col("_votes"), F.lit(0)) >= need).drop("_votes")


def ensemble_runtime(df: DataFrame, keys, time: str, value: str, *, detectors: Sequence[str] = ("kde", "ewma"),
                     tiebreak=(), params: dict | None = None) -> DataFrame:
    """The ensemble as it runs on arrival of new data: every detector fits
    on a whole series and tests its newest row.  ``params`` override the
    defaults of the runtime; series with fewer than ``min_training_points``
    rows give nothing."""
    p = {**(ENSEMBLE3_DEFAULTS if "arma" in detectors else KDE_EWMA_DEFAULTS), **(params or {})}
    return ensemble(df, keys, time, value, detectors=detectors, tiebreak=tiebreak, params=p,
                    min_points=p["min_training_points"])


def series_reasons(base: DataFrame, keys, value: str, min_points: int = 10) -> DataFrame:
    """(keys, ``n_points``, ``reason``) per series: why no detector can say
    anything about it (``no value``, ``too short``: fewer than ``min_points``
    values, ``constant``), null where nothing stands in the way."""
    v = F.when(~F.isnan(value), F.col(value)) if dict(base.dtypes)[value] in ("double", "float") else F.col(value)
    g = base.groupBy(*as_list(keys)).agg(F.count(F.lit(1)).alias("n_points"), F.count(v).alias("_v"),
                                         F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    reason = (F.when(F.col("_v") == 0, NO_VALUE).when(F.col("_v") < min_points, TOO_SHORT)
               .when(F.col("_lo") == F.col("_hi"), CONSTANT))
    return g.select(*as_list(keys), "n_points", reason.alias("reason"))


def run_metrics(base: DataFrame, anomalies: DataFrame, keys, *, detectors: Sequence[str],
                params: dict | None = None, run_id: str = "", value: str | None = None,
                min_points: int = 10, seconds: float | None = None) -> DataFrame:
    """One row per series: points, anomalies per detector and in total, the
    parameters as JSON, and ``error``: with ``value``, the reason why the
    series could not be judged (:func:`series_reasons`), null when it could.
    ``seconds`` (of :func:`timed_write`) adds the run's processing time."""
    keys = as_list(keys)
    if value is None:
        n = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_points")).withColumn("reason", F.lit(None).cast("string"))
    else:
        n = series_reasons(base, keys, value, min_points)
    a = anomalies.groupBy(*keys).agg(
        *[F.count_if(F.col(f"is_outlier_{d}")).alias(f"anomalies_{d}") for d in detectors],
        F.count(F.lit(1)).alias("anomalies_detected"))
    out = join_on(n, a, keys, "left")
    out = out.fillna(0, subset=[f"anomalies_{d}" for d in detectors] + ["anomalies_detected"])
    out = out.withColumns({"params": F.lit(json.dumps(params or {}, sort_keys=True, default=str)),
                           "run_id": F.lit(run_id), "error": F.col("reason")}).drop("reason")
    return out if seconds is None else out.withColumn("seconds", F.lit(float(seconds)))


def timed_write(df: DataFrame, path: str, name: str, *, metrics: dict | None = None, mode: str = "overwrite") -> dict:
    """Write a result as Parquet and measure that one pass: its processing
    time and, by ``DataFrame.observe``, its rows and any further ``metrics``
    (aggregate columns by name).  Returns ``{"name", "rows", "seconds", ...}``
    for the run log; nothing is computed twice."""
    seen = Observation(name)
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
    start = clock.perf_counter()
    watched.write.mode(mode).parquet(path)
    return {"name": name, "seconds": clock.perf_counter() - start, **seen.get}
