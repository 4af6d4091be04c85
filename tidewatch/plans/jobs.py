"""End-to-end jobs composed from the operators.

* :func:`preprocess_job` — raw header-CSV telemetry to model-ready slices:
  clean (rename, strip, parse time, project, dedup, cast), zero-as-missing
  forward fill, counter features (bucket mean -> increments -> log ->
  zero fill), overlapping slices.
* :func:`detection_job` — wide feature table to anomalies: unpivot to one
  series per (entity, metric), run the detector ensemble per series,
  return anomalies plus a per-series run log.

Both are ``DataFrame -> DataFrame`` compositions; sinks are separate
(:mod:`tidewatch.sources.io`).  Positions of rows are found, and written to
the checkpoint folder, while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.catalog import DEFAULT_CATALOG, FeatureCatalog
from tidewatch.operators.clean import clean_raw
from tidewatch.operators.ensemble import ensemble, run_metrics
from tidewatch.operators.features import forward_fill, run_feature_steps
from tidewatch.operators.reshape import slice_series, wide_to_long


def preprocess_job(raw: DataFrame, *, catalog: FeatureCatalog = DEFAULT_CATALOG,
                   signal_groups: Sequence[str] = ("signal_quality",),
                   counter_groups: Sequence[str] = ("throughput_data",),
                   steps: Sequence[str] = ("incr", "log", "fill"), slice_length: int | None = 200,
                   slice_shift: int = 1, filters=None, unit: str | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Raw logs -> clean wide frame -> features -> (optionally) slices.
    Rows of one entity with equal times are ordered by ``tiebreak``; where
    that does not tell them apart, by a hash of the whole row."""
    ent, t = catalog.entity, catalog.time
    signals = [c for c in catalog.features(*signal_groups) if c in raw.columns]
    counters = [c for c in catalog.features(*counter_groups) if c in raw.columns]
    d = clean_raw(raw, signals + counters, entity=ent, time=t, filters=filters)
    zero_cols = [c for c in catalog.zero_is_missing if c in d.columns]
    if zero_cols:
        d = forward_fill(d, ent, t, zero_cols, tiebreak=tiebreak)
    if counters:
        d = run_feature_steps(d, ent, t, counters, steps=steps, unit=unit, carry_order=[t, *tiebreak])
    if slice_length:
        d = slice_series(d, ent, t, slice_length, slice_shift, tiebreak=() if counters else tiebreak)
    return d


def detection_job(wide: DataFrame, *, entity: str, time: str, features: Sequence[str],
                  detectors: Sequence[str] = ("kde", "ewma"), params: dict | None = None,
                  rule: str = "any", min_points: int = 10, run_id: str = "") -> tuple[DataFrame, DataFrame]:
    """Wide table -> (anomalies, run log).  Series key = (entity, feature)."""
    long = wide_to_long(wide, [entity, time], features).filter(F.col("value").isNotNull())
    keys = [entity, "feature"]
    anomalies = ensemble(long, keys, time, "value", detectors=detectors, rule=rule, params=params,
                         min_points=min_points)
    log = run_metrics(long, anomalies, keys, detectors=detectors, params=params, run_id=run_id)
    return anomalies, log
