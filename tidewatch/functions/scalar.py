"""Column-level helpers (JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch() -> Column:
    # built lazily: module import must not need a SparkContext (Python workers)
    return F.lit(_dt.datetime(1970, 1, 1)).cast("timestamp_ntz")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(c) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ column.

    ``timestamp_diff`` on NTZ values does not depend on the session time
    zone, so results agree with engines whose timestamps are naive.
    """
    return F.timestamp_diff("MICROSECOND", _epoch(), col(c).cast("timestamp_ntz"))


def from_epoch_us(c) -> Column:
    return F.timestamp_add("MICROSECOND", col(c).cast("long"), _epoch())


def parse_epoch_ms(c, truncate_to_second: bool = True) -> Column:
    """Epoch-millisecond text -> TIMESTAMP_NTZ; malformed text -> null.

    ``truncate_to_second`` mirrors the original job, which went through a
    whole-second formatted string.
    """
    ms = col(c).try_cast("long")
    if truncate_to_second:
        ms = F.floor(ms / 1000) * 1000
    return from_epoch_us(ms * 1000)


def clean_id(c, chars: str = '"') -> Column:
    """Strip quote characters from an identifier."""
    return F.regexp_replace(col(c), "[" + chars.replace("\\", "\\\\") + "]", "")


def to_numeric(c, decimals: int | None = 2) -> Column:
    """Text -> double, malformed -> null (``try_cast``), optionally rounded."""
    v = col(c).try_cast("double")
    return F.round(v, decimals) if decimals is not None else v


def zero_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(0))


def log1p_clamped(c, decimals: int | None = 2) -> Column:
    """``log1p(max(x, 0))`` keeping nulls null, rounded."""
    x = col(c)
    v = F.log1p(F.when(x < 0, F.lit(0.0)).otherwise(x))
    return F.round(v, decimals) if decimals is not None else v


def directional_flag(x, lo, hi, direction: str) -> Column:
    """Strict out-of-band test.  ``direction`` is low/high/both (aliases
    lower/upper accepted).  Null comparisons count as not flagged."""
    d = {"lower": "low", "upper": "high"}.get(direction, direction)
    x, lo, hi = col(x), col(lo), col(hi)
    if d == "low":
        e = x < lo
    elif d == "high":
        e = x > hi
    elif d == "both":
        e = (x < lo) | (x > hi)
    else:
        raise ValueError(f"unknown direction {direction!r}")
    return F.coalesce(e, F.lit(False))


def anomaly_type(x, lo, hi, direction: str) -> Column:
    """'low' / 'high' / null label matching :func:`directional_flag`."""
    d = {"lower": "low", "upper": "high"}.get(direction, direction)
    x, lo, hi = col(x), col(lo), col(hi)
    low = F.when(x < lo, F.lit("low"))
    high = F.when(x > hi, F.lit("high"))
    if d == "low":
        return low
    if d == "high":
        return high
    return F.coalesce(low, high)


def series_id(key, start_time, fmt: str = "yyyyMMddHHmmss") -> Column:
    """``<key>_<start time formatted>`` slice identifier."""
    return F.concat_ws("_", col(key).cast("string"), F.date_format(col(start_time), fmt))


def entity_of_slice(c) -> Column:
    """Text before the first underscore of a slice id."""
    return F.substring_index(col(c), "_", 1)
