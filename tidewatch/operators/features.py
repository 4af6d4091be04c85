"""Feature engineering: bucket averages, counter increments, log, fills.

All sequential steps run through the block layer in
:mod:`tidewatch.operators.sequence`; one ``select`` per stage handles all
feature columns sharing a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalar import log1p_clamped
from tidewatch.operators.sequence import (DEFAULT_BLOCK, POS, as_list, ffill_blocked, join_on,
                                          series_windowed, with_position)

STEP_ORDER = ("hourly", "incr", "log", "fill")


def time_bucket_avg(df: DataFrame, keys, time: str, columns: Sequence[str], *, unit: str | None = None,
                    carry_order=None, decimals: int | None = 2) -> DataFrame:
    """Mean of ``columns`` per ``(keys, time bucket)``; every other column is
    carried as its first non-null value by ``carry_order`` (a column or
    several; default: time).

    ``unit=None`` groups on the raw time (the original job's behaviour);
    ``unit='hour'`` etc. truncates first.  Partial aggregation makes this
    safe for hot keys.
    """
    keys, columns = as_list(keys), list(columns)
    t = F.date_trunc(unit, time).cast(df.schema[time].dataType).alias(time) if unit else F.col(time)
    others = [c for c in df.columns if c not in columns and c not in keys and c != time]
    order = F.struct(*as_list(carry_order or time))
    aggs = [(F.round(F.avg(c), decimals) if decimals is not None else F.avg(c)).alias(c) for c in columns]
    aggs += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in others]
    return df.groupBy(*keys, t).agg(*aggs)


def _incr(x1, x2, x3):
    """Increment at a row from its value x1 and the two before (x2, x3)."""
    return F.when(x1 < x2, F.coalesce(x2 - x3, F.lit(0.0))).otherwise(x1 - x2)


def smoothed_increment(df: DataFrame, keys, time: str, columns: Sequence[str], *, tiebreak=(),
                       decimals: int = 2, how: str = "any", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Counter-reset-aware increments.

    ``incr = x - prev`` unless the counter went down, then the previous raw
    increment (0 if none); a negative ``incr`` is replaced by the previous
    ``incr``.  Rows with a null result are dropped (``how='any'`` over the
    columns), so each series loses its first row.
    """
    keys, columns = as_list(keys), list(columns)

    def build(w):
        out = {}
        for c in columns:
            x = [F.lag(c, k).over(w) for k in range(4)]
            x[0] = F.col(c)
            inc = _incr(x[0], x[1], x[2])
            inc_prev = _incr(x[1], x[2], x[3])
            out[c] = F.round(F.when(inc < 0, inc_prev).otherwise(inc), decimals)
        return out

    d = series_windowed(df, keys, [time, *as_list(tiebreak)], 3, build, block=block)
    return d.dropna(how=how, subset=columns)


def log1p_transform(df: DataFrame, columns: Sequence[str], decimals: int = 2) -> DataFrame:
    return df.withColumns({c: log1p_clamped(c, decimals) for c in columns})


def ffill_zeros(df: DataFrame, keys, time: str, columns: Sequence[str], *, tiebreak=(),
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """Replace 0/null by the last non-zero value of the series; leading
    zeros stay null."""
    keys, columns = as_list(keys), list(columns)
    d = with_position(df, keys, [time, *as_list(tiebreak)])
    d = d.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in columns})
    return ffill_blocked(d, keys, columns, block=block).drop(POS)


def forward_fill(df: DataFrame, keys, time: str, columns: Sequence[str], *, tiebreak=(),
                 fallback_excludes_zero: bool = False, scope: str = "global",
                 block: int = DEFAULT_BLOCK) -> DataFrame:
    """:func:`ffill_zeros` plus a fallback for leading gaps: the mean of the
    column over all rows, or with ``scope="entity"`` over the rows of the
    series (zeros counted unless ``fallback_excludes_zero``).

    Global means form a one-row table joined by broadcast, so they make no
    driver round trip; means per series are joined on the keys.
    """
    if scope not in ("global", "entity"):
        raise ValueError(f"unknown scope {scope!r}")
    columns = list(columns)
    aggs = [F.avg(F.nullif(F.col(c), F.lit(0)) if fallback_excludes_zero else F.col(c)).alias(f"_mean_{i}")
            for i, c in enumerate(columns)]
    d = ffill_zeros(df, keys, time, columns, tiebreak=tiebreak, block=block)
    if scope == "global":
        d = d.crossJoin(F.broadcast(df.agg(*aggs)))
    else:
        d = join_on(d, df.groupBy(*as_list(keys)).agg(*aggs), as_list(keys), "left")
    d = d.withColumns({c: F.coalesce(F.col(c), F.col(f"_mean_{i}")) for i, c in enumerate(columns)})
    return d.drop(*[f"_mean_{i}" for i in range(len(columns))])


def run_feature_steps(df: DataFrame, keys, time: str, columns: Sequence[str],
                      steps: Sequence[str] = STEP_ORDER, *, tiebreak=(), unit: str | None = None,
                      carry_order=None, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Ordered step runner over ``hourly, incr, log, fill``.

    Asking for a step runs its prerequisites first; each step runs once;
    ``fill`` alone runs ``hourly`` first.  Columns outside ``columns`` are
    carried through.
    """
    unknown = set(steps) - set(STEP_ORDER)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}")
    need = set(steps)
    if "log" in need:
        need |= {"incr"}
    if "incr" in need or "fill" in need:
        need |= {"hourly"}
    d = df
    for step in STEP_ORDER:
        if step not in need:
            continue
        if step == "hourly":
            d = time_bucket_avg(d, keys, time, columns, unit=unit, carry_order=carry_order)
        elif step == "incr":
            d = smoothed_increment(d, keys, time, columns, tiebreak=tiebreak, block=block)
        elif step == "log":
            d = log1p_transform(d, columns)
        elif step == "fill":
            d = ffill_zeros(d, keys, time, columns, tiebreak=tiebreak, block=block)
    return d
