"""Reshape: wide->long, overlapping slices, head/tail splits, guards."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import series_id
from tidewatch.operators.sequence import (BLK, CUT, DEFAULT_BLOCK, HALO, POS, as_list, attach_series_agg,
                                          block_arrays, block_window, effective_block, join_on,
                                          whole_runs, with_block, with_position)


def wide_to_long(df: DataFrame, ids: Sequence[str], features: Sequence[str],
                 name: str = "feature", value: str = "value") -> DataFrame:
    """One row per (ids, feature); nulls kept.  Values are cast to double
    first because unpivot needs one common type."""
    ids, features = list(ids), list(features)
    d = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    return d.unpivot(ids, features, name, value)


def slice_series(df: DataFrame, keys, time: str, length: int, shift: int | None = None, *,
                 overlap: float | None = None, tiebreak=(), id_col: str = "series_id",
                 time_fmt: str = "yyyyMMddHHmmss", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Overlapping windows of ``length`` rows advancing ``shift`` rows.

    Each row is emitted once per slice that covers it (output-sized work).
    The slices of a row, with their start times, are collected from the rows
    before it in its block, so nothing is shuffled after the rows have been
    dealt to blocks.  Series shorter than ``length`` produce nothing; partial
    tails are dropped.  Adds ``slice_start`` (0-based start position) and
    ``id_col`` = key + '_' + formatted start time.
    """
    shift = slice_shift(length, shift, overlap)
    keys = as_list(keys)
    block = effective_block(block, length - 1)
    d0 = with_position(df, keys, [time, *as_list(tiebreak)])
    d = attach_series_agg(with_block(d0, length - 1, block), d0, keys, {"_n": F.count(F.lit(1))}, block=block)
    p = F.col(POS)
    covering = F.collect_list(F.when(p % shift == 0, F.struct(p.alias("at"), F.col(time).alias("time")))).over(
        block_window(keys).rowsBetween(-(length - 1), 0))
    d = d.withColumn("_slices", covering).filter(~F.col(HALO))
    d = d.withColumn("_slice", F.explode(F.filter("_slices", lambda s: s["at"] + length <= F.col("_n"))))
    d = d.withColumn("slice_start", F.col("_slice.at"))
    d = d.withColumn(id_col, series_id(_key_text(keys), F.col("_slice.time"), time_fmt))
    return d.drop("_n", POS, BLK, HALO, "_slices", "_slice")


def slice_shift(length: int, shift: int | None, overlap: float | None) -> int:
    """Rows by which slices advance, from ``shift`` or the share ``overlap``."""
    if shift is None:
        shift = max(1, int(length * (1 - (overlap or 0.0))))
    if length <= 0 or shift <= 0:
        raise ValueError("length and shift must be positive")
    return shift


def _key_text(keys):
    return F.concat_ws("_", *[F.col(k).cast("string") for k in keys])


#: Values of slices held at once.
_VALUES = 1 << 20


def slice_vectors(df: DataFrame, keys, time: str, value: str, length: int, shift: int | None = None, *,
                  overlap: float | None = None, tiebreak=(), id_col: str = "series_id",
                  time_fmt: str = "yyyyMMddHHmmss", out: str = "x", block: int = DEFAULT_BLOCK) -> DataFrame:
    """The slices of :func:`slice_series` as arrays, one row per slice:
    (keys, ``slice_start``, ``id_col``, ``out``).

    Every block of rows, with the ``length - 1`` rows before it, is one row
    of arrays; the slices that end in it are views of those arrays.  Rows are
    shuffled twice, by range and by block, whatever ``length / shift`` is."""
    shift = slice_shift(length, shift, overlap)
    keys = as_list(keys)
    d = with_position(df.select(*dict.fromkeys([*keys, time, *as_list(tiebreak), value])), keys, [time, *as_list(tiebreak)])
    blocks = block_arrays(d, keys, [time, value], length - 1, block=block)
    kinds = T.StructType([*[blocks.schema[k] for k in keys], T.StructField("slice_start", T.LongType()),
                          T.StructField("_start", blocks.schema[time].dataType.elementType),
                          T.StructField(out, blocks.schema[value].dataType)])

    def cut(batches):
        for b in batches:
            first, own = b.column("first").to_pylist(), b.column("own").to_pylist()
            for i in range(b.num_rows):
                times, values = b.column(time)[i].values, b.column(value)[i].values
                begin = max(0, own[i] - length + 1)
                begin += -(first[i] + begin) % shift
                starts = np.arange(begin, len(values) - length + 1, shift)
                for part in np.array_split(starts, max(1, len(starts) * length // _VALUES)):
                    if len(part):
                        ends = np.arange(0, (len(part) + 1) * length, length, dtype=np.int32)
                        rows = values.take(pa.array((part[:, None] + np.arange(length)).ravel()))
                        yield pa.RecordBatch.from_arrays(
                            [*[b.column(k).take(pa.array(np.full(len(part), i))) for k in keys], pa.array(part + first[i]),
                             times.take(pa.array(part)), pa.ListArray.from_arrays(pa.array(ends), rows)],
                            [*keys, "slice_start", "_start", out])

    got = blocks.mapInArrow(cut, kinds)
    return got.select(*keys, "slice_start", series_id(_key_text(keys), F.col("_start"), time_fmt).alias(id_col), out)


def split_tail(df: DataFrame, keys, time: str, horizon: int, *, tiebreak=(),
               flag: str = "is_test") -> DataFrame:
    """Mark the last ``horizon`` rows of each series (``is_test``)."""
    keys = as_list(keys)
    d = with_position(df, keys, [time, *as_list(tiebreak)], descending=True, name="_rpos")
    return d.withColumn(flag, F.col("_rpos") < horizon).drop("_rpos")


def split_range(df: DataFrame, keys, time: str, lo: int, hi: int | None, *, tiebreak=(),
                flag: str = "in_range") -> DataFrame:
    """Mark rows whose 0-based position is in ``[lo, hi)`` (``hi=None``:
    to the end); negative bounds count from the end (Python slicing)."""
    keys = as_list(keys)
    d = with_position(df, keys, [time, *as_list(tiebreak)])
    if (lo is not None and lo < 0) or (hi is not None and hi < 0):
        d = with_position(d, keys, [time, *as_list(tiebreak)], descending=True, name="_rpos")
        n = F.col(POS) + F.col("_rpos") + 1
    else:
        n = None
    p = F.col(POS)
    lo_e = F.lit(0) if lo is None else (n + lo if lo < 0 else F.lit(lo))
    hi_e = None if hi is None else (n + hi if hi < 0 else F.lit(hi))
    cond = p >= lo_e if hi_e is None else (p >= lo_e) & (p < hi_e)
    return d.withColumn(flag, cond).drop(POS, *(["_rpos"] if n is not None else []))


def split_positions(df: DataFrame, keys, time: str, positions: Sequence[int], *, tiebreak=(),
                    flag: str = "in_list") -> DataFrame:
    """Mark the rows at the listed 0-based positions of each series
    (negative ones count from its end)."""
    keys, order = as_list(keys), [time, *as_list(tiebreak)]
    d = with_position(df, keys, order)
    hit = F.col(POS).isin([p for p in positions if p >= 0])
    back = [-1 - p for p in positions if p < 0]
    if back:
        d = with_position(d, keys, order, descending=True, name="_rpos")
        hit = hit | F.col("_rpos").isin(back)
    return d.withColumn(flag, hit).drop(POS, "_rpos")


def recent_only(df: DataFrame, keys, time: str, n: int, *, tiebreak=()) -> DataFrame:
    """Keep the last ``n`` rows of each series."""
    return split_tail(df, keys, time, n, tiebreak=tiebreak, flag="_keep").filter("_keep").drop("_keep")


def min_points(df: DataFrame, keys, n: int) -> DataFrame:
    """Drop series with fewer than ``n`` rows (left-semi join on the
    qualifying keys; AQE broadcasts or splits skewed keys).  Series whose rows
    are all in one partition, as ``_cut`` of :func:`with_position` tells, are
    counted there and not joined."""
    keys = as_list(keys)
    if CUT in df.columns:
        if df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < n).isEmpty():
            return df
        stay, rest = df.filter(~F.col(CUT)).drop(CUT), df.filter(CUT).drop(CUT)
        stay = stay.mapInArrow(_long_enough(keys, n), stay.schema).withColumn(CUT, F.lit(False))
        # a join may leave a series in pieces: its rows are put in order again
        rest = with_position(min_points(rest, keys, n), keys, [POS]).withColumn(CUT, F.lit(True))
        return stay.unionByName(rest)
    ok = df.groupBy(*keys).count().filter(F.col("count") >= n).select(*keys)
    return join_on(df, ok, keys, "left_semi")


def _long_enough(keys, n: int):
    """The rows of the runs of equal ``keys`` that are ``n`` long at least."""
    def run(batches):
        for b, start in whole_runs(batches, keys):
            of = np.cumsum(start) - 1
            yield b.filter(pa.array((np.bincount(of) >= n)[of]))
    return run
