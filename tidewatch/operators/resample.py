"""Fixed-frequency resampling with an explicit time spine, and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.scalar import epoch_us, from_epoch_us
from tidewatch.operators.sequence import POS, as_list, fill_blocked, interval_us, with_position

FILL_METHODS = ("interpolate", "ffill", "bfill", "zero")


#: Buckets of a chunk of the spine.
CHUNK = 1 << 16


def spine_chunks(ranges: DataFrame, keys, us: int, chunk: int = CHUNK) -> DataFrame:
    """(keys, ``_from``, ``_to``): the buckets ``us`` apart from ``_lo`` to
    ``_hi`` of every row of ``ranges``, in chunks of at most ``chunk``."""
    span = us * chunk
    last = F.floor((F.col("_hi") - F.col("_lo")) / span)
    d = ranges.select(*keys, "_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("_chunk"))
    start = F.col("_lo") + F.col("_chunk") * span
    return d.select(*keys, start.alias("_from"), F.least(start + (span - us), F.col("_hi")).alias("_to"))


def _tasks(df: DataFrame) -> int:
    """Tasks for rows that are unfolded after a shuffle.  The number is fixed:
    the shuffled rows are few and small, so tasks coalesced by their bytes
    would leave the unfolding to one of them."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spine(ranges: DataFrame, keys, us: int, chunk: int = CHUNK) -> DataFrame:
    """(keys, ``_b``): every bucket of every range.  The chunks are dealt to
    tasks before they are unfolded, so neither an array nor a task holds the
    whole span of a key (a decade of seconds is 4,813 chunks)."""
    d = spine_chunks(ranges, as_list(keys), us, chunk).repartition(_tasks(ranges), *as_list(keys), "_from")
    return d.select(*as_list(keys), F.explode(F.sequence("_from", "_to", F.lit(us).cast("long"))).alias("_b"))


def resample_mean(df: DataFrame, keys, time: str, value: str, freq="1 hour", *, chunk: int = CHUNK,
                  keep_pos: bool = False) -> DataFrame:
    """Mean of ``value`` per ``freq`` bucket (aligned to the epoch), with
    every empty bucket between a series' first and last one present as a
    null row.

    Only bucket means are shuffled, to chunks of at most ``chunk`` buckets:
    there each is unfolded into its own bucket and the empty ones up to the
    next mean.  A mark at the start of every chunk of a series' range does the
    same for what precedes the first mean.  ``keep_pos`` adds the position in
    the series (``_pos``) and its length (``_n``), which follow from the
    range, so an evenly spaced series needs no ranking of its rows.
    """
    keys = as_list(keys)
    us = interval_us(freq)
    span = F.lit(us * chunk).cast("long")
    bucket_us = F.floor(epoch_us(time) / us) * us
    agg = df.groupBy(*keys, bucket_us.alias("_b")).agg(F.avg(value).alias(value)).filter("_b IS NOT NULL")
    rng = agg.groupBy(*keys).agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    start = lambda c: F.col(c) - F.pmod(F.col(c), span)
    marks = rng.select(*keys, "_lo", "_hi", F.explode(F.sequence(start("_lo"), start("_hi"), span)).alias("_chunk"))
    marks = marks.withColumns({"_b": F.greatest("_chunk", "_lo"), "_mark": F.lit(True)})
    d = agg.withColumns({"_chunk": start("_b"), "_mark": F.lit(False)}).unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_b", F.desc("_mark"))
    known = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)     # the mark comes first
    d = d.repartition(_tasks(df), *keys, "_chunk").withColumns({
        "_lo": F.first("_lo").over(known), "_hi": F.first("_hi").over(known), "_next": F.lead("_b").over(w)})
    d = d.withColumn("_to", F.coalesce(F.col("_next"), F.least(F.col("_chunk") + span, F.col("_hi") + us)) - us)
    d = d.filter("_to >= _b").withColumn("_at", F.explode(F.sequence("_b", "_to", F.lit(us).cast("long"))))
    at = [((F.col("_at") - F.col("_lo")) / us).cast("long").alias(POS),
          (((F.col("_hi") - F.col("_lo")) / us).cast("long") + 1).alias("_n")] if keep_pos else []
    return d.select(*keys, from_epoch_us(F.col("_at")).alias(time), F.when(F.col("_at") == F.col("_b"), F.col(value)).alias(value), *at)


def fill_gaps(df: DataFrame, keys, time: str, value: str, method: str = "interpolate",
              *, out: str | None = None, keep_pos: bool = False) -> DataFrame:
    """Fill nulls per series: ``interpolate`` (linear in row position;
    leading nulls stay, trailing nulls keep the last value), ``ffill``,
    ``bfill`` or ``zero``.  Both directions use one set of positions, which
    ``keep_pos`` leaves on the rows (``_pos``); rows that carry them are not
    ranked again."""
    if method not in FILL_METHODS:
        raise ValueError(f"Unknown fill_method: {method}")
    keys = as_list(keys)
    out = out or value
    rest = () if keep_pos else (POS,)
    d = with_position(df, keys, [time]) if POS not in df.columns and (keep_pos or method != "zero") else df
    if method == "zero":
        return d.withColumn(out, F.coalesce(F.col(value), F.lit(0.0))).drop(*rest)
    if method == "ffill":
        return fill_blocked(d, keys, [value], before=[out]).drop(*rest)
    if method == "bfill":
        return fill_blocked(d, keys, [value], after=[out]).drop(*rest)
    d = d.withColumn("_vpos", F.when(F.col(value).isNotNull(), F.col(POS)))
    d = fill_blocked(d, keys, [value, "_vpos"], ["_y0", "_x0"], ["_y1", "_x1"])
    slope = (F.col("_y1") - F.col("_y0")) / (F.col("_x1") - F.col("_x0"))
    interp = slope * (F.col(POS) - F.col("_x0")) + F.col("_y0")
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
               .when(F.col("_y1").isNull(), F.col("_y0"))
               .otherwise(interp))
    return d.withColumn(out, filled).drop("_vpos", "_y0", "_x0", "_y1", "_x1", *rest)
