"""Sources and sinks: raw CSV logs, partitioned feature tables, slices,
run logs, partition coverage."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import epoch_us, from_epoch_us
from tidewatch.operators.resample import CHUNK, spine
from tidewatch.operators.sequence import as_list, interval_us, join_on


def raw_schema(columns: Sequence[str]) -> T.StructType:
    """All-string schema for header CSV logs (no inference pass)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_raw_csv(spark: SparkSession, paths, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV (gz allowed) with every column as text.  Passing
    ``columns`` avoids the header/schema job."""
    r = spark.read.option("header", True)
    if columns:
        r = r.schema(raw_schema(columns))
    return r.csv(paths)


def recent_folders(spark: SparkSession, root: str, end: _dt.datetime, hours: int) -> list[str]:
    """The ``date=YYYY-MM-DD/hr=H`` folders under ``root`` of the last
    ``hours`` hours that exist.  Only the days in question are looked into
    (one glob each); hours may be written with or without a leading zero."""
    wanted = {(t.strftime("%Y-%m-%d"), t.hour) for t in (end - _dt.timedelta(hours=h) for h in range(hours))}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for day in sorted({d for d, _ in wanted}):
        for x in fs.globStatus(path(f"{root}/date={day}/hr=*")) or []:
            hour = x.getPath().getName()[3:]
            if hour.isdigit() and (day, int(hour)) in wanted:
                found.append(f"{root}/date={day}/hr={hour}")
    return found


def read_recent(spark: SparkSession, root: str, end: _dt.datetime, hours: int,
                fmt: str = "csv", columns: Sequence[str] | None = None) -> DataFrame:
    """Last ``hours`` hours of a ``date=YYYY-MM-DD/hr=HH`` partitioned table.

    Only the wanted folders are listed (:func:`recent_folders`); missing ones
    are skipped, and ``date`` and ``hr`` stay columns (``basePath``).  Where
    none exists the result is empty: of the given ``columns``, or of
    ``date`` and ``hr`` only.
    """
    r = spark.read.option("basePath", root)
    part = [T.StructField("date", T.StringType()), T.StructField("hr", T.StringType())]
    named = T.StructType([*(raw_schema(columns).fields if columns else []), *part])
    if fmt == "csv":
        r = r.option("header", True)
        if columns:
            r = r.schema(named)
    paths = recent_folders(spark, root, end, hours)
    if not paths:
        return spark.createDataFrame([], named)
    return r.format(fmt).load(paths)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """Parquet under any directory layout (partition folders ignored)."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def write_features(df: DataFrame, path: str, *, time: str = "time", partition_by=("date",),
                   sort_by: Sequence[str] = ()) -> None:
    """Overwrite a feature table partitioned by day; rows are sorted within
    files (no global sort) so readers get good min/max statistics."""
    d = df
    if "date" in partition_by and "date" not in d.columns:
        d = d.withColumn("date", F.to_date(F.col(time)))
    if sort_by:
        d = d.sortWithinPartitions(*sort_by)
    d.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_run_log(df: DataFrame, path: str) -> None:
    """Append run metrics (one row per series and run) as Parquet."""
    df.write.mode("append").parquet(path)


#: Units of a fixed length, whose buckets need no calendar.
_FIXED = {"second", "minute", "hour", "day"}


def partition_coverage(df: DataFrame, keys, time: str, unit: str = "hour", *, chunk: int = CHUNK) -> DataFrame:
    """Missing ``unit`` buckets per key between its first and last bucket.

    Expected buckets are unfolded in chunks (output sized; units of a fixed
    length), or by the calendar (weeks, months, years), present ones come
    from a distinct projection; a left-anti join keeps the gaps.  Rows with a
    null time count nowhere.
    """
    keys = as_list(keys)
    b = F.date_trunc(unit, time).cast("timestamp_ntz")
    present = df.select(*keys, b.alias("bucket")).filter("bucket IS NOT NULL").distinct()
    if unit in _FIXED:
        rng = present.groupBy(*keys).agg(epoch_us(F.min("bucket")).alias("_lo"), epoch_us(F.max("bucket")).alias("_hi"))
        expected = spine(rng, keys, interval_us(f"1 {unit}"), chunk).select(*keys, from_epoch_us(F.col("_b")).alias("bucket"))
    else:
        rng = present.groupBy(*keys).agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi"))
        step = F.expr(f"INTERVAL 1 {unit.upper()}")
        expected = rng.select(*keys, F.explode(F.sequence("_lo", "_hi", step)).alias("bucket"))
    return join_on(expected, present, [*keys, "bucket"], "left_anti")
