"""Structured Streaming versions of the main operators.

All functions take a streaming DataFrame and return a streaming DataFrame;
:func:`run_available` drives one to completion (``availableNow``) into a
Parquet sink under the shared checkpoint folder and returns the result as
a batch DataFrame.

Event time: ``withWatermark`` needs a TIMESTAMP column, while the source
times are TIMESTAMP_NTZ.  :func:`event_time` maps NTZ wall-clock values to
the instant with the same UTC reading (independent of the session time
zone) and :func:`ntz` maps window bounds back.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewatch.functions.scalar import epoch_us, from_epoch_us
from tidewatch.session import checkpoint_dir
from tidewatch.operators.recon import load_model_version, model_versions, save_model_version
from tidewatch.operators.sequence import _ewm_params, _ewm_run, _gap_cap, as_list, interval_us

ET = "_event_time"


def event_time(c) -> Column:
    return F.timestamp_micros(epoch_us(c))


def ntz(c) -> Column:
    return from_epoch_us(F.unix_micros(c))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rocksdb(spark: SparkSession) -> None:
    """Let queries started from now on keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def file_stream(spark: SparkSession, folder: str, table: str, max_files: int = 1) -> DataFrame:
    """Parquet file source over ``folder/<table>.parquet``, a file or a
    folder of part files."""
    path = f"{folder}/{table}.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", max_files)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of a stream, shared by all executors."""
    return f"{checkpoint_dir(spark)}/streams/{name}/{uuid.uuid4().hex}"


def arrivals(df: DataFrame, parts: list, name: str) -> DataFrame:
    """A stream of ``df`` that arrives in the given ``parts`` (conditions),
    one micro-batch each: every part is written as one file of a folder, one
    after the other, and read back as a file source."""
    path = f"{run_folder(df.sparkSession, name)}/arrivals"
    for part in parts:
        df.filter(part).coalesce(1).write.mode("append").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_available(sdf: DataFrame, name: str, *, mode: str = "append", idle_batches: bool = True) -> DataFrame:
    """Run a streaming query over everything available, sink to Parquet in
    the checkpoint folder, and return the sink as a batch DataFrame.
    ``idle_batches=False`` is for states with a ``timeout``: Spark asks for
    one more batch without data as long as processing time can expire
    something, so such a run would never be done."""
    spark = sdf.sparkSession
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    run = run_folder(spark, name)
    q = (sdf.writeStream.format("parquet").outputMode(mode)
            .option("path", f"{run}/data").option("checkpointLocation", f"{run}/_checkpoint")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(sdf.schema).parquet(f"{run}/data")


# -- T1 / T2: tumbling and sliding window statistics ------------------------

def stream_bucket_avg(sdf: DataFrame, keys, time: str, value: str, *, window: str = "1 hour",
                      delay: str = "1 hour") -> DataFrame:
    """Tumbling-window mean and count per key; a window is emitted once the
    watermark (max event time - ``delay``) passes its end."""
    keys = as_list(keys)
    s = sdf.withColumn(ET, event_time(time)).withWatermark(ET, delay)
    g = s.groupBy(*keys, F.window(ET, window).alias("w")).agg(F.avg(value).alias("mean"),
                                                                F.count(F.lit(1)).alias("n"))
    return g.select(*keys, ntz(F.col("w.start")).alias("window_start"), ntz(F.col("w.end")).alias("window_end"),
                    "mean", "n")


def stream_sliding_stats(sdf: DataFrame, keys, time: str, value: str, *, window: str = "24 hours",
                         slide: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Sliding-window mean / sample std / count per key."""
    keys = as_list(keys)
    s = sdf.withColumn(ET, event_time(time)).withWatermark(ET, delay)
    g = s.groupBy(*keys, F.window(ET, window, slide).alias("w")).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(F.lit(1)).alias("n"))
    return g.select(*keys, ntz(F.col("w.start")).alias("window_start"), ntz(F.col("w.end")).alias("window_end"),
                    "mean", "std", "n")


# -- T3: duplicate suppression ----------------------------------------------

def stream_dedup(sdf: DataFrame, keys, time: str, *, delay: str = "1 hour") -> DataFrame:
    """Drop repeated rows (same ``keys``) arriving within the watermark."""
    s = sdf.withColumn(ET, event_time(time)).withWatermark(ET, delay)
    return s.dropDuplicatesWithinWatermark(as_list(keys)).drop(ET)


# -- T4: stateful EWMA control chart -----------------------------------------

def _absent(v) -> bool:
    """Whether a value is null or not a number; such order values come last."""
    return v is None or v != v


class EwmaState(StatefulProcessor):
    """EWMA chart of one series over micro-batches.

    State, read and written once a call: the last mean, the rows since its
    last observation (``gap``), the row count, and the last ``window`` values,
    nulls included.  The rows of a micro-batch are one vectorised step from
    that state; they come and go as rows, since frames would cost every
    series more than its step.  ``ttl_ms`` lets Spark expire the state that
    long after its last update, and a timer of the same length clears a
    series that has fallen silent.
    """

    def __init__(self, time: str, value: str, tiebreak: str | None, window: int, no_of_stds: float, direction: str,
                 min_std_ratio: float, ttl_ms: int | None, names: list[str]):
        self.order = [time] + ([tiebreak] if tiebreak else [])
        self.value, self.window, self.k, self.direction = value, window, no_of_stds, direction
        self.ratio, self.ttl, self.names = min_std_ratio, ttl_ms, names

    def init(self, handle) -> None:
        self.handle = handle
        self.chart = handle.getValueState("chart", "ema double, gap bigint, n bigint, x array<double>", self.ttl)

    def step(self, x: np.ndarray, ema: float, gap: int, n: int, ring: np.ndarray):
        """(ema, std) before each of the values ``x`` and the state after
        them.  A mean that is ``gap`` rows old weighs ``beta^gap``; a missing
        value repeats the mean; the std needs ``window`` values before a row."""
        alpha, beta = _ewm_params(self.window)
        target = np.concatenate([ring[-1:] if n else [np.nan], x])[:len(x)]     # the value one row back
        got = np.full(len(x), np.nan)
        seen = np.flatnonzero(~np.isnan(target))
        if not np.isnan(ema):
            got = _ewm_run(-gap, ema, np.arange(len(x)), target, alpha, _gap_cap(beta))
        elif len(seen):
            j = seen[0]
            got[j] = target[j]
            if j + 1 < len(x):
                got[j + 1:] = _ewm_run(int(j), float(target[j]), np.arange(j + 1, len(x)), target[j + 1:], alpha, _gap_cap(beta))
        past = np.concatenate([np.full(self.window - len(ring), np.nan), ring, x])
        frames = np.lib.stride_tricks.sliding_window_view(past, self.window)[:len(x)]
        std = frames.std(axis=1, ddof=1) if self.window > 1 else np.full(len(x), np.nan)
        gap = len(x) - int(seen[-1]) if len(seen) else gap + len(x)
        return got, std, (float(got[-1]), gap, n + len(x), past[len(past) - min(n + len(x), self.window):])

    def handleInputRows(self, key, rows, timerValues):
        ema, gap, n, ring = self.chart.get() or (None, 0, 0, [])
        rows = sorted(rows, key=lambda r: [(True,) if _absent(r[c]) else (False, r[c]) for c in self.order])
        x = np.array([r[self.value] for r in rows], dtype=float)
        got, std, (ema, gap, n, ring) = self.step(x, np.nan if ema is None else ema, gap, n, np.array(ring, dtype=float))
        at = np.arange(n - len(x), n)
        floor = self.ratio * np.abs(x)
        std = np.where(std >= floor, std, floor)
        ucl, lcl = got + self.k * std, got - self.k * std
        high, low = x > ucl, x < lcl
        flag = {"high": high, "low": low, "both": high | low}[self.direction] & (at >= self.window)
        self.chart.update((None if np.isnan(ema) else ema, gap, n, [None if v != v else v for v in ring.tolist()]))
        if self.ttl:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl)
        kept = np.flatnonzero(~np.isnan(got) & ~np.isnan(x))
        numbers = np.stack([x, got, std, ucl, lcl], axis=1)[kept].tolist()
        out = Row(*self.names)
        for i, v, f in zip(kept.tolist(), numbers, flag[kept].tolist()):
            yield out(*key, *[rows[i][c] for c in self.order], *[None if e != e else e for e in v], f)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.chart.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_ewma_detect(sdf: DataFrame, key: str, time: str, value: str, *, tiebreak: str | None = None,
                       window: int = 100, no_of_stds: float = 3.0, direction: str = "high",
                       min_std_ratio: float = 0.01, timeout: str | None = None) -> DataFrame:
    """EWMA chart per series with the recursion carried in streaming state
    (:class:`EwmaState`, ``transformWithState``); rows without a value or a
    mean are dropped, as in the batch chart.

    Rows of a micro-batch are processed in (time, tiebreak) order; a row
    older than what the state already saw counts in arrival order.
    ``timeout`` (e.g. '7 days', of processing time) drops the state of idle
    series.  Spark keeps such state in RocksDB only: the session's
    ``spark.sql.streaming.stateStore.providerClass`` must name that provider
    when the query starts (:func:`rocksdb` sets it).
    """
    out = T.StructType([sdf.schema[key], sdf.schema[time]] + ([sdf.schema[tiebreak]] if tiebreak else [])
                       + [T.StructField(c, T.DoubleType()) for c in (value, "ema", "std", "ucl", "lcl")]
                       + [T.StructField("is_outlier", T.BooleanType())])
    ttl = interval_us(timeout) // 1000 if timeout else None
    state = EwmaState(time, value, tiebreak, window, no_of_stds, direction, min_std_ratio, ttl, out.names)
    return sdf.groupBy(key).transformWithState(state, out, "append", "ProcessingTime" if timeout else "None")


# -- T5: scoring with a stored model -----------------------------------------

def stream_score(sdf: DataFrame, model: DataFrame, keys, value: str, *, k: float = 3.0) -> DataFrame:
    """Stateless scoring against a stored per-series model table
    (``keys, mean, std``): a stream-static join, then ``|z| > k``.  Rows of
    a series the model does not know, or whose values never varied, have a
    null ``z`` and are no anomaly."""
    keys = as_list(keys)
    j = sdf.join(model, keys, "left")
    z = F.try_divide(F.col(value) - F.col("mean"), F.col("std"))
    return j.withColumn("z", z).withColumn("is_anomaly", F.coalesce(F.abs(F.col("z")) > k, F.lit(False)))


def stream_score_slices(sdf: DataFrame, model, col: str = "x") -> DataFrame:
    """Scores of a stream of slices under a fitted (or loaded)
    ``ReconstructionModel``; no state, no join."""
    return model.score(sdf, col)


def model_for_batch(spark: SparkSession, root: str, batch: int):
    """The newest version under ``root`` that was not learned from ``batch``
    or a later one: a replayed batch gets the model that it got first."""
    for v in reversed(model_versions(spark, root)):
        m = load_model_version(spark, root, v)
        if m.learned_batch is None or m.learned_batch < batch:
            return m
    raise ValueError(f"no model under {root} for batch {batch}")


def score_batch(batch: DataFrame, batch_id: int, root: str, sink: str, col: str = "x", learn: bool = False) -> None:
    """Score one micro-batch with the newest model and replace the folder
    ``sink/batch=<id>``, so that a replay leaves the same rows and adds none.
    With ``learn`` the model is then updated by the batch, once, and saved as
    the next version for the batches to come."""
    spark = batch.sparkSession
    batch = batch.persist()
    model = model_for_batch(spark, root, batch_id)
    scored = model.score(batch, col).withColumn("model_version", F.lit(model.version))
    scored.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    newest = load_model_version(spark, root)
    if learn and (newest.learned_batch is None or newest.learned_batch < batch_id) and not batch.isEmpty():
        save_model_version(spark, replace(model.update(batch, col), learned_batch=batch_id), root)
    batch.unpersist()


def run_scoring(sdf: DataFrame, root: str, name: str, *, col: str = "x", learn: bool = False,
                sink: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Score a stream of slices batch by batch (``foreachBatch``,
    :func:`score_batch`) until everything available is done; returns the sink
    as a batch DataFrame.  Model versions that other jobs save under ``root``
    while the stream runs are picked up by the next batch."""
    spark = sdf.sparkSession
    run = run_folder(spark, name)
    sink = sink or f"{run}/data"
    q = (sdf.writeStream.foreachBatch(lambda d, i: score_batch(d, i, root, sink, col, learn))
            .option("checkpointLocation", checkpoint or f"{run}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink)


def fit_zscore_model(df: DataFrame, keys, value: str) -> DataFrame:
    return df.groupBy(*as_list(keys)).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


# -- T6: sessions --------------------------------------------------------------

def stream_sessions(sdf: DataFrame, keys, time: str, value: str, *, gap: str = "30 minutes",
                    delay: str = "1 hour") -> DataFrame:
    """Activity sessions per key (closed after ``gap`` of silence)."""
    keys = as_list(keys)
    s = sdf.withColumn(ET, event_time(time)).withWatermark(ET, delay)
    g = s.groupBy(*keys, F.session_window(ET, gap).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return g.select(*keys, ntz(F.col("w.start")).alias("session_start"), ntz(F.col("w.end")).alias("session_end"),
                    "n", "total")
