"""Registered queries of sources, cleaning, resampling and run logs that
show how odd input is handled, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.plans import series as S
from tidewatch.plans.queries import _LV, _ens, _ens_sql, _ewma_sql, _l_vectors, _resample_sql, r, register

# --- quarantine ---------------------------------------------------------------

#: Raw text with malformed times and values, made by formula from the events.
_RAW = """SELECT event_id, CASE WHEN event_id % 31 = 0 THEN '' ELSE CAST(user_id AS {text}) END AS sn,
  CASE WHEN event_id % 11 = 0 THEN 'not a time' WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '2024-13-45 00:00:00'
       ELSE CAST(event_id * 1000 + 1704067200000 AS {text}) END AS ts,
  CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN ' ' ELSE CAST(event_id AS {text}) END AS value
FROM events"""


def _raw(spark, sf_dir):
    S.table(spark, sf_dir, "events").createOrReplaceTempView("tidewatch_raw_events")
    return spark.sql(_RAW.replace("FROM events", "FROM tidewatch_raw_events").format(text="STRING"))


_REASONS = f"""WITH e AS ({_RAW.format(text='VARCHAR')}),
m AS (SELECT event_id, 'no entity' AS reason FROM e WHERE sn = '' UNION ALL
  SELECT event_id, CASE WHEN ts IS NULL THEN 'no time' ELSE 'bad time' END FROM e WHERE ts IS NULL OR TRY_CAST(ts AS BIGINT) IS NULL UNION ALL
  SELECT event_id, 'bad value: value' FROM e WHERE trim(value) != '' AND TRY_CAST(value AS DOUBLE) IS NULL)"""


@register("bad_timestamps", _REASONS + " SELECT reason, count(*) AS rows FROM m GROUP BY reason")
def q_bad_timestamps(spark, sf_dir):
    """Rejected rows per reason."""
    from tidewatch.operators.clean import quarantine, reject_counts
    return reject_counts(quarantine(_raw(spark, sf_dir), "sn", "ts", ["value"])[1])


@register("quarantine_good", _REASONS + """ SELECT event_id, sn, make_timestamp(CAST(ts AS BIGINT) * 1000) AS ts,
  TRY_CAST(value AS DOUBLE) AS value FROM e ANTI JOIN m USING (event_id)""")
def q_quarantine_good(spark, sf_dir):
    from tidewatch.operators.clean import quarantine
    return quarantine(_raw(spark, sf_dir), "sn", "ts", ["value"])[0].select("event_id", "sn", "ts", "value")


# --- chunked spine ------------------------------------------------------------

_MINUTE_US = 60_000_000


@register("resample_chunked", f"""WITH {_resample_sql('SELECT * FROM events', 'event_type', 'ts', 'value', 10 * _MINUTE_US)}
SELECT event_type, make_timestamp(b) AS ts, {S.rnd('v', 6)} AS value FROM j""")
def q_resample_chunked(spark, sf_dir):
    """Ten-minute means with a spine unfolded in chunks of 500 buckets."""
    from tidewatch.operators.resample import resample_mean
    d = resample_mean(S.table(spark, sf_dir, "events"), "event_type", "ts", "value", "10 minutes", chunk=500)
    return d.select("event_type", "ts", r("value"))


# --- reasons in the run log ---------------------------------------------------

_ODD = """CASE WHEN event_type = 'click' THEN 5.0 WHEN event_type = 'view' THEN NULL
  WHEN event_type = 'signup' AND event_id > 200 THEN NULL ELSE value END"""
_ODD_SRC = f"SELECT event_type, ts, event_id, {_ODD} AS value FROM events"
_ODD_EWMA = _ewma_sql(f"SELECT * FROM ({_ODD_SRC}) o WHERE value IS NOT NULL", "event_type", "ts", "value", 50, 3.0, "high", 6)


@register("run_metrics_reasons", f"""WITH o AS ({_ODD_SRC}),
a AS (SELECT event_type, count(*) AS n FROM ({_ODD_EWMA}) q GROUP BY 1)
SELECT o.event_type, count(*) AS n_points, coalesce(any_value(a.n), 0) AS anomalies_ewma, coalesce(any_value(a.n), 0) AS anomalies_detected,
  CASE WHEN count(value) = 0 THEN 'no value' WHEN count(value) < 400 THEN 'too short' WHEN min(value) = max(value) THEN 'constant' END AS error
FROM o LEFT JOIN a ON a.event_type = o.event_type GROUP BY 1""")
def q_run_metrics_reasons(spark, sf_dir):
    """Why series could not be judged, beside the anomalies of the others."""
    from tidewatch.operators.ensemble import ensemble, run_metrics
    ev = S.table(spark, sf_dir, "events").select("event_type", "ts", "event_id", F.expr(_ODD).alias("value"))
    an = ensemble(ev, "event_type", "ts", "value", detectors=["ewma"], params={"window": 50, "anomaly_direction": "high"})
    d = run_metrics(ev, an, "event_type", detectors=["ewma"], value="value", min_points=400)
    return d.select("event_type", "n_points", "anomalies_ewma", "anomalies_detected", "error")


@register("ensemble_vote", _ens_sql(["kde", "ewma", "arma"], 2))
def q_ensemble_vote(spark, sf_dir):
    """Rows that at least two of three detectors flag."""
    return _ens(spark, sf_dir, ["kde", "ewma", "arma"], "vote")


# --- sources and sinks --------------------------------------------------------

def _folder(spark, name: str) -> str:
    import uuid
    from tidewatch.session import shared_folder
    return f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"


@register("raw_csv_clean", f"""SELECT DISTINCT CAST(user_id AS VARCHAR) AS sn, event_type AS MDN, date_trunc('second', ts) AS time,
  {S.rnd('value', 2)} AS value FROM events""")
def q_raw_csv_clean(spark, sf_dir):
    """Gzipped header CSV, written twice over, read as text and cleaned."""
    from tidewatch.functions.scalar import epoch_us
    from tidewatch.operators.clean import clean_raw
    from tidewatch.sources.io import read_raw_csv
    raw = S.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("sn"), F.concat(F.lit('"'), F.col("event_type"), F.lit('"')).alias("mdn"),
        F.floor(epoch_us("ts") / 1000).cast("string").alias("ts"), F.col("value").cast("string").alias("value"))
    path = _folder(spark, "csv")
    for _ in range(2):
        raw.write.mode("append").option("header", True).option("compression", "gzip").csv(path)
    return clean_raw(read_raw_csv(spark, path, ["sn", "mdn", "ts", "value"]), ["value"])


_NEWEST = "(SELECT date_trunc('hour', max(ts)) FROM events)"


@register("read_recent_hours", f"SELECT event_id, user_id, ts, value FROM events WHERE ts >= {_NEWEST} - INTERVAL 5 HOUR")
def q_read_recent_hours(spark, sf_dir):
    """The last six hours of a table partitioned by day and hour."""
    from tidewatch.sources.io import read_recent, write_features
    ev = S.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    d = ev.withColumns({"date": F.date_format("ts", "yyyy-MM-dd"), "hr": F.date_format("ts", "HH")})
    path = _folder(spark, "hours")
    write_features(d, path, time="ts", partition_by=("date", "hr"))
    return read_recent(spark, path, ev.agg(F.max("ts")).first()[0], 6, fmt="parquet").select(ev.columns)


@register("feature_table", """SELECT event_id, user_id, ts, value, CAST(ts AS DATE) AS date FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' AND user_id % 2 = 0""")
def q_feature_table(spark, sf_dir):
    """A feature table by day, sorted within files, read back with pruning."""
    from tidewatch.sources.io import read_features, write_features
    path = _folder(spark, "features")
    write_features(S.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"), path, time="ts", sort_by=("user_id", "ts"))
    d = read_features(spark, path).filter(F.col("date").between("2024-01-10", "2024-01-12") & (F.col("user_id") % 2 == 0))
    return d.select("event_id", "user_id", "ts", "value", "date")


@register("slice_table", "SELECT CAST(event_type AS VARCHAR) AS kind, count(*) AS n FROM events GROUP BY 1")
def q_slice_table(spark, sf_dir):
    """Files in nested folders of different depth, read as one table."""
    from tidewatch.sources.io import read_slices
    ev, path = S.table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), "event_id"), _folder(spark, "nested")
    ev.filter("event_id % 2 = 0").write.parquet(f"{path}/a")
    ev.filter("event_id % 2 = 1").write.parquet(f"{path}/b/deep=1/er")
    return read_slices(spark, path).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@register("run_log", "SELECT 'r' || k AS run_id, user_id, count(*) AS n_points FROM events, range(1, 3) t(k) GROUP BY ALL")
def q_run_log(spark, sf_dir):
    """Two runs appended to one log."""
    from tidewatch.operators.ensemble import run_metrics
    from tidewatch.sources.io import write_run_log
    ev, path = S.table(spark, sf_dir, "events").select("user_id", "value"), _folder(spark, "log")
    none = ev.limit(0).withColumn("is_outlier_kde", F.lit(True))
    for k in (1, 2):
        write_run_log(run_metrics(ev, none, "user_id", detectors=["kde"], run_id=f"r{k}"), path)
    return spark.read.parquet(path).select("run_id", "user_id", "n_points")


@register("entity_filter", """SELECT event_id, user_id FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10)
  OR user_id = 1""")
def q_entity_filter(spark, sf_dir):
    """Entities of a table, and of a list."""
    from tidewatch.operators.clean import filter_entities
    ev = S.table(spark, sf_dir, "events").select("event_id", "user_id")
    ids = S.table(spark, sf_dir, "supplier").filter("s_nationkey < 10").select("s_suppkey")
    return filter_entities(ev, "user_id", ids).unionAll(filter_entities(ev, "user_id", [1, 1])).distinct()


@register("unscale_series", f"WITH s AS ({S.L_SQL}) SELECT l_suppkey, l_shipdate, {S.rnd('avg_qty', 4)} AS unscaled FROM s")
def q_unscale_series(spark, sf_dir):
    """Scaled and scaled back."""
    from tidewatch.operators.stats import scale_series, unscale_series
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    d = unscale_series(scale_series(l, "l_suppkey", "l_shipdate", "avg_qty"), "l_suppkey", "avg_qty", "scaled")
    return d.select("l_suppkey", "l_shipdate", r("unscaled", 4))


# --- reconstruction models ----------------------------------------------------

@register("score_slices_mean", f"""WITH {_LV},
p AS (SELECT avg(v) AS mu, stddev_pop(v) AS sd FROM (SELECT unnest(x) AS v FROM vec) q),
z AS (SELECT l_suppkey, slice_start, list_transform(x, lambda v: (v - p.mu) / p.sd) AS x FROM vec, p),
m AS (SELECT i, avg(x[i + 1]) AS m FROM z, range(0, 24) a(i) GROUP BY i),
s AS (SELECT l_suppkey, slice_start, sqrt(sum(pow(x[i + 1] - m, 2))) AS score FROM z, m GROUP BY 1, 2),
t AS (SELECT quantile_cont(score, 0.95) AS threshold FROM s)
SELECT l_suppkey, slice_start, {S.rnd('score', 6)} AS score, {S.rnd('threshold', 6)} AS threshold, score > threshold AS is_anomaly FROM s, t""")
def q_score_slices_mean(spark, sf_dir):
    """The model without components: the distance from the mean slice, its
    threshold and its outliers."""
    from tidewatch.operators.recon import ReconstructionModel
    from tidewatch.session import materialize
    v = materialize(_l_vectors(spark, sf_dir))
    d = ReconstructionModel.fit(v, "x", k=0, threshold_percentile=95).score(v)
    return d.select("l_suppkey", "slice_start", r("score"), r("threshold"), "is_anomaly")


@register("recon_warm_start", f"""WITH {_LV},
p AS (SELECT avg(v) AS mu, stddev_pop(v) AS sd FROM (SELECT unnest(x) AS v FROM vec WHERE l_suppkey % 2 = 0) q),
z AS (SELECT list_transform(x, lambda v: (v - p.mu) / p.sd) AS x FROM vec, p)
SELECT CAST(i AS INTEGER) AS i, count(*) AS n, {S.rnd('avg(x[i + 1])', 6)} AS mean, {S.rnd('sum(x[i + 1] * x[24 - i])', 4)} AS g
FROM z, range(0, 24) a(i) GROUP BY i""")
def q_recon_warm_start(spark, sf_dir):
    """A model fitted on half of the suppliers and updated by the others."""
    from tidewatch.operators.recon import ReconstructionModel
    from tidewatch.session import materialize
    v = materialize(_l_vectors(spark, sf_dir))
    m = ReconstructionModel.fit(v.filter("l_suppkey % 2 = 0"), "x").update(v.filter("l_suppkey % 2 = 1"))
    rows = [(i, m.n, m.mean[i], m.gram[i][23 - i]) for i in range(24)]
    return spark.createDataFrame(rows, "i int, n long, mean double, g double").select("i", "n", r("mean"), r("g", 4))


@register("training_runs", f"""WITH {_LV}
SELECT k AS run_id, CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS version, CAST(24 AS INTEGER) AS length, n
FROM (SELECT count(*) AS n FROM vec) q, (VALUES ('a'), ('b')) t(k)""")
def q_training_runs(spark, sf_dir):
    """Two training runs: versions of the model and rows of the run log."""
    from tidewatch.operators.recon import train_and_log
    root, l = _folder(spark, "training"), S.supplier_daily(spark, sf_dir)
    for run in "ab":
        train_and_log(l, "l_suppkey", "l_shipdate", "avg_qty", root, length=24, shift=12, run_id=run)
    log = spark.read.parquet(f"{root}/runs")
    return log.select("run_id", "version", F.get_json_object("params", "$.length").cast("int").alias("length"), "n")


class _Level:
    """A user's own model: how far the mean of a slice is from that of all."""

    def fit(self, df):
        self.level = df.select(F.explode("x").alias("v")).agg(F.avg("v")).first()[0]

    def transform(self, df):
        mean = F.aggregate("x", F.lit(0.0), lambda a, b: a + b) / F.size("x")
        return df.withColumn("off", mean - F.lit(self.level))


@register("user_model", f"""WITH {_LV}, a AS (SELECT avg(v) AS level FROM (SELECT unnest(x) AS v FROM vec WHERE l_suppkey % 2 = 0) q)
SELECT l_suppkey, slice_start, {S.rnd('list_avg(x) - level', 6)} AS off FROM vec, a WHERE l_suppkey % 2 = 1""")
def q_user_model(spark, sf_dir):
    from tidewatch.operators.recon import fit_and_score
    from tidewatch.session import materialize
    v = materialize(_l_vectors(spark, sf_dir))
    d = fit_and_score(_Level(), v.filter("l_suppkey % 2 = 0"), v.filter("l_suppkey % 2 = 1"))
    return d.select("l_suppkey", "slice_start", r("off"))


class _ShareOfMax:
    """A user's own scaler: values as a share of the series' largest."""

    def stats(self, value):
        return {"_most": F.max(value)}

    def transform(self, x):
        return x / F.col("_most")


@register("ewma_custom_scaler", _ewma_sql(f"SELECT l_suppkey, l_shipdate, avg_price / max(avg_price) OVER (PARTITION BY l_suppkey) AS share FROM ({S.L_SQL}) q",
                                          "l_suppkey", "l_shipdate", "share", 50, 2.0, "both", 6).replace("x AS share", f"{S.rnd('x', 6)} AS share"))
def q_ewma_custom_scaler(spark, sf_dir):
    from tidewatch.operators.ewma import ewma_detect
    d = ewma_detect(S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_price"), "l_suppkey", "l_shipdate", "avg_price",
                    window=50, no_of_stds=2.0, direction="both", scaler=_ShareOfMax())
    return d.select("l_suppkey", "l_shipdate", F.round("scaled", 6).alias("share"), r("ema"), r("ucl"), r("lcl"))
