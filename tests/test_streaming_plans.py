import re

from pyspark.sql import functions as F

from tidewatch.operators.ewma import ewma_detect
from tidewatch.operators.features import smoothed_increment
from tidewatch.plans import series as S
from tidewatch.sources.io import read_recent, write_features
from tidewatch.streaming.jobs import arrivals, file_stream, rocksdb, run_available, stream_ewma_detect

from conftest import SF0


def _chart(rows):
    return {(r.user_id, r.event_id): (round(r.ema, 9), round(r.std, 9), r.is_outlier) for r in rows}


def test_stream_ewma_over_micro_batches_equals_batch(spark):
    """Three micro-batches, missing values, whole batches without a value,
    and series that start late."""
    rocksdb(spark)
    u = S.user_events(spark, SF0).select("user_id", "ts", "event_id", "value")
    u = u.withColumn("value", F.when((F.col("event_id") % 5 != 0) & ~((F.col("user_id") % 3 == 0) & F.col("ts").between(
        "2024-01-10", "2024-01-20")), F.col("value")))
    third = [F.col("ts") < "2024-01-10", F.col("ts").between("2024-01-10", "2024-01-20"), F.col("ts") > "2024-01-20"]
    kw = dict(tiebreak="event_id", window=10, no_of_stds=2.0, direction="both")
    st = run_available(stream_ewma_detect(arrivals(u, third, "t4"), "user_id", "ts", "value", timeout="7 days", **kw), "t4", idle_batches=False)
    b = ewma_detect(u, "user_id", "ts", "value", **{**kw, "tiebreak": ["event_id"]}, only_anomalies=False)
    got, want = _chart(st.collect()), _chart(b.collect())
    assert got == want and any(f for _, _, f in want.values())


def test_replayed_batches_add_nothing_and_get_their_first_model(spark, tmp_path):
    import numpy as np
    from tidewatch.operators.recon import ReconstructionModel, model_versions, save_model_version
    from tidewatch.streaming.jobs import run_scoring, score_batch
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, i % 3, rng.normal(size=6).tolist()) for i in range(300)], "id long, part int, x array<double>")
    root, sink = str(tmp_path / "models"), str(tmp_path / "sink")
    save_model_version(spark, ReconstructionModel.fit(df.filter("part = 0"), "x", k=2), root)
    show = lambda: sorted((r.id, r.model_version, r.batch, round(r.score, 9)) for r in spark.read.parquet(sink).collect())
    run_scoring(arrivals(df, [F.col("part") == i for i in range(3)], "t5"), root, "t5", learn=True, sink=sink)
    first = show()
    assert len(first) == 300 and {(v, b) for _, v, b, _ in first} == {(1, 0), (2, 1), (3, 2)} and model_versions(spark, root) == [1, 2, 3, 4]
    for i in (2, 0):
        score_batch(df.filter(F.col("part") == i), i, root, sink, learn=True)
    assert show() == first and model_versions(spark, root) == [1, 2, 3, 4]


def test_file_stream_over_a_folder_of_parts(spark, tmp_path):
    S.table(spark, SF0, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = run_available(file_stream(spark, str(tmp_path), "events"), "parts")
    assert got.count() == S.table(spark, SF0, "events").count()


def test_sql_only_operator_has_no_python_node(spark):
    c = S.user_counter(spark, SF0)
    plan = smoothed_increment(c, "user_id", "ts", ["counter"], tiebreak=["event_id"])._jdf \
        .queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_pushdown_and_partition_pruning(spark, tmp_path):
    import datetime as dt
    ev = S.table(spark, SF0, "events").withColumn("time", F.col("ts"))
    path = str(tmp_path / "features")
    d = ev.withColumn("date", F.date_format("ts", "yyyy-MM-dd")).withColumn("hr", F.date_format("ts", "HH"))
    write_features(d.drop("time"), path, partition_by=("date", "hr"))
    r = read_recent(spark, path, dt.datetime(2024, 1, 2, 5), 6, fmt="parquet").filter(F.col("user_id") == 3)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and re.search(r"PushedFilters: \[[^\]]*user_id", plan)
    allr = read_recent(spark, path, dt.datetime(2024, 1, 2, 5), 6, fmt="parquet")
    lo, hi, n = allr.select(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    assert n > 0 and lo >= dt.datetime(2024, 1, 2, 0) and hi < dt.datetime(2024, 1, 2, 6)
    assert n == ev.filter((F.col("ts") >= dt.datetime(2024, 1, 2, 0))
                          & (F.col("ts") < dt.datetime(2024, 1, 2, 6))).count()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "ema" in df.columns


def test_raw_csv_roundtrip_clean(spark, tmp_path):
    from tidewatch.functions.scalar import epoch_us
    from tidewatch.operators.clean import clean_raw
    from tidewatch.sources.io import read_raw_csv
    ev = S.table(spark, SF0, "events")
    raw = ev.select(F.col("user_id").cast("string").alias("sn"),
                    F.concat(F.lit('"'), F.col("event_type"), F.lit('"')).alias("mdn"),
                    F.floor(epoch_us("ts") / 1000).cast("string").alias("ts"),
                    F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
                    .alias("value"))
    path = str(tmp_path / "raw")
    raw.unionByName(raw).write.option("header", True).option("compression", "gzip").csv(path)
    back = read_raw_csv(spark, path, ["sn", "mdn", "ts", "value"])
    assert all(isinstance(f.dataType, type(back.schema["sn"].dataType)) for f in back.schema.fields)
    clean = clean_raw(back, ["value"])
    assert clean.count() == ev.count()                      # duplicates removed
    assert clean.filter(F.col("value").isNull()).count() == ev.filter(F.col("event_id") % 5 == 0).count()
    assert clean.filter(F.col("MDN").contains('"')).count() == 0


def test_a_call_of_the_streaming_chart_takes_rows_and_one_state():
    """Rows come and go as rows, and the state is read and written once a call."""
    import numpy as np
    from pyspark.sql import Row
    from tidewatch.streaming.jobs import EwmaState

    class Value:
        calls, held = 0, None

        def get(self):
            self.calls += 1
            return self.held

        def exists(self):
            raise AssertionError("a second round trip")

        def update(self, new):
            self.calls, self.held = self.calls + 1, new

    made = []

    class Handle:
        def getValueState(self, name, schema, ttl=None):
            made.append(Value())
            return made[-1]

    names = ["k", "t", "id", "v", "ema", "std", "ucl", "lcl", "is_outlier"]
    chart, one, out = EwmaState("t", "v", "id", 4, 2.0, "high", 0.01, None, names), Row("k", "t", "id", "v"), []
    chart.init(Handle())
    x = [float(v) for v in np.random.default_rng(3).normal(10, 1, 40)]
    x[7], x[20], x[31] = None, None, 99.0
    for i, j in ((0, 15), (15, 18), (18, 40)):
        rows = [one("a", None if n == 39 else n // 2, n, x[n]) for n in range(i, j)]
        out += chart.handleInputRows(("a",), iter(rows[::-1]), None)
    assert [v.calls for v in made] == [6]
    assert [r.id for r in out] == [n for n in range(1, 40) if x[n] is not None] and list(out[0].asDict()) == names
    assert [r.id for r in out if r.is_outlier and r.v == 99.0] == [31] and out[-1].t is None
