"""Pruned discovery, quarantine, chunked spines, run logs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.clean import parse_time, quarantine, reject_counts
from tidewatch.operators.ensemble import detector_flags, run_metrics, series_reasons, timed_write
from tidewatch.operators.resample import resample_mean, spine, spine_chunks
from tidewatch.sources.io import partition_coverage, read_recent, recent_folders


def test_only_wanted_folders_are_listed(spark, tmp_path):
    """Other days hold folders that Spark refuses to list beside these."""
    root = tmp_path / "t"
    for day, hr in (("2024-01-01", "22"), ("2024-01-01", "23"), ("2024-01-02", "0"), ("2024-01-02", "02")):
        spark.createDataFrame([(f"{day} {hr}",)], "v string").write.parquet(str(root / f"date={day}/hr={hr}"))
    spark.createDataFrame([("no",)], "v string").write.parquet(str(root / "date=2023-12-31/odd=1/more=2"))
    end = dt.datetime(2024, 1, 2, 3, 30)
    got = recent_folders(spark, str(root), end, 5)
    assert [g.split("/t/")[1] for g in got] == ["date=2024-01-01/hr=23", "date=2024-01-02/hr=0", "date=2024-01-02/hr=02"]
    d = read_recent(spark, str(root), end, 5, fmt="parquet")
    assert sorted(r.v for r in d.collect()) == ["2024-01-01 23", "2024-01-02 0", "2024-01-02 02"] and {"date", "hr"} < set(d.columns)
    with pytest.raises(Exception, match="(?i)conflicting"):
        spark.read.parquet(str(root)).count()
    assert read_recent(spark, str(root), dt.datetime(2020, 1, 1), 3, columns=["v"]).columns == ["v", "date", "hr"]


def test_quarantine_keeps_every_row_once(spark):
    rows = [(1, "a", "1704067200123", "1.5"), (2, "a", "2024-01-01 00:00:00", " 2 "), (3, "a", "2024-01-01T00:00:00.5", None),
            (4, "a", "20240101000000", ""), (5, "a", "soon", "1"), (6, "a", None, "x"), (7, "", "2024-01-01", "NaN"), (8, None, " ", "1e999"),
            (9, "a", "2024-02-30 00:00:00", "1"), (10, "a", "-1704067200123", "-0"), (5, "a", "soon", "1")]
    df = spark.createDataFrame(rows, "id long, sn string, ts string, v string")
    good, bad = quarantine(df, "sn", "ts", ["v"])
    got = {r.id: (str(r.ts), r.v) for r in good.collect()}
    assert got == {1: ("2024-01-01 00:00:00.123000", 1.5), 2: ("2024-01-01 00:00:00", 2.0), 3: ("2024-01-01 00:00:00.500000", None),
                   4: ("2024-01-01 00:00:00", None), 10: ("1916-01-01 23:59:59.877000", 0.0)}
    why = {r.id: r.reasons for r in bad.collect()}
    assert why == {5: ["bad time"], 6: ["no time", "bad value: v"], 7: ["no entity", "bad value: v"],
                   8: ["no entity", "no time", "bad value: v"], 9: ["bad time"]}
    assert good.count() + bad.count() == len(rows) and bad.drop("reasons").dtypes == df.dtypes
    assert {(r.reason, r.rows) for r in reject_counts(bad).collect()} == {
        ("bad time", 3), ("no time", 2), ("bad value: v", 3), ("no entity", 2)}
    assert df.limit(0).select(parse_time("ts").alias("t")).count() == 0


def test_spine_of_a_decade_never_builds_one_array(spark):
    decade = spark.createDataFrame([("a", 0, 315_532_800_000_000)], "k string, _lo long, _hi long")
    chunks = spine_chunks(decade, ["k"], 1_000_000)
    n, most, total = chunks.select((F.col("_to") - F.col("_from")) / 1_000_000 + 1).toDF("n").agg(F.count("*"), F.max("n"), F.sum("n")).first()
    assert (n, most, total) == (4815, 65536, 315_532_801)
    plan = spine(decade, ["k"], 1_000_000)._jdf.queryExecution().optimizedPlan().toString()
    first, then = plan.index("Generate"), plan.rindex("Generate")
    assert first < plan.index("RepartitionByExpression") < then
    few = spark.createDataFrame([("a", 5, 5), ("b", 0, 70), ("c", 0, 40)], "k string, _lo long, _hi long")
    got = sorted((r.k, r._b) for r in spine(few, ["k"], 10, 3).collect())
    assert got == [("a", 5)] + [("b", i) for i in range(0, 71, 10)] + [("c", i) for i in range(0, 41, 10)]


def test_chunks_do_not_change_results(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0, 0), 1.0), ("a", dt.datetime(2024, 1, 1, 2, 0, 1), 3.0), ("b", dt.datetime(2024, 1, 5), 2.0), ("b", None, 9.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    show = lambda d: sorted(map(tuple, d.collect()), key=repr)
    small, large = (resample_mean(df, "k", "t", "v", "1 second", chunk=c) for c in (7, 1 << 16))
    assert show(small) == show(large) and large.count() == 7202 + 1
    assert show(partition_coverage(df, "k", "t", "minute", chunk=5)) == show(partition_coverage(df, "k", "t", "minute"))
    assert partition_coverage(df, "k", "t", "minute").count() == 119


def test_reasons_and_timings(spark, tmp_path):
    rows = [("flat", i, 2.0) for i in range(20)] + [("none", i, None) for i in range(20)] + [("short", i, float(i)) for i in range(3)]
    rows += [("nan", i, float("nan")) for i in range(20)] + [("good", i, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    why = {r.k: r.reason for r in series_reasons(df, "k", "v").collect()}
    assert why == {"flat": "constant", "none": "no value", "nan": "no value", "short": "too short", "good": None}
    told = timed_write(df, str(tmp_path / "out"), "points", metrics={"known": F.count("v")})
    assert told["rows"] == len(rows) and told["known"] == len(rows) - 20 and told["seconds"] > 0 and spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    log = run_metrics(df, df.limit(0).withColumn("is_outlier_kde", F.lit(True)), "k", detectors=["kde"], value="v", seconds=told["seconds"])
    assert {(r.k, r.error, r.anomalies_kde, r.seconds > 0) for r in log.collect()} == {(k, w, 0, True) for k, w in why.items()}


def test_forecasters_take_part_in_ensembles(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    x = np.zeros(300)
    for i in range(1, 300):
        x[i] = 0.6 * x[i - 1] + rng.normal()
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(v) - (40 if i == 299 and k == "bad" else 0)) for k in ("ok", "bad") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    for name in ("arima", "auto_ar", "auto_seasonal"):
        hit = detector_flags(df, "k", "t", "v", name, params={"arima_order": (1, 0, 1), "arima_steps": 1, "auto_season": 6}).collect()
        assert [(r.k, r.t) for r in hit] == [("bad", dt.datetime(2024, 1, 1) + dt.timedelta(hours=299))], name


def test_slice_scalers(spark):
    from tidewatch.operators.recon import ReconstructionModel

    class Halves:
        def affine(self, values):
            return values.agg(F.max("v")).first()[0] / 2, 2.0
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],), ([5.0, 9.0, 7.0, 10.0],), ([2.0, 2.0, 8.0, 1.0],)], "x array<double>")
    m = ReconstructionModel.fit(df, "x", k=1, scaler=Halves())
    assert (m.scale_center, m.scale_div, m.scaler) == (5.0, 2.0, "Halves") and ReconstructionModel.from_json(m.to_json()) == m
    r = ReconstructionModel.fit(df, "x", k=1, scaler="robust")
    assert (r.scale_center, r.scale_div) == (3.5, 5.25)


def test_old_leftovers_are_cleaned(spark):
    import time
    from tidewatch.session import clean_shared, materialize, shared_folder
    kept = materialize(spark.range(10))
    root = shared_folder(spark)
    for p in ("streams/old/run", "tables/old"):
        spark.range(3).write.mode("overwrite").parquet(f"{root}/{p}")
    assert not any("old" in g for g in clean_shared(spark, 3600))
    time.sleep(1.5)
    gone = clean_shared(spark, 1)
    assert {g.split(root.rstrip("/"))[-1] for g in gone} >= {"/streams/old/run", "/tables/old"}
    assert kept.count() == 10       # this application's checkpoints stay
