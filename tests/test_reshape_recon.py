import numpy as np
from pyspark.sql import functions as F

from tidewatch.operators.recon import ReconstructionModel, slices_to_vectors
from tidewatch.operators.reshape import (min_points, slice_series, split_range,
                                         split_tail, wide_to_long)
from tidewatch.plans import series as S

from conftest import SF0


def test_slicing_equals_indexing(spark):
    u = S.user_events(spark, SF0).select("user_id", "ts", "event_id", "value")
    a = slice_series(u, "user_id", "ts", 7, 3, tiebreak=["event_id"], block=16)
    want = set()
    for user, rows in u.toPandas().sort_values(["ts", "event_id"]).groupby("user_id"):
        for s in range(0, len(rows) - 6, 3):
            cut = rows.iloc[s:s + 7]
            name = f"{user}_{cut.ts.iloc[0]:%Y%m%d%H%M%S}"
            want |= {(user, e, s, name) for e in cut.event_id}
    got = a.select("user_id", "event_id", "slice_start", "series_id").toPandas()
    assert len(got) == len(want) and set(got.itertuples(index=False, name=None)) == want
    per = a.groupBy("user_id", "slice_start").count().select(F.min("count"), F.max("count")).first()
    assert tuple(per) == (7, 7)


def test_unpivot_count_and_splits(spark):
    l = S.supplier_daily(spark, SF0)
    assert wide_to_long(l, ["l_suppkey", "l_shipdate"], S.L_FEATURES).count() == 4 * l.count()
    u = S.user_events(spark, SF0)
    t = split_tail(u, "user_id", "ts", 3, tiebreak=["event_id"])
    assert t.filter("is_test").count() == u.groupBy("user_id").count().select(
        F.sum(F.least(F.col("count"), F.lit(3)))).first()[0]
    r = split_range(u, "user_id", "ts", -3, None, tiebreak=["event_id"])
    assert r.filter("in_range").count() == t.filter("is_test").count()
    assert min_points(u, "user_id", 10 ** 9).count() == 0


def test_model_update_equals_joint_fit_and_roundtrip(spark, tmp_path):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(base)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    a, b = df.filter("id < 180"), df.filter("id >= 180")
    m_all = ReconstructionModel.fit(df, "x", k=3, scaler=None)
    m_inc = ReconstructionModel.fit(a, "x", k=3, scaler=None).update(b, "x")
    assert np.allclose(m_all.mean, m_inc.mean) and np.allclose(np.abs(m_all.components), np.abs(m_inc.components))
    m_all.save(spark, str(tmp_path / "model"))
    back = ReconstructionModel.load(spark, str(tmp_path / "model"))
    s1 = m_all.score(df).select("id", "score").orderBy("id").collect()
    s2 = back.score(df).select("id", "score").orderBy("id").collect()
    assert s1 == s2
    # PCA residual: with k = d the reconstruction is exact
    full = ReconstructionModel.fit(df, "x", k=6, scaler="standard")
    assert full.score(df).agg(F.max("score")).first()[0] < 1e-9


def test_model_of_long_slices_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 3)) @ rng.normal(size=(3, 200)) + 5.0
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(base)]
    odd = [(1000, None), (1001, []), (1002, [1.0] * 199), (1003, [None] + [1.0] * 199), (1004, [9.0] * 200)]
    df = spark.createDataFrame(rows, "id long, x array<double>").repartition(5)
    m = ReconstructionModel.fit(df.unionAll(spark.createDataFrame(odd[:4], df.schema)), "x", k=3, scaler="standard")
    assert m.d == 200 and m.n == 150
    x = (base - m.scale_center) / m.scale_div
    assert np.allclose(m.gram, x.T @ x) and np.allclose(m.sums, x.sum(axis=0))
    got = {r.id: r for r in m.score(spark.createDataFrame(odd, df.schema)).collect()}
    assert all(got[i].score is None and got[i].is_anomaly is False for i in (1000, 1001, 1002, 1003))
    assert got[1004].is_anomaly and m.score(df).agg(F.max("score")).first()[0] < 1e-6


def test_training_runs_are_versioned_and_stream_scores_equal_batch(spark, tmp_path):
    from tidewatch.operators.recon import load_model_version, model_versions, train_and_log
    from tidewatch.streaming.jobs import run_available, stream_score_slices
    u = S.user_events(spark, SF0)
    root = str(tmp_path / "models")
    kw = dict(tiebreak=["event_id"], length=8, shift=4, k=2)
    first, _ = train_and_log(u, "user_id", "ts", "value", root, run_id="a", **kw)
    second, scored = train_and_log(u, "user_id", "ts", "value", root, run_id="b", **kw)
    assert (first.version, second.version) == (1, 2) and model_versions(spark, root) == [1, 2]
    assert load_model_version(spark, root) == second and load_model_version(spark, root, 1) == first
    log = spark.read.parquet(f"{root}/runs").orderBy("version").collect()
    assert [r.run_id for r in log] == ["a", "b"] and log[0].n == scored.count() and log[0].histogram
    assert log[0].n_anomalies == scored.filter("is_anomaly").count()
    scored.select("user_id", "slice_start", "x").repartition(3).write.parquet(str(tmp_path / "slices"))
    sdf = (spark.readStream.schema("user_id long, slice_start long, x array<double>").option("maxFilesPerTrigger", 1)
           .parquet(str(tmp_path / "slices")))
    got = run_available(stream_score_slices(sdf, load_model_version(spark, root)), "slices")
    show = lambda d: sorted((r.user_id, r.slice_start, round(r.score, 9), r.is_anomaly) for r in d.collect())
    assert show(got) == show(scored)


def test_split_slices_by_series_and_user_model(spark):
    from tidewatch.operators.recon import fit_and_score, split_slices
    df = spark.createDataFrame([(f"k{i % 50}", i) for i in range(400)] + [(None, 1), (None, 2)], "k string, s int")
    got = split_slices(df, "k", 0.3)
    assert got.groupBy("k").agg(F.countDistinct("is_validation").alias("n")).filter("n > 1").count() == 0
    part = got.filter("is_validation").select("k").distinct().count()
    assert 5 <= part <= 25

    class Mean:
        def fit(self, d):
            self.mean = d.agg(F.avg("s")).first()[0]

        def transform(self, d):
            return d.withColumn("score", F.abs(F.col("s") - self.mean))

    out = fit_and_score(Mean(), got.filter("NOT is_validation"), got.filter("is_validation"))
    assert out.count() == got.filter("is_validation").count() and out.filter("score IS NULL").count() == 0
