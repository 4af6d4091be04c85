"""Block machinery: exact positions, halos, carries — against naive
whole-series windows and pandas, with tiny blocks/buckets so every carry
path runs, including one hot series holding most rows."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import sequence as Q


def _frame(spark, seed=0, hot=3000):
    rng = np.random.default_rng(seed)
    rows = []
    for k, n in enumerate([hot, 40, 7, 1]):
        x = rng.normal(size=n)
        x[rng.random(n) < 0.15] = np.nan
        if n > 500:
            x[200:450] = np.nan
            x[:3] = np.nan
        for i in range(n):
            rows.append((k, int(i * 7 + (i % 3)), i, None if np.isnan(x[i]) else float(x[i])))
    pdf = pd.DataFrame(rows, columns=["k", "t", "tb", "x"])
    return pdf, spark.createDataFrame(pdf)


def test_positions_match_row_number(spark):
    pdf, df = _frame(spark)
    w = Window.partitionBy("k").orderBy("t", "tb")
    exp = df.withColumn("rn", F.row_number().over(w) - 1)
    got = Q.with_position(df, "k", ["t", "tb"])
    assert got.count() == df.count()
    assert got.join(exp, ["k", "t", "tb"]).filter(F.col(Q.POS) != F.col("rn")).count() == 0
    desc = Q.with_position(df, "k", ["t", "tb"], descending=True, name="r").toPandas()
    n = pdf.groupby("k")["t"].transform("size")
    merged = desc.merge(pdf.assign(rn=pdf.groupby("k").cumcount(), n=n), on=["k", "t", "tb"])
    assert (merged["r"] == merged["n"] - 1 - merged["rn"]).all()


def test_halo_windows_equal_whole_series(spark):
    _, df = _frame(spark)

    def build(w):
        frame = w.rowsBetween(-5, -1)
        return {"l3": F.lag("x", 3).over(w), "s5": F.stddev_samp("x").over(frame),
                "c5": F.count("x").over(frame)}
    got = Q.series_windowed(df, "k", ["t", "tb"], 5, build, block=8)
    w = Window.partitionBy("k").orderBy("t", "tb")
    exp = df.withColumns(build(w))
    assert got.count() == df.count()
    j = got.alias("a").join(exp.alias("b"), ["k", "t", "tb"])
    bad = j.filter(~F.col("a.l3").eqNullSafe(F.col("b.l3")) | ~F.col("a.c5").eqNullSafe(F.col("b.c5"))
                   | (F.abs(F.col("a.s5") - F.col("b.s5")) > 1e-9)).count()
    assert bad == 0


def test_ewm_blocked_matches_pandas(spark):
    pdf, df = _frame(spark)
    exp = pdf.sort_values(["k", "t", "tb"]).groupby("k")["x"].transform(
        lambda s: s.ewm(span=20, adjust=False).mean())
    for block in (16, 100, 8192):
        d = Q.with_position(df, "k", ["t", "tb"])
        out = Q.ewm_blocked(d, "k", "x", 20, "ema", block=block).toPandas().sort_values(["k", "t", "tb"])
        a, b = out["ema"].to_numpy(), exp.to_numpy()
        assert (np.isnan(a) == np.isnan(b)).all()
        assert np.nanmax(np.abs(a - b)) < 1e-12


def test_ewm_tree_has_levels_and_bounded_groups(spark):
    """Blocks of 8 rows in trees of 3 children: 3000 rows give 375 blocks and
    six levels; gaps, leading nulls and whole blocks without a value."""
    pdf, df = _frame(spark)
    exp = pdf.sort_values(["k", "t", "tb"]).groupby("k")["x"].transform(
        lambda s: s.ewm(span=20, adjust=False).mean())
    d = Q.with_position(df, "k", ["t", "tb"])
    out = Q.ewm_blocked(d, "k", "x", 20, "ema", block=8, fan=3).toPandas().sort_values(["k", "t", "tb"])
    a, b = out["ema"].to_numpy(), exp.to_numpy()
    assert (np.isnan(a) == np.isnan(b)).all()
    assert np.nanmax(np.abs(a - b)) < 1e-12


def test_fills_from_both_sides_match_pandas(spark):
    pdf, df = _frame(spark)
    d = Q.with_position(df, "k", ["t", "tb"])
    out = Q.fill_blocked(d, "k", ["x"], ["f"], ["b"], block=16, fan=4).toPandas().sort_values(["k", "t", "tb"])
    g = pdf.sort_values(["k", "t", "tb"]).groupby("k")["x"]
    for got, exp in ((out["f"], g.ffill()), (out["b"], g.bfill())):
        assert np.array_equal(got.to_numpy(), exp.to_numpy(), equal_nan=True)


def test_runs_of_equal_keys_over_batches():
    import pyarrow as pa
    runs = Q._Runs(["a", "f", "s"])
    batch = lambda rows: pa.RecordBatch.from_pylist(rows, pa.schema([("a", pa.string()), ("f", pa.float64()),
                                                                     ("s", pa.struct([("x", pa.int64())]))]))
    nan = float("nan")
    rows = [("p", nan, {"x": 1}), ("p", nan, {"x": 1}), (None, nan, {"x": 1}), (None, nan, {"x": 2}), (None, None, {"x": 2})]
    first = batch([dict(zip("afs", r)) for r in rows])
    assert runs.starts(first).tolist() == [True, False, True, True, True]
    assert runs.starts(batch([dict(zip("afs", r)) for r in (rows[4], rows[0])])).tolist() == [False, True]


def test_positions_need_no_join_of_rows(spark):
    """Two exchanges of rows in a windowed statistic: by range, then by block."""
    from tidewatch.operators.stats import rolling_std
    _, df = _frame(spark)
    d = rolling_std(df, "k", "t", "x", 4, tiebreak="tb")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_ffill_blocked_matches_pandas(spark):
    pdf, df = _frame(spark)
    d = Q.with_position(df, "k", ["t", "tb"])
    out = Q.ffill_blocked(d, "k", ["x"], ["xf"], block=32).toPandas().sort_values(["k", "t", "tb"])
    exp = pdf.sort_values(["k", "t", "tb"]).groupby("k")["x"].ffill()
    a, b = out["xf"].to_numpy(), exp.to_numpy()
    assert (np.isnan(a) == np.isnan(b)).all()
    assert np.nanmax(np.abs(a - b)) == 0


def test_series_stats_reach_every_block(spark):
    pdf, df = _frame(spark)
    got = Q.series_windowed(df, "k", ["t", "tb"], 2, lambda w: {"m": F.col("_m")}, block=8,
                            stats={"_m": F.max("t")}).toPandas()
    exp = pdf.groupby("k")["t"].max()
    assert (got["m"].to_numpy() == exp.loc[got["k"]].to_numpy()).all()


def test_positions_survive_bursts_ties_and_nulls(spark):
    """One old row and a burst at one instant, null times and keys."""
    rows = [("a", 0, 0)] + [("a", 10**9, i) for i in range(4000)] + [("a", None, i) for i in range(500)]
    rows += [(None, i, i) for i in range(50)] + [("b", None, 0)]
    df = spark.createDataFrame(rows, "k string, t long, v int")
    got = Q.with_position(df, "k", ["t"]).toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby("k", dropna=False):
        g = g.sort_values(Q.POS)
        assert list(g[Q.POS]) == list(range(len(g)))
        times = g["t"].fillna(-1).tolist()
        assert times == sorted(times)


def test_burst_is_spread_over_partitions(spark):
    """No partition of the written rows holds much more than its share."""
    df = spark.range(40000).select(F.lit("a").alias("k"), F.when(F.col("id") == 0, 0).otherwise(10**9).alias("t"), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        by = ["k", "t", Q._row_hash(df, ["k", "t"])]
        sizes = df.repartitionByRange(8, *by).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) == 8 and sizes.max() <= 2 * 40000 / 8


def test_positions_follow_the_instant_over_daylight_saving(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = 1730606400  # 2024-11-03 00:00 in New York; clocks go back at 02:00
        df = spark.range(24).select(F.lit(1).alias("k"), "id", F.timestamp_seconds(F.lit(start) + F.col("id") * 600).alias("t"))
        got = Q.with_position(df, "k", ["t"]).filter(F.col("id") != F.col(Q.POS)).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == 0


def test_percentiles_by_rank_match_numpy(spark):
    pdf, df = _frame(spark)
    got = Q.percentiles_by_rank(df, "k", "x", [0.0, 0.1, 0.5, 0.99, 1.0], list("abcde")).toPandas().set_index("k")
    for k, g in pdf.dropna().groupby("k"):
        np.testing.assert_allclose(got.loc[k].to_numpy(dtype=float), np.percentile(g["x"], [0, 10, 50, 99, 100]), atol=1e-12)
    one = Q.percentiles_by_rank(df, [], "x", [0.25], ["q"]).first()["q"]
    assert abs(one - np.percentile(pdf["x"].dropna(), 25)) < 1e-12
    assert Q.percentiles_by_rank(df.limit(0), "k", "x", [0.5], ["q"]).count() == 0
    assert Q.percentiles_by_rank(df.limit(0), [], "x", [0.5], ["q"]).collect()[0]["q"] is None
