"""Work and memory of operators at size, seen from their plans, beside the
same results."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _density(x, xs, h=0.5):
    return float(np.exp(-0.5 * ((x - xs) / h) ** 2).sum() / (len(xs) * h * math.sqrt(2 * math.pi)))


def test_kde_curve_joins_no_grid(spark):
    from tidewatch.operators.kde import kde_curve
    rng = np.random.default_rng(4)
    rows = [("a", float(v)) for v in rng.normal(0, 40, 300)] + [("a", 900.0), ("b", 7.0), (None, 127.9), (None, 128.1), ("n", None)]
    d = kde_curve(spark.createDataFrame(rows, "k string, v double"), "k", "v", 0.5, points=200)
    assert "Join" not in _plan(d)      # the boxes of the grid were broadcast
    got = d.collect()
    assert sorted({(r.k is None, r.k or "") for r in got}) == [(False, "a"), (False, "b"), (False, "n"), (True, "")]
    for k in ("a", "b", None):
        xs = np.array([v for key, v in rows if key == k])
        mine = sorted((r for r in got if r.k == k), key=lambda r: r.i)
        assert [r.i for r in mine] == list(range(200)) and mine[-1].x == xs.max() + 1 and mine[0].x == xs.min() - 1
        for r in mine:
            assert abs(r.density - _density(r.x, xs)) < 1e-13
    assert [(r.x, r.density) for r in got if r.k == "n"] == [(None, None)] * 200


def test_kde_boxes_are_sent_to_at_most_two_strips(spark):
    from tidewatch.operators.kde import box_moments, kde_density
    values = [float(v) for v in np.arange(-300, 300, 0.5)]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    moments = box_moments(df, "k", "v", 0.5)
    assert "(_from" not in _plan(moments) and moments.count() == len(values)    # 21 rows a box before
    xs = np.array(values)
    for r in kde_density(df, df, "k", "v", 0.5).collect():
        assert abs(r.density - _density(r.v, xs)) < 1e-13


def test_kde_moments_are_not_broadcast(spark):
    from tidewatch.operators.kde import kde_density
    df = spark.createDataFrame([("a", float(v)) for v in range(50)], "k string, v double")
    plan = kde_density(df, df, "k", "v", 0.5).drop("density")._jdf.queryExecution().analyzed().toString()
    assert "strategy=merge" in plan


def test_ew_std_computes_the_mean_once(spark):
    from tidewatch.operators.stats import ew_std
    from tidewatch.operators.ewma import ew_weights
    x = np.random.default_rng(2).normal(5, 2, 60)
    d = ew_std(spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "k string, t int, v double"), "k", "t", "v", 8)
    assert _plan(d).count("aggregate(") == 2        # three with the mean inside the sum of squares
    w = np.array(ew_weights(8))
    for r in d.collect():
        if r.t < 8:
            assert r.ew_std is None
        else:
            f = x[r.t - 7:r.t + 1]
            assert abs(r.ew_std - math.sqrt((w * (f - (w * f).sum()) ** 2).sum())) < 1e-12


def _wave(spark, n=300):
    x = np.random.default_rng(6).normal(10, 2, n)
    x[::40] += 9
    return spark.createDataFrame([(k, i, float(v)) for k in ("a", "b") for i, v in enumerate(x)], "k string, t int, v double")


def test_ensemble_reads_its_input_once(spark, monkeypatch):
    from tidewatch.operators import ensemble as E
    seen = []

    def flags(df, keys, time, value, name, **kw):
        seen.append(_plan(df))
        return df.filter(F.col(value) > 15).select(*keys, time, value)
    monkeypatch.setattr(E, "detector_flags", flags)
    daily = _wave(spark).groupBy("k", "t").agg(F.avg("v").alias("v"))
    assert E.ensemble(daily, "k", "t", "v").count() > 0
    assert len(seen) == 2 and not any("Aggregate" in p for p in seen)


def test_kde_detect_judges_only_rows_beyond_the_bounds(spark, monkeypatch):
    from tidewatch.operators import kde
    df, judged, real = _wave(spark), [], kde.kde_density

    def density(points, *args, **kw):
        judged.append(points)
        return real(points, *args, **kw)
    monkeypatch.setattr(kde, "kde_density", density)
    kw = dict(filter_percentile=99, threshold_percentile=95, direction="both")
    every = kde.kde_detect(df, "k", "t", "v", only_anomalies=False, **kw)
    few = kde.kde_detect(df, "k", "t", "v", **kw)
    assert sorted(few.collect()) == sorted(every.filter("is_outlier").collect()) and every.count() == 600
    assert judged[-1].count() < 100


def test_two_stage_runs_stage_one_once(spark):
    from tidewatch.operators.report import two_stage_detect
    seen = []
    two_stage_detect(_wave(spark), "k", "t", "v", stage1=dict(window=20, no_of_stds=2.0, direction="high"),
                     stage2=lambda d: seen.append(d) or d)
    assert "Join" not in _plan(seen[0]) and seen[0].count() == 600


def test_outlier_flag_computes_scores_once(spark):
    from tidewatch.operators.report import slice_dev_score, with_outlier_flag
    d = spark.createDataFrame([([float(i), 2.0, 3.0],) for i in range(200)], "x array<double>")
    out = with_outlier_flag(slice_dev_score(d), 99)
    assert "aggregate(" not in _plan(out) and out.filter("is_outlier").count() == 2


def _gappy(spark):
    """Daily series with gaps over several chunks, a null key, null times and
    buckets that hold nulls only (the first of a, the last of b)."""
    import datetime as dt
    day = lambda n: dt.datetime(1969, 12, 28) + dt.timedelta(days=n)
    rows = [("a", day(0), None), ("a", day(3), 5.0), ("a", day(3), 7.0), ("a", day(40), 1.0), ("b", day(2), 4.0), ("b", day(9), None),
            ("one", day(5), 2.0), (None, day(1), 3.0), (None, day(8), 8.0), ("a", None, 99.0), ("lost", None, 1.0)]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, v double"), day


def test_resampled_rows_know_their_position_without_ranking(spark, monkeypatch):
    from tidewatch.operators import forecast, resample

    def ranked(*a, **kw):
        raise AssertionError("an evenly spaced series was ranked")
    monkeypatch.setattr(resample, "with_position", ranked)
    monkeypatch.setattr(forecast, "with_position", ranked)
    df, day = _gappy(spark)
    for method in ("zero", "ffill", "bfill", "interpolate"):
        got = forecast.prepare_series(df, "k", "t", "v", freq="1 day", fill_method=method)
        for k, lo, hi, known in (("a", 0, 40, {3: 6.0, 40: 1.0}), ("b", 2, 9, {2: 4.0}), ("one", 5, 5, {5: 2.0}), (None, 1, 8, {1: 3.0, 8: 8.0})):
            v = pd.Series([known.get(i, np.nan) for i in range(lo, hi + 1)])
            v = {"zero": lambda: v.fillna(0), "ffill": v.ffill, "bfill": v.bfill, "interpolate": v.interpolate}[method]()
            mine = sorted((r._pos, r.t, r.v) for r in got.collect() if r.k == k)
            assert [m[:2] for m in mine] == [(i - lo, day(i)) for i in range(lo, hi + 1)]
            assert np.allclose([np.nan if m[2] is None else m[2] for m in mine], v, equal_nan=True)
        assert got.filter("k = 'lost'").count() == 0
        kept = forecast.prepare_series(df, "k", "t", "v", freq="1 day", fill_method=method, drop_null=True)
        held = {r.k: r.t for r in forecast.split_horizon(kept, "k", "t", 1).filter("step = 1").collect()}
        assert held == {"a": day(40), "b": day(2 if method == "bfill" else 9), "one": day(5), None: day(8)}


def test_empty_buckets_are_unfolded_by_several_tasks(spark):
    from tidewatch.operators.resample import resample_mean, spine
    df, _ = _gappy(spark)
    for chunk in (4, 1 << 16):
        got = resample_mean(df, "k", "t", "v", "1 day", chunk=chunk).collect()
        assert len(got) == 41 + 8 + 1 + 8 and sum(r.v is not None for r in got) == 6
    pairs = [(f"s{i}", d) for i in range(40) for d in (0, 50)]
    s = spark.createDataFrame([(k, 86_400 * d, 1.0) for k, d in pairs], "k string, t long, v double").withColumn("t", F.timestamp_seconds("t"))
    ranges = s.groupBy("k").agg(F.min(F.unix_micros("t")).alias("_lo"), F.max(F.unix_micros("t")).alias("_hi"))
    for d in (resample_mean(s, "k", "t", "v", "1 day"), spine(ranges, ["k"], 86_400_000_000)):
        assert d.count() == 40 * 51
        assert d.select(F.spark_partition_id()).distinct().count() > 1     # one task before


def test_auto_ar_sums_in_one_pass_over_the_common_sample(spark, monkeypatch):
    from tidewatch.operators import forecast
    written = []
    keep = forecast.materialize
    monkeypatch.setattr(forecast, "materialize", lambda d: written.append(d) or keep(d))
    rng = np.random.default_rng(5)
    series = {"level": rng.normal(10, 1, 60), "walk": rng.normal(0, 1, 60).cumsum(), "few": rng.normal(0, 1, 8)}
    df = spark.createDataFrame([(k, i, float(v)) for k, y in series.items() for i, v in enumerate(y)], "k string, t long, v double")
    got = {r.k: r for r in forecast.auto_ar_detect(df, "k", "t", "v").collect()}
    assert len(written) == 1 and set(got) == {"level", "walk"}         # the lags were written too
    for k, r in got.items():
        y, best = series[k][:-1], []
        for d in (0, 1):
            x = np.diff(y, d)
            x = x[len(x) - (len(y) - 3) - 2:] if d else x[1:]       # two lags before the common sample
            for p in (0, 1, 2):
                a = np.column_stack([np.ones(len(x) - 2), *[x[2 - i:len(x) - i] for i in range(1, p + 1)]])
                b = np.linalg.lstsq(a, x[2:], rcond=None)[0]
                n, sse, kk = len(x) - 2, float(((x[2:] - a @ b) ** 2).sum()), p + 2
                ahead = float(b[0] + sum(c * x[-i] for i, c in enumerate(b[1:], 1)))
                best.append((n * np.log(sse / n) + 2 * kk + 2 * kk * (kk + 1) / (n - kk - 1), d, p, ahead + (y[-1] if d else 0)))
        _, d, p, ahead = min(best)
        assert (r.d, r.p) == (d, p) and abs(r.forecast - ahead) < 1e-9


def _chart_rows(spark):
    """Series of several blocks with nulls, a gap longer than a block, a flat
    stretch, one row, no value, a null key."""
    rng = np.random.default_rng(8)
    y = {"long": rng.normal(50, 5, 700), "gap": rng.normal(-3, 1, 400), "flat": np.r_[rng.normal(0, 1, 90), np.full(200, 0.1), 4.0],
         "one": np.ones(1), "none": np.full(40, np.nan), None: rng.normal(0, 2, 130)}
    y["gap"][100:260] = np.nan
    y["long"][rng.random(700) < 0.03] = np.nan
    rows = [(k, i, None if np.isnan(v) else float(v)) for k, s in y.items() for i, v in enumerate(s)]
    return y, spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "k string, t long, v double")


def test_chart_writes_and_deals_its_rows_once(spark, monkeypatch):
    from tidewatch.operators import ewma, sequence
    written = []
    for module in (ewma, sequence):
        monkeypatch.setattr(module, "materialize", lambda d, keep=module.materialize: written.append(len(d.columns)) or keep(d))
    y, df = _chart_rows(spark)
    for kw in ({"n_shift": 1}, {"n_shift": 3}, {"n_shift": 0}, {"scaler": "standard"}):
        written.clear()
        d = ewma.ewma_detect(df, "k", "t", "v", window=20, min_std_ratio=0.0, block=8, only_anomalies=False, direction="both", **kw)
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" not in plan and "Window" not in plan      # a frame per row, a frame of pandas per block
        assert "scaler" in kw or max(written) <= 5                    # positions and maps: the rows were written twice
        got, shift = d.toPandas(), kw.get("n_shift", 1)
        for k, x in y.items():
            g = got[got.k.isna() if k is None else got.k == k].sort_values("t")
            x = pd.Series(x)
            if "scaler" in kw:
                x = (x - x.mean()) / (x.std(ddof=0) or 1)
            past = x.shift(shift)
            exp = pd.DataFrame({"x": x, "ema": past.ewm(span=20, adjust=False).mean(), "std": past.rolling(20).std()}).dropna(subset=["x", "ema"])
            assert list(g.t) == list(exp.index)
            assert np.allclose(g.ema, exp.ema, rtol=0, atol=1e-12) and np.allclose(g["std"], exp["std"].fillna(0), rtol=0, atol=1e-7)


def test_rolling_std_slides_without_a_frame_per_row(spark):
    from tidewatch.operators.stats import rolling_std
    y, df = _chart_rows(spark)
    for window, shift, block in ((20, 0, 8), (5, 2, 4), (1, 0, 8)):
        d = rolling_std(df, "k", "t", "v", window, shift=shift, block=block)
        assert "stddev_samp" not in _plan(d)
        got = d.toPandas()
        for k, x in y.items():
            g = got[got.k.isna() if k is None else got.k == k].sort_values("t")
            assert np.allclose(g.rolling_std, pd.Series(x).shift(shift).rolling(window).std(), rtol=0, atol=1e-7, equal_nan=True)
        flat = got[(got.k == "flat") & (got.t.between(120, 280))]
        assert window == 1 or (flat.rolling_std == 0).all()
    huge = spark.createDataFrame([("a", i, v) for i, v in enumerate([1e9, 1e9 + 1, 1e9 + 2, float("nan"), 1.0, 2.0, 3.0])], "k string, t int, v double")
    got = [r.rolling_std for r in rolling_std(huge, "k", "t", "v", 3).orderBy("t").collect()]
    assert got[:2] == [None, None] and abs(got[2] - 1) < 1e-9 and abs(got[6] - 1) < 1e-12 and all(math.isnan(v) for v in got[3:6])


def test_chart_of_short_series_needs_no_states(spark, monkeypatch):
    from tidewatch.operators import ewma, sequence
    y, df = _chart_rows(spark)
    kw = dict(window=20, only_anomalies=False, direction="both")
    rows = lambda d: sorted(((r.k or "", r.t, round(r.ema, 9), round(r.ucl, 9)) for r in d.collect()))
    long = rows(ewma.ewma_detect(df, "k", "t", "v", block=8, **kw))

    def entered(*a, **kw):
        raise AssertionError("states of blocks that nothing enters")
    monkeypatch.setattr(sequence, "ewm_entering", entered)
    assert rows(ewma.ewma_detect(df, "k", "t", "v", **kw)) == long
    assert ewma.ewma_detect(df.limit(0), "k", "t", "v", **kw).count() == 0


def _odd_series(spark, n=40):
    """Series of different length, also one and two rows, null keys and
    values, equal times, values far apart and values equal to each other."""
    rng = np.random.default_rng(11)
    rows = [(f"s{i:02d}", j, float(v)) for i in range(n) for j, v in enumerate(np.r_[rng.normal(0, 3, 5 + 2 * i), rng.choice([-30.0, 2e5, 2.0], 2)])]
    rows += [(None, j, float(v)) for j, v in enumerate(rng.normal(5, 1, 60))] + [("one", 1, 3.0), ("two", 1, 3.0), ("two", 2, 4.0), ("none", 1, None)]
    rows += [("s30", 3, 1.25), ("s30", 3, 40.0), ("s30", None, 7.0), ("nan", 1, float("nan")), ("flat", 1, 2.0), ("flat", 2, 2.0), ("flat", 2, 2.0)]
    return spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "k string, t int, v double")


def _rounded(rows):
    return sorted(tuple("" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


def test_cut_tells_which_series_lie_whole_in_a_partition(spark, monkeypatch):
    from tidewatch.operators import sequence as Q
    df = _odd_series(spark)
    for whole in (1 << 16, 100, 20, 0):
        monkeypatch.setattr(Q, "WHOLE", whole)
        for kw in ({}, {"descending": True}):
            d = Q.with_position(df, "k", "t", cut=Q.CUT, **kw).withColumn("p", F.spark_partition_id())
            places = {}
            for r in d.collect():
                places.setdefault(r.k, []).append((r.p, r[Q.POS], r[Q.CUT]))
            assert {k: sorted(x[1] for x in v) for k, v in places.items()} == {k: list(range(len(v))) for k, v in places.items()}
            for v in places.values():
                if not any(cut for _, _, cut in v):
                    assert len({p for p, _, _ in v}) == 1 and [x[1] for x in v] == sorted(x[1] for x in v) and len(v) <= whole
                else:
                    assert all(cut for _, _, cut in v)
            assert whole < 1 << 16 or not any(cut for v in places.values() for _, _, cut in v)


def test_kde_detect_deals_rows_and_no_moments(spark, monkeypatch):
    from tidewatch.operators import kde, sequence as Q
    df, real = _odd_series(spark), kde.box_moments

    def sent(*a, **kw):
        raise AssertionError("moments were written: 24 values for each box")
    for kw in (dict(filter_percentile=99, threshold_percentile=95, direction="both"), dict(threshold_percentile=90, direction="low"),
               dict(train=("head", 4), new=("tail", 4), threshold_percentile=90, direction="high"),
               dict(new=("tail", 3), exclude_new=True, threshold_percentile=80, direction="both", only_anomalies=False)):
        got = []
        for whole in (1 << 16, 50, 0):           # 50: some series are spread over tasks, 0: all
            monkeypatch.setattr(Q, "WHOLE", whole)
            monkeypatch.setattr(kde, "box_moments", sent if whole > 50 else real)
            d = kde.kde_detect(df, "k", "t", "v", **kw)
            assert d.columns == ["k", "t", "v", "lower", "upper", "threshold", "density", "is_outlier"]
            got.append(_rounded(d.collect()))
        assert got[0] == got[1] == got[2] and len(got[0]) > 5
    monkeypatch.setattr(Q, "WHOLE", 1 << 16)
    monkeypatch.setattr(kde, "box_moments", sent)
    d = kde.kde_detect(df, "k", "t", "v", bandwidth=0.5, only_anomalies=False, direction="both").filter("k = 's20'").collect()
    xs = np.array([r.v for r in df.collect() if r.k == "s20"])
    assert len(d) == len(xs)
    for r in d:
        assert abs(r.density - _density(r.v, xs)) < 1e-13
        assert abs(r.threshold - np.quantile([_density(v, xs) for v in xs], 0.01)) < 1e-13


def test_kde_detect_takes_other_types_and_no_keys(spark, monkeypatch):
    from tidewatch.operators import kde, sequence as Q
    df = _odd_series(spark).filter("v between -1000 and 1000 and k is not null")
    for kind in ("float", "int", "decimal(12,3)"):
        got = []
        for whole in (1 << 16, 0):
            monkeypatch.setattr(Q, "WHOLE", whole)
            got.append(_rounded(kde.kde_detect(df.withColumn("v", F.col("v").cast(kind)), "k", "t", "v", threshold_percentile=90, direction="both").collect()))
        assert got[0] == got[1] and got[0]
    assert kde.kde_detect(df, [], "t", "v", threshold_percentile=90, direction="both", only_anomalies=False).count() == df.count()
    assert kde.kde_detect(df.limit(0), "k", "t", "v").count() == 0


def test_ensemble_takes_series_where_they_lie(spark, monkeypatch):
    from tidewatch.operators import ensemble as E, sequence as Q
    df = _odd_series(spark)
    params = {"bandwidth": 0.5, "filter_percentile": 99, "threshold_percentile": 90, "anomaly_direction": "both", "window": 10, "no_of_stds": 1.5}
    for kw in ({}, dict(min_points=30), dict(only_anomalies=False, rule="all"), dict(tail=1, min_points=10)):
        p, kw, got = dict(params), dict(kw), []
        if kw.pop("tail", 0):
            p |= {"kde_new": ("tail", 1), "recent_window_size": 1, "scaler": "standard"}
        for whole in (1 << 16, 50):
            monkeypatch.setattr(Q, "WHOLE", whole)
            d = E.ensemble(df, "k", "t", "v", params=p, **kw)
            if whole > 50 and not kw:
                assert "RepartitionByExpression" not in _plan(d)        # dealt once more by each detector
            got.append(_rounded(d.collect()))
        assert got[0] == got[1] and got[0]


def test_chart_of_whole_series_leaves_out_rows_within_the_limits(spark, monkeypatch):
    from tidewatch.operators import ewma, sequence as Q
    y, df = _chart_rows(spark)
    for kw in (dict(direction="both"), dict(direction="low", n_shift=3), dict(direction="high", min_std_ratio=0.2), dict(direction="both", no_of_stds=0.0)):
        kw = {"window": 20, "no_of_stds": 1.5, **kw}
        every = ewma.ewma_detect(df, "k", "t", "v", only_anomalies=False, **kw).filter("is_outlier").collect()
        placed = Q.with_position(df, "k", "t", cut=Q.CUT)
        for d in (ewma.ewma_detect(df, "k", "t", "v", **kw), ewma.ewma_detect(df, "k", "t", "v", block=8, **kw), ewma.ewma_detect(placed, "k", "t", "v", **kw)):
            assert d.columns == ["k", "t", "v", "scaled", "ema", "std", "ucl", "lcl", "is_outlier", "anomaly_type"]
            assert _rounded(d.collect()) == _rounded(every)
        assert len(every) > 20


def test_min_points_counts_whole_series_where_they_lie(spark, monkeypatch):
    from tidewatch.operators import reshape, sequence as Q
    df = _odd_series(spark)
    exp = _rounded(reshape.min_points(df, "k", 30).collect())
    for whole in (1 << 16, 50, 0):
        monkeypatch.setattr(Q, "WHOLE", whole)
        got = reshape.min_points(Q.with_position(df, "k", "t", cut=Q.CUT), "k", 30)
        assert _rounded(got.select("k", "t", "v").collect()) == exp
        runs = got.withColumn("p", F.spark_partition_id()).filter(~F.col(Q.CUT)).groupBy("k").agg(F.countDistinct("p").alias("n"))
        assert runs.filter("n > 1").count() == 0
