"""EWMA, KDE and forecast detectors against independent pandas/numpy
implementations of the stated rules, on seeded synthetic series."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewatch.operators.ewma import ew_weights, ewma_detect
from tidewatch.operators.forecast import ar_forecast_detect
from tidewatch.operators.kde import kde_density, kde_detect


def _ewma_reference(x, window, k, direction, n_shift=1, ratio=0.01, weighted=False):
    s = pd.Series(x)
    target = s.shift(n_shift)
    ema = target.ewm(span=window, adjust=False).mean()
    if weighted:
        w = np.array(ew_weights(window))
        std = pd.Series([np.nan if i < window else
                         math.sqrt(np.sum(w * (target.values[i - window + 1:i + 1]
                                               - np.sum(w * target.values[i - window + 1:i + 1])) ** 2))
                         for i in range(len(x))])
    else:
        std = target.rolling(window).std()
    floor = ratio * s.abs()
    std = std.where(std >= floor, floor)
    ucl, lcl = ema + k * std, ema - k * std
    flag = {"high": s > ucl, "low": s < lcl, "both": (s > ucl) | (s < lcl)}[direction]
    flag.iloc[:window] = False
    keep = ema.notna() & ucl.notna() & lcl.notna() & s.notna()
    return set(np.flatnonzero(flag & keep))


def _novelty_series(n=200, seed=1):
    rng = np.random.default_rng(seed)
    x = np.sin(np.linspace(0, 6 * np.pi, n)) + rng.normal(0, 0.2, n)
    x[175:190] += 3
    x[190:] -= 3
    return x


def test_ewma_matches_reference_rules(spark):
    x = _novelty_series()
    df = spark.createDataFrame([("d1", i, float(v)) for i, v in enumerate(x)], "sn string, t long, v double")
    for window, k, direction, weighted in [(50, 2.5, "both", False), (60, 3.0, "low", True), (30, 2.0, "high", False)]:
        got = ewma_detect(df, "sn", "t", "v", window=window, no_of_stds=k, direction=direction,
                          use_weighted_std=weighted, block=64)
        assert {r.t for r in got.collect()} == _ewma_reference(x, window, k, direction, weighted=weighted)


def test_ewma_short_series_flags_nothing_and_recent(spark):
    x = _novelty_series()
    df = spark.createDataFrame([("d1", i, float(v)) for i, v in enumerate(x)], "sn string, t long, v double")
    assert ewma_detect(df.filter("t < 50"), "sn", "t", "v", window=50, direction="both").count() == 0
    allf = {r.t for r in ewma_detect(df, "sn", "t", "v", window=50, no_of_stds=2.5, direction="both").collect()}
    rec = {r.t for r in ewma_detect(df, "sn", "t", "v", window=50, no_of_stds=2.5, direction="both",
                                    recent=30).collect()}
    assert rec == {t for t in allf if t >= 170}


def test_ewma_minmax_scaler_detects_injection(spark):
    x = _novelty_series()
    df = spark.createDataFrame([("d1", i, float(v)) for i, v in enumerate(x)], "sn string, t long, v double")
    got = {r.t for r in ewma_detect(df, "sn", "t", "v", window=50, no_of_stds=2.5, direction="both",
                                    scaler="minmax").collect()}
    assert got and all(t >= 170 for t in got)


def test_kde_density_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(v)) for k in range(3) for v in rng.normal(k, 1 + k, 150)]
    rows += [(0, 40.0), (1, -25.0)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = kde_density(df, df, "k", "v", 0.5).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    for _, r in got.sample(60, random_state=0).iterrows():
        xs = pdf[pdf.k == r.k].v.to_numpy()
        exp = np.exp(-0.5 * ((r.v - xs) / 0.5) ** 2).sum() / (len(xs) * 0.5 * math.sqrt(2 * math.pi))
        assert abs(r.density - exp) <= 1e-12 * max(exp, 1e-300) + 1e-300


def test_kde_novelty_flags_injected_tail(spark):
    rng = np.random.default_rng(5)
    x = np.sin(np.linspace(0, 8 * np.pi, 200)) + rng.normal(0, 0.2, 200)
    x[180:190] += 4
    x[190:] -= 4
    df = spark.createDataFrame([("d", i, float(v)) for i, v in enumerate(x)], "sn string, t long, v double")
    both = {r.t for r in kde_detect(df, "sn", "t", "v", train=("head", 20), new=("tail", 20),
                                    filter_percentile=95, threshold_percentile=95, direction="both").collect()}
    low = {r.t for r in kde_detect(df, "sn", "t", "v", train=("head", 20), new=("tail", 20),
                                   filter_percentile=95, threshold_percentile=95, direction="low").collect()}
    high = {r.t for r in kde_detect(df, "sn", "t", "v", train=("head", 20), new=("tail", 20),
                                    filter_percentile=95, threshold_percentile=95, direction="high").collect()}
    assert both == low | high
    assert len(both) >= 15 and all(t >= 180 for t in both)


def test_ar_forecast_recovers_coefficient(spark):
    rng = np.random.default_rng(7)
    y = np.zeros(3000)
    for t in range(1, 3000):
        y[t] = 2.0 + 0.6 * y[t - 1] + rng.normal()
    y[-1] = y[-2] + 9  # injected spike at the held-out point
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "sn string, t long, v double")
    out = ar_forecast_detect(df, "sn", "t", "v", horizon=1, level=0.99, direction="both").collect()
    assert len(out) == 1 and out[0].is_anomaly and out[0].anomaly_type == "high"
    mean = 2.0 / (1 - 0.6)
    assert abs(out[0].forecast - (2.0 + 0.6 * y[-2])) < 0.2 or abs(out[0].forecast - mean) < 5


def test_series_that_cannot_be_fitted_have_null_forecasts(spark):
    from tidewatch.operators.forecast import ar_forecast_detect, arma11_forecast_detect, auto_ar_detect
    rng = np.random.default_rng(0)
    rows = [("flat", i, 5.0) for i in range(40)] + [("one", 0, 1.0), ("two", 0, 1.0), ("two", 1, 2.0)]
    rows += [("none", i, None) for i in range(20)] + [("ok", i, float(v)) for i, v in enumerate(rng.normal(size=60))]
    d = spark.createDataFrame(rows, "k string, t long, v double")
    for fn in (ar_forecast_detect, arma11_forecast_detect, auto_ar_detect):
        got = fn(d, "k", "t", "v", **({} if fn is auto_ar_detect else {"horizon": 2})).toPandas()
        ok = got[got.k == "ok"]
        assert len(ok) and ok.forecast.notna().all()
        assert not got[got.k == "flat"].is_anomaly.fillna(False).astype(bool).any()


def test_ensemble_with_arma_keeps_tie_breaks(spark):
    from tidewatch.operators.ensemble import ensemble
    rng = np.random.default_rng(3)
    rows = [("a", i, i, float(v)) for i, v in enumerate(rng.normal(size=80))]
    rows[-1] = ("a", 79, 79, -40.0)
    d = spark.createDataFrame(rows, "k string, t long, id long, v double")
    got = ensemble(d, "k", "t", "v", detectors=["arma", "kde"], tiebreak=["id"], params={"arima_horizon": 1}).toPandas()
    last = got[got.id == 79]
    assert len(last) == 1 and bool(last.is_outlier_arma.iloc[0])


def test_histogram_of_equal_scores(spark):
    from tidewatch.operators.report import score_histogram
    d = spark.createDataFrame([(2.0,)] * 5, "score double")
    assert [(r.bin, r["count"]) for r in score_histogram(d, 4).collect()] == [(0, 5)]


def test_filter_entities_one_null_rule(spark):
    from tidewatch.operators.clean import filter_entities
    d = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    for ids in (["a", None], ["a", None] + [f"x{i}" for i in range(2000)]):
        assert sorted(r.v for r in filter_entities(d, "k", ids).collect()) == [1, 3]


def test_kde_translated_moments_equal_all_pairs(spark):
    """Dense, sparse and far values; the relative error stays near rounding,
    and a shorter series or cutoff stays within its stated bound."""
    import math
    import numpy as np
    from pyspark.sql import functions as F
    from tidewatch.operators.kde import kde_density
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=1500) * 3, rng.uniform(-20, 20, 300), [55.0, 60.0, -1e6]])
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("b", 1.0), ("b", None)], "k string, v double")
    true = np.exp(-0.5 * ((x[:, None] - x) / 0.5) ** 2).sum(axis=1) / (len(x) * 0.5 * math.sqrt(2 * math.pi))
    for terms, cutoff in ((24, 9.0), (12, 9.0), (24, 5.0)):
        got = kde_density(df, df, "k", "v", 0.5, cutoff=cutoff, terms=terms).filter("k = 'a'").toPandas()
        mine = got.set_index("v")["density"].loc[x].to_numpy()
        bound = 1e-12 if (terms, cutoff) == (24, 9.0) else 3 * len(x) * max(
            math.exp(-cutoff ** 2 / 2), math.exp(-terms / 2) * (terms / 4) ** (terms / 2) / math.factorial(terms))
        assert np.abs(mine / true - 1).max() <= 1e-12 if bound == 1e-12 else (np.abs(mine - true) <= bound).all()
    own = kde_density(df, df, "k", "v", 0.5).filter("k = 'b'").orderBy(F.col("v").asc_nulls_last()).collect()
    assert own[0].density == 1 / (0.5 * math.sqrt(2 * math.pi)) and own[1].density is None


def test_kde_explodes_boxes_not_rows(spark):
    from tidewatch.operators.kde import box_moments
    df = spark.range(5000).selectExpr("'a' AS k", "(id % 100) / 25.0D AS v")
    plan = box_moments(df, "k", "v", 0.5)._jdf.queryExecution().optimizedPlan().toString()
    explode = plan.index("Generate explode")
    assert plan.count("Generate") == 1 and "Aggregate" in plan[explode:]        # distinct boxes below the explode
    assert box_moments(df, "k", "v", 0.5).count() == 8
