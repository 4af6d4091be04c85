"""Forecast-interval detectors: AR(1), ARMA(1,1) and automatic AR order.

Every fit is a per-series aggregate of lagged values (means, variances,
covariances — map-side combined, hot-key safe) solved in closed form, so
nothing but a handful of coefficients per series ever meets in one place.

* :func:`ar_forecast_detect` — ``y_t = c + phi*y_(t-1) + e`` by OLS.
* :func:`arma11_forecast_detect` — ARMA(1,1) by Hannan–Rissanen: an AR(2)
  OLS gives innovation estimates ``e``; then ``y_t = c + phi*y_(t-1) +
  theta*e_(t-1)`` by OLS.
* :func:`auto_ar_detect` — candidates ``p in {0,1,2}``, ``d in {0,1}`` fitted
  on a common sample, the lowest AICc wins.

Intervals are ``forecast ± z * sigma * sqrt(sum psi_j^2)``.  Maximum
likelihood parity with other ARIMA fitters is not a goal; the estimators
are stated here so results are reproducible anywhere (see the SQL
oracles).

A series that cannot be fitted (constant, too short, or without any value)
has null forecasts and limits and no anomalies; it never fails the job.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalar import anomaly_type, directional_flag
from tidewatch.operators.resample import fill_gaps, resample_mean
from tidewatch.operators.sequence import POS, as_list, series_windowed, with_position
from tidewatch.operators.stats import attach_by_key
from tidewatch.session import materialize


def z_value(level: float) -> float:
    """Two-sided normal quantile; ``level`` as 0.99 or 99."""
    lv = level / 100 if level > 1 else level
    return NormalDist().inv_cdf(1 - (1 - lv) / 2)


def ols_aggs(y: str, xs: list[str], pre: str, n: Column | None = None) -> list[Column]:
    """Aggregates for OLS of ``y`` on ``xs`` (<= 2) with intercept; ``n``
    counts the rows of the sample where others, with nulls, are among them."""
    a = [(F.count(F.lit(1)) if n is None else n).alias(f"{pre}n"), F.avg(y).alias(f"{pre}my"), F.var_pop(y).alias(f"{pre}syy")]
    for i, x in enumerate(xs, 1):
        a += [F.avg(x).alias(f"{pre}m{i}"), F.var_pop(x).alias(f"{pre}s{i}{i}"),
              F.covar_pop(x, y).alias(f"{pre}s{i}y")]
    if len(xs) == 2:
        a.append(F.covar_pop(xs[0], xs[1]).alias(f"{pre}s12"))
    return a


def ols_solve(k: int, pre: str) -> dict[str, Column]:
    """Coefficients ``{pre}c, {pre}b1.., {pre}sse`` from :func:`ols_aggs`."""
    c = lambda n: F.col(f"{pre}{n}")
    if k == 0:
        return {f"{pre}c": c("my"), f"{pre}sse": c("n") * c("syy")}
    if k == 1:
        b1 = F.try_divide(c("s1y"), c("s11"))
        return {f"{pre}b1": b1, f"{pre}c": c("my") - b1 * c("m1"),
                f"{pre}sse": c("n") * (c("syy") - b1 * c("s1y"))}
    det = c("s11") * c("s22") - c("s12") * c("s12")
    b1 = F.try_divide(c("s1y") * c("s22") - c("s2y") * c("s12"), det)
    b2 = F.try_divide(c("s2y") * c("s11") - c("s1y") * c("s12"), det)
    return {f"{pre}b1": b1, f"{pre}b2": b2, f"{pre}c": c("my") - b1 * c("m1") - b2 * c("m2"),
            f"{pre}sse": c("n") * (c("syy") - b1 * c("s1y") - b2 * c("s2y"))}


def _sigma(sse: Column, freedom: Column) -> Column:
    """Residual deviation; null without degrees of freedom."""
    return F.when((freedom > 0) & (sse >= 0), F.sqrt(F.try_divide(sse, freedom)))


def _fit(d: DataFrame, keys, y: str, xs: list[str], pre: str) -> DataFrame:
    keys = as_list(keys)
    rows = d.filter(F.col(y).isNotNull())
    for x in xs:
        rows = rows.filter(F.col(x).isNotNull())
    fit = rows.groupBy(*keys).agg(*ols_aggs(y, xs, pre))
    return fit.withColumns(ols_solve(len(xs), pre))


def prepare_series(df: DataFrame, keys, time: str, value: str, *, freq=None,
                   fill_method: str | None = "interpolate", drop_null: bool = False) -> DataFrame:
    """Optional fixed-frequency resample + gap fill, as the forecasters
    expect an evenly spaced series.  The rows carry their position
    (``_pos``, for filling, splitting and lags), which a resample gives
    without ranking, with the series' length (``_n``) where it is known, and
    are written once.  ``drop_null`` drops rows without a value: where gaps
    are filled those are only leading ones (trailing ones for ``bfill``)."""
    keys = as_list(keys)
    d = df.select(*keys, time, value)
    some = F.col(value).isNotNull() if drop_null else F.lit(True)
    if freq is None or not fill_method and drop_null:
        d = d if freq is None else materialize(resample_mean(d, keys, time, value, freq))      # positions read it twice
        return materialize(with_position(d.filter(some), keys, [time]))
    d = resample_mean(d, keys, time, value, freq, keep_pos=True)
    if not fill_method:
        return materialize(d)
    if fill_method != "zero":
        d = materialize(d)      # filling reads it twice
    if fill_method == "bfill" and drop_null:
        d = d.drop("_n")
    return materialize(fill_gaps(d, keys, time, value, fill_method, keep_pos=True).filter(some))


def split_horizon(d: DataFrame, keys, time: str, horizon: int) -> DataFrame:
    """Adds ``step``: 1..horizon for the held-out tail, null for training.
    The length of a series is taken from ``_n`` where the rows carry it."""
    if POS not in d.columns:
        d = with_position(d, keys, [time])
    if "_n" not in d.columns:
        n = d.groupBy(*as_list(keys)).agg((F.max(POS) + 1).alias("_n"))
        d = attach_by_key(d, n, keys)
    held = F.col(POS) - F.col("_n") + F.lit(horizon) + 1
    return d.withColumn("step", F.when(held >= 1, held)).drop("_n")


def _geo(r: Column, k: Column) -> Column:
    """1 + r + ... + r^(k-1)."""
    return F.when(r == 1, k.cast("double")).otherwise((1 - F.pow(r, k)) / (1 - r))


def _flags(d: DataFrame, value: str, direction: str) -> DataFrame:
    return (d.withColumn("is_anomaly", directional_flag(value, "lo", "hi", direction))
             .withColumn("anomaly_type", anomaly_type(value, "lo", "hi", direction)))


def ar_forecast_detect(df: DataFrame, keys, time: str, value: str, *, horizon: int = 24,
                       level: float = 0.99, direction: str = "both", freq=None,
                       fill_method: str | None = "interpolate") -> DataFrame:
    """AR(1)-with-constant forecast of the last ``horizon`` points; returns
    the test rows with ``forecast, lo, hi, is_anomaly, anomaly_type``."""
    keys = as_list(keys)
    z = z_value(level)
    d = split_horizon(prepare_series(df, keys, time, value, freq=freq, fill_method=fill_method),
                      keys, time, horizon)
    train = d.filter(F.col("step").isNull())
    lag = series_windowed(train, keys, [time], 1, lambda w: {"_x1": F.lag(value, 1).over(w)})
    fit = _fit(lag, keys, value, ["_x1"], "f_")
    last = train.groupBy(*keys).agg(F.max_by(value, time).alias("_yT"))
    fit = attach_by_key(fit, last, keys).withColumn("_sig", _sigma(F.col("f_sse"), F.col("f_n") - 2))
    test = attach_by_key(d.filter(F.col("step").isNotNull()), fit, keys)
    phi, k = F.col("f_b1"), F.col("step")
    fc = F.col("f_c") * _geo(phi, k) + F.pow(phi, k) * F.col("_yT")
    var = F.pow(F.col("_sig"), 2) * _geo(phi * phi, k)
    test = (test.withColumn("forecast", fc)
                .withColumn("lo", F.col("forecast") - z * F.sqrt(var))
                .withColumn("hi", F.col("forecast") + z * F.sqrt(var)))
    test = _flags(test, value, direction)
    return test.select(*keys, time, "step", value, "forecast", "lo", "hi", "is_anomaly", "anomaly_type")


def arma11_forecast_detect(df: DataFrame, keys, time: str, value: str, *, horizon: int = 1,
                           level: float = 0.995, direction: str = "low", freq=None,
                           fill_method: str | None = "ffill", differences: int = 0) -> DataFrame:
    """ARMA(1,1) with constant by Hannan–Rissanen (AR(2) innovations), of
    the values or, with ``differences=1``, of their first differences
    (ARIMA(1,1,1) with drift), whose forecasts are summed up from the last
    training value."""
    if differences not in (0, 1):
        raise ValueError("differences must be 0 or 1")
    keys = as_list(keys)
    z = z_value(level)
    d = split_horizon(prepare_series(df, keys, time, value, freq=freq, fill_method=fill_method),
                      keys, time, horizon)
    train = d.filter(F.col("step").isNull())
    lags = series_windowed(train, keys, [time], 2 + differences,
                           lambda w: {f"_v{i}": F.lag(value, i).over(w) for i in range(1, 3 + differences)}, keep_pos=True)
    v = [F.col(value), *[F.col(f"_v{i}") for i in range(1, 3 + differences)]]
    if differences:
        v = [a - b for a, b in zip(v, v[1:])]
    lags = lags.withColumns({"_w": v[0], "_x1": v[1], "_x2": v[2]})
    s1 = _fit(lags, keys, "_w", ["_x1", "_x2"], "a_").select(*keys, "a_c", "a_b1", "a_b2")
    lags = attach_by_key(lags, s1, keys)
    lags = lags.withColumn("_e", F.col("_w") - F.col("a_c") - F.col("a_b1") * F.col("_x1")
                           - F.col("a_b2") * F.col("_x2"))
    lags = series_windowed(lags.drop("a_c", "a_b1", "a_b2"), keys, [time], 1,
                           lambda w: {"_e1": F.lag("_e", 1).over(w)})
    fit = _fit(lags, keys, "_w", ["_x1", "_e1"], "h_")
    fit = fit.withColumn("_sig", _sigma(F.col("h_sse"), F.col("h_n") - 3))
    last = lags.groupBy(*keys).agg(F.max_by("_w", time).alias("_wT"), F.max_by("_e", time).alias("_eT"),
                                   F.max_by(value, time).alias("_yT"))
    fit = attach_by_key(fit, last, keys)
    test = attach_by_key(d.filter(F.col("step").isNotNull()), fit, keys)
    phi, theta, k = F.col("h_b1"), F.col("h_b2"), F.col("step")
    one = F.col("h_c") + phi * F.col("_wT") + theta * F.col("_eT")

    def at(i: Column) -> Column:
        return F.col("h_c") * _geo(phi, i - 1) + F.pow(phi, i - 1) * one

    if differences:
        zero, add = F.lit(0.0), lambda a, x: a + x
        fc = F.col("_yT") + F.aggregate(F.transform(F.sequence(F.lit(1), k.cast("int")), at), zero, add)
        psi = F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda i: F.pow(1 + (phi + theta) * _geo(phi, i), 2))
        var = F.pow(F.col("_sig"), 2) * F.aggregate(psi, zero, add)
    else:
        fc = at(k)
        var = F.pow(F.col("_sig"), 2) * (1 + F.pow(phi + theta, 2) * _geo(phi * phi, k - 1))
    test = (test.withColumn("forecast", fc)
                .withColumn("lo", F.col("forecast") - z * F.sqrt(var))
                .withColumn("hi", F.col("forecast") + z * F.sqrt(var)))
    test = _flags(test, value, direction)
    return test.select(*keys, time, "step", value, "forecast", "lo", "hi", "is_anomaly", "anomaly_type")


AUTO_CANDIDATES = [(p, dd) for dd in (0, 1) for p in (0, 1, 2)]


def auto_ar_detect(df: DataFrame, keys, time: str, value: str, *, level: float = 0.99,
                   direction: str = "low", freq=None, fill_method: str | None = "interpolate",
                   min_points: int = 10) -> DataFrame:
    """One-step-ahead forecast of each series' last point with the AR order
    ``p`` and differencing ``d`` that minimise AICc on a common sample.

    AICc = n ln(SSE/n) + 2k + 2k(k+1)/(n-k-1), k = p + 2.  Ties go to the
    smaller (d, p).  Series with fewer than ``min_points`` rows are skipped.
    """
    keys = as_list(keys)
    zq = z_value(level)
    d = split_horizon(prepare_series(df, keys, time, value, freq=freq, fill_method=fill_method, drop_null=True),
                      keys, time, 1)
    train = d.filter(F.col("step").isNull())
    lags = series_windowed(train, keys, [time], 3, lambda w: {f"_y{i}": F.lag(value, i).over(w) for i in (1, 2, 3)})
    y = [F.col(value), *[F.col(f"_y{i}") for i in (1, 2, 3)]]
    common = y[3].isNotNull()
    lags = lags.withColumns({"_v0": F.when(common, y[0]), "_v1": F.when(common, y[1]), "_v2": F.when(common, y[2]),
                             "_d0": F.when(common, y[0] - y[1]), "_d1": F.when(common, y[1] - y[2]),
                             "_d2": F.when(common, y[2] - y[3])})
    targets = {0: ("_v0", ["_v1", "_v2"]), 1: ("_d0", ["_d1", "_d2"])}
    aggs = []
    for (p, dd) in AUTO_CANDIDATES:
        t, xs = targets[dd]
        aggs += ols_aggs(t, xs[:p], f"c{p}{dd}_", F.count_if(common))
    # the sums over the common sample and the last values come from one pass over the rows
    fit = lags.groupBy(*keys).agg(*aggs, F.max_by(value, time).alias("_l1"), F.max_by("_y1", time).alias("_l2"),
                                  F.max_by("_y2", time).alias("_l3"))
    cands = []
    for (p, dd) in AUTO_CANDIDATES:
        pre = f"c{p}{dd}_"
        fit = fit.withColumns(ols_solve(p, pre))
        n, kk = F.col(f"{pre}n"), p + 2
        aicc = n * F.log(F.try_divide(F.col(f"{pre}sse"), n)) + 2 * kk + F.try_divide(F.lit(2.0 * kk * (kk + 1)), n - kk - 1)
        cands.append(F.struct(aicc.alias("aicc"), F.lit(dd).alias("d"), F.lit(p).alias("p"),
                              F.col(f"{pre}c").alias("c"),
                              (F.col(f"{pre}b1") if p >= 1 else F.lit(0.0)).alias("b1"),
                              (F.col(f"{pre}b2") if p >= 2 else F.lit(0.0)).alias("b2"),
                              _sigma(F.col(f"{pre}sse"), n - p - 1).alias("sigma")))
    best = F.get(F.array_sort(F.filter(F.array(*cands), lambda s: s["aicc"].isNotNull() & ~F.isnan(s["aicc"]))), F.lit(0))
    fit = fit.filter(F.col("c00_n") + 3 >= min_points).filter("c00_n > 0").select(*keys, best.alias("m"), "_l1", "_l2", "_l3")
    test = attach_by_key(d.filter(F.col("step").isNotNull()), fit, keys)
    m = F.col("m")
    lvl = m["c"] + m["b1"] * F.col("_l1") + m["b2"] * F.col("_l2")
    dif = F.col("_l1") + m["c"] + m["b1"] * (F.col("_l1") - F.col("_l2")) + m["b2"] * (F.col("_l2") - F.col("_l3"))
    test = (test.withColumn("forecast", F.when(m["d"] == 0, lvl).otherwise(dif))
                .withColumn("lo", F.col("forecast") - zq * m["sigma"])
                .withColumn("hi", F.col("forecast") + zq * m["sigma"])
                .withColumn("p", m["p"]).withColumn("d", m["d"]))
    test = _flags(test, value, direction)
    return test.select(*keys, time, value, "p", "d", "forecast", "lo", "hi", "is_anomaly", "anomaly_type")
