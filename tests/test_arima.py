"""ARIMA by block recursions against plain loops over whole series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import arima as A


def scalar_rows(w, beta, p, q, const):
    """(e, J) residual by residual."""
    k = const + p + q
    e, jac = np.zeros(len(w)), np.zeros((len(w), k))
    for t in range(p, len(w)):
        x = ([1.0] if const else []) + [w[t - i] for i in range(1, p + 1)] + [e[t - j] if t >= j else 0.0 for j in range(1, q + 1)]
        e[t] = w[t] - sum(b * v for b, v in zip(beta, x))
        jac[t] = -np.array(x)
        for j in range(1, q + 1):
            if t >= j:
                jac[t] -= beta[const + p + j - 1] * jac[t - j]
    return e, jac


@pytest.mark.parametrize("p,q,const", [(1, 1, 0), (2, 1, 1), (0, 2, 1), (3, 2, 0), (2, 0, 1)])
def test_recursion_and_its_maps(p, q, const):
    rng = np.random.default_rng(p * 7 + q)
    w = rng.normal(size=400)
    beta = np.concatenate([[0.3][:const], rng.uniform(-0.3, 0.3, p), rng.uniform(-0.4, 0.4, q)])
    want_e, want_j = scalar_rows(w, beta, p, q, const)
    rec = A.Recursion(p, q, bool(const))
    zero = np.zeros(q * (1 + rec.k))
    e, jac, left = rec.run(w, 0, p, beta, zero)
    assert np.allclose(e, want_e) and np.allclose(jac, want_j)
    # two blocks: the second from the state the first leaves, or by its map
    e1, j1, s1 = rec.run(w[:150], 0, p, beta, zero)
    e2, j2, s2 = rec.run(w[140:], 10, 0, beta, s1)
    assert np.allclose(np.append(e1, e2), want_e) and np.allclose(np.concatenate([j1, j2]), want_j) and np.allclose(s2, left)
    _, _, b = rec.run(w[140:], 10, 0, beta, zero)
    assert np.allclose(rec.across(beta, 250) @ s1 + b, left)


def brute_fit(y, order, const, steps, horizon, z):
    p, d, q = order
    train = y[:len(y) - horizon]
    w = np.diff(train, d)
    long = p + q
    one = lambda n: [np.ones(n)] if const else []
    beta = None
    if q:
        t = np.arange(long, len(w))
        x = np.stack(one(len(t)) + [w[t - i] for i in range(1, long + 1)], 1)
        a = np.linalg.lstsq(x, w[t], rcond=None)[0]
        e = np.full(len(w), np.nan)
        e[t] = w[t] - x @ a
        t = np.arange(long + q, len(w))
        x = np.stack(one(len(t)) + [w[t - i] for i in range(1, p + 1)] + [e[t - j] for j in range(1, q + 1)], 1)
    else:
        t = np.arange(p, len(w))
        x = np.stack(one(len(t)) + [w[t - i] for i in range(1, p + 1)], 1)
    beta = np.linalg.lstsq(x, w[t], rcond=None)[0]
    if q:
        beta[-q:] = A.shrink(beta[-q:])
    seen = []
    for i in range(steps + 1 if q else 1):
        e, jac = scalar_rows(w, beta, p, q, const)
        seen.append((float(e @ e), i, beta, e))
        beta = beta - np.linalg.solve(jac[p:].T @ jac[p:], jac[p:].T @ e[p:])
        if q:
            beta[-q:] = A.shrink(beta[-q:])
    css, _, beta, e = min(seen, key=lambda s: s[:2])
    k = const + p + q
    c, phi, theta = (beta[0] if const else 0.0), beta[const:const + p], beta[const + p:]
    # forecasts of the differences, summed up
    hist, res = list(w), list(e)
    for _ in range(horizon):
        hist.append(c + sum(f * hist[-i] for i, f in enumerate(phi, 1)) + sum(t * res[-j] for j, t in enumerate(theta, 1)))
        res.append(0.0)
    fc = np.array(hist[len(w):])
    for i in range(d):
        fc = np.diff(train, d - 1 - i)[-1] + np.cumsum(fc)
    psi = [1.0]
    for j in range(1, horizon):
        psi.append(sum(f * psi[j - i] for i, f in enumerate(phi, 1) if i <= j) + (theta[j - 1] if j <= q else 0.0))
    for _ in range(d):
        psi = np.cumsum(psi)
    half = z * np.sqrt(css / (len(w) - p - k) * np.cumsum(np.square(psi)))
    return fc, half


def arma(rng, n, phi, theta, c=0.0):
    e, out = rng.normal(size=n + 50), np.zeros(n + 50)
    for t in range(3, n + 50):
        out[t] = c + sum(f * out[t - i] for i, f in enumerate(phi, 1)) + e[t] + sum(h * e[t - j] for j, h in enumerate(theta, 1))
    return out[50:]


def frame(spark, series):
    rows = [(k, i, float(v)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "k string, t long, y double").repartition(5)


@pytest.mark.parametrize("order", [(1, 1, 1), (2, 0, 2), (2, 1, 0)])
def test_arima_equals_plain_loops_over_many_blocks(spark, order):
    rng = np.random.default_rng(4)
    series = {"a": arma(rng, 900, [0.5, 0.2], [0.4], 1.0), "b": np.cumsum(arma(rng, 260, [0.3], [-0.5])), "c": 50 + arma(rng, 70, [0.6], [0.3])}
    d = A.arima_detect(frame(spark, series), "k", "t", "y", order=order, horizon=20, level=0.95, direction="both",
                       steps=1, block=60, fan=4).toPandas()
    assert d["reason"].isna().all()
    for k, y in series.items():
        got = d[d["k"] == k].sort_values("t")
        fc, half = brute_fit(y, order, int(order[1] == 0), 1, 20, A.z_value(0.95))
        assert np.allclose(got["forecast"], fc, rtol=1e-6, atol=1e-6), k
        assert np.allclose(got["hi"] - got["forecast"], half, rtol=1e-6), k
        assert (got["is_anomaly"] == ((got["y"] < got["lo"]) | (got["y"] > got["hi"]))).all()
        assert list(got["step"]) == list(range(1, 21))


def test_arima_recovers_coefficients_and_flags_a_jump(spark):
    rng = np.random.default_rng(9)
    y = arma(rng, 4000, [0.6], [0.4], 2.0)
    y[-1] += 60
    d = A.arima_detect(frame(spark, {"a": y}), "k", "t", "y", order=(1, 0, 1), horizon=2, direction="both", steps=3).toPandas().sort_values("t")
    assert list(d["is_anomaly"]) == [False, True] and d["anomaly_type"].iloc[1] == "high"
    assert abs((d["hi"] - d["forecast"]).iloc[0] / A.z_value(0.99) - 1) < 0.05      # sigma of the noise


def test_series_that_cannot_be_fitted_have_a_reason(spark):
    rng = np.random.default_rng(2)
    series = {"good": arma(rng, 200, [0.5], [0.3]), "flat": np.full(60, 3.0), "short": np.arange(7.0)}
    df = frame(spark, series).unionAll(spark.createDataFrame([("none", i, None) for i in range(40)], "k string, t long, y double"))
    d = A.arima_detect(df, "k", "t", "y", order=(1, 1, 1), horizon=5, steps=1).select("k", "reason", F.isnull("forecast")).distinct().collect()
    assert {tuple(r) for r in d} == {("good", None, False), ("flat", "constant", True), ("short", "too short", True)}
    s = A.auto_ar_seasonal_detect(df, "k", "t", "y", season=4, horizon=5).select("k", "reason", F.isnull("forecast")).distinct().collect()
    assert {tuple(r) for r in s} == {("good", None, False), ("flat", "constant", True), ("short", "too short", True)}
    with pytest.raises(ValueError):
        A.arima_detect(df, "k", "t", "y", order=(0, 1, 0))


def test_levinson_solves_the_normal_equations():
    rng = np.random.default_rng(3)
    y = arma(rng, 500, [0.5, -0.3], [0.2])
    y -= y.mean()
    g = np.array([y[k:] @ y[:len(y) - k] for k in range(9)]) / len(y)
    for p, (phi, var) in enumerate(A.levinson(g)):
        toeplitz = np.array([[g[abs(i - j)] for j in range(p)] for i in range(p)]).reshape(p, p)
        assert np.allclose(phi, np.linalg.solve(toeplitz, g[1:p + 1]) if p else [])
        assert var == pytest.approx(g[0] - phi @ g[1:p + 1])


def test_seasonal_order_is_found_over_many_blocks(spark):
    rng = np.random.default_rng(5)
    t = np.arange(1500)
    season = 10 * np.sin(2 * np.pi * t / 12) + rng.normal(size=1500) * 0.1
    walk = np.cumsum(rng.normal(size=1500))
    noise = arma(rng, 1500, [0.7, -0.4], [])
    got = {}
    for block in (64, 8192):
        d = A.auto_ar_seasonal_detect(frame(spark, {"season": season, "walk": walk, "ar": noise}), "k", "t", "y", season=12,
                                      horizon=24, block=block).toPandas().sort_values(["k", "t"])
        got[block] = d
    assert np.allclose(got[64]["forecast"], got[8192]["forecast"]) and np.allclose(got[64]["lo"], got[8192]["lo"])
    picked = got[64].groupby("k")[["d", "seasonal", "p"]].first()
    assert tuple(picked.loc["season"])[:2] == (0, 1) and tuple(picked.loc["walk"])[:2] == (1, 0) and tuple(picked.loc["ar"]) == (0, 0, 2)
    s = got[64][got[64]["k"] == "season"]
    assert np.abs(s["forecast"] - s["y"]).max() < 1.0
