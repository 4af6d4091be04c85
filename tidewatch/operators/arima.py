"""ARIMA(p, d, q) and seasonal automatic AR, fitted from blocks.

Series are cut into blocks of values with the last rows of the block before
(:func:`~tidewatch.operators.sequence.block_arrays`), one row per block, and
every pass over the data is a map over that table:

* :func:`arima_detect` minimises the conditional sum of squares.  The
  residuals ``e_t = w_t - c - sum phi_i w_(t-i) - sum theta_j e_(t-j)`` and
  their derivatives by every coefficient obey one linear recursion, so a
  block is an affine map of the state entering it, and the entering states
  follow from composing maps in a tree (a parallel prefix).  A step of
  Gauss-Newton is a pass for the maps, the tree, and a pass for the sums of
  ``J'J`` and ``J'e``, which are added per series.  It starts from the
  Hannan-Rissanen estimate (two least-squares passes).
* :func:`auto_ar_seasonal_detect` adds up lagged products of the values and
  of their (seasonal) differences; per series the Levinson recursion turns
  autocovariances into the AR models of all orders, of which AICc takes one.

Per series only sums, coefficients and the newest values meet in one place.
A series that cannot be fitted has null forecasts and a reason.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.forecast import _flags, prepare_series, split_horizon, z_value
from tidewatch.operators.sequence import BLK, DEFAULT_BLOCK, FAN, POS, as_list, block_arrays, join_on
from tidewatch.session import materialize

#: Reasons of series without a forecast.
TOO_SHORT, CONSTANT, SINGULAR, NO_VALUE = "too short", "constant", "singular", "no value"
_SEGMENT = 64


# --- polynomials ------------------------------------------------------------

def difference_polynomial(d: int, season: int = 1, seasonal: int = 0) -> np.ndarray:
    """Coefficients of ``(1 - B)^d (1 - B^season)^seasonal`` by power of B."""
    out = np.ones(1)
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    for _ in range(seasonal):
        out = np.convolve(out, np.concatenate([[1.0], np.zeros(season - 1), [-1.0]]))
    return out


def invertible(theta: np.ndarray) -> bool:
    """Whether all roots of ``1 + theta_1 z + ...`` lie outside the unit
    circle, by the step-down recursion."""
    a = np.asarray(theta, float)
    while len(a):
        k = a[-1]
        if not abs(k) < 0.999:
            return False
        a = (a[:-1] - k * a[:-1][::-1]) / (1 - k * k)
    return True


def shrink(theta: np.ndarray) -> np.ndarray:
    """Moves the roots of a polynomial that is not invertible outwards:
    ``theta_j / 2^j`` until it is."""
    theta = np.asarray(theta, float)
    while not invertible(theta):
        theta = theta * 0.5 ** np.arange(1, len(theta) + 1)
    return theta


def forecasts(y: Sequence[float], e: Sequence[float], c: float, phi, theta, diff: np.ndarray, n: int):
    """(values, sums of squared psi weights) of the ``n`` steps after ``y``,
    the newest training values, with newest residuals ``e``; ``c`` is the
    constant of the differenced series."""
    ar = np.convolve(np.concatenate([[1.0], -np.asarray(phi, float)]), diff)
    y, e, psi = list(y), list(e), []
    for h in range(n):
        y.append(c - sum(a * y[-i] for i, a in enumerate(ar) if i) + sum(t * e[-j] for j, t in enumerate(theta, 1)))
        e.append(0.0)
        now = 1.0 if h == 0 else theta[h - 1] if h <= len(theta) else 0.0
        psi.append(now - sum(ar[i] * psi[h - i] for i in range(1, min(h, len(ar) - 1) + 1)))
    return np.array(y[len(y) - n:]), np.cumsum(np.square(psi))


# --- passes over blocks -----------------------------------------------------

def _map_blocks(blocks: DataFrame, keys, params: DataFrame | None, fn: Callable, out: str) -> DataFrame:
    """``fn(row) -> dict`` for every block (joined with its series' row of
    ``params``), with the keys and ``_blk`` kept; one block at a time."""
    d = blocks if params is None else join_on(blocks, params, keys)
    kinds = T.StructType([*[d.schema[k] for k in [*keys, BLK]], *T.StructType.fromDDL(out).fields])
    names = kinds.names[len(keys) + 1:]

    def run(frames):
        for pdf in frames:
            rows = [fn(r) for r in pdf.to_dict("records")]
            got = pd.DataFrame(rows, columns=names)
            yield pd.concat([pdf[[*keys, BLK]].reset_index(drop=True), got], axis=1)
    return d.mapInPandas(run, kinds)


def _map_series(rows: DataFrame, keys, fn: Callable, out: str) -> DataFrame:
    """``fn(row) -> dict`` for every row of a table with one row per series."""
    kinds = T.StructType([*[rows.schema[k] for k in keys], *T.StructType.fromDDL(out).fields])
    names = kinds.names[len(keys):]

    def run(frames):
        for pdf in frames:
            got = pd.DataFrame([fn(r) for r in pdf.to_dict("records")], columns=names)
            yield pd.concat([pdf[[*keys]].reset_index(drop=True), got], axis=1)
    return rows.mapInPandas(run, kinds)


def _add_up(rows: DataFrame, keys, col: str) -> DataFrame:
    """(keys, col): element-wise sums of the arrays ``col`` per series."""
    d = rows.select(*keys, F.posexplode(col).alias("_i", "_v")).groupBy(*keys, "_i").agg(F.sum("_v").alias("_v"))
    g = d.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_s"))
    return g.select(*keys, F.col("_s._v").alias(col))


def _normal(x: np.ndarray, y: np.ndarray) -> list[float]:
    """n, X'X, X'y, y'y of a block as one list."""
    return [float(len(y)), *(x.T @ x).ravel().tolist(), *(x.T @ y).tolist(), float(y @ y)]


def _solve(sums: Sequence[float]) -> tuple[float, np.ndarray | None, float]:
    """(n, solution or None, y'y) of added-up normal equations."""
    s = np.asarray(sums, float)
    k = int(round((-1 + np.sqrt(1 + 4 * (len(s) - 2))) / 2))
    n, xx, xy, yy = s[0], s[1:1 + k * k].reshape(k, k), s[1 + k * k:-1], s[-1]
    if not np.isfinite(s).all() or n <= k:
        return n, None, yy
    scale = np.sqrt(np.maximum(np.diag(xx), 1e-300))
    unit = xx / scale[:, None] / scale
    if k and np.linalg.cond(unit) > 1e12:
        return n, None, yy
    return n, np.linalg.solve(unit, xy / scale) / scale, yy


def _lags(w: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    return [w[at - i] for i in range(1, n + 1)]


# --- ARIMA(p, d, q) ---------------------------------------------------------

class Recursion:
    """Residuals of ARMA(p, q) and their derivatives by the coefficients
    (constant if any, phi, theta): one linear recursion, whose state is the
    last q rows of (residual, derivatives), newest first."""

    def __init__(self, p: int, q: int, constant: bool):
        self.p, self.q, self.c = p, q, int(constant)
        self.k = self.c + p + q

    def split(self, beta):
        beta = np.asarray(beta, float)
        return (beta[0] if self.c else 0.0), beta[self.c:self.c + self.p], beta[self.c + self.p:]

    def _filter(self, u: np.ndarray, theta: np.ndarray, past: np.ndarray) -> np.ndarray:
        """``r_t = u_t - sum theta_j r_(t-j)`` down the rows of ``u`` after the
        rows ``past`` (newest first), a segment at a time: within one the
        answer is a matrix product."""
        q, n = self.q, len(u)
        if not q:
            return u
        size = min(_SEGMENT, max(n, 1))
        h = np.zeros(size + q)          # response to one unit
        h[q] = 1.0
        for t in range(1, size):
            h[q + t] = -theta @ h[q + t - q:q + t][::-1]
        lower = np.array([[h[q + i - j] if i >= j else 0.0 for j in range(size)] for i in range(size)])
        first = np.zeros((size, q))     # what past row j adds to the inputs
        for j in range(q):
            for i in range(min(size, q - j)):
                first[i, j] = -theta[i + j]
        out, past = np.empty_like(u), past.copy()
        for i in range(0, n, size):
            m = min(size, n - i)
            out[i:i + m] = lower[:m, :m] @ (u[i:i + m] + first[:m] @ past)
            past = np.concatenate([out[i:i + m][::-1], past])[:q]
        return out

    def run(self, w: np.ndarray, own: int, skip: int, beta, state: np.ndarray):
        """(e, J, state left) of the rows ``own`` .. of ``w``; the first
        ``skip`` of them, which lack lags, count as zero."""
        c, phi, theta = self.split(beta)
        at = np.arange(own + skip, len(w))
        lags = _lags(w, at, self.p)
        past = np.asarray(state, float).reshape(self.q, 1 + self.k)
        e = np.zeros((len(w) - own, 1))
        e[skip:, 0] = w[at] - c - sum((f * x for f, x in zip(phi, lags)), np.zeros(len(at)))
        e = self._filter(e, theta, past[:, :1])
        u = np.zeros((len(w) - own, self.k))
        if self.c:
            u[skip:, 0] = -1.0
        for i, x in enumerate(lags):
            u[skip:, self.c + i] = -x
        before = np.concatenate([past[::-1, 0], e[:, 0]])
        for j in range(1, self.q + 1):
            u[skip:, self.c + self.p + j - 1] = -before[self.q - j + skip:self.q - j + len(e)]
        jac = self._filter(u, theta, past[:, 1:])
        rows = np.concatenate([past[::-1], np.concatenate([e, jac], axis=1)])
        return e[:, 0], jac, rows[len(rows) - self.q:][::-1].ravel()

    def matrix(self, beta) -> np.ndarray:
        """One step of the state without input."""
        theta, m = self.split(beta)[2], 1 + self.k
        a = np.zeros((self.q * m, self.q * m))
        for j in range(self.q):
            a[:m, j * m:(j + 1) * m] = -theta[j] * np.eye(m)
            a[1 + self.c + self.p + j, j * m] -= 1.0
        for j in range(1, self.q):
            a[j * m:(j + 1) * m, (j - 1) * m:j * m] = np.eye(m)
        return a

    def across(self, beta, n: int) -> np.ndarray:
        return np.linalg.matrix_power(self.matrix(beta), int(n))


def entering_states(maps: DataFrame, keys, rec: Recursion, fan: int = FAN) -> DataFrame:
    """(keys, ``_blk``, state) from one map (``n`` rows, the state ``b`` that
    they leave when none enters, ``beta``) per block: maps of ``fan``
    neighbours compose into their parent's, level by level, then the states
    go down the same tree."""
    size = rec.q * (1 + rec.k)
    kinds = T.StructType([*[maps.schema[k] for k in keys], *T.StructType.fromDDL("node long, n long, b array<double>, beta array<double>").fields])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        beta, b, n = pdf["beta"].iloc[0], np.zeros(size), 0
        for m, add in zip(pdf["n"], pdf["b"]):
            b, n = rec.across(beta, m) @ b + np.asarray(add, float), n + int(m)
        return pdf.head(1).assign(node=pdf["_up"].iloc[0], n=n, b=[b.tolist()])[kinds.names]

    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        beta, s, out = pdf["beta"].iloc[0], np.asarray(pdf["state"].iloc[0], float), []
        for m, add in zip(pdf["n"], pdf["b"]):
            out.append(s.tolist())
            s = rec.across(beta, m) @ s + np.asarray(add, float)
        return pdf.assign(state=out)[state_kinds.names]

    state_kinds = T.StructType([*kinds.fields[:len(keys) + 1], T.StructField("state", T.ArrayType(T.DoubleType()))])
    levels = [materialize(maps.withColumnRenamed(BLK, "node").select(*kinds.names))]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    up = F.floor(F.col("node") / fan)
    while top > 0:
        levels.append(materialize(levels[-1].withColumn("_up", up).groupBy(*keys, "_up").applyInPandas(compose, kinds)))
        top //= fan
    zero = F.array(*[F.lit(0.0)] * size) if size else F.array().cast("array<double>")
    state = levels[-1].select(*keys, "node", zero.alias("state"))
    for level in levels[-2::-1]:
        d = join_on(level.withColumn("_up", up), state.withColumnRenamed("node", "_up"), [*keys, "_up"])
        state = d.groupBy(*keys, "_up").applyInPandas(descend, state_kinds)
    return state.withColumnRenamed("node", BLK)


def _series(value: str, p: int, d: int) -> Callable:
    """``row -> (w, own, skip)``: scaled differences of a block, the index of
    its first own one, and how many of those lack ``d`` + p rows before."""
    diff = difference_polynomial(d)

    def of(r):
        y = (np.asarray(r[value], float) - r["m"]) / r["s"]
        w = np.concatenate([np.zeros(d), np.convolve(y, diff, "valid")]) if len(y) > d else np.zeros(len(y))
        missing = d + p - (int(r["first"]) + int(r["own"]))
        return w, int(r["own"]), int(np.clip(missing, 0, len(w) - int(r["own"])))
    return of


class _Fit:
    """Passes of one fit over blocks of values.  What runs in tasks takes
    the recursion and plain numbers along, never the object itself."""

    def __init__(self, train: DataFrame, keys, value: str, order, constant: bool, block: int, fan: int):
        self.keys, self.value, self.fan = keys, value, fan
        p, self.d, q = order
        self.rec, self.constant = Recursion(p, q, constant), constant
        self.long = p + q               # order of the first autoregression
        self.series = _series(value, p, self.d)
        stats = train.groupBy(*keys).agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("s"), F.count(value).alias("n_train"),
                                         F.max_by(value, POS).alias("_last"))
        center = F.col("m") if constant and not self.d else F.lit(0.0)
        self.stats = materialize(stats.select(*keys, center.alias("m"), F.when(F.col("s") > 0, F.col("s")).otherwise(1.0).alias("s"),
                                              (F.col("s") > 0).alias("varies"), "n_train"))
        halo = self.d + max(self.long + q, p, 1)
        self.blocks = materialize(block_arrays(train, keys, [value], halo, block=block))

    def least_squares(self, params: DataFrame, lags: int, past: int) -> DataFrame:
        """Normal equations per series of w on ``lags`` lags of w and ``past``
        lags of the residuals of the first autoregression ``a``."""
        series, constant, d, long = self.series, self.constant, self.d, self.long
        need = d + (lags if not past else max(lags, long + past))

        def fn(r):
            w, own, _ = series(r)
            at = np.arange(max(own, need - int(r["first"])), len(w))
            x = [np.ones(len(at))] if constant else []
            x += _lags(w, at, lags)
            if past:
                a = np.asarray(r["a"], float)
                e = np.zeros(len(w))
                t = np.arange(max(d + long - int(r["first"]), long), len(w))
                c, phi = (a[0], a[1:]) if constant else (0.0, a)
                e[t] = w[t] - c - sum((f * v for f, v in zip(phi, _lags(w, t, long))), np.zeros(len(t)))
                x += _lags(e, at, past)
            return {"sums": _normal(np.stack(x, axis=1) if x else np.zeros((len(at), 0)), w[at])}
        return _add_up(_map_blocks(self.blocks, self.keys, params, fn, "sums array<double>"), self.keys, "sums")

    def start(self) -> DataFrame:
        """Hannan-Rissanen estimates ``beta`` (null with a ``reason``)."""
        p, q, keys = self.rec.p, self.rec.q, self.keys

        def solved(name):
            def fn(r):
                n, b, yy = _solve(r["sums"])
                if not r["varies"]:
                    return {name: None, "reason": CONSTANT}
                if b is None:
                    return {name: None, "reason": TOO_SHORT if n * n <= len(r["sums"]) else SINGULAR}
                if name == "beta" and q:
                    b = np.concatenate([b[:-q], shrink(b[-q:])])
                return {name: b.tolist(), "reason": None}
            return fn
        first = None
        if q:
            sums = join_on(self.least_squares(self.stats, self.long, 0), self.stats, keys)
            first = materialize(_map_series(sums, keys, solved("a"), "a array<double>, reason string"))
        params = self.stats if first is None else join_on(self.stats, first.filter("a IS NOT NULL").select(*keys, "a"), keys)
        sums = join_on(self.least_squares(params, p, q), self.stats, keys)
        beta = _map_series(sums, keys, solved("beta"), "beta array<double>, reason string")
        if first is not None:
            beta = beta.unionByName(first.filter("a IS NULL").select(*keys, F.lit(None).cast("array<double>").alias("beta"), "reason"))
        return materialize(beta)

    def evaluate(self, beta: DataFrame) -> DataFrame:
        """(keys, beta, css, n, left, next): the conditional sum of squares at
        ``beta``, the state after the last row, and a Gauss-Newton step."""
        rec, keys, series = self.rec, self.keys, self.series
        params = join_on(self.stats, beta, keys)
        zero = np.zeros(rec.q * (1 + rec.k))

        def enter(r):
            w, own, skip = series(r)
            return {"n": len(w) - own, "b": rec.run(w, own, skip, r["beta"], zero)[2].tolist(), "beta": list(r["beta"])}
        state = entering_states(_map_blocks(self.blocks, keys, params, enter, "n long, b array<double>, beta array<double>"),
                                keys, rec, self.fan) if rec.q else None
        blocks = self.blocks if state is None else join_on(self.blocks, state, [*keys, BLK])

        def sums(r):
            w, own, skip = series(r)
            e, jac, left = rec.run(w, own, skip, r["beta"], r["state"] if "state" in r else zero)
            return {"sums": _normal(jac[skip:], e[skip:]), "left": left.tolist()}
        got = materialize(_map_blocks(blocks, keys, params, sums, "sums array<double>, left array<double>"))
        both = join_on(_add_up(got, keys, "sums"), got.groupBy(*keys).agg(F.max_by("left", BLK).alias("left")), keys)
        both = join_on(both, beta, keys)

        def step(r):
            n, move, css = _solve(r["sums"])
            b = np.asarray(r["beta"], float)
            if move is not None:
                b = b - move
                if rec.q:
                    b[-rec.q:] = shrink(b[-rec.q:])
            return {"beta": list(r["beta"]), "css": css, "n": int(n), "left": list(r["left"]), "next": b.tolist()}
        return materialize(_map_series(both, keys, step, "beta array<double>, css double, n long, left array<double>, next array<double>"))


def _tails(train: DataFrame, keys, value: str, n: int) -> DataFrame:
    """(keys, tail): the newest ``n`` training values, oldest first."""
    ends = train.groupBy(*keys).agg((F.max(POS) - n).alias("_cut"))
    near = join_on(train.select(*keys, POS, value), ends, keys).filter(F.col(POS) > F.col("_cut"))
    g = near.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(POS, F.col(value).cast("double").alias("_v")))).alias("_t"))
    return g.select(*keys, F.col("_t._v").alias("tail"))


def _judge(test: DataFrame, fit: DataFrame, keys, time: str, value: str, direction: str, extra=()) -> DataFrame:
    """Test rows with the forecast, limits and anomaly of their step.
    ``fit`` has one row per series: arrays ``fc`` and ``half`` by step."""
    d = join_on(test, fit, keys, "left")
    at = lambda c: F.get(F.col(c), F.col("step").cast("int") - 1)
    d = d.withColumn("forecast", at("fc"))
    d = d.withColumns({"lo": F.col("forecast") - at("half"), "hi": F.col("forecast") + at("half")})
    d = d.withColumn("reason", F.when(F.col("forecast").isNull(), F.coalesce("reason", F.lit(NO_VALUE))))
    d = _flags(d, value, direction)
    return d.select(*keys, time, "step", value, *extra, "forecast", "lo", "hi", "is_anomaly", "anomaly_type", "reason")


def arima_detect(df: DataFrame, keys, time: str, value: str, *, order=(1, 1, 1), horizon: int = 24, level: float = 0.99,
                 direction: str = "low", freq=None, fill_method: str | None = "interpolate", constant: bool | None = None,
                 steps: int = 6, block: int = DEFAULT_BLOCK, fan: int = FAN) -> DataFrame:
    """Forecast of each series' last ``horizon`` points by ARIMA(p, d, q);
    returns the test rows with ``forecast, lo, hi, is_anomaly, anomaly_type``
    and ``reason`` (why there is no forecast, null otherwise).

    The differences have a constant where ``constant`` says so (default:
    only without differencing).  Coefficients start from Hannan-Rissanen and
    take ``steps`` Gauss-Newton steps on the conditional sum of squares
    (residuals before the p-th difference are zero); a moving average that
    stops being invertible is shrunk.  Of all coefficients evaluated those
    with the least sum count.  Limits are ``forecast +- z * sigma *
    sqrt(sum psi^2)``, ``sigma^2`` being the sum over its degrees of freedom.
    Rows without a value are dropped after filling.
    """
    p, d, q = order
    if min(order) < 0 or p + q == 0 and not (constant if constant is not None else d == 0):
        raise ValueError("order needs a coefficient to fit")
    keys = as_list(keys)
    constant = d == 0 if constant is None else constant
    z = z_value(level)
    rows = split_horizon(prepare_series(df, keys, time, value, freq=freq, fill_method=fill_method, drop_null=True),
                         keys, time, horizon)
    train = rows.filter(F.col("step").isNull()).drop("step")
    fit = _Fit(train, keys, value, order, constant, block, fan)
    start = fit.start()
    beta, seen = start.filter("beta IS NOT NULL").select(*keys, "beta"), []
    for i in range(steps + 1 if q else 1):
        seen.append(fit.evaluate(beta).withColumn("i", F.lit(i)))
        beta = seen[-1].select(*keys, F.col("next").alias("beta"))
    every = seen[0]
    for more in seen[1:]:
        every = every.unionByName(more)
    best = every.filter("NOT isnan(css)").groupBy(*keys).agg(
        F.min_by(F.struct("beta", "css", "n", "left"), F.struct("css", "i")).alias("f")).select(*keys, "f.*")
    best = join_on(join_on(best, fit.stats, keys), _tails(train, keys, value, p + d + 1), keys)
    rec, diff = fit.rec, difference_polynomial(d)

    def ahead(r):
        c, phi, theta = rec.split(r["beta"])
        free = r["n"] - rec.k
        if free <= 0:
            return {"fc": None, "half": None, "reason": TOO_SHORT}
        y = (np.asarray(r["tail"], float) - r["m"]) / r["s"]
        e = np.asarray(r["left"], float).reshape(q, 1 + rec.k)[::-1, 0] if q else []
        fc, psi = forecasts(y, e, c, phi, theta, diff, horizon)
        half = z * np.sqrt(max(r["css"], 0.0) / free * psi)
        return {"fc": (fc * r["s"] + r["m"]).tolist(), "half": (half * r["s"]).tolist(), "reason": None}
    made = _map_series(best, keys, ahead, "fc array<double>, half array<double>, reason string")
    failed = start.filter("beta IS NULL").select(*keys, F.lit(None).cast("array<double>").alias("fc"),
                                                 F.lit(None).cast("array<double>").alias("half"), "reason")
    return _judge(rows.filter(F.col("step").isNotNull()), made.unionByName(failed), keys, time, value, direction)


# --- seasonal automatic AR --------------------------------------------------

def levinson(gamma: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """(coefficients, innovation variance) of the AR models of order 0 ..
    ``len(gamma) - 1`` with autocovariances ``gamma``."""
    phi, var = np.zeros(0), float(gamma[0])
    out = [(phi, var)]
    for k in range(1, len(gamma)):
        if var <= 0:
            break
        r = (gamma[k] - phi @ gamma[k - 1:0:-1]) / var if k > 1 else gamma[1] / var
        phi = np.append(phi - r * phi[::-1], r)
        var *= 1 - r * r
        out.append((phi, var))
    return out


def aicc(n: float, var: float, p: int) -> float:
    k = p + 2
    return n * np.log(var) + 2 * k + 2 * k * (k + 1) / (n - k - 1) if n > k + 1 and var > 0 else np.inf


def auto_ar_seasonal_detect(df: DataFrame, keys, time: str, value: str, *, season: int = 24, max_order: int | None = None,
                            horizon: int = 24, level: float = 0.99, direction: str = "both", freq=None,
                            fill_method: str | None = "interpolate", min_points: int = 10,
                            block: int = DEFAULT_BLOCK) -> DataFrame:
    """Forecast of each series' last ``horizon`` points by an AR model whose
    differencing and order are chosen per series; returns the test rows with
    ``d, seasonal, p, forecast, lo, hi, is_anomaly, anomaly_type, reason``.

    Of the plain values, first differences, differences at lag ``season`` and
    both, the one with the least variance is modelled (ties: fewer seasonal,
    then fewer first differences; a ``season`` of 1 has no seasonal ones).
    Its Yule-Walker models of order 0 .. ``max_order`` (default: one more than
    the season, 5 without) come from one Levinson recursion over the sample
    autocovariances, and the least AICc ``n ln(var) + 2k + 2k(k+1)/(n-k-1)``,
    k = p + 2, decides.  Series with fewer than ``min_points`` training rows,
    with too few differences for the largest order, or without variation have
    null forecasts and a reason.
    """
    keys = as_list(keys)
    z = z_value(level)
    top = max_order if max_order is not None else season + 1 if season > 1 else 5
    kinds = [(d, s) for s in ((0, 1) if season > 1 else (0,)) for d in (0, 1)]
    diffs = {v: difference_polynomial(v[0], season, v[1]) for v in kinds}
    rows = split_horizon(prepare_series(df, keys, time, value, freq=freq, fill_method=fill_method, drop_null=True),
                         keys, time, horizon)
    train = rows.filter(F.col("step").isNull()).drop("step")
    reach = max(len(x) for x in diffs.values()) - 1
    blocks = materialize(block_arrays(train, keys, [value], reach + top, block=block))
    stats = train.groupBy(*keys).agg(F.avg(value).alias("m"), F.count(value).alias("n_train"))

    def products(r):
        y, own = np.asarray(r[value], float) - r["m"], int(r["own"])
        sums = []
        for x in diffs.values():
            o = len(x) - 1
            w = np.convolve(y, x, "valid") if len(y) > o else np.zeros(0)      # w[i] belongs to y[i + o]
            for k in range(top + 1):
                at = np.arange(max(own, o + k), len(y)) - o
                a, b = w[at], w[at - k]
                sums += [float(len(at)), float(a.sum()), float(b.sum()), float(a @ b)]
        return {"sums": sums}
    added = _add_up(_map_blocks(blocks, keys, stats, products, "sums array<double>"), keys, "sums")
    fit = join_on(join_on(added, stats, keys), _tails(train, keys, value, reach + top + 1), keys)

    def choose(r):
        none = {"d": None, "seasonal": None, "p": None, "fc": None, "half": None}
        if r["n_train"] < min_points:
            return {**none, "reason": TOO_SHORT}
        s = np.asarray(r["sums"], float).reshape(len(kinds), top + 1, 4)
        found = []
        for v, table in zip(kinds, s):
            n = table[0, 0]
            if n <= top + 3:
                continue
            mean = table[0, 1] / n
            gamma = (table[:, 3] - mean * (table[:, 1] + table[:, 2]) + table[:, 0] * mean * mean) / n
            found.append((gamma[0], v[1], v[0], n, mean, gamma))
        if not found:
            return {**none, "reason": TOO_SHORT}
        var, seasonal, d, n, mean, gamma = min(found, key=lambda f: f[:3])
        if not var > 1e-12 * (1 + r["m"] ** 2):
            return {**none, "reason": CONSTANT}
        models = levinson(gamma)
        p = min(range(len(models)), key=lambda i: (aicc(n, models[i][1], i), i))
        phi, var = models[p]
        fc, psi = forecasts(np.asarray(r["tail"], float) - r["m"], [], mean * (1 - phi.sum()), phi, [], diffs[d, seasonal], horizon)
        return {"d": d, "seasonal": seasonal, "p": p, "fc": (fc + r["m"]).tolist(), "half": (z * np.sqrt(var * psi)).tolist(),
                "reason": None}
    made = _map_series(fit, keys, choose, "d int, seasonal int, p int, fc array<double>, half array<double>, reason string")
    return _judge(rows.filter(F.col("step").isNotNull()), made, keys, time, value, direction, ["d", "seasonal", "p"])
