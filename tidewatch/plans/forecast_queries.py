"""Registered queries of the ARIMA and seasonal detectors, with their SQL:
normal equations by elimination, residuals and derivatives by recursion."""

from __future__ import annotations

from tidewatch.plans import series as S
from tidewatch.plans.queries import _HOUR_US, Z, _fc_out, _filled_sql, r, register

_EVENTS = _filled_sql("SELECT * FROM events", "event_type", "ts", "value", _HOUR_US, "interpolate")


def _out() -> list:
    return ["event_type", "ts", "step", r("value"), r("forecast", 4), r("lo", 4), r("hi", 4), "is_anomaly", "anomaly_type"]


def _eliminate(src: str, key: str, k: int, pre: str, keep: str = "") -> list[str]:
    """CTEs that solve ``sum a_ij x_j = y_i`` (columns a1_1.., y1.. of
    ``src``, i <= j) for x1.. in ``{pre}``, by elimination without pivots."""
    a = lambda i, j: f"a{min(i, j)}_{max(i, j)}"
    cols = [f"{a(i, j)} AS m{i}_{j}" for i in range(1, k + 1) for j in range(1, k + 1)] + [f"y{i} AS b{i}" for i in range(1, k + 1)]
    out = [f"{pre}0 AS (SELECT {key}{keep}, {', '.join(cols)} FROM {src})"]
    for p in range(1, k):
        new = [f"m{i}_{j} - m{i}_{p} / m{p}_{p} * m{p}_{j} AS m{i}_{j}" for i in range(p + 1, k + 1) for j in range(p + 1, k + 1)]
        new += [f"b{i} - m{i}_{p} / m{p}_{p} * b{p} AS b{i}" for i in range(p + 1, k + 1)]
        out.append(f"{pre}{p} AS (SELECT * REPLACE ({', '.join(new)}) FROM {pre}{p - 1})")
    xs = [f"(b{i} {' '.join(f'- m{i}_{j} * x{j}' for j in range(i + 1, k + 1))}) / nullif(m{i}_{i}, 0) AS x{i}" for i in range(k, 0, -1)]
    out.append(f"{pre} AS (SELECT {key}{keep}, {', '.join(xs)} FROM {pre}{k - 1})")
    return out


def _sums(xs: list[str], y: str) -> str:
    k = len(xs)
    return ", ".join([f"sum(({xs[i]}) * ({xs[j]})) AS a{i + 1}_{j + 1}" for i in range(k) for j in range(i, k)]
                     + [f"sum(({xs[i]}) * ({y})) AS y{i + 1}" for i in range(k)])


def _times(a: list[str], b: list[str]) -> list[str]:
    """Product of two polynomials of SQL expressions."""
    out = [[] for _ in range(len(a) + len(b) - 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            out[i + j].append(f"({x}) * ({y})")
    return [" + ".join(t) for t in out]


def _path_sql(key: str, fit: str, ar: list[str], c: str, first: str, H: int) -> list[str]:
    """CTE fc(key, step, forecast, wide): values by ``y = c - sum ar_i y_-i``
    (``first`` is added to the first) and sums of squared psi weights; ``fit``
    has the newest values as l1, l2, ..."""
    n = len(ar) - 1
    nexty = f"({c}) " + " ".join(f"- ({a}) * y{i}" for i, a in enumerate(ar) if i)
    nextp = " ".join(f"- ({a}) * p{i}" for i, a in enumerate(ar) if i)
    start = ", ".join([f"l{i} AS y{i}" for i in range(1, n + 1)] + [f"0.0::DOUBLE AS p{i}" for i in range(1, n + 1)])
    cols = ", ".join([f"y{i}" for i in range(1, n + 1)] + [f"p{i}" for i in range(1, n + 1)])
    moved = ", ".join(f"n{x}" if i == 1 else f"{x}{i - 1}" for x in "yp" for i in range(1, n + 1))
    return [f"""path AS (
  SELECT {key}, 0 AS step, 0.0::DOUBLE AS forecast, 0.0::DOUBLE AS wide, {cols} FROM (SELECT {key}, {start} FROM {fit})
  UNION ALL
  SELECT {key}, step + 1, ny, wide + np * np, {moved}
  FROM (SELECT path.*, {nexty} + CASE WHEN step = 0 THEN {first} ELSE 0 END AS ny,
               {nextp or '0'} + CASE WHEN step = 0 THEN 1 WHEN step = 1 THEN th ELSE 0 END AS np
        FROM path JOIN {fit} USING ({key})) WHERE step < {H})""",
            f"fc AS (SELECT {key}, step, forecast, wide FROM path WHERE step > 0)"]


def _arima_sql(prep: str, key: str, t: str, v: str, order, H: int, level: float, direction: str, steps: int) -> str:
    """ARIMA(p, d, 1): Hannan-Rissanen, then Gauss-Newton on the conditional
    sum of squares, residual by residual."""
    p, d, q = order
    assert q == 1
    const, z, k = d == 0, Z[level], (1 if d == 0 else 0) + p + 1
    w = f"PARTITION BY {key} ORDER BY t"
    ctes = [prep, f"""d AS (SELECT {key}, {t}, {v}, row_number() OVER (PARTITION BY {key} ORDER BY {t}) AS t,
       count(*) OVER (PARTITION BY {key}) AS n FROM fl WHERE {v} IS NOT NULL)""",
            f"w0 AS (SELECT {key}, t, {v} AS v, CAST({v} AS DOUBLE) AS w FROM d WHERE t <= n - {H})"]
    for i in range(d):
        ctes.append(f"w{i + 1} AS (SELECT {key}, t, v, w - lag(w) OVER ({w}) AS w FROM w{i})")
    long = p + q
    one, c0 = (["1.0"], "x1") if const else ([], "0.0")
    lags = ", ".join(f"lag(w, {i}) OVER ({w}) AS w{i}" for i in range(1, long + 1))
    ctes.append(f"x AS MATERIALIZED (SELECT *, {lags} FROM w{d})")
    ctes.append(f"s1 AS (SELECT {key}, {_sums(one + [f'w{i}' for i in range(1, long + 1)], 'w')} FROM x WHERE w{long} IS NOT NULL GROUP BY 1)")
    ctes += _eliminate("s1", key, len(one) + long, "h1")
    res = f"x.w - {c0 if not const else 'h1.x1'} " + " ".join(f"- h1.x{i + len(one)} * x.w{i}" for i in range(1, long + 1))
    ctes.append(f"e0 AS (SELECT x.*, {res} AS e FROM x JOIN h1 USING ({key}))")
    ctes.append(f"e1 AS (SELECT *, lag(e) OVER ({w}) AS el FROM e0)")
    ctes.append(f"s2 AS (SELECT {key}, {_sums(one + [f'w{i}' for i in range(1, p + 1)] + ['el'], 'w')} FROM e1 WHERE el IS NOT NULL GROUP BY 1)")
    ctes += _eliminate("s2", key, k, "h2")
    safe = lambda th: f"CASE WHEN abs({th}) < 0.999 THEN {th} ELSE ({th}) / pow(2, floor(log2(abs({th}) / 0.999)) + 1) END"
    ctes.append(f"b0 AS MATERIALIZED (SELECT {key}, {', '.join(f'x{i}' for i in range(1, k))}, {safe(f'x{k}')} AS x{k} FROM h2)")
    t0 = d + p + 1
    for s in range(steps + 1):
        phi = [f"b.x{i + len(one)}" for i in range(1, p + 1)]
        e = f"x.w - {'b.x1' if const else '0.0'} " + " ".join(f"- {f} * x.w{i}" for i, f in enumerate(phi, 1))
        base = ([f"-1.0::DOUBLE"] if const else []) + [f"-x.w{i}" for i in range(1, p + 1)]
        g0 = ", ".join([f"{x} AS g{i}" for i, x in enumerate(base, 1)] + [f"0.0::DOUBLE AS g{k}"])
        gn = ", ".join([f"{x} - b.x{k} * r.g{i}" for i, x in enumerate(base, 1)] + [f"-r.e - b.x{k} * r.g{k}"])
        ctes.append(f"""r{s} AS (SELECT {key}, t, {e} AS e, {g0} FROM x JOIN b{s} b USING ({key}) WHERE t = {t0}
  UNION ALL
  SELECT x.{key}, x.t, {e} - b.x{k} * r.e, {gn}
  FROM r{s} r JOIN x ON x.{key} = r.{key} AND x.t = r.t + 1 JOIN b{s} b ON b.{key} = r.{key})""")
        ctes.append(f"""n{s} AS MATERIALIZED (SELECT {key}, {_sums([f'g{i}' for i in range(1, k + 1)], 'e')}, sum(e * e) AS css,
  arg_max(e, t) AS el, count(*) AS n FROM r{s} GROUP BY 1)""")
        ctes += _eliminate(f"n{s}", key, k, f"m{s}")
        move = ", ".join(f"b.x{i} - m.x{i} AS x{i}" for i in range(1, k))
        ctes.append(f"""b{s + 1} AS MATERIALIZED (SELECT {key}, {move}{', ' if move else ''}{safe(f'(b.x{k} - m.x{k})')} AS x{k}
  FROM b{s} b JOIN m{s} m USING ({key}))""")
    every = " UNION ALL ".join(f"SELECT {s} AS i, n{s}.{key}, css, el, n, {', '.join(f'b{s}.x{i}' for i in range(1, k + 1))} FROM n{s} JOIN b{s} USING ({key})"
                               for s in range(steps + 1))
    ctes.append(f"every AS ({every})")
    ctes.append(f"best AS (SELECT * FROM every WHERE NOT isnan(css) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY css, i) = 1)")
    tails = ", ".join(f"max(CASE WHEN d.t = d.n - {H} - {i - 1} THEN d.{v} END) AS l{i}" for i in range(1, p + d + 1))
    ctes.append(f"""fit AS MATERIALIZED (SELECT {key}, any_value(x{k}) AS th, any_value(el) AS el, any_value(css / (best.n - {k})) AS s2,
  {', '.join(f'any_value(x{i}) AS c{i}' for i in range(1, k))}{', ' if k > 1 else ''}{tails} FROM best JOIN d USING ({key}) GROUP BY 1)""")
    ar = ["1"] + [f"-c{i + len(one)}" for i in range(1, p + 1)]
    for _ in range(d):
        ar = _times(ar, ["1", "-1"])
    ctes += _path_sql(key, "fit", ar, "c1" if const else "0", "th * el", H)
    ctes.append(f"""b AS (SELECT d.{key}, d.{t}, d.{v}, fc.step, forecast, forecast - {z} * sqrt(s2 * wide) AS lo,
  forecast + {z} * sqrt(s2 * wide) AS hi FROM d JOIN fc ON fc.{key} = d.{key} AND fc.step = d.t - d.n + {H} JOIN fit ON fit.{key} = d.{key})""")
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + _fc_out(key, t, v, direction, "step, ") + " FROM b"


def _arima(spark, sf_dir, order, **kw):
    from tidewatch.operators.arima import arima_detect
    d = arima_detect(S.table(spark, sf_dir, "events"), "event_type", "ts", "value", order=order, horizon=20,
                     freq="1 hour", fill_method="interpolate", **kw)
    return d.select(*_out())


@register("arima_general", _arima_sql(_EVENTS, "event_type", "ts", "value", (1, 1, 1), 20, 0.99, "both", 4))
def q_arima_general(spark, sf_dir):
    return _arima(spark, sf_dir, (1, 1, 1), level=0.99, direction="both", steps=4)


@register("arima_general_201", _arima_sql(_EVENTS, "event_type", "ts", "value", (2, 0, 1), 20, 0.95, "low", 4))
def q_arima_general_201(spark, sf_dir):
    return _arima(spark, sf_dir, (2, 0, 1), level=0.95, direction="low", steps=4)


def _auto_seasonal_sql(prep: str, key: str, t: str, v: str, m: int, top: int, H: int, level: float, direction: str) -> str:
    """Autocovariances by lagged sums, AR models of all orders by Gauss-Jordan
    elimination of their normal equations, AICc, forecasts by recursion."""
    z, w = Z[level], f"PARTITION BY {key}, v ORDER BY t"
    kinds = [(0, 0), (1, 0), (0, 1), (1, 1)]
    poly = {}
    for d, s in kinds:
        a = [0.0] * (d + s * m + 1)
        for i, x in ((0, 1.0), (1, -1.0)) if d else ((0, 1.0),):
            for j, y in ((0, 1.0), (m, -1.0)) if s else ((0, 1.0),):
                a[i + j] += x * y
        poly[d, s] = a
    ctes = [prep, f"""d AS (SELECT {key}, {t}, {v}, row_number() OVER (PARTITION BY {key} ORDER BY {t}) AS t,
       count(*) OVER (PARTITION BY {key}) AS n FROM fl WHERE {v} IS NOT NULL)""",
            f"tr AS MATERIALIZED (SELECT {key}, t, CAST({v} AS DOUBLE) AS y FROM d WHERE t <= n - {H})"]
    parts = []
    for i, kind in enumerate(kinds):
        x = " ".join(f"{c:+} * " + (f"lag(y, {j}) OVER (PARTITION BY {key} ORDER BY t)" if j else "y") for j, c in enumerate(poly[kind]) if c)
        parts.append(f"SELECT {key}, {i} AS v, t, {x} AS w FROM tr")
    ctes.append(f"ws AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE w IS NOT NULL)")
    ctes.append(f"cs AS (SELECT {key}, v, t, w - avg(w) OVER (PARTITION BY {key}, v) AS w, avg(w) OVER (PARTITION BY {key}, v) AS mean FROM ws)")
    prods = ", ".join(f"sum(w * l{k}) / count(*)" for k in range(top + 1))
    ls = ", ".join(f"lag(w, {k}) OVER ({w}) AS l{k}" if k else "w AS l0" for k in range(top + 1))
    ctes.append(f"g AS (SELECT {key}, v, count(*) AS n, any_value(mean) AS mean, [{prods}] AS g FROM (SELECT *, {ls} FROM cs) GROUP BY 1, 2)")
    ctes.append(f"pick AS MATERIALIZED (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY g[1], v) = 1)")
    ctes.append(f"""sys AS (SELECT {key}, p, 0 AS i, list_transform(range(1, p + 1), lambda a:
    list_append(list_transform(range(1, p + 1), lambda b: g[abs(a - b)::INT + 1]), g[a::INT + 1])) AS m
  FROM pick, range(0, {top + 1}) AS o(p)
  UNION ALL
  SELECT {key}, p, i + 1, list_transform(range(1, p + 1), lambda a: CASE WHEN a = i + 1
      THEN list_transform(m[i + 1], lambda x: x / m[i + 1][i + 1])
      ELSE list_transform(range(1, p + 2), lambda b: m[a::INT][b::INT] - m[a::INT][i + 1] * m[i + 1][b::INT] / m[i + 1][i + 1]) END)
  FROM sys WHERE i < p)""")
    ctes.append(f"""ar AS (SELECT {key}, p, list_transform(m, lambda row: row[p + 1]) AS phi FROM sys WHERE i = p)""")
    ctes.append(f"""cand AS (SELECT {key}, v, p, n, mean, phi,
    g[1] - coalesce(list_sum(list_transform(range(1, p + 1), lambda a: phi[a::INT] * g[a::INT + 1])), 0) AS var FROM ar JOIN pick USING ({key}))""")
    ctes.append(f"""best AS MATERIALIZED (SELECT *, n * ln(var) + 2 * (p + 2) + 2.0 * (p + 2) * (p + 3) / (n - p - 3) AS aicc FROM cand
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY aicc, p) = 1)""")
    diffs = "[" + ", ".join("[" + ", ".join(f"{x}::DOUBLE" for x in poly[k]) + "]" for k in kinds) + "]"
    ctes.append(f"""poly AS (SELECT {key}, v, p, mean, phi, var, list_transform(range(1, p + len(f) + 1), lambda a: list_sum(list_transform(range(1, len(f) + 1),
    lambda b: CASE WHEN a - b = 0 THEN f[b::INT] WHEN a - b BETWEEN 1 AND p THEN -phi[(a - b)::INT] * f[b::INT] ELSE 0.0 END))) AS a
  FROM (SELECT *, ({diffs})[v + 1] AS f FROM best))""")
    ctes.append(f"last AS (SELECT {key}, list(y ORDER BY t DESC) AS ys FROM tr GROUP BY 1)")
    ctes.append(f"""path AS (SELECT {key}, 0 AS step, 0.0::DOUBLE AS forecast, 0.0::DOUBLE AS wide, ys, []::DOUBLE[] AS ps FROM last
  UNION ALL
  SELECT {key}, step + 1, ny, wide + np * np, list_prepend(ny, ys), list_prepend(np, ps)
  FROM (SELECT path.*, mean * (1 - coalesce(list_sum(phi), 0)) - coalesce(list_sum(list_transform(range(2, len(a) + 1), lambda i: a[i::INT] * ys[i::INT - 1])), 0) AS ny,
          CASE WHEN step = 0 THEN 1.0 ELSE -coalesce(list_sum(list_transform(range(2, least(step + 1, len(a)) + 1), lambda i: a[i::INT] * ps[i::INT - 1])), 0) END AS np
        FROM path JOIN poly USING ({key})) WHERE step < {H})""")
    ctes.append(f"""b AS (SELECT d.{key}, d.{t}, d.{v}, path.step, forecast, v % 2 AS dd, v // 2 AS seasonal, p,
    forecast - {z} * sqrt(var * wide) AS lo, forecast + {z} * sqrt(var * wide) AS hi
  FROM d JOIN path ON path.{key} = d.{key} AND path.step = d.t - d.n + {H} JOIN poly ON poly.{key} = d.{key} WHERE path.step > 0)""")
    out = _fc_out(key, t, v, direction, "step, CAST(dd AS INTEGER) AS d, CAST(seasonal AS INTEGER) AS seasonal, CAST(p AS INTEGER) AS p, ")
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + out + " FROM b"


@register("auto_ar_seasonal", _auto_seasonal_sql(_EVENTS, "event_type", "ts", "value", 24, 25, 24, 0.99, "both"))
def q_auto_ar_seasonal(spark, sf_dir):
    from tidewatch.operators.arima import auto_ar_seasonal_detect
    d = auto_ar_seasonal_detect(S.table(spark, sf_dir, "events"), "event_type", "ts", "value", season=24, horizon=24, level=0.99,
                                direction="both", freq="1 hour", fill_method="interpolate")
    return d.select(*_out(), "d", "seasonal", "p")
