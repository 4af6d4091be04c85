"""Registered queries: one per operator, each with a DuckDB oracle.

Every query reads the driver tables (whole tables, no id subsets) and
returns a DataFrame whose column names match its oracle SQL.  Floating
outputs are rounded in both places; decision columns are computed before
rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans import series as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r(c, d: int = 6):
    return F.round(F.col(c), d).alias(c)


def alpha_sql(span: int) -> str:
    return f"(CAST(2 AS DOUBLE) / CAST({span + 1} AS DOUBLE))"


def ewma_rec_sql(src: str, key: str, x: str, span: int, start: int = 1) -> str:
    """Recursive CTE body computing the EWM of column ``x`` (non-null from
    position ``start``) of CTE ``src`` (needs ``key, pos, x``)."""
    a = alpha_sql(span)
    return f"""rec({key}, pos, ema) AS (
  SELECT {key}, pos, {x} FROM {src} WHERE pos = {start}
  UNION ALL
  SELECT p.{key}, p.pos,
         CASE WHEN rec.ema = p.{x} THEN rec.ema
              ELSE ((1 - {a}) * rec.ema + {a} * p.{x}) / ((1 - {a}) + {a}) END
  FROM rec JOIN {src} p ON p.{key} = rec.{key} AND p.pos = rec.pos + 1)"""


# ---------------------------------------------------------------------------
# flagship: supplier-daily revenue, EWMA chart, high side
# ---------------------------------------------------------------------------

def _ewma_sql(src: str, key: str, t: str, feature: str, window: int, k: float, direction: str,
              round_d: int) -> str:
    cmp = {"high": "x > ucl", "low": "x < lcl", "both": "(x > ucl OR x < lcl)"}[direction]
    return f"""WITH RECURSIVE s AS ({src}),
p AS (
  SELECT {key}, {t}, {feature} AS x,
         row_number() OVER (PARTITION BY {key} ORDER BY {t}) - 1 AS pos,
         lag({feature}, 1) OVER (PARTITION BY {key} ORDER BY {t}) AS target,
         CASE WHEN count({feature}) OVER w = {window} THEN stddev_samp({feature}) OVER w END AS sd
  FROM s
  WINDOW w AS (PARTITION BY {key} ORDER BY {t}
               ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING)),
{ewma_rec_sql('p', key, 'target', window)},
f AS (
  SELECT p.*, rec.ema,
         CASE WHEN p.sd >= 0.01 * abs(p.x) THEN p.sd ELSE 0.01 * abs(p.x) END AS std
  FROM p JOIN rec USING ({key}, pos)),
g AS (SELECT *, ema + {k} * std AS ucl, ema - {k} * std AS lcl FROM f)
SELECT {key}, {t}, x AS {feature}, {S.rnd('ema', round_d)} AS ema,
       {S.rnd('ucl', round_d)} AS ucl, {S.rnd('lcl', round_d)} AS lcl
FROM g WHERE {cmp} AND pos >= {window}"""


def _ewma_l_sql(feature: str, window: int, k: float, direction: str, round_d: int) -> str:
    return _ewma_sql(S.L_SQL, "l_suppkey", "l_shipdate", feature, window, k, direction, round_d)


def _ewma_l(spark, sf_dir, feature, window, k, direction, round_d):
    from tidewatch.operators.ewma import ewma_detect
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", feature)
    out = ewma_detect(l, "l_suppkey", "l_shipdate", feature, window=window, no_of_stds=k,
                      direction=direction)
    return out.select("l_suppkey", "l_shipdate", feature, r("ema", round_d), r("ucl", round_d),
                      r("lcl", round_d))


@register("ewma_detect_high", _ewma_l_sql("sum_price", 100, 3.0, "high", 2))
def q_ewma_detect_high(spark, sf_dir):
    return _ewma_l(spark, sf_dir, "sum_price", 100, 3.0, "high", 2)


@register("ewma_detect_low", _ewma_l_sql("avg_qty", 100, 2.0, "low", 4))
def q_ewma_detect_low(spark, sf_dir):
    return _ewma_l(spark, sf_dir, "avg_qty", 100, 2.0, "low", 4)


@register("ewma_detect_both", _ewma_l_sql("avg_price", 100, 2.0, "both", 2))
def q_ewma_detect_both(spark, sf_dir):
    return _ewma_l(spark, sf_dir, "avg_price", 100, 2.0, "both", 2)


# ---------------------------------------------------------------------------
# cleaning, parsing, sources
# ---------------------------------------------------------------------------
_K_SQL = """regexp_extract(props, '"k": (\\d+)', 1)"""


@register("to_numeric", f"""SELECT event_id,
  {S.rnd(f"TRY_CAST(CASE WHEN event_id % 13 = 0 THEN 'x' || {_K_SQL} ELSE {_K_SQL} END AS DOUBLE)", 2)} AS k_num
FROM events""")
def q_to_numeric(spark, sf_dir):
    from tidewatch.functions.scalar import to_numeric
    ev = S.table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    txt = F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("x"), k)).otherwise(k)
    return ev.select("event_id", to_numeric(txt, 2).alias("k_num"))


@register("parse_epoch_ms", """SELECT event_id,
  CASE WHEN event_id % 17 = 0 THEN NULL
       ELSE make_timestamp((epoch_us(ts) // 1000 // 1000) * 1000000) END AS time
FROM events""")
def q_parse_epoch_ms(spark, sf_dir):
    from tidewatch.functions.scalar import epoch_us, parse_epoch_ms
    ev = S.table(spark, sf_dir, "events")
    ms = F.floor(epoch_us("ts") / 1000).cast("string")
    txt = F.when(F.col("event_id") % 17 == 0, F.lit("bad")).otherwise(ms)
    return ev.select("event_id", parse_epoch_ms(txt).alias("time"))


def _raw_logs(spark, sf_dir):
    """Events rendered as a raw text log (quoted ids, epoch-ms text),
    every row present twice."""
    from tidewatch.functions.scalar import epoch_us
    ev = S.table(spark, sf_dir, "events")
    raw = ev.select(F.col("user_id").cast("string").alias("sn"),
                    F.concat(F.lit('"'), F.col("event_type"), F.lit('"')).alias("mdn"),
                    F.floor(epoch_us("ts") / 1000).cast("string").alias("ts"),
                    F.col("value").cast("string").alias("value"),
                    F.col("event_type").alias("ModelName"))
    return raw.unionByName(raw)


@register("clean_dedup", f"""SELECT DISTINCT CAST(user_id AS VARCHAR) AS sn, event_type AS MDN,
  make_timestamp((epoch_us(ts) // 1000 // 1000) * 1000000) AS time, {S.rnd('value', 2)} AS value
FROM events WHERE event_type IN ('click', 'view')""")
def q_clean_dedup(spark, sf_dir):
    from tidewatch.operators.clean import clean_raw
    return clean_raw(_raw_logs(spark, sf_dir), ["value"],
                     filters=[F.col("ModelName").isin("click", "view")])


@register("extract_json_metric", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_extract_json_metric(spark, sf_dir):
    from tidewatch.operators.clean import extract_json_metric
    ev = S.table(spark, sf_dir, "events")
    return extract_json_metric(ev, "props", {"k": "int"}).select("event_id", "k")


@register("flatten_struct", """SELECT event_id, user_id AS e_user_id, event_type AS e_m_event_type,
  value AS e_m_value FROM events""")
def q_flatten_struct(spark, sf_dir):
    from tidewatch.operators.clean import flatten_struct
    ev = S.table(spark, sf_dir, "events")
    nested = ev.select("event_id", F.struct("user_id", F.struct("event_type", "value").alias("m")).alias("e"))
    return flatten_struct(nested)


@register("partition_coverage", """WITH p AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS bucket FROM events),
r AS (SELECT event_type, min(bucket) AS lo, max(bucket) AS hi FROM p GROUP BY event_type),
e AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM r)
SELECT e.event_type, e.bucket FROM e ANTI JOIN p ON e.event_type = p.event_type AND e.bucket = p.bucket""")
def q_partition_coverage(spark, sf_dir):
    from tidewatch.sources.io import partition_coverage
    return partition_coverage(S.table(spark, sf_dir, "events"), "event_type", "ts", "hour")


# ---------------------------------------------------------------------------
# feature engineering
# ---------------------------------------------------------------------------

@register("time_bucket_avg", f"""SELECT event_type, date_trunc('hour', ts) AS ts, {S.rnd('avg(value)', 2)} AS value,
  arg_min(user_id, event_id) AS user_id, min(event_id) AS event_id
FROM events GROUP BY event_type, date_trunc('hour', ts)""")
def q_time_bucket_avg(spark, sf_dir):
    from tidewatch.operators.features import time_bucket_avg
    ev = S.table(spark, sf_dir, "events").select("event_type", "ts", "value", "user_id", "event_id")
    return time_bucket_avg(ev, "event_type", "ts", ["value"], unit="hour", carry_order="event_id")


def _incr_sql(src: str, x: str = "counter") -> str:
    return f"""l AS (
  SELECT *, lag({x}, 1) OVER w AS x1, lag({x}, 2) OVER w AS x2, lag({x}, 3) OVER w AS x3
  FROM {src} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (
  SELECT *, CASE WHEN {x} < x1 THEN coalesce(x1 - x2, 0.0) ELSE {x} - x1 END AS inc,
            CASE WHEN x1 < x2 THEN coalesce(x2 - x3, 0.0) ELSE x1 - x2 END AS inc_prev FROM l),
sm AS (
  SELECT user_id, ts, event_id, {S.rnd('CASE WHEN inc < 0 THEN inc_prev ELSE inc END', 2)} AS {x}
  FROM i WHERE (CASE WHEN inc < 0 THEN inc_prev ELSE inc END) IS NOT NULL)"""


@register("smoothed_increment", f"""WITH c AS ({S.U_COUNTER_SQL}),
{_incr_sql('c')}
SELECT * FROM sm""")
def q_smoothed_increment(spark, sf_dir):
    from tidewatch.operators.features import smoothed_increment
    return smoothed_increment(S.user_counter(spark, sf_dir), "user_id", "ts", ["counter"], tiebreak=["event_id"])


@register("feature_steps", f"""WITH c AS ({S.U_COUNTER_SQL}),
h AS (SELECT user_id, ts, {S.rnd('avg(counter)', 2)} AS counter, min(event_id) AS event_id
      FROM c GROUP BY user_id, ts),
{_incr_sql('h')},
lg AS (SELECT user_id, ts, event_id,
              {S.rnd('ln(1 + CASE WHEN counter < 0 THEN 0 ELSE counter END)', 2)} AS counter FROM sm)
SELECT user_id, ts, event_id,
       last_value(CASE WHEN counter = 0 THEN NULL ELSE counter END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS counter
FROM lg""")
def q_feature_steps(spark, sf_dir):
    from tidewatch.operators.features import run_feature_steps
    return run_feature_steps(S.user_counter(spark, sf_dir), "user_id", "ts", ["counter"],
                             steps=("incr", "log", "fill"), tiebreak=["event_id"], carry_order="event_id")


_FFILL_SQL = """last_value(CASE WHEN value = 0 THEN NULL ELSE value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@register("ffill_zeros", f"""WITH u AS ({S.U0_SQL})
SELECT user_id, ts, event_id, event_type, {_FFILL_SQL} AS value FROM u""")
def q_ffill_zeros(spark, sf_dir):
    from tidewatch.operators.features import ffill_zeros
    return ffill_zeros(S.user_events_with_zeros(spark, sf_dir), "user_id", "ts", ["value"], tiebreak=["event_id"])


@register("forward_fill", f"""WITH u AS ({S.U0_SQL})
SELECT user_id, ts, event_id, event_type,
       {S.rnd(f'coalesce({_FFILL_SQL}, (SELECT avg(value) FROM u))', 6)} AS value FROM u""")
def q_forward_fill(spark, sf_dir):
    from tidewatch.operators.features import forward_fill
    d = forward_fill(S.user_events_with_zeros(spark, sf_dir), "user_id", "ts", ["value"], tiebreak=["event_id"])
    return d.withColumn("value", F.round("value", 6))


@register("forward_fill_entity", f"""WITH u AS ({S.U0_SQL})
SELECT user_id, ts, event_id, event_type,
       {S.rnd(f'coalesce({_FFILL_SQL}, avg(nullif(value, 0)) OVER (PARTITION BY user_id))', 6)} AS value FROM u""")
def q_forward_fill_entity(spark, sf_dir):
    from tidewatch.operators.features import forward_fill
    d = forward_fill(S.user_events_with_zeros(spark, sf_dir), "user_id", "ts", ["value"], tiebreak=["event_id"],
                     fallback_excludes_zero=True, scope="entity")
    return d.withColumn("value", F.round("value", 6))


# ---------------------------------------------------------------------------
# reshape
# ---------------------------------------------------------------------------

@register("wide_to_long", f"""WITH s AS ({S.L_SQL})
""" + "\nUNION ALL\n".join(
    f"SELECT l_suppkey, l_shipdate, '{c}' AS feature, {c} AS value FROM s" for c in S.L_FEATURES))
def q_wide_to_long(spark, sf_dir):
    from tidewatch.operators.reshape import wide_to_long
    return wide_to_long(S.supplier_daily(spark, sf_dir), ["l_suppkey", "l_shipdate"], S.L_FEATURES)


_SLICE_SQL = """WITH u AS (SELECT user_id, ts, event_id, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
n AS (SELECT user_id, max(rn) AS N FROM u GROUP BY user_id HAVING max(rn) >= {L}),
s AS (SELECT user_id, unnest(generate_series(1, N - {L} + 1, {S})) AS s FROM n),
j AS (SELECT u.*, s.s FROM u JOIN s USING (user_id) WHERE u.rn >= s.s AND u.rn < s.s + {L})
SELECT user_id, ts, event_id, value, s - 1 AS slice_start,
       CAST(user_id AS VARCHAR) || '_' || strftime(min(ts) OVER (PARTITION BY user_id, s), '%Y%m%d%H%M%S')
         AS series_id
FROM j"""


@register("slice_series", _SLICE_SQL.format(L=20, S=5))
def q_slice_series(spark, sf_dir):
    from tidewatch.operators.reshape import slice_series
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return slice_series(u, "user_id", "ts", 20, 5, tiebreak=["event_id"])


@register("slice_series_overlap", _SLICE_SQL.format(L=24, S=12))
def q_slice_series_overlap(spark, sf_dir):
    from tidewatch.operators.reshape import slice_series
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return slice_series(u, "user_id", "ts", 24, overlap=0.5, tiebreak=["event_id"])


_RN_DESC = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)"


@register("split_tail", f"SELECT user_id, ts, event_id, value, {_RN_DESC} <= 5 AS is_test FROM events")
def q_split_tail(spark, sf_dir):
    from tidewatch.operators.reshape import split_tail
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return split_tail(u, "user_id", "ts", 5, tiebreak=["event_id"])


@register("recent_only", f"""SELECT user_id, ts, event_id, value FROM (
  SELECT *, {_RN_DESC} AS rd FROM events) WHERE rd <= 10""")
def q_recent_only(spark, sf_dir):
    from tidewatch.operators.reshape import recent_only
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return recent_only(u, "user_id", "ts", 10, tiebreak=["event_id"])


_RN_ASC = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@register("split_range", f"""SELECT user_id, ts, event_id, value,
  ({_RN_DESC} <= 30 AND {_RN_DESC} > 5) AS in_range FROM events""")
def q_split_range(spark, sf_dir):
    from tidewatch.operators.reshape import split_range
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return split_range(u, "user_id", "ts", -30, -5, tiebreak=["event_id"])


@register("split_positions", f"""SELECT user_id, ts, event_id, value,
  ({_RN_ASC} IN (1, 4) OR {_RN_DESC} = 1) AS in_list FROM events""")
def q_split_positions(spark, sf_dir):
    from tidewatch.operators.reshape import split_positions
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return split_positions(u, "user_id", "ts", [0, 3, -1], tiebreak=["event_id"])


@register("min_points", """SELECT user_id, ts, event_id, value FROM events
WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) >= 70)""")
def q_min_points(spark, sf_dir):
    from tidewatch.operators.reshape import min_points
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return min_points(u, "user_id", 70)


# ---------------------------------------------------------------------------
# per-series statistics
# ---------------------------------------------------------------------------
_PL = "PARTITION BY l_suppkey"


@register("scale_standard", f"""WITH s AS ({S.L_SQL})
SELECT l_suppkey, l_shipdate, sum_price,
  {S.rnd(f'(sum_price - avg(sum_price) OVER ({_PL})) / CASE WHEN stddev_pop(sum_price) OVER ({_PL}) = 0 THEN 1 ELSE stddev_pop(sum_price) OVER ({_PL}) END', 6)} AS scaled
FROM s""")
def q_scale_standard(spark, sf_dir):
    from tidewatch.operators.stats import scale_series
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "sum_price")
    return scale_series(l, "l_suppkey", "l_shipdate", "sum_price", "standard").withColumn(
        "scaled", F.round("scaled", 6))


@register("scale_minmax", f"""WITH s AS ({S.L_SQL})
SELECT l_suppkey, l_shipdate, avg_qty,
  {S.rnd(f'(avg_qty - min(avg_qty) OVER ({_PL})) / CASE WHEN max(avg_qty) OVER ({_PL}) - min(avg_qty) OVER ({_PL}) = 0 THEN 1 ELSE max(avg_qty) OVER ({_PL}) - min(avg_qty) OVER ({_PL}) END', 6)} AS scaled
FROM s""")
def q_scale_minmax(spark, sf_dir):
    from tidewatch.operators.stats import scale_series
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    return scale_series(l, "l_suppkey", "l_shipdate", "avg_qty", "minmax").withColumn(
        "scaled", F.round("scaled", 6))


@register("rolling_std", f"""WITH s AS ({S.L_SQL})
SELECT l_suppkey, l_shipdate, avg_price,
  {S.rnd('CASE WHEN count(avg_price) OVER w = 30 THEN stddev_samp(avg_price) OVER w END', 6)} AS rolling_std
FROM s WINDOW w AS ({_PL} ORDER BY l_shipdate ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def q_rolling_std(spark, sf_dir):
    from tidewatch.operators.stats import rolling_std
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_price")
    return rolling_std(l, "l_suppkey", "l_shipdate", "avg_price", 30).withColumn(
        "rolling_std", F.round("rolling_std", 6))


def _ew_std_sql(span: int) -> str:
    raw = [(1 - 2 / (span + 1)) ** j for j in range(span - 1, -1, -1)]
    wl = "[" + ", ".join(repr(w / sum(raw)) + "::DOUBLE" for w in raw) + "]"
    mu = f"list_reduce(list_transform(arr, lambda x, i: x * {wl}[i]), lambda acc, v: acc + v)"
    var = (f"list_reduce(list_transform(arr, lambda x, i: {wl}[i] * (x - mu) * (x - mu)), "
           f"lambda acc, v: acc + v)")
    return f"""WITH s AS ({S.L_SQL}),
a AS (SELECT l_suppkey, l_shipdate, avg_qty, list(avg_qty) OVER w AS arr, count(avg_qty) OVER w AS c,
             row_number() OVER ({_PL} ORDER BY l_shipdate) - 1 AS pos
      FROM s WINDOW w AS ({_PL} ORDER BY l_shipdate ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW)),
b AS (SELECT *, {mu} AS mu FROM a)
SELECT l_suppkey, l_shipdate, avg_qty,
       {S.rnd(f'CASE WHEN c = {span} AND pos >= {span} THEN sqrt({var}) END', 6)} AS ew_std
FROM b"""


@register("ew_std", _ew_std_sql(20))
def q_ew_std(spark, sf_dir):
    from tidewatch.operators.stats import ew_std
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    return ew_std(l, "l_suppkey", "l_shipdate", "avg_qty", 20).withColumn("ew_std", F.round("ew_std", 6))


_QS = [0.01, 0.25, 0.5, 0.75, 0.99]


@register("series_percentiles", f"""WITH s AS ({S.L_SQL})
SELECT l_suppkey, """ + ", ".join(
    f"{S.rnd(f'quantile_cont(avg_price, {q})', 6)} AS p{int(round(q * 100)):02d}" for q in _QS)
    + " FROM s GROUP BY l_suppkey")
def q_series_percentiles(spark, sf_dir):
    from tidewatch.operators.stats import series_percentiles
    d = series_percentiles(S.supplier_daily(spark, sf_dir), "l_suppkey", "avg_price", _QS)
    return d.select("l_suppkey", *[r(c) for c in d.columns[1:]])


@register("trim_tails", f"""WITH s AS ({S.L_SQL}),
b AS (SELECT l_suppkey, quantile_cont(avg_qty, 0.05) AS lo, quantile_cont(avg_qty, 0.95) AS hi
      FROM s GROUP BY l_suppkey)
SELECT s.l_suppkey, s.l_shipdate, s.avg_qty FROM s JOIN b USING (l_suppkey)
WHERE s.avg_qty BETWEEN b.lo AND b.hi""")
def q_trim_tails(spark, sf_dir):
    from tidewatch.operators.stats import trim_tails
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    return trim_tails(l, "l_suppkey", "avg_qty", 90)


@register("rolling_detect", f"""WITH s AS ({S.L_SQL}),
a AS (SELECT l_suppkey, l_shipdate, avg_price,
             CASE WHEN count(avg_price) OVER w = 100 THEN avg(avg_price) OVER w END AS m,
             CASE WHEN count(avg_price) OVER w = 100 THEN stddev_samp(avg_price) OVER w END AS sd
      FROM s WINDOW w AS ({_PL} ORDER BY l_shipdate ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING))
SELECT l_suppkey, l_shipdate, avg_price, {S.rnd('m', 6)} AS train_mean, {S.rnd('sd', 4)} AS train_std
FROM a WHERE avg_price < m - 2.0 * sd OR avg_price > m + 2.0 * sd""")
def q_rolling_detect(spark, sf_dir):
    from tidewatch.operators.stats import rolling_detect
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_price")
    d = rolling_detect(l, "l_suppkey", "l_shipdate", "avg_price", train=100, k=2.0)
    return d.select("l_suppkey", "l_shipdate", "avg_price", r("train_mean", 6), r("train_std", 4))


@register("ewma_anomaly_type", _ewma_l_sql("avg_price", 100, 2.0, "both", 2).replace(
    "SELECT l_suppkey, l_shipdate, x AS avg_price,",
    "SELECT l_suppkey, l_shipdate, CASE WHEN x < lcl THEN 'low' WHEN x > ucl THEN 'high' END AS anomaly_type,"
).replace(f"{S.rnd('ema', 2)} AS ema,\n       {S.rnd('ucl', 2)} AS ucl, {S.rnd('lcl', 2)} AS lcl", "1 AS one"))
def q_ewma_anomaly_type(spark, sf_dir):
    from tidewatch.operators.ewma import ewma_detect
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_price")
    out = ewma_detect(l, "l_suppkey", "l_shipdate", "avg_price", window=100, no_of_stds=2.0, direction="both")
    return out.select("l_suppkey", "l_shipdate", "anomaly_type", F.lit(1).alias("one"))


# ---------------------------------------------------------------------------
# KDE (oracle: brute-force pairwise sums, fine at the check scale)
# ---------------------------------------------------------------------------
import math as _math  # noqa: E402


def _kde_norm(h: float) -> str:
    return repr(h * _math.sqrt(2 * _math.pi))


def _kde_sql(src: str, key: str, order_desc: str, v: str, h: float, train, new, filt: float, thr: float,
             direction: str, out_cols: str, row_cols: str) -> str:
    train_cond = "TRUE" if train == "all" else f"rpos >= {train[1]}"
    new_cond = "TRUE" if new == "all" else f"rpos < {new[1]}"
    k2 = f"((a.{v} - b.{v}) / {h!r}) * ((a.{v} - b.{v}) / {h!r})"
    if filt < 100:
        lo = (100 - filt) / 2 / 100
        trim = f"""fb AS (SELECT {key}, quantile_cont({v}, {lo!r}) AS flo, quantile_cont({v}, {1 - lo!r}) AS fhi
       FROM tr0 GROUP BY {key}),
tr AS (SELECT tr0.{key}, tr0.{v} FROM tr0 JOIN fb USING ({key}) WHERE tr0.{v} BETWEEN fb.flo AND fb.fhi),"""
    else:
        trim = f"tr AS (SELECT {key}, {v} FROM tr0),"
    p = thr / 100
    cmp = {"low": f"{v} < lower", "high": f"{v} > upper",
           "both": f"({v} < lower OR {v} > upper)"}[direction]
    return f"""WITH u AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order_desc}) - 1 AS rpos
           FROM ({src}) WHERE {v} IS NOT NULL),
tr0 AS (SELECT * FROM u WHERE {train_cond}),
{trim}
st AS (SELECT {key}, count(*) AS n, quantile_cont({v}, {1 - p!r}) AS lower, quantile_cont({v}, {p!r}) AS upper
       FROM tr GROUP BY {key}),
tri AS (SELECT *, row_number() OVER () AS rid FROM tr),
trd AS (SELECT a.{key}, a.rid, sum(exp(-0.5 * {k2})) AS s FROM tri a JOIN tr b USING ({key})
        GROUP BY a.{key}, a.rid),
th AS (SELECT trd.{key}, quantile_cont(trd.s / (st.n * {_kde_norm(h)}), 0.01) AS threshold
       FROM trd JOIN st USING ({key}) GROUP BY trd.{key}),
nw AS (SELECT * FROM u WHERE {new_cond}),
nd AS (SELECT {row_cols}, sum(exp(-0.5 * {k2})) AS s FROM nw a JOIN tr b USING ({key}) GROUP BY {row_cols}),
f AS (SELECT nd.*, nd.s / (st.n * {_kde_norm(h)}) AS density, st.lower, st.upper, th.threshold
      FROM nd JOIN st USING ({key}) JOIN th USING ({key}))
SELECT {out_cols} FROM f WHERE density < threshold * (1 - 1e-9) AND {cmp}"""


_U_ROW = "a.user_id, a.ts, a.event_id, a.value"
_U_OUT = f"user_id, ts, event_id, value, {S.rnd('density', 6)} AS density"


def _kde_u(spark, sf_dir, **kw):
    from tidewatch.operators.kde import kde_detect
    u = S.user_events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    d = kde_detect(u, "user_id", "ts", "value", tiebreak=["event_id"], **kw)
    return d.select("user_id", "ts", "event_id", "value", r("density"))


@register("kde_detect_all", _kde_sql(S.U_SQL, "user_id", "ts DESC, event_id DESC", "value", 0.5, "all", "all",
                                     99, 95, "both", _U_OUT, _U_ROW))
def q_kde_detect_all(spark, sf_dir):
    return _kde_u(spark, sf_dir, bandwidth=0.5, filter_percentile=99, threshold_percentile=95,
                  direction="both")


@register("kde_novelty", _kde_sql(S.U_SQL, "user_id", "ts DESC, event_id DESC", "value", 0.5, ("head", 10),
                                  ("tail", 10), 100, 95, "both", _U_OUT, _U_ROW))
def q_kde_novelty(spark, sf_dir):
    return _kde_u(spark, sf_dir, bandwidth=0.5, train=("head", 10), new=("tail", 10),
                  filter_percentile=100, threshold_percentile=95, direction="both")


@register("kde_detect_recent", _kde_sql(S.L_SQL, "l_suppkey", "l_shipdate DESC", "avg_qty", 0.5, "all",
                                        ("tail", 30), 99, 95, "both",
                                      f"l_suppkey, l_shipdate, avg_qty, {S.rnd('density', 6)} AS density",
                                      "a.l_suppkey, a.l_shipdate, a.avg_qty"))
def q_kde_detect_recent(spark, sf_dir):
    from tidewatch.operators.kde import kde_detect
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    d = kde_detect(l, "l_suppkey", "l_shipdate", "avg_qty", bandwidth=0.5, new=("tail", 30),
                   filter_percentile=99, threshold_percentile=95, direction="both")
    return d.select("l_suppkey", "l_shipdate", "avg_qty", r("density"))


@register("kde_density", f"""WITH u AS ({S.U_SQL})
SELECT a.user_id, a.event_id,
       {S.rnd(f"sum(exp(-0.5 * ((a.value - b.value) / 0.5) * ((a.value - b.value) / 0.5))) / (count(*) * {_kde_norm(0.5)})", 6)} AS density
FROM u a JOIN u b USING (user_id) GROUP BY a.user_id, a.event_id""")
def q_kde_density(spark, sf_dir):
    from tidewatch.operators.kde import kde_density
    u = S.user_events(spark, sf_dir).select("user_id", "event_id", "value")
    return kde_density(u, u, "user_id", "value", 0.5).select("user_id", "event_id", r("density"))


@register("kde_curve", f"""WITH u AS ({S.U_SQL}),
g0 AS (SELECT user_id, min(value) - 1 AS lo, max(value) + 1 AS hi, count(*) AS n FROM u GROUP BY user_id),
g AS (SELECT user_id, n, i, CASE WHEN i = 999 THEN hi ELSE lo + i * ((hi - lo) / 999) END AS x
      FROM g0, generate_series(0, 999) t(i))
SELECT g.user_id, g.i, {S.rnd('g.x', 6)} AS x,
       {S.rnd(f"sum(exp(-0.5 * ((g.x - u.value) / 0.5) * ((g.x - u.value) / 0.5))) / (g.n * {_kde_norm(0.5)})", 6)} AS density
FROM g JOIN u USING (user_id) GROUP BY g.user_id, g.i, g.x, g.n""")
def q_kde_curve(spark, sf_dir):
    from tidewatch.operators.kde import kde_curve
    u = S.user_events(spark, sf_dir).select("user_id", "value")
    d = kde_curve(u, "user_id", "value", 0.5)
    return d.select("user_id", F.col("i").cast("long").alias("i"), r("x"), r("density"))


# ---------------------------------------------------------------------------
# resampling, gap filling, forecasting
# ---------------------------------------------------------------------------
_HOUR_US = 3_600_000_000


def _resample_sql(src: str, key: str, t: str, v: str, us: int) -> str:
    """CTEs a (bucket means), j (spine with pos, column v nullable)."""
    return f"""a AS (SELECT {key}, (epoch_us({t}) // {us}) * {us} AS b, avg({v}) AS v FROM ({src}) GROUP BY 1, 2),
r AS (SELECT {key}, min(b) AS lo, max(b) AS hi FROM a GROUP BY 1),
sp AS (SELECT {key}, unnest(generate_series(lo, hi, {us})) AS b FROM r),
j AS (SELECT sp.{key}, sp.b, a.v, row_number() OVER (PARTITION BY sp.{key} ORDER BY sp.b) - 1 AS pos
      FROM sp LEFT JOIN a USING ({key}, b))"""


def _fill_sql(key: str, method: str) -> str:
    w = f"PARTITION BY {key} ORDER BY pos"
    prev = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    nxt = f"OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    if method == "zero":
        return "coalesce(v, 0.0)"
    if method == "ffill":
        return f"last_value(v IGNORE NULLS) {prev}"
    if method == "bfill":
        return f"first_value(v IGNORE NULLS) {nxt}"
    y0, x0 = f"last_value(v IGNORE NULLS) {prev}", f"last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {prev}"
    y1, x1 = f"first_value(v IGNORE NULLS) {nxt}", f"first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {nxt}"
    return (f"CASE WHEN v IS NOT NULL THEN v WHEN ({y1}) IS NULL THEN {y0} "
            f"ELSE (({y1}) - ({y0})) / (({x1}) - ({x0})) * (pos - ({x0})) + ({y0}) END")


def _filled_sql(src, key, t, v, us, method):
    return f"""{_resample_sql(src, key, t, v, us)},
fl AS (SELECT {key}, make_timestamp(b) AS {t}, pos, {_fill_sql(key, method)} AS {v} FROM j)"""


for _m in ("interpolate", "ffill", "bfill", "zero"):
    def _mk(method):
        def q(spark, sf_dir):
            from tidewatch.operators.resample import fill_gaps, resample_mean
            ev = S.table(spark, sf_dir, "events").select("event_type", "ts", "value")
            d = fill_gaps(resample_mean(ev, "event_type", "ts", "value", "1 hour"), "event_type", "ts", "value",
                          method)
            return d.select("event_type", "ts", r("value"))
        return q
    register(f"resample_fill_{_m}", f"""WITH {_filled_sql('SELECT * FROM events', 'event_type', 'ts', 'value', _HOUR_US, _m)}
SELECT event_type, ts, {S.rnd('value', 6)} AS value FROM fl""")(_mk(_m))


def _geo_sql(rr: str, k: str) -> str:
    return f"(CASE WHEN {rr} = 1 THEN CAST({k} AS DOUBLE) ELSE (1 - pow({rr}, {k})) / (1 - {rr}) END)"


def _ols_sql(y: str, xs: list, pre: str) -> str:
    a = [f"count(*) AS {pre}n", f"avg({y}) AS {pre}my", f"var_pop({y}) AS {pre}syy"]
    for i, x in enumerate(xs, 1):
        a += [f"avg({x}) AS {pre}m{i}", f"var_pop({x}) AS {pre}s{i}{i}", f"covar_pop({x}, {y}) AS {pre}s{i}y"]
    if len(xs) == 2:
        a.append(f"covar_pop({xs[0]}, {xs[1]}) AS {pre}s12")
    return ", ".join(a)


#: Two-sided normal quantiles of the levels used below (fixed values).
Z = {0.95: "1.9599639845400536", 0.99: "2.5758293035489", 0.995: "2.8070337683438114"}


def _ols_solve_sql(k: int, pre: str) -> str:
    c = lambda n: f"{pre}{n}"
    if k == 0:
        return f"{c('my')} AS {pre}c, {c('n')} * {c('syy')} AS {pre}sse"
    if k == 1:
        b1 = f"({c('s1y')} / nullif({c('s11')}, 0))"
        return (f"{b1} AS {pre}b1, {c('my')} - {b1} * {c('m1')} AS {pre}c, "
                f"{c('n')} * ({c('syy')} - {b1} * {c('s1y')}) AS {pre}sse")
    det = f"nullif({c('s11')} * {c('s22')} - {c('s12')} * {c('s12')}, 0)"
    b1 = f"(({c('s1y')} * {c('s22')} - {c('s2y')} * {c('s12')}) / {det})"
    b2 = f"(({c('s2y')} * {c('s11')} - {c('s1y')} * {c('s12')}) / {det})"
    return (f"{b1} AS {pre}b1, {b2} AS {pre}b2, {c('my')} - {b1} * {c('m1')} - {b2} * {c('m2')} AS {pre}c, "
            f"{c('n')} * ({c('syy')} - {b1} * {c('s1y')} - {b2} * {c('s2y')}) AS {pre}sse")


def _flag_sql(v, direction):
    return {"low": (f"{v} < lo", f"CASE WHEN {v} < lo THEN 'low' END"),
            "high": (f"{v} > hi", f"CASE WHEN {v} > hi THEN 'high' END"),
            "both": (f"({v} < lo OR {v} > hi)",
                     f"CASE WHEN {v} < lo THEN 'low' WHEN {v} > hi THEN 'high' END")}[direction]


def _fc_out(key, t, v, direction, extra=""):
    f, a = _flag_sql(v, direction)
    return (f"SELECT {key}, {t}, {extra}{S.rnd(v, 6)} AS {v}, {S.rnd('forecast', 4)} AS forecast, "
            f"{S.rnd('lo', 4)} AS lo, {S.rnd('hi', 4)} AS hi, coalesce({f}, false) AS is_anomaly, {a} AS anomaly_type")


def _ar_sql(prep: str, key: str, t: str, v: str, H: int, level: float, direction: str) -> str:
    z = Z[level]
    return f"""WITH {prep},
d AS (SELECT {key}, {t}, {v}, row_number() OVER (PARTITION BY {key} ORDER BY {t} DESC) - 1 AS rpos FROM fl),
tr AS (SELECT *, lag({v}, 1) OVER (PARTITION BY {key} ORDER BY {t}) AS x1 FROM d WHERE rpos >= {H}),
f0 AS (SELECT {key}, {_ols_sql(v, ['x1'], 'f_')} FROM tr WHERE {v} IS NOT NULL AND x1 IS NOT NULL GROUP BY 1),
f1 AS (SELECT *, {_ols_solve_sql(1, 'f_')} FROM f0),
fit AS (SELECT f1.*, sqrt(f_sse / (f_n - 2)) AS sig, l.yT FROM f1
        JOIN (SELECT {key}, arg_max({v}, {t}) AS yT FROM tr GROUP BY 1) l USING ({key})),
te AS (SELECT d.{key}, d.{t}, {H} - d.rpos AS step, d.{v}, fit.* EXCLUDE ({key}) FROM d JOIN fit USING ({key})
       WHERE d.rpos < {H}),
fc AS (SELECT *, f_c * {_geo_sql('f_b1', 'step')} + pow(f_b1, step) * yT AS forecast,
              pow(sig, 2) * {_geo_sql('f_b1 * f_b1', 'step')} AS var FROM te),
b AS (SELECT *, forecast - {z} * sqrt(var) AS lo, forecast + {z} * sqrt(var) AS hi FROM fc)
{_fc_out(key, t, v, direction, 'step, ')} FROM b"""


@register("ar_forecast_detect", _ar_sql(_filled_sql("SELECT * FROM events", "event_type", "ts", "value", _HOUR_US,
                                                    "interpolate"), "event_type", "ts", "value", 24, 0.99, "both"))
def q_ar_forecast_detect(spark, sf_dir):
    from tidewatch.operators.forecast import ar_forecast_detect
    ev = S.table(spark, sf_dir, "events")
    d = ar_forecast_detect(ev, "event_type", "ts", "value", horizon=24, level=0.99, direction="both",
                           freq="1 hour", fill_method="interpolate")
    return d.select("event_type", "ts", "step", r("value"), r("forecast", 4), r("lo", 4), r("hi", 4),
                    "is_anomaly", "anomaly_type")


_FLAT = "CASE WHEN event_type = 'click' THEN 5.0 ELSE value END"


@register("forecast_degenerate", _ar_sql(_filled_sql(f"SELECT * REPLACE ({_FLAT} AS value) FROM events", "event_type",
                                                     "ts", "value", _HOUR_US, "interpolate"),
                                         "event_type", "ts", "value", 24, 0.99, "both"))
def q_forecast_degenerate(spark, sf_dir):
    """One series made constant beside normal ones: null forecasts for it."""
    from tidewatch.operators.forecast import ar_forecast_detect
    ev = S.table(spark, sf_dir, "events").withColumn("value", F.expr(_FLAT))
    d = ar_forecast_detect(ev, "event_type", "ts", "value", horizon=24, level=0.99, direction="both",
                           freq="1 hour", fill_method="interpolate")
    return d.select("event_type", "ts", "step", r("value"), r("forecast", 4), r("lo", 4), r("hi", 4),
                    "is_anomaly", "anomaly_type")


def _arima111_sql(src: str, key: str, t: str, v: str, H: int, level: float, direction: str) -> str:
    z = Z[level]
    w = f"PARTITION BY {key} ORDER BY {t}"
    step_fc = f"h_c * {_geo_sql('h_b1', 'i - 1')} + pow(h_b1, i - 1) * (h_c + h_b1 * wT + h_b2 * eT)"
    step_psi = f"pow(1 + (h_b1 + h_b2) * {_geo_sql('h_b1', 'i')}, 2)"
    return f"""WITH d AS (SELECT {key}, {t}, {v}, row_number() OVER (PARTITION BY {key} ORDER BY {t} DESC) - 1 AS rpos
           FROM ({src}) q),
l AS (SELECT *, lag({v}, 1) OVER ({w}) AS l1, lag({v}, 2) OVER ({w}) AS l2, lag({v}, 3) OVER ({w}) AS l3
      FROM d WHERE rpos >= {H}),
tr AS (SELECT *, {v} - l1 AS w, l1 - l2 AS x1, l2 - l3 AS x2 FROM l),
s10 AS (SELECT {key}, {_ols_sql('w', ['x1', 'x2'], 'a_')} FROM tr
        WHERE w IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL GROUP BY 1),
s1 AS (SELECT *, {_ols_solve_sql(2, 'a_')} FROM s10),
e AS (SELECT tr.*, tr.w - s1.a_c - s1.a_b1 * tr.x1 - s1.a_b2 * tr.x2 AS e FROM tr JOIN s1 USING ({key})),
e1 AS (SELECT *, lag(e, 1) OVER ({w}) AS e1 FROM e),
s20 AS (SELECT {key}, {_ols_sql('w', ['x1', 'e1'], 'h_')} FROM e1
        WHERE w IS NOT NULL AND x1 IS NOT NULL AND e1 IS NOT NULL GROUP BY 1),
s2 AS (SELECT *, {_ols_solve_sql(2, 'h_')} FROM s20),
fit AS (SELECT s2.*, sqrt(h_sse / (h_n - 3)) AS sig, z.wT, z.eT, z.yT FROM s2
        JOIN (SELECT {key}, arg_max(w, {t}) AS wT, arg_max(e, {t}) AS eT, arg_max({v}, {t}) AS yT
              FROM e1 GROUP BY 1) z USING ({key})),
te AS (SELECT d.{key}, d.{t}, {H} - d.rpos AS step, d.{v}, fit.* EXCLUDE ({key}) FROM d JOIN fit USING ({key})
       WHERE d.rpos < {H}),
un AS (SELECT {key}, {t}, unnest(range(1, step + 1)) AS i, h_c, h_b1, h_b2, wT, eT FROM te),
cum AS (SELECT {key}, {t}, sum({step_fc}) AS up FROM un GROUP BY ALL),
pi AS (SELECT {key}, {t}, sum({step_psi}) AS wide FROM (SELECT * REPLACE (i - 1 AS i) FROM un) q GROUP BY ALL),
fc AS (SELECT te.*, yT + up AS forecast, pow(sig, 2) * wide AS var FROM te JOIN cum USING ({key}, {t}) JOIN pi USING ({key}, {t})),
b AS (SELECT *, forecast - {z} * sqrt(var) AS lo, forecast + {z} * sqrt(var) AS hi FROM fc)
{_fc_out(key, t, v, direction, 'step, ')} FROM b"""


def _arma_sql(prep: str, key: str, t: str, v: str, H: int, level: float, direction: str) -> str:
    z = Z[level]
    w = f"PARTITION BY {key} ORDER BY {t}"
    return f"""WITH {prep},
d AS (SELECT {key}, {t}, {v}, row_number() OVER (PARTITION BY {key} ORDER BY {t} DESC) - 1 AS rpos FROM fl),
tr AS (SELECT *, lag({v}, 1) OVER ({w}) AS x1, lag({v}, 2) OVER ({w}) AS x2 FROM d WHERE rpos >= {H}),
s10 AS (SELECT {key}, {_ols_sql(v, ['x1', 'x2'], 'a_')} FROM tr
        WHERE {v} IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL GROUP BY 1),
s1 AS (SELECT *, {_ols_solve_sql(2, 'a_')} FROM s10),
e AS (SELECT tr.*, tr.{v} - s1.a_c - s1.a_b1 * tr.x1 - s1.a_b2 * tr.x2 AS e FROM tr JOIN s1 USING ({key})),
e1 AS (SELECT *, lag(e, 1) OVER ({w}) AS e1 FROM e),
s20 AS (SELECT {key}, {_ols_sql(v, ['x1', 'e1'], 'h_')} FROM e1
        WHERE {v} IS NOT NULL AND x1 IS NOT NULL AND e1 IS NOT NULL GROUP BY 1),
s2 AS (SELECT *, {_ols_solve_sql(2, 'h_')} FROM s20),
fit AS (SELECT s2.*, sqrt(h_sse / (h_n - 3)) AS sig, l.yT, l.eT FROM s2
        JOIN (SELECT {key}, arg_max({v}, {t}) AS yT, arg_max(e, {t}) AS eT FROM e1 GROUP BY 1) l USING ({key})),
te AS (SELECT d.{key}, d.{t}, {H} - d.rpos AS step, d.{v}, fit.* EXCLUDE ({key}) FROM d JOIN fit USING ({key})
       WHERE d.rpos < {H}),
fc AS (SELECT *, h_c * {_geo_sql('h_b1', 'step - 1')} + pow(h_b1, step - 1) * (h_c + h_b1 * yT + h_b2 * eT) AS forecast,
              pow(sig, 2) * (1 + pow(h_b1 + h_b2, 2) * {_geo_sql('h_b1 * h_b1', 'step - 1')}) AS var FROM te),
b AS (SELECT *, forecast - {z} * sqrt(var) AS lo, forecast + {z} * sqrt(var) AS hi FROM fc)
{_fc_out(key, t, v, direction, 'step, ')} FROM b"""


@register("arma11_forecast_detect", _arma_sql(_filled_sql("SELECT * FROM events", "event_type", "ts", "value",
                                                          _HOUR_US, "ffill"), "event_type", "ts", "value", 12, 0.95,
                                              "both"))
def q_arma11_forecast_detect(spark, sf_dir):
    from tidewatch.operators.forecast import arma11_forecast_detect
    ev = S.table(spark, sf_dir, "events")
    d = arma11_forecast_detect(ev, "event_type", "ts", "value", horizon=12, level=0.95, direction="both",
                               freq="1 hour", fill_method="ffill")
    return d.select("event_type", "ts", "step", r("value"), r("forecast", 4), r("lo", 4), r("hi", 4),
                    "is_anomaly", "anomaly_type")


@register("arima111_forecast_detect", _arima111_sql(S.L_SQL, "l_suppkey", "l_shipdate", "avg_qty", 4, 0.95, "both"))
def q_arima111_forecast_detect(spark, sf_dir):
    from tidewatch.operators.forecast import arma11_forecast_detect
    l = S.supplier_daily(spark, sf_dir)
    d = arma11_forecast_detect(l, "l_suppkey", "l_shipdate", "avg_qty", horizon=4, level=0.95, direction="both",
                               differences=1)
    return d.select("l_suppkey", "l_shipdate", "step", r("avg_qty"), r("forecast", 4), r("lo", 4), r("hi", 4),
                    "is_anomaly", "anomaly_type")


def _auto_sql(prep: str, key: str, t: str, v: str, level: float, direction: str) -> str:
    z = Z[level]
    candidates = [(0, 0), (1, 0), (2, 0), (0, 1), (1, 1), (2, 1)]       # (p, d)
    w = f"PARTITION BY {key} ORDER BY {t}"
    targets = {0: (v, ["y1", "y2"]), 1: ("d0", ["d1", "d2"])}
    aggs = ", ".join(_ols_sql(targets[dd][0], targets[dd][1][:p], f"c{p}{dd}_") for p, dd in candidates)
    solves = ", ".join(_ols_solve_sql(p, f"c{p}{dd}_") for p, dd in candidates)
    rows = " UNION ALL ".join(
        f"SELECT {key}, {dd} AS d, {p} AS p, c{p}{dd}_n AS n, c{p}{dd}_c AS c, {f'c{p}{dd}_b1' if p >= 1 else '0.0::DOUBLE'} AS b1, "
        f"{f'c{p}{dd}_b2' if p >= 2 else '0.0::DOUBLE'} AS b2, c{p}{dd}_sse AS sse FROM f1" for p, dd in candidates)
    aicc = "n * ln(sse / n) + 2 * (p + 2) + 2.0 * (p + 2) * (p + 3) / (n - p - 3)"
    return f"""WITH {prep},
d AS MATERIALIZED (SELECT {key}, {t}, {v}, row_number() OVER (PARTITION BY {key} ORDER BY {t} DESC) - 1 AS rpos
      FROM fl WHERE {v} IS NOT NULL),
tr AS MATERIALIZED (SELECT *, lag({v}, 1) OVER ({w}) AS y1, lag({v}, 2) OVER ({w}) AS y2, lag({v}, 3) OVER ({w}) AS y3
       FROM d WHERE rpos >= 1),
cs AS (SELECT *, {v} - y1 AS d0, y1 - y2 AS d1, y2 - y3 AS d2 FROM tr WHERE y3 IS NOT NULL),
f0 AS MATERIALIZED (SELECT {key}, {aggs} FROM cs GROUP BY 1),
f1 AS MATERIALIZED (SELECT *, {solves} FROM f0),
cd AS MATERIALIZED (SELECT *, {aicc} AS aicc FROM ({rows}) WHERE n + 3 >= 10),
f2 AS MATERIALIZED (SELECT *, sqrt(sse / (n - p - 1)) AS sigma FROM cd WHERE NOT isnan(aicc)
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY aicc, d, p) = 1),
lt AS (SELECT {key}, arg_max({v}, {t}) AS l1, arg_max(y1, {t}) AS l2, arg_max(y2, {t}) AS l3 FROM tr GROUP BY 1),
te AS (SELECT d.{key}, d.{t}, d.{v}, f2.* EXCLUDE ({key}), lt.l1, lt.l2, lt.l3 FROM d JOIN f2 USING ({key}) JOIN lt USING ({key})
       WHERE d.rpos < 1),
fc AS (SELECT *, CASE WHEN d = 0 THEN c + b1 * l1 + b2 * l2 ELSE l1 + c + b1 * (l1 - l2) + b2 * (l2 - l3) END AS forecast FROM te),
b AS (SELECT *, forecast - {z} * sigma AS lo, forecast + {z} * sigma AS hi FROM fc)
{_fc_out(key, t, v, direction, 'p, d, ')} FROM b"""


_L_DAILY_US = 86_400_000_000


_L_FILLED = f"""src AS MATERIALIZED ({S.L_SQL}),
{_filled_sql('FROM src', 'l_suppkey', 'l_shipdate', 'sum_price', _L_DAILY_US, 'zero')}"""


@register("auto_ar_detect", _auto_sql(_L_FILLED, "l_suppkey", "l_shipdate", "sum_price", 0.99, "low"))
def q_auto_ar_detect(spark, sf_dir):
    from tidewatch.operators.forecast import auto_ar_detect
    l = S.supplier_daily(spark, sf_dir)
    d = auto_ar_detect(l, "l_suppkey", "l_shipdate", "sum_price", level=0.99, direction="low", freq="1 day",
                       fill_method="zero")
    return d.select("l_suppkey", "l_shipdate", F.col("p").cast("int").alias("p"), F.col("d").cast("int").alias("d"),
                    r("sum_price"), r("forecast", 4), r("lo", 4), r("hi", 4), "is_anomaly", "anomaly_type")


# ---------------------------------------------------------------------------
# ensembles and run metrics
# ---------------------------------------------------------------------------
_ENS_PARAMS = {"bandwidth": 0.5, "filter_percentile": 99, "threshold_percentile": 95,
               "anomaly_direction": "both", "window": 100, "no_of_stds": 2.0, "recent_window_size": "all",
               "arima_level": 0.95, "arima_horizon": 1}


def _ens_parts_sql(v: str = "avg_qty") -> dict:
    kde = _kde_sql(S.L_SQL, "l_suppkey", "l_shipdate DESC", v, 0.5, "all", "all", 99, 95, "both",
                   "l_suppkey, l_shipdate", f"a.l_suppkey, a.l_shipdate, a.{v}")
    ewma = _ewma_l_sql(v, 100, 2.0, "both", 4)
    arma = _arma_sql(f"fl AS (SELECT l_suppkey, l_shipdate, {v} FROM ({S.L_SQL}) q)", "l_suppkey",
                     "l_shipdate", v, 1, 0.95, "both")
    return {"kde": f"SELECT l_suppkey, l_shipdate FROM ({kde}) t",
            "ewma": f"SELECT l_suppkey, l_shipdate FROM ({ewma}) t",
            "arma": f"SELECT l_suppkey, l_shipdate FROM ({arma}) t WHERE is_anomaly"}


def _ens_sql(dets, need: int, select: str | None = None, group: str = "", v: str = "avg_qty") -> str:
    parts = _ens_parts_sql(v)
    ctes = ",\n".join(f"{d} AS ({parts[d]})" for d in dets)
    joins = "\n".join(f"LEFT JOIN {d} ON {d}.l_suppkey = s.l_suppkey AND {d}.l_shipdate = s.l_shipdate"
                      for d in dets)
    votes = " + ".join(f"CASE WHEN {d}.l_suppkey IS NOT NULL THEN 1 ELSE 0 END" for d in dets)
    flags = ", ".join(f"{d}.l_suppkey IS NOT NULL AS is_outlier_{d}" for d in dets)
    sel = select or f"s.l_suppkey, s.l_shipdate, s.{v}, {flags}"
    return f"""WITH s AS ({S.L_SQL}),
{ctes}
SELECT {sel} FROM s
{joins}
WHERE {votes} >= {need} {group}"""


def _ens(spark, sf_dir, dets, rule):
    from tidewatch.operators.ensemble import ensemble
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    return ensemble(l, "l_suppkey", "l_shipdate", "avg_qty", detectors=dets, rule=rule, params=_ENS_PARAMS)


@register("ensemble_any", _ens_sql(["kde", "ewma"], 1))
def q_ensemble_any(spark, sf_dir):
    return _ens(spark, sf_dir, ["kde", "ewma"], "any")


@register("ensemble_all", _ens_sql(["kde", "ewma"], 2))
def q_ensemble_all(spark, sf_dir):
    return _ens(spark, sf_dir, ["kde", "ewma"], "all")


@register("ensemble_kde_ewma_arma", _ens_sql(["kde", "ewma", "arma"], 1))
def q_ensemble_kde_ewma_arma(spark, sf_dir):
    return _ens(spark, sf_dir, ["kde", "ewma", "arma"], "any")


def _ens_runtime_sql() -> str:
    src = S.L_SQL
    kde = _kde_sql(src, "l_suppkey", "l_shipdate DESC", "avg_qty", 0.5, "all", ("tail", 1), 99, 80, "both",
                   "l_suppkey, l_shipdate", "a.l_suppkey, a.l_shipdate, a.avg_qty")
    ewma = _ewma_l_sql("avg_qty", 100, 1.0, "both", 4)
    return f"""WITH s AS ({src}), newest AS (SELECT l_suppkey, max(l_shipdate) AS l_shipdate, count(*) AS n FROM s GROUP BY 1),
kde AS ({kde}), ewma AS ({ewma})
SELECT s.l_suppkey, s.l_shipdate, s.avg_qty, kde.l_suppkey IS NOT NULL AS is_outlier_kde,
       ewma.l_suppkey IS NOT NULL AS is_outlier_ewma
FROM s JOIN newest ON newest.l_suppkey = s.l_suppkey AND newest.l_shipdate = s.l_shipdate
LEFT JOIN kde ON kde.l_suppkey = s.l_suppkey AND kde.l_shipdate = s.l_shipdate
LEFT JOIN ewma ON ewma.l_suppkey = s.l_suppkey AND ewma.l_shipdate = s.l_shipdate
WHERE newest.n >= 10 AND (kde.l_suppkey IS NOT NULL OR ewma.l_suppkey IS NOT NULL)"""


@register("ensemble_runtime", _ens_runtime_sql())
def q_ensemble_runtime(spark, sf_dir):
    from tidewatch.operators.ensemble import ensemble_runtime
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    return ensemble_runtime(l, "l_suppkey", "l_shipdate", "avg_qty",
                            params={"no_of_stds": 1.0, "threshold_percentile": 80, "anomaly_direction": "both"})


def _run_metrics_sql() -> str:
    import json
    params = json.dumps(_ENS_PARAMS, sort_keys=True, default=str).replace("'", "''")
    inner = _ens_sql(["kde", "ewma"], 1)
    return f"""WITH a AS ({inner}),
n AS (SELECT l_suppkey, count(*) AS n_points FROM ({S.L_SQL}) q GROUP BY 1),
c AS (SELECT l_suppkey, CAST(count_if(is_outlier_kde) AS BIGINT) AS anomalies_kde,
             CAST(count_if(is_outlier_ewma) AS BIGINT) AS anomalies_ewma,
             count(*) AS anomalies_detected FROM a GROUP BY 1)
SELECT n.l_suppkey, n.n_points, coalesce(c.anomalies_kde, 0) AS anomalies_kde,
       coalesce(c.anomalies_ewma, 0) AS anomalies_ewma, coalesce(c.anomalies_detected, 0) AS anomalies_detected,
       '{params}' AS params, 'r1' AS run_id, CAST(NULL AS VARCHAR) AS error
FROM n LEFT JOIN c ON n.l_suppkey = c.l_suppkey"""


@register("run_metrics", _run_metrics_sql())
def q_run_metrics(spark, sf_dir):
    from tidewatch.operators.ensemble import run_metrics
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    an = _ens(spark, sf_dir, ["kde", "ewma"], "any")
    return run_metrics(l, an, "l_suppkey", detectors=["kde", "ewma"], params=_ENS_PARAMS, run_id="r1")


# ---------------------------------------------------------------------------
# slices -> vectors, reconstruction model, score reports
# ---------------------------------------------------------------------------

def _slice_sql(src: str, key: str, order: str, cols: str, L: int, Sh: int, t: str) -> str:
    return f"""u AS (SELECT {cols}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM ({src}) q),
n AS (SELECT {key}, max(rn) AS N FROM u GROUP BY {key} HAVING max(rn) >= {L}),
st AS (SELECT {key}, unnest(generate_series(1, N - {L} + 1, {Sh})) AS s FROM n),
j AS (SELECT u.*, st.s FROM u JOIN st USING ({key}) WHERE u.rn >= st.s AND u.rn < st.s + {L}),
sl AS (SELECT *, s - 1 AS slice_start,
       CAST({key} AS VARCHAR) || '_' || strftime(min({t}) OVER (PARTITION BY {key}, s), '%Y%m%d%H%M%S') AS series_id
       FROM j)"""


_LV = f"""{_slice_sql(S.L_SQL, 'l_suppkey', 'l_shipdate', 'l_suppkey, l_shipdate, avg_qty', 24, 12, 'l_shipdate')},
vec AS (SELECT l_suppkey, slice_start, series_id, list(avg_qty ORDER BY l_shipdate) AS x
        FROM sl GROUP BY l_suppkey, slice_start, series_id)"""


def _l_vectors(spark, sf_dir):
    from tidewatch.operators.reshape import slice_vectors
    l = S.supplier_daily(spark, sf_dir)
    return slice_vectors(l, "l_suppkey", "l_shipdate", "avg_qty", 24, 12)


@register("slices_to_vectors", f"WITH {_LV} SELECT * FROM vec")
def q_slices_to_vectors(spark, sf_dir):
    return _l_vectors(spark, sf_dir)


@register("slices_collected", f"WITH {_LV} SELECT * FROM vec")
def q_slices_collected(spark, sf_dir):
    """Vectors from exploded slices, for slices that exist only as rows."""
    from tidewatch.operators.recon import slices_to_vectors
    from tidewatch.operators.reshape import slice_series
    l = S.supplier_daily(spark, sf_dir).select("l_suppkey", "l_shipdate", "avg_qty")
    sl = slice_series(l, "l_suppkey", "l_shipdate", 24, 12)
    return slices_to_vectors(sl, "l_suppkey", "l_shipdate", "avg_qty", length=24)


def _recon_scores(spark, sf_dir):
    from tidewatch.operators.recon import ReconstructionModel
    from tidewatch.session import materialize
    v = materialize(_l_vectors(spark, sf_dir))  # fit and scoring both read the vectors
    model = ReconstructionModel.fit(v, "x", k=4, scaler="standard", threshold_percentile=99)
    return model.score(v, "x").select("l_suppkey", "slice_start", "series_id", "score", "threshold", "is_anomaly")


@register("score_slices")
def q_score_slices(spark, sf_dir):
    return _recon_scores(spark, sf_dir)


@register("slice_outliers")
def q_slice_outliers(spark, sf_dir):
    return _recon_scores(spark, sf_dir).filter("is_anomaly")


_GRAM_SQL = f"""{_LV},
flat AS (SELECT unnest(x) AS v FROM vec),
p AS (SELECT avg(v) AS mu, stddev_pop(v) AS sd FROM flat),
sx AS (SELECT list_transform(x, lambda v: (v - p.mu) / p.sd) AS x FROM vec, p),
ij AS (SELECT i, j FROM range(0, 24) a(i), range(0, 24) b(j) WHERE i <= j)"""


def _l_model(spark, sf_dir):
    from tidewatch.operators.recon import ReconstructionModel
    from tidewatch.session import materialize
    v = materialize(_l_vectors(spark, sf_dir))
    return v, ReconstructionModel.fit(v, "x", k=4, scaler="standard", threshold_percentile=99)


@register("recon_gram", f"""WITH {_GRAM_SQL}
SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {S.rnd('sum(x[i + 1] * x[j + 1])', 4)} AS g FROM sx, ij GROUP BY ALL""")
def q_recon_gram(spark, sf_dir):
    """Sufficient statistics of the reconstruction model (upper triangle)."""
    m = _l_model(spark, sf_dir)[1]
    g = spark.createDataFrame([(i, j, m.gram[i][j]) for i in range(m.d) for j in range(i, m.d)], "i int, j int, g double")
    return g.select("i", "j", r("g", 4))


_SEGMENT_SQL = f"""{_LV},
v AS (SELECT s.s_nationkey, vec.x FROM vec JOIN supplier s ON s.s_suppkey = vec.l_suppkey),
p AS (SELECT s_nationkey, avg(e) AS mu, stddev_pop(e) AS sd FROM (SELECT s_nationkey, unnest(x) AS e FROM v) q GROUP BY 1),
sx AS (SELECT s_nationkey, list_transform(x, lambda e: (e - p.mu) / p.sd) AS x FROM v JOIN p USING (s_nationkey)),
ij AS (SELECT i, j FROM range(0, 24) a(i), range(0, 24) b(j) WHERE i <= j)"""


def _segment_vectors(spark, sf_dir):
    sup = S.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return _l_vectors(spark, sf_dir).join(sup, "l_suppkey")


@register("recon_by_segment", f"""WITH {_SEGMENT_SQL}
SELECT s_nationkey, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, count(*) AS n, {S.rnd('sum(x[i + 1] * x[j + 1])', 4)} AS g
FROM sx, ij GROUP BY ALL""")
def q_recon_by_segment(spark, sf_dir):
    """Sufficient statistics of one reconstruction model per nation."""
    from tidewatch.operators.recon import KeyedModels
    from tidewatch.session import materialize
    sums, d = KeyedModels.sums(materialize(_segment_vectors(spark, sf_dir)), "s_nationkey")
    g = sums.select("s_nationkey", "n", F.posexplode("gram").alias("at", "g"))
    g = g.select("s_nationkey", F.floor(F.col("at") / d).cast("int").alias("i"), (F.col("at") % d).cast("int").alias("j"), "n", r("g", 4))
    return g.filter("i <= j")


@register("recon_segment_variance", f"""WITH {_SEGMENT_SQL},
mu AS (SELECT s_nationkey, i, avg(x[i + 1]) AS m FROM sx, range(0, 24) a(i) GROUP BY 1, 2)
SELECT s_nationkey, count(DISTINCT rowid) AS n, {S.rnd('sum(pow(x[i + 1] - m, 2))', 4)} AS total
FROM (SELECT *, row_number() OVER () AS rowid FROM sx) q JOIN mu USING (s_nationkey) GROUP BY 1""")
def q_recon_segment_variance(spark, sf_dir):
    """Per nation, residual variance plus the variance that its components
    capture is the total variance of its slices."""
    from tidewatch.operators.recon import KeyedModels
    from tidewatch.session import materialize
    v = materialize(_segment_vectors(spark, sf_dir))
    models = KeyedModels.fit(v, "s_nationkey", k=4)
    left = models.score(v).groupBy("s_nationkey").agg(F.count("score").alias("n"), F.sum(F.pow("score", F.lit(2.0))).alias("_res"))
    # captured: of a centred slice, the squared length less the residual's
    center = v.join(models.table, "s_nationkey")
    z = F.zip_with(F.transform("x", lambda e: (e - F.col("center")) / F.col("scale")), "mean", lambda a, b: a - b)
    caught = F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.lit(0.0), lambda acc, c: acc + F.pow(F.aggregate(
        F.zip_with("_z", F.slice("components", c * 24 + 1, 24), lambda a, b: a * b), F.lit(0.0), lambda s, e: s + e), F.lit(2.0)))
    got = center.withColumn("_z", z).groupBy("s_nationkey").agg(F.sum(caught).alias("_got"))
    return left.join(got, "s_nationkey").select("s_nationkey", "n", F.round(F.col("_res") + F.col("_got"), 4).alias("total"))


@register("recon_variance", f"""WITH {_GRAM_SQL},
mu AS (SELECT i, avg(x[i + 1]) AS m FROM sx, range(0, 24) a(i) GROUP BY i)
SELECT (SELECT count(*) FROM sx) AS n, {S.rnd('sum(pow(x[i + 1] - m, 2))', 4)} AS total
FROM sx JOIN mu ON true""")
def q_recon_variance(spark, sf_dir):
    """Residual variance plus the variance the components capture is the
    total variance of the slices."""
    import numpy as np
    v, m = _l_model(spark, sf_dir)
    mu, c = np.array(m.mean), np.array(m.components)
    caught = float(np.trace(c @ (np.array(m.gram) - m.n * np.outer(mu, mu)) @ c.T))
    total = F.sum(F.pow("score", F.lit(2.0))) + F.lit(caught)
    return m.score(v).agg(F.count(F.lit(1)).alias("n"), F.round(total, 4).alias("total"))


@register("split_slices", f"""WITH {_LV}
SELECT l_suppkey, slice_start, series_id,
       CAST(CAST('0x' || substr(md5('split' || chr(31) || l_suppkey), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 < 0.2
       AS is_validation FROM vec""")
def q_split_slices(spark, sf_dir):
    from tidewatch.operators.recon import split_slices
    return split_slices(_l_vectors(spark, sf_dir).drop("x"), "l_suppkey", 0.2)


_DEV = ("sqrt(list_reduce(list_transform(x, lambda v: (v - list_reduce(x, lambda a, b: a + b) / len(x)) * "
        "(v - list_reduce(x, lambda a, b: a + b) / len(x))), lambda a, b: a + b))")
_SC = f"""{_LV},
sc AS (SELECT *, {_DEV} AS score FROM vec),
th AS (SELECT quantile_cont(score, 0.99) AS threshold FROM sc),
fl AS (SELECT sc.*, th.threshold, sc.score > th.threshold AS is_outlier FROM sc, th)"""


def _dev_scores(spark, sf_dir):
    from tidewatch.operators.report import slice_dev_score
    return slice_dev_score(_l_vectors(spark, sf_dir))


@register("score_summary", f"""WITH {_SC}
SELECT {S.rnd('any_value(threshold)', 6)} AS threshold, {S.rnd('avg(score)', 6)} AS mean,
       {S.rnd('stddev_pop(score)', 6)} AS std, count(*) AS n, CAST(count_if(is_outlier) AS BIGINT) AS n_anomalies
FROM fl""")
def q_score_summary(spark, sf_dir):
    from tidewatch.operators.report import score_summary
    d = score_summary(_dev_scores(spark, sf_dir), 99)
    return d.select(r("threshold"), r("mean"), r("std"), "n", "n_anomalies")


@register("score_histogram", f"""WITH {_SC},
mm AS (SELECT min(score) AS mn, max(score) AS mx FROM sc),
b AS (SELECT CAST(coalesce(least(floor((score - mn) / (mx - mn) * 30), 29), 0) AS INTEGER) AS bin, mn, mx
      FROM sc, mm)
SELECT bin, {S.rnd('any_value(mn) + bin * ((any_value(mx) - any_value(mn)) / 30)', 6)} AS lo,
       {S.rnd('any_value(mn) + (bin + 1) * ((any_value(mx) - any_value(mn)) / 30)', 6)} AS hi, count(*) AS count
FROM b GROUP BY bin""")
def q_score_histogram(spark, sf_dir):
    from tidewatch.operators.report import score_histogram
    return score_histogram(_dev_scores(spark, sf_dir), 30).select("bin", r("lo"), r("hi"), "count")


@register("slice_profile", f"""WITH {_SC},
e AS (SELECT is_outlier, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM fl)
SELECT is_outlier, CAST(pos AS INTEGER) AS pos, {S.rnd('avg(v)', 6)} AS mean, {S.rnd('stddev_pop(v)', 6)} AS std,
       {S.rnd('quantile_cont(v, 0.1)', 6)} AS p10, {S.rnd('quantile_cont(v, 0.9)', 6)} AS p90, count(*) AS n
FROM e GROUP BY is_outlier, pos""")
def q_slice_profile(spark, sf_dir):
    from tidewatch.operators.report import slice_profile, with_outlier_flag
    d = slice_profile(with_outlier_flag(_dev_scores(spark, sf_dir), 99))
    return d.select("is_outlier", "pos", r("mean"), r("std"), r("p10"), r("p90"), "n")


_HASH_SQL = "(l_suppkey * 7919 + slice_start * 104729) % 1000003"


@register("sample_slices", f"""WITH {_SC}
SELECT l_suppkey, slice_start, series_id, {S.rnd('score', 6)} AS score FROM fl WHERE NOT is_outlier
ORDER BY {_HASH_SQL}, l_suppkey, slice_start LIMIT 20""")
def q_sample_slices(spark, sf_dir):
    from tidewatch.operators.report import sample_slices, with_outlier_flag
    d = with_outlier_flag(_dev_scores(spark, sf_dir), 99)
    key = F.pmod(F.col("l_suppkey") * 7919 + F.col("slice_start") * 104729, F.lit(1000003))
    d = sample_slices(d, 20, [key, F.col("l_suppkey"), F.col("slice_start")], "is_outlier", False)
    return d.select("l_suppkey", "slice_start", "series_id", r("score"))


@register("select_by_score", f"""WITH {_SC}
SELECT l_suppkey, slice_start, series_id, {S.rnd('score', 6)} AS score FROM fl WHERE score > threshold""")
def q_select_by_score(spark, sf_dir):
    from tidewatch.operators.report import select_by_score, with_outlier_flag
    d = select_by_score(with_outlier_flag(_dev_scores(spark, sf_dir), 99), "abnormal")
    return d.select("l_suppkey", "slice_start", "series_id", r("score"))


@register("entity_of_slice", f"""WITH {_LV}
SELECT series_id, split_part(series_id, '_', 1) AS entity FROM vec""")
def q_entity_of_slice(spark, sf_dir):
    from tidewatch.functions.scalar import entity_of_slice
    return _l_vectors(spark, sf_dir).select("series_id", entity_of_slice("series_id").alias("entity"))


# ---------------------------------------------------------------------------
# granularity, two-stage detection, roll-up
# ---------------------------------------------------------------------------
_NATION_SQL = f"""SELECT s.s_nationkey AS s_nationkey, l.l_shipdate, {S.rnd('sum(l.sum_price)', 2)} AS sum_price
FROM ({S.L_SQL}) l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2"""


@register("detect_by_segment", _ewma_sql(_NATION_SQL, "s_nationkey", "l_shipdate", "sum_price", 100, 2.0, "both", 2))
def q_detect_by_segment(spark, sf_dir):
    from tidewatch.operators.report import segment_series
    from tidewatch.operators.ewma import ewma_detect
    l = S.supplier_daily(spark, sf_dir)
    sup = S.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = l.join(sup, l.l_suppkey == sup.s_suppkey)
    seg = segment_series(j, ["s_nationkey"], "l_shipdate", "sum_price").withColumn("sum_price", F.round("sum_price", 2))
    out = ewma_detect(seg, "s_nationkey", "l_shipdate", "sum_price", window=100, no_of_stds=2.0, direction="both")
    return out.select("s_nationkey", "l_shipdate", "sum_price", r("ema", 2), r("ucl", 2), r("lcl", 2))


_CAND_SQL = f"""SELECT * FROM ({S.L_SQL}) q WHERE l_suppkey IN (
  SELECT l_suppkey FROM ({_ewma_l_sql('sum_price', 100, 3.0, 'high', 2)}) c)"""


@register("two_stage_detect", _kde_sql(_CAND_SQL, "l_suppkey", "l_shipdate DESC", "avg_qty", 0.5, "all", "all", 99,
                                       95, "both",
                                       f"l_suppkey, l_shipdate, avg_qty, {S.rnd('density', 6)} AS density",
                                       "a.l_suppkey, a.l_shipdate, a.avg_qty"))
def q_two_stage_detect(spark, sf_dir):
    from tidewatch.operators.kde import kde_detect
    from tidewatch.operators.report import two_stage_detect
    l = S.supplier_daily(spark, sf_dir)

    def stage2(d):
        k = kde_detect(d.select("l_suppkey", "l_shipdate", "avg_qty"), "l_suppkey", "l_shipdate", "avg_qty",
                       bandwidth=0.5, filter_percentile=99, threshold_percentile=95, direction="both")
        return k.select("l_suppkey", "l_shipdate", "avg_qty", r("density"))
    return two_stage_detect(l, "l_suppkey", "l_shipdate", "sum_price",
                            stage1=dict(window=100, no_of_stds=3.0, direction="high"), stage2=stage2)


@register("anomaly_rollup", f"""WITH a AS ({_ewma_l_sql('sum_price', 100, 3.0, 'high', 2)}),
h AS (SELECT r.r_name, n.n_name, CAST(a.l_suppkey AS VARCHAR) AS l_suppkey FROM a JOIN supplier s ON a.l_suppkey = s.s_suppkey
      JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT r_name, n_name, l_suppkey, count(*) AS n_anomalies,
       CAST(3 - bit_count(CAST(GROUPING(r_name, n_name, l_suppkey) AS BIGINT)) AS INTEGER) AS level
FROM h GROUP BY ROLLUP (r_name, n_name, l_suppkey)""")
def q_anomaly_rollup(spark, sf_dir):
    from tidewatch.operators.report import anomaly_rollup
    a = q_ewma_detect_high(spark, sf_dir).select("l_suppkey")
    sup = S.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = S.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = S.table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    h = (a.join(sup, a.l_suppkey == sup.s_suppkey).join(nat, sup.s_nationkey == nat.n_nationkey)
          .join(reg, nat.n_regionkey == reg.r_regionkey)
          .select("r_name", "n_name", F.col("l_suppkey").cast("string").alias("l_suppkey")))
    return anomaly_rollup(h, ["r_name", "n_name", "l_suppkey"])


# ---------------------------------------------------------------------------
# streaming (file source over the events table, availableNow, Parquet sink)
# ---------------------------------------------------------------------------
_MX = "(SELECT max(ts) FROM events)"


def _events_stream(spark, sf_dir):
    from tidewatch.streaming.jobs import file_stream
    return file_stream(spark, sf_dir, "events")


@register("stream_bucket_avg", f"""SELECT event_type, date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {S.rnd('avg(value)', 6)} AS mean, count(*) AS n
FROM events GROUP BY 1, 2, 3 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_MX} - INTERVAL 1 HOUR""")
def q_stream_bucket_avg(spark, sf_dir):
    from tidewatch.streaming.jobs import run_available, stream_bucket_avg
    s = stream_bucket_avg(_events_stream(spark, sf_dir), "event_type", "ts", "value", window="1 hour",
                          delay="1 hour")
    return run_available(s, "bucket_avg").select("event_type", "window_start", "window_end", r("mean"), "n")


@register("stream_sliding_stats", f"""WITH e AS (SELECT event_type, value, date_trunc('hour', ts) AS h FROM events),
w AS (SELECT event_type, value, h - k * INTERVAL 1 HOUR AS window_start FROM e, range(0, 24) t(k))
SELECT event_type, window_start, window_start + INTERVAL 24 HOUR AS window_end, {S.rnd('avg(value)', 6)} AS mean,
       {S.rnd('stddev_samp(value)', 6)} AS std, count(*) AS n
FROM w GROUP BY 1, 2, 3 HAVING window_start + INTERVAL 24 HOUR <= {_MX} - INTERVAL 1 HOUR""")
def q_stream_sliding_stats(spark, sf_dir):
    from tidewatch.streaming.jobs import run_available, stream_sliding_stats
    s = stream_sliding_stats(_events_stream(spark, sf_dir), "event_type", "ts", "value")
    return run_available(s, "sliding").select("event_type", "window_start", "window_end", r("mean"), r("std"), "n")


@register("stream_dedup", "SELECT DISTINCT event_id, ts, user_id, event_type, value FROM events")
def q_stream_dedup(spark, sf_dir):
    from tidewatch.streaming.jobs import run_available, stream_dedup
    s = _events_stream(spark, sf_dir)
    s = s.unionByName(_events_stream(spark, sf_dir))
    d = run_available(stream_dedup(s, ["event_id"], "ts"), "dedup")
    return d.select("event_id", "ts", "user_id", "event_type", "value")


def _ewma_null_sql(src: str, key: str, t: str, v: str, window: int, k: float, cmp: str) -> str:
    """EWMA chart over series with missing values: a mean ``gap`` rows old
    weighs (1 - a)^gap, missing values repeat it."""
    a = alpha_sql(window)
    w = f"PARTITION BY {key} ORDER BY {t}"
    return f"""WITH RECURSIVE p AS MATERIALIZED (
  SELECT *, row_number() OVER ({w}) - 1 AS pos, lag({v}) OVER ({w}) AS target,
         CASE WHEN count({v}) OVER f = {window} THEN stddev_samp({v}) OVER f END AS sd
  FROM ({src}) s WINDOW f AS ({w} ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING)),
rec AS (
  SELECT {key}, pos, CAST(NULL AS DOUBLE) AS ema, 0 AS gap FROM p WHERE pos = 0
  UNION ALL
  SELECT p.{key}, p.pos, CASE WHEN p.target IS NULL THEN rec.ema WHEN rec.ema IS NULL THEN p.target
           ELSE (pow(1 - {a}, gap) * rec.ema + {a} * p.target) / (pow(1 - {a}, gap) + {a}) END,
         CASE WHEN p.target IS NULL THEN gap + 1 ELSE 1 END
  FROM rec JOIN p ON p.{key} = rec.{key} AND p.pos = rec.pos + 1),
f AS (SELECT p.*, rec.ema, CASE WHEN p.sd >= 0.01 * abs({v}) THEN p.sd ELSE 0.01 * abs({v}) END AS std
      FROM p JOIN rec USING ({key}, pos) WHERE rec.ema IS NOT NULL AND {v} IS NOT NULL),
g AS (SELECT *, ema + {k} * std AS ucl, ema - {k} * std AS lcl FROM f)
SELECT {key}, event_id, {v}, {S.rnd('ema', 6)} AS ema, {S.rnd('ucl', 6)} AS ucl, {S.rnd('lcl', 6)} AS lcl
FROM g WHERE ({cmp}) AND pos >= {window}"""


_GAPPED = "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END"


@register("stream_ewma_detect", _ewma_null_sql(f"SELECT user_id, ts, event_id, {_GAPPED} AS value FROM events", "user_id",
                                               "ts, event_id", "value", 20, 3.0, "value > ucl"))
def q_stream_ewma_detect(spark, sf_dir):
    """Events with missing values, arriving in four micro-batches by time."""
    from tidewatch.streaming.jobs import arrivals, rocksdb, run_available, stream_ewma_detect
    rocksdb(spark)
    ev = S.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.expr(_GAPPED).alias("value"))
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    cuts = [lo + (hi - lo) * i / 4 for i in range(1, 4)]
    bounds = [None, *cuts, None]
    parts = [(F.lit(True) if a is None else F.col("ts") > a) & (F.lit(True) if z is None else F.col("ts") <= z)
             for a, z in zip(bounds, bounds[1:])]
    s = arrivals(ev, parts, "ewma")
    d = run_available(stream_ewma_detect(s, "user_id", "ts", "value", tiebreak="event_id", window=20,
                                         no_of_stds=3.0, direction="high"), "ewma")
    return d.filter("is_outlier").select("user_id", "event_id", "value", r("ema"), r("ucl"), r("lcl"))


@register("stream_score_slices", f"""WITH {_LV},
v AS (SELECT *, l_suppkey % 4 AS part FROM vec),
p AS (SELECT avg(e) AS mu, stddev_pop(e) AS sd FROM (SELECT unnest(x) AS e FROM v WHERE part = 3) q),
z AS (SELECT l_suppkey, slice_start, part, list_transform(x, lambda e: (e - p.mu) / p.sd) AS x FROM v, p),
m AS (SELECT b.part, i, avg(z.x[i + 1]) AS m FROM z JOIN range(0, 3) b(part) ON z.part = 3 OR z.part < b.part, range(0, 24) a(i)
      GROUP BY b.part, i)
SELECT l_suppkey, slice_start, CAST(part + 1 AS INTEGER) AS model_version, {S.rnd('sum(pow(x[i + 1] - m, 2))', 4)} AS total
FROM z JOIN m USING (part) GROUP BY l_suppkey, slice_start, part""")
def q_stream_score_slices(spark, sf_dir):
    """Slices that arrive in three micro-batches, each scored by the model
    that learned from the batches before it: squared score plus the squared
    part that the model's components capture is the squared length."""
    from tidewatch.operators.recon import ReconstructionModel, load_model_version, model_versions, save_model_version
    from tidewatch.session import materialize
    from tidewatch.streaming.jobs import arrivals, run_folder, run_scoring
    v = materialize(_l_vectors(spark, sf_dir).select("l_suppkey", "slice_start", "x"))
    root = f"{run_folder(spark, 'slices')}/models"
    save_model_version(spark, ReconstructionModel.fit(v.filter("l_suppkey % 4 = 3"), "x", k=4), root)
    s = arrivals(v, [F.col("l_suppkey") % 4 == i for i in range(3)], "slices")
    got = run_scoring(s, root, "slices", learn=True)
    total = F.lit(None).cast("double")
    for n in model_versions(spark, root):
        m = load_model_version(spark, root, n)
        z = F.zip_with(F.transform("x", _scaled(m)), F.array(*[F.lit(a) for a in m.mean]), lambda a, b: a - b)
        caught = F.lit(0.0)
        for c in m.components:
            caught = caught + F.pow(F.aggregate(F.zip_with(z, F.array(*[F.lit(a) for a in c]), lambda a, b: a * b),
                                                F.lit(0.0), lambda s, e: s + e), F.lit(2.0))
        total = F.when(F.col("model_version") == n, F.pow("score", F.lit(2.0)) + caught).otherwise(total)
    return got.select("l_suppkey", "slice_start", "model_version", F.round(total, 4).alias("total"))


def _scaled(m):
    return lambda e: (e - F.lit(m.scale_center)) / F.lit(m.scale_div)


@register("stream_score", f"""WITH m AS (SELECT user_id, avg(value) AS mean, stddev_samp(value) AS std FROM events
                            GROUP BY user_id)
SELECT e.user_id, e.ts, e.event_id, e.value, {S.rnd('(e.value - m.mean) / m.std', 6)} AS z,
       coalesce(abs((e.value - m.mean) / m.std) > 2.5, false) AS is_anomaly
FROM events e LEFT JOIN m ON e.user_id = m.user_id""")
def q_stream_score(spark, sf_dir):
    from tidewatch.session import checkpoint_dir
    from tidewatch.streaming.jobs import fit_zscore_model, run_available, stream_score
    import uuid
    root = checkpoint_dir(spark)
    path = f"{root}/models/zscore/{uuid.uuid4().hex}"
    fit_zscore_model(S.table(spark, sf_dir, "events"), "user_id", "value").write.parquet(path)
    model = spark.read.parquet(path)
    s = stream_score(_events_stream(spark, sf_dir), model, "user_id", "value", k=2.5)
    d = run_available(s, "score")
    return d.select("user_id", "ts", "event_id", "value", r("z"), "is_anomaly")


@register("stream_sessions", f"""WITH a AS (
  SELECT user_id, ts, event_id, value,
         CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS brk
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM a),
s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n,
             sum(value) AS total FROM b GROUP BY user_id, sid)
SELECT user_id, session_start, session_end, n, {S.rnd('total', 6)} AS total FROM s
WHERE session_end <= {_MX} - INTERVAL 1 HOUR""")
def q_stream_sessions(spark, sf_dir):
    from tidewatch.streaming.jobs import run_available, stream_sessions
    s = stream_sessions(_events_stream(spark, sf_dir), "user_id", "ts", "value")
    return run_available(s, "sessions").select("user_id", "session_start", "session_end", "n", r("total"))


# ---------------------------------------------------------------------------
# end-to-end jobs (compositions of the operators above; rows-only checks,
# every step has its own oracle)
# ---------------------------------------------------------------------------

def _events_catalog():
    from tidewatch.functions.catalog import FeatureCatalog
    return FeatureCatalog(groups={"signal": ["value"], "counters": ["counter"]},
                          zero_is_missing=("value",), entity="sn", time="time")


def _raw_event_logs(spark, sf_dir):
    """Events plus a resetting counter, rendered as an all-text raw log."""
    from tidewatch.functions.scalar import epoch_us
    u = S.user_events_with_zeros(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value")
    c = S.user_counter(spark, sf_dir).select("user_id", "event_id", "counter")
    j = u.join(c, ["user_id", "event_id"])
    return j.select(F.col("user_id").cast("string").alias("sn"),
                    F.concat(F.lit('"'), F.col("event_type"), F.lit('"')).alias("mdn"),
                    F.floor(epoch_us("ts") / 1000).cast("string").alias("ts"),
                    F.col("value").cast("string").alias("value"),
                    F.col("counter").cast("string").alias("counter"))


_TIES = "time, counter, MDN, value"
_FILL = "OVER (PARTITION BY sn ORDER BY {by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register("preprocess_job", f"""WITH c AS ({S.U_COUNTER_SQL}), u AS ({S.U0_SQL}),
r AS (SELECT DISTINCT CAST(u.user_id AS VARCHAR) AS sn, event_type AS MDN, date_trunc('second', ts) AS time,
  {S.rnd('value', 2)} AS value, {S.rnd('counter', 2)} AS counter FROM u JOIN (SELECT user_id, event_id, counter FROM c) c USING (user_id, event_id)),
f AS (SELECT sn, MDN, time, counter, coalesce(last_value(nullif(value, 0) IGNORE NULLS) {_FILL.format(by=_TIES)},
  (SELECT avg(value) FROM r)) AS value FROM r),
h AS (SELECT sn, time, {S.rnd('avg(counter)', 2)} AS counter, first(MDN ORDER BY counter, MDN, value) AS MDN,
  first(value ORDER BY counter, MDN, value) AS value FROM f GROUP BY sn, time),
l AS (SELECT *, lag(counter, 1) OVER w AS x1, lag(counter, 2) OVER w AS x2, lag(counter, 3) OVER w AS x3
  FROM h WINDOW w AS (PARTITION BY sn ORDER BY time)),
i AS (SELECT *, CASE WHEN counter < x1 THEN coalesce(x1 - x2, 0.0) ELSE counter - x1 END AS inc,
  CASE WHEN x1 < x2 THEN coalesce(x2 - x3, 0.0) ELSE x1 - x2 END AS inc_prev FROM l),
g AS (SELECT sn, time, MDN, value, {S.rnd('CASE WHEN inc < 0 THEN inc_prev ELSE inc END', 2)} AS counter FROM i
  WHERE (CASE WHEN inc < 0 THEN inc_prev ELSE inc END) IS NOT NULL),
lg AS (SELECT sn, time, MDN, value, {S.rnd('ln(1 + greatest(counter, 0))', 2)} AS counter FROM g),
z AS (SELECT sn, time, MDN, value, last_value(nullif(counter, 0) IGNORE NULLS) {_FILL.format(by='time')} AS counter FROM lg),
{_slice_sql('SELECT * FROM z', 'sn', 'time', 'sn, time, MDN, value, counter', 20, 5, 'time').replace('u AS (', 'uu AS (', 1).replace('FROM u ', 'FROM uu ').replace('u.*', 'uu.*').replace('u.rn', 'uu.rn')}
SELECT sn, time, MDN, {S.rnd('value', 6)} AS value, counter, slice_start, series_id FROM sl""")
def q_preprocess_job(spark, sf_dir):
    from tidewatch.plans.jobs import preprocess_job
    d = preprocess_job(_raw_event_logs(spark, sf_dir), catalog=_events_catalog(), signal_groups=("signal",),
                       counter_groups=("counters",), slice_length=20, slice_shift=5, tiebreak=["counter", "MDN", "value"])
    return d.select("sn", "time", "MDN", r("value"), "counter", "slice_start", "series_id")


@register("detection_job", " UNION ALL ".join(f"""SELECT l_suppkey, '{v}' AS feature, l_shipdate, {v} AS value, is_outlier_kde, is_outlier_ewma
FROM ({_ens_sql(['kde', 'ewma'], 1, v=v)}) d_{v}""" for v in ("avg_qty", "avg_price")))
def q_detection_job(spark, sf_dir):
    from tidewatch.plans.jobs import detection_job
    l = S.supplier_daily(spark, sf_dir)
    anomalies, _ = detection_job(l, entity="l_suppkey", time="l_shipdate", features=["avg_qty", "avg_price"],
                                 params=_ENS_PARAMS)
    return anomalies


from tidewatch.plans import forecast_queries, ops_queries  # noqa: E402,F401  (they register their queries)
