"""Series derived from the driver tables (see FIXTURES.md, F8).

* ``U`` — events per ``user_id`` ordered by ``(ts, event_id)``.
* ``E`` — hourly mean ``value`` per ``event_type``.
* ``L`` — daily lineitem measures per ``l_suppkey`` (wide, four features).

Each has a twin SQL text (``*_SQL``) for the DuckDB oracle, so the Spark
and SQL sides start from identical numbers.  Zeros, nulls and counter
resets are derived by formula in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def rnd(expr: str, d: int) -> str:
    """SQL rounding that matches Spark's ``round``: HALF_UP applied to the
    shortest decimal text of the double (DuckDB's ``round(double)`` rounds
    the binary value, which differs on ties such as 1.015)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)"


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- L: supplier-daily, wide --------------------------------------------
L_FEATURES = ["avg_qty", "avg_price", "avg_disc", "sum_price"]


def supplier_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_suppkey", "l_shipdate")
              .agg(F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
                   F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
                   F.round(F.avg("l_discount"), 4).alias("avg_disc"),
                   F.round(F.sum("l_extendedprice"), 2).alias("sum_price")))


L_SQL = f"""SELECT l_suppkey, l_shipdate,
       {rnd('avg(l_quantity)', 4)} AS avg_qty,
       {rnd('avg(l_extendedprice)', 4)} AS avg_price,
       {rnd('avg(l_discount)', 4)} AS avg_disc,
       {rnd('sum(l_extendedprice)', 2)} AS sum_price
FROM lineitem GROUP BY l_suppkey, l_shipdate"""


# ---- U: per-user event values -------------------------------------------
def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")


U_SQL = "SELECT user_id, ts, event_id, event_type, value FROM events"


def user_events_with_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U with every 7th event's value set to 0 (missing-as-zero fixture)."""
    ev = user_events(spark, sf_dir)
    return ev.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(0.0)).otherwise(F.col("value")))


U0_SQL = """SELECT user_id, ts, event_id, event_type,
       CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE value END AS value FROM events"""


def user_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cumulative counter per user with a reset every 11th event.

    counter = running sum of value within segments; a new segment starts
    at each event whose id is divisible by 11 (a device reboot).
    """
    from pyspark.sql import Window
    ev = user_events(spark, sf_dir)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seg = F.sum(F.when(F.col("event_id") % 11 == 0, 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, 0))
    ev = ev.withColumn("seg", seg)
    ws = Window.partitionBy("user_id", "seg").orderBy("ts", "event_id").rowsBetween(
        Window.unboundedPreceding, 0)
    return ev.select("user_id", "ts", "event_id",
                     F.round(F.sum("value").over(ws), 2).alias("counter"))


U_COUNTER_SQL = f"""WITH a AS (
  SELECT user_id, ts, event_id, value,
         sum(CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END)
           OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
  FROM events)
SELECT user_id, ts, event_id,
       {rnd("""sum(value) OVER (PARTITION BY user_id, seg ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", 2)} AS counter
FROM a"""


# ---- E: hourly mean per event type --------------------------------------
def type_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
              .agg(F.round(F.avg("value"), 4).alias("avg_value")))


E_SQL = f"""SELECT event_type, date_trunc('hour', ts) AS hour, {rnd('avg(value)', 4)} AS avg_value
FROM events GROUP BY event_type, date_trunc('hour', ts)"""
