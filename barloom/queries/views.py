"""Candle views of the driver tables, in Spark and in SQL.

`m1`: minute rows from `events` (symbol = event type).
`dm`: daily rows of the same symbols but one, so that both timeframes meet.
`d1`: daily rows from `orders` (symbol = priority), daily data only.
`candles`: the three together, with `timeframe`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.bars import delivery_percent

# Floating-point sums differ in the last bits between engines. Results are compared
# after rounding; the odd offset keeps exact halves away from the rounding edge.
OFFSET = 0.2345678


def settled(value: Column, digits: int = 6) -> Column:
    return F.round(value + F.lit(OFFSET / 10**digits), digits)


def sql_settled(value: str, digits: int = 6) -> str:
    return f"round({value} + CAST({OFFSET / 10**digits!r} AS DOUBLE), {digits})"


ROW = ["symbol", "timestamp", "open", "high", "low", "close", "volume", "delivery", "del_percent"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def m1(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    value, event = F.col("value"), F.col("event_id")
    close = value + (event % 7 - 3) / F.lit(20)
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("timestamp"),
        value.alias("open"),
        (F.greatest(value, close) + (event % 3) / F.lit(20)).alias("high"),
        (F.least(value, close) - (event % 2) / F.lit(20)).alias("low"),
        close.alias("close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.lit(None).cast("bigint").alias("delivery"),
        F.lit(None).cast("double").alias("del_percent"),
        "event_id",
    )
    return rows if with_id else rows.drop("event_id")


def dm(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.col("timestamp")
    return (
        m1(spark, sf_dir, with_id=True)
        .where(F.col("symbol") != "error")
        .groupBy("symbol", stamp.cast("date").cast("timestamp_ntz").alias("day"))
        .agg(
            F.min_by("open", stamp).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", stamp).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum(F.when(F.col("event_id") % 2 == 0, F.col("volume"))).alias("delivery"),
        )
        .withColumnRenamed("day", "timestamp")
        .withColumn("del_percent", delivery_percent(F.col("delivery"), F.col("volume")))
        .select(*ROW)
    )


def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("timestamp"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.sum("o_custkey").alias("volume"),
            F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("delivery"),
        )
        .withColumn("del_percent", delivery_percent(F.col("delivery"), F.col("volume")))
        .select(*ROW)
    )


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = d1(spark, sf_dir).unionByName(dm(spark, sf_dir)).withColumn("timeframe", F.lit("day"))
    return day.unionByName(m1(spark, sf_dir).withColumn("timeframe", F.lit("1m")))


M1 = """m1 AS (
  SELECT event_type AS symbol, ts AS timestamp, value AS open,
         greatest(value, value + (event_id % 7 - 3) / 20) + (event_id % 3) / 20 AS high,
         least(value, value + (event_id % 7 - 3) / 20) - (event_id % 2) / 20 AS low,
         value + (event_id % 7 - 3) / 20 AS close,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
         CAST(NULL AS BIGINT) AS delivery, CAST(NULL AS DOUBLE) AS del_percent, event_id
  FROM events)"""

PERCENT = """CASE WHEN volume > 0 AND delivery IS NOT NULL
       THEN CAST(delivery AS DOUBLE) * 100.0::DOUBLE / volume END AS del_percent"""

DM = f"""dm AS (
  SELECT *, {PERCENT} FROM (
    SELECT symbol, CAST(CAST(timestamp AS DATE) AS TIMESTAMP) AS timestamp,
           arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low,
           arg_max(close, timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume,
           CAST(sum(CASE WHEN event_id % 2 = 0 THEN volume END) AS BIGINT) AS delivery
    FROM m1 WHERE symbol <> 'error' GROUP BY 1, 2))"""

D1 = f"""d1 AS (
  SELECT *, {PERCENT} FROM (
    SELECT o_orderpriority AS symbol, o_orderdate AS timestamp,
           arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
           min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
           CAST(sum(o_custkey) AS BIGINT) AS volume,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS BIGINT) AS delivery
    FROM orders GROUP BY 1, 2))"""

CANDLES = """candles AS (
  SELECT symbol, 'day' AS timeframe, timestamp, open, high, low, close, volume, delivery, del_percent FROM d1
  UNION ALL
  SELECT symbol, 'day', timestamp, open, high, low, close, volume, delivery, del_percent FROM dm
  UNION ALL
  SELECT symbol, '1m', timestamp, open, high, low, close, volume, delivery, del_percent FROM m1)"""

WITH_M1 = f"WITH {M1}"
WITH_D1 = f"WITH {D1}"
WITH_CANDLES = f"WITH {M1}, {DM}, {D1}, {CANDLES}"

BUCKETS = {
    "1m": "date_trunc('minute', timestamp)",
    "5m": "time_bucket(INTERVAL '5 minutes', timestamp)",
    "15m": "time_bucket(INTERVAL '15 minutes', timestamp)",
    "Day": "CAST(date_trunc('day', timestamp) AS TIMESTAMP)",
    "Week": "CAST(date_trunc('week', timestamp) AS TIMESTAMP)",
    "Month": "CAST(date_trunc('month', timestamp) AS TIMESTAMP)",
    "Quarter": "CAST(date_trunc('quarter', timestamp) AS TIMESTAMP)",
    "Year": "CAST(date_trunc('year', timestamp) AS TIMESTAMP)",
}


def sql_bars(source: str, interval: str) -> str:
    """SQL for bars over rows of `source`, delivery known only if all rows have it."""
    return f"""SELECT *, {PERCENT} FROM (
  SELECT symbol, {BUCKETS[interval]} AS bucket, arg_min(open, timestamp) AS open,
         max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close,
         CAST(sum(volume) AS BIGINT) AS volume,
         CASE WHEN count(delivery) = count(*) THEN CAST(sum(delivery) AS BIGINT) END AS delivery
  FROM {source} GROUP BY 1, 2)"""


def sql_period(column: str, interval: str) -> str:
    return BUCKETS[interval].replace("timestamp)", f"{column})", 1)


def sql_roll_up(source: str, interval: str, time: str = "bucket") -> str:
    bucket = sql_period(time, interval)
    return f"""SELECT *, CASE WHEN volume <> 0 AND delivery IS NOT NULL
       THEN CAST(delivery AS DOUBLE) * 100.0::DOUBLE / volume END AS del_percent FROM (
  SELECT symbol, {bucket} AS bucket, first(open ORDER BY {time}) AS open, max(high) AS high,
         min(low) AS low, last(close ORDER BY {time}) AS close,
         CAST(sum(coalesce(volume, 0)) AS BIGINT) AS volume, CAST(sum(delivery) AS BIGINT) AS delivery
  FROM {source} GROUP BY symbol, {bucket})"""
