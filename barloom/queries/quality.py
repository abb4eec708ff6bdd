"""Data-quality checks (QLT) over candles with some damage done to them."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.names import decode_symbol, symbol_group
from barloom.operators import quality as ops
from barloom.plans import changes
from barloom.queries import views as v
from barloom.queries.files import folder, stored
from barloom.queries.registry import query
from barloom.queries.relational import ACTIONS_SQL, sources
from barloom.sources import tables

# Minute rows and daily rows with known faults, keyed by the event or by the day.
DAMAGED_SQL = f"""{v.WITH_CANDLES}, damaged AS (
  SELECT '1m' AS timeframe, symbol, CASE WHEN event_id % 10 = 1 THEN date_trunc('hour', timestamp) ELSE timestamp END AS timestamp,
         open, CASE WHEN event_id % 11 = 0 THEN low - 1 ELSE high END AS high,
         CASE WHEN event_id % 13 = 0 THEN close + 1 ELSE low END AS low, close,
         CASE WHEN event_id % 17 = 0 THEN -volume - 1 ELSE volume END AS volume,
         CASE WHEN event_id % 19 = 0 THEN 5 END AS delivery, CAST(NULL AS DOUBLE) AS del_percent FROM m1
  UNION ALL
  SELECT 'day', symbol, timestamp, open, high, low, close, volume,
         CASE WHEN day(timestamp) = 3 THEN -delivery ELSE delivery END,
         CASE WHEN day(timestamp) = 5 THEN del_percent + 90 ELSE del_percent END FROM d1)"""

COLUMNS = ["timeframe", "symbol", "timestamp", "open", "high", "low", "close", "volume", "delivery", "del_percent"]
LIST = ", ".join(COLUMNS)


def damaged(spark, sf_dir):
    event = F.col("event_id")
    stamp = F.col("timestamp")
    hour = stamp.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(stamp))
    minutes = v.m1(spark, sf_dir, with_id=True).select(
        F.lit("1m").alias("timeframe"),
        "symbol",
        F.when(event % 10 == 1, hour).otherwise(stamp).alias("timestamp"),
        "open",
        F.when(event % 11 == 0, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        F.when(event % 13 == 0, F.col("close") + 1).otherwise(F.col("low")).alias("low"),
        "close",
        F.when(event % 17 == 0, -F.col("volume") - 1).otherwise(F.col("volume")).alias("volume"),
        F.when(event % 19 == 0, F.lit(5)).cast("bigint").alias("delivery"),
        F.lit(None).cast("double").alias("del_percent"),
    )
    day = F.dayofmonth("timestamp")
    days = (
        v.d1(spark, sf_dir)
        .withColumn("timeframe", F.lit("day"))
        .withColumn("delivery", F.when(day == 3, -F.col("delivery")).otherwise(F.col("delivery")))
        .withColumn("del_percent", F.when(day == 5, F.col("del_percent") + 90).otherwise(F.col("del_percent")))
    )
    return minutes.unionByName(days.select(*COLUMNS))


@query(
    "qlt01_schema_problems",
    """SELECT * FROM (VALUES ('del_percent', 'missing'), ('volume', 'type'), ('source', 'unexpected'), ('high', 'order'),
        ('low', 'order')) AS t(column_name, problem) WHERE (SELECT count(*) FROM events) > 0""",
)
def qlt01(spark, sf_dir):
    rows = v.m1(spark, sf_dir).select(
        "timestamp", "open", "low", "high", "close", F.col("volume").cast("int").alias("volume"), "delivery"
    )
    path = folder(spark, sf_dir, "qlt01")
    rows.withColumn("source", F.lit("x")).write.mode("overwrite").parquet(path)
    return ops.schema_problems(spark.read.parquet(path))


@query(
    "qlt02_duplicate_stamps",
    f"{DAMAGED_SQL} SELECT timeframe, symbol, timestamp, count(*) AS occurrences FROM damaged GROUP BY 1, 2, 3 HAVING count(*) > 1",
)
def qlt02(spark, sf_dir):
    return ops.duplicate_stamps(damaged(spark, sf_dir))


@query(
    "qlt03_ohlc_bounds",
    f"{DAMAGED_SQL} SELECT {LIST} FROM damaged WHERE high < greatest(open, low, close) OR low > least(open, high, close)",
)
def qlt03(spark, sf_dir):
    return ops.ohlc_violations(damaged(spark, sf_dir))


@query(
    "qlt04_delivery_bounds",
    f"{DAMAGED_SQL} SELECT {LIST} FROM damaged WHERE delivery < 0 OR del_percent < 0 OR del_percent > 100",
)
def qlt04(spark, sf_dir):
    return ops.delivery_violations(damaged(spark, sf_dir))


@query(
    "qlt05_minute_delivery",
    f"{DAMAGED_SQL} SELECT {LIST} FROM damaged WHERE timeframe = '1m' AND (delivery IS NOT NULL OR del_percent IS NOT NULL)",
)
def qlt05(spark, sf_dir):
    return ops.minute_delivery(damaged(spark, sf_dir))


@query("qlt06_negative_volume", f"{DAMAGED_SQL} SELECT {LIST} FROM damaged WHERE volume < 0")
def qlt06(spark, sf_dir):
    return ops.negative_volume(damaged(spark, sf_dir))


@query(
    "qlt07_timeframe_rows",
    f"{v.WITH_CANDLES} SELECT t.timeframe, count(c.symbol) AS rows FROM (VALUES ('day'), ('1m')) t(timeframe) LEFT JOIN candles c USING (timeframe) GROUP BY 1",
)
def qlt07(spark, sf_dir):
    return ops.timeframe_rows(v.candles(spark, sf_dir))


@query("qlt08_unexpected_files", "SELECT DISTINCT o_orderpriority AS stray FROM orders")
def qlt08(spark, sf_dir):
    """Text files, one folder per priority, left in the table's folder."""
    path = stored(spark, sf_dir, "qlt08")
    strays = v.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("stray"))
    strays.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("stray").csv(f"{path}/strays")
    found = ops.unexpected_files(tables.listing(spark, path))
    folder_name = F.regexp_extract("path", "/stray=([^/]+)/", 1)
    return found.select(decode_symbol(folder_name).alias("stray")).distinct()


@query("qlt09_outputs_exist", f"{v.WITH_CANDLES} SELECT count(*) AS rows, true AS has_files FROM candles")
def qlt09(spark, sf_dir):
    found = tables.totals(tables.inventory(spark, stored(spark, sf_dir, "qlt09")))
    return found.select("rows", (F.col("files") > 0).alias("has_files"))


@query(
    "qlt10_build_summary",
    f"""{v.WITH_CANDLES}, {ACTIONS_SQL} SELECT 'sources' AS metric, (SELECT count(*) FROM discovered) AS value
        UNION ALL SELECT 'equities', count(DISTINCT symbol) FROM candles WHERE timeframe = 'day'
        UNION ALL SELECT 'day_rows', count(*) FROM candles WHERE timeframe = 'day'
        UNION ALL SELECT 'minute_rows', count(*) FROM candles WHERE timeframe = '1m'
        UNION ALL SELECT 'files', count(*) FROM (SELECT DISTINCT timeframe, symbol FROM candles)""",
)
def qlt10(spark, sf_dir):
    rows = v.candles(spark, sf_dir)
    # One consumer file per symbol and timeframe; a large one is a folder of parts.
    outputs = rows.select(symbol_group(F.col("symbol")), "symbol", "timeframe").distinct()
    return ops.build_summary(rows, sources(spark, sf_dir)[0], outputs)


@query(
    "qlt11_percent_mismatch",
    f"""{DAMAGED_SQL} SELECT timeframe, symbol, timestamp, round(del_percent, 4) AS del_percent,
        round(CAST(delivery AS DOUBLE) * 100.0::DOUBLE / volume, 4) AS computed FROM damaged
        WHERE volume <> 0 AND abs(del_percent - CAST(delivery AS DOUBLE) * 100.0::DOUBLE / volume) > 0.01""",
)
def qlt11(spark, sf_dir):
    rows = ops.percent_mismatch(damaged(spark, sf_dir))
    rounded = [F.round(c, 4).alias(c) for c in ("del_percent", "computed")]
    return rows.select("timeframe", "symbol", "timestamp", *rounded)


@query(
    "qlt12_coverage",
    f"""{v.WITH_CANDLES} SELECT timeframe, symbol, CAST(min(timestamp) AS DATE) AS first_day, CAST(max(timestamp) AS DATE) AS last_day,
        count(DISTINCT CAST(timestamp AS DATE)) AS days FROM candles GROUP BY 1, 2""",
)
def qlt12(spark, sf_dir):
    return ops.coverage(v.candles(spark, sf_dir))


@query(
    "qlt12_missing_days",
    f"""{v.WITH_CANDLES}, days AS (SELECT DISTINCT timeframe, symbol, CAST(timestamp AS DATE) AS day FROM candles),
        spans AS (SELECT timeframe, symbol, min(day) AS a, max(day) AS b FROM days GROUP BY 1, 2),
        calendar AS (SELECT DISTINCT timeframe, day FROM days)
        SELECT s.timeframe, s.symbol, c.day FROM spans s JOIN calendar c ON c.timeframe = s.timeframe AND c.day BETWEEN s.a AND s.b
        WHERE NOT EXISTS (SELECT 1 FROM days d WHERE d.timeframe = s.timeframe AND d.symbol = s.symbol AND d.day = c.day)""",
)
def qlt12_missing(spark, sf_dir):
    return ops.missing_days(v.candles(spark, sf_dir))


@query(
    "qlt13_change_summary",
    f"""WITH {ACTIONS_SQL} SELECT kind, count(*) FILTER (action <> 'deleted') AS discovered, count(*) FILTER (action = 'processed') AS changed,
        count(*) FILTER (action = 'deleted') AS deleted, count(*) FILTER (action = 'cached') AS unchanged FROM actions GROUP BY 1""",
)
def qlt13(spark, sf_dir):
    return changes.summary(changes.classify(*sources(spark, sf_dir)))
