"""Filters (FLT), joins (JOIN), ordering (ORD) and sets (SET)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from barloom.functions import names
from barloom.functions.calendar import ntz
from barloom.functions.casts import lenient_bigint
from barloom.operators import bars as ops
from barloom.operators import sets
from barloom.plans import changes
from barloom.queries import views as v
from barloom.queries.registry import query
from barloom.schema import CANDLE_COLUMNS

SERIES_SQL = """raw AS (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN ' EQ' WHEN 1 THEN 'eq ' WHEN 2 THEN ' BE' ELSE 'EQ' END AS series,
         CASE WHEN o_orderkey % 50 = 0 THEN '  ' ELSE ' ' || o_orderpriority END AS symbol,
         CASE o_orderkey % 5 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN '1,000' ELSE CAST(o_custkey AS VARCHAR) END AS quantity
  FROM orders)"""


def raw_orders(spark, sf_dir):
    key = F.col("o_orderkey")
    series = (
        F.when(key % 4 == 0, F.lit(" EQ")).when(key % 4 == 1, F.lit("eq ")).when(key % 4 == 2, F.lit(" BE")).otherwise("EQ")
    )
    quantity = (
        F.when(key % 5 == 0, F.lit("-"))
        .when(key % 5 == 1, F.lit(""))
        .when(key % 5 == 2, F.lit("1,000"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    symbol = F.when(key % 50 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority")))
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey", series.alias("series"), symbol.alias("symbol"), quantity.alias("quantity")
    )


@query("flt01_series_filter", f"WITH {SERIES_SQL} SELECT o_orderkey, series FROM raw WHERE upper(trim(series)) = 'EQ'")
def flt01(spark, sf_dir):
    kept = F.upper(F.trim("series")) == "EQ"
    return raw_orders(spark, sf_dir).where(kept).select("o_orderkey", "series")


@query("flt02_non_empty_symbol", f"WITH {SERIES_SQL} SELECT o_orderkey, symbol FROM raw WHERE trim(symbol) <> ''")
def flt02(spark, sf_dir):
    return raw_orders(spark, sf_dir).where(F.trim("symbol") != "").select("o_orderkey", "symbol")


@query(
    "flt03_parsed_not_null",
    f"WITH {SERIES_SQL} SELECT o_orderkey, TRY_CAST(quantity AS BIGINT) AS quantity FROM raw WHERE TRY_CAST(quantity AS BIGINT) IS NOT NULL",
)
def flt03(spark, sf_dir):
    rows = raw_orders(spark, sf_dir).select("o_orderkey", lenient_bigint(F.col("quantity")).alias("quantity"))
    return rows.where(F.col("quantity").isNotNull())


TICKER_SQL = """tickers AS (
  SELECT event_id, event_type || CASE event_id % 4 WHEN 0 THEN '.NC.NSE' WHEN 1 THEN '.NSE' WHEN 2 THEN '.NSE_IDX' ELSE '.BO' END AS ticker
  FROM events)"""


def tickers(spark, sf_dir):
    event = F.col("event_id") % 4
    suffix = F.when(event == 0, ".NC.NSE").when(event == 1, ".NSE").when(event == 2, ".NSE_IDX").otherwise(".BO")
    return v.table(spark, sf_dir, "events").select("event_id", F.concat("event_type", suffix).alias("ticker"))


@query(
    "flt04_ticker_suffix",
    rf"WITH {TICKER_SQL} SELECT event_id, ticker FROM tickers WHERE regexp_matches(ticker, '(\.NC)?\.NSE$')",
)
def flt04(spark, sf_dir):
    return tickers(spark, sf_dir).where(F.col("ticker").rlike(names.EQUITY_SUFFIX))


@query(
    "flt05_universe_membership",
    f"""{v.WITH_CANDLES} SELECT symbol, timestamp, close FROM candles
        WHERE timeframe = '1m' AND symbol IN (SELECT symbol FROM candles WHERE timeframe = 'day')""",
)
def flt05(spark, sf_dir):
    rows = v.candles(spark, sf_dir)
    listed = sets.universe(rows.where(F.col("timeframe") == "day"))
    minutes = rows.where(F.col("timeframe") == "1m").select("symbol", "timestamp", "close")
    return sets.join_symbols(minutes, listed, "left_semi")


@query(
    "flt06_timeframe_list",
    f"{v.WITH_CANDLES} SELECT timeframe, symbol, count(*) AS n FROM candles WHERE timeframe IN ('day') GROUP BY 1, 2",
)
def flt06(spark, sf_dir):
    rows = v.candles(spark, sf_dir).where(F.col("timeframe").isin(["day"]))
    return rows.groupBy("timeframe", "symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flt07_bound_range",
    f"""{v.WITH_D1} SELECT symbol, timestamp, open, high, low, close, volume, delivery, del_percent FROM d1
        WHERE timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""",
)
def flt07(spark, sf_dir):
    bounds = {"first": "1997-01-01", "last": "1997-12-31"}
    return spark.sql(
        "SELECT symbol, timestamp, open, high, low, close, volume, delivery, del_percent FROM {daily} "
        "WHERE timestamp BETWEEN CAST(:first AS TIMESTAMP_NTZ) AND CAST(:last AS TIMESTAMP_NTZ)",
        args=bounds,
        daily=v.d1(spark, sf_dir),
    )


@query("flt07_lower_bound", f"{v.WITH_D1} SELECT symbol, timestamp, close FROM d1 WHERE timestamp >= DATE '1999-01-01'")
def flt07_lower(spark, sf_dir):
    rows = v.d1(spark, sf_dir).select("symbol", "timestamp", "close")
    return rows.where(F.col("timestamp") >= ntz(datetime(1999, 1, 1)))


@query(
    "flt08_as_of_cutoff",
    f"""{v.WITH_CANDLES} SELECT symbol, timeframe, timestamp, close FROM candles
        WHERE (timeframe = '1m' AND timestamp <= TIMESTAMP '2024-01-17 13:30:59')
           OR (timeframe = 'day' AND timestamp < DATE '2024-01-17')""",
)
def flt08(spark, sf_dir):
    stamp, frame = F.col("timestamp"), F.col("timeframe")
    known = ((frame == "1m") & (stamp <= ntz(datetime(2024, 1, 17, 13, 30, 59)))) | (
        (frame == "day") & (stamp < ntz(datetime(2024, 1, 17)))
    )
    return v.candles(spark, sf_dir).where(known).select("symbol", "timeframe", "timestamp", "close")


@query(
    "flt09_high_delivery",
    f"{v.WITH_D1} SELECT symbol, timestamp, close, volume, delivery, del_percent FROM d1 WHERE del_percent >= 60 ORDER BY timestamp DESC",
)
def flt09(spark, sf_dir):
    rows = v.d1(spark, sf_dir).select("symbol", "timestamp", "close", "volume", "delivery", "del_percent")
    return rows.where(F.col("del_percent") >= 60).orderBy(F.desc("timestamp"))


@query("flt10_symbol_search", f"{v.WITH_CANDLES} SELECT DISTINCT symbol FROM candles WHERE contains(upper(symbol), upper(trim(' i ')))")
def flt10(spark, sf_dir):
    return sets.universe(v.candles(spark, sf_dir)).where(names.contains_text(F.col("symbol"), " i "))


@query(
    "flt11_contract_projection",
    f"{v.WITH_D1} SELECT timestamp, open, high, low, close, volume, delivery, del_percent FROM d1",
)
def flt11(spark, sf_dir):
    return v.d1(spark, sf_dir).select(*CANDLE_COLUMNS)


@query(
    "flt12_delivery_to_volume",
    f"{v.WITH_D1} SELECT symbol, timestamp, CASE WHEN volume <> 0 THEN CAST(delivery AS DOUBLE) / volume * 100 END AS delivery_to_volume FROM d1",
)
def flt12(spark, sf_dir):
    ratio = F.when(F.col("volume") != 0, F.col("delivery").cast("double") / F.col("volume") * 100)
    return v.d1(spark, sf_dir).select("symbol", "timestamp", ratio.alias("delivery_to_volume"))


@query(
    "flt13_typed_literals",
    f"{v.WITH_M1} SELECT 'day' AS timeframe, symbol, close, CAST(NULL AS BIGINT) AS delivery, CAST(NULL AS DOUBLE) AS del_percent FROM m1",
)
def flt13(spark, sf_dir):
    return v.m1(spark, sf_dir).select(
        F.lit("day").alias("timeframe"),
        "symbol",
        "close",
        F.lit(None).cast("bigint").alias("delivery"),
        F.lit(None).cast("double").alias("del_percent"),
    )


@query(
    "flt14_candle_shape",
    f"""{v.WITH_M1} SELECT event_id, CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction,
        least(open, close) AS body_low, abs(close - open) AS body_size FROM m1""",
)
def flt14(spark, sf_dir):
    opened, closed = F.col("open"), F.col("close")
    return v.m1(spark, sf_dir, with_id=True).select(
        "event_id",
        F.when(closed >= opened, "up").otherwise("down").alias("direction"),
        F.least(opened, closed).alias("body_low"),
        F.abs(closed - opened).alias("body_size"),
    )


@query(
    "join01_symbol_set",
    f"""{v.WITH_CANDLES}, ids AS (SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS id FROM (SELECT DISTINCT symbol FROM candles))
        SELECT id, symbol, timeframe, timestamp, close FROM candles JOIN ids USING (symbol)""",
)
def join01(spark, sf_dir):
    from barloom.queries.indicators import win01

    rows = v.candles(spark, sf_dir).select("symbol", "timeframe", "timestamp", "close")
    return sets.join_symbols(rows, win01(spark, sf_dir), "inner")


@query(
    "join02_semi_join_universe",
    f"""{v.WITH_CANDLES} SELECT symbol, count(*) AS n FROM candles WHERE timeframe = '1m'
        AND symbol IN (SELECT symbol FROM dm) GROUP BY 1""",
)
def join02(spark, sf_dir):
    minutes = sets.join_symbols(v.m1(spark, sf_dir), sets.universe(v.dm(spark, sf_dir)), "left_semi")
    return minutes.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


# Sources: one per month and kind of order. The manifest knows a slightly different state.
SOURCES_SQL = """src AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'day' ELSE 'minute' END AS kind, strftime(o_orderdate, '%Y-%m') AS name,
         o_orderkey, o_custkey FROM orders),
discovered AS (
  SELECT kind || ':' || name AS source_key, kind, CAST(sum(o_custkey) AS VARCHAR) AS fingerprint
  FROM src WHERE name <> '1996-05' GROUP BY kind, name),
manifest AS (
  SELECT kind || ':' || name AS source_key, kind,
         CAST(sum(CASE WHEN name < '1998-01' THEN o_custkey ELSE o_orderkey END) AS VARCHAR) AS fingerprint,
         name <> '1997-03' AS has_cache
  FROM src WHERE name < '2000-01' GROUP BY kind, name)"""


def sources(spark, sf_dir):
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    src = v.table(spark, sf_dir, "orders").select(
        F.when(key % 2 == 0, "day").otherwise("minute").alias("kind"),
        F.date_format("o_orderdate", "yyyy-MM").alias("name"),
        "o_orderkey",
        "o_custkey",
    )
    name = F.col("name")
    discovered = (
        src.where(name != "1996-05")
        .groupBy("kind", "name")
        .agg(F.sum(customer).cast("string").alias("fingerprint"))
        .select(names.source_key(F.col("kind"), name).alias("source_key"), "kind", "fingerprint")
    )
    manifest = (
        src.where(name < "2000-01")
        .groupBy("kind", "name")
        .agg(F.sum(F.when(name < "1998-01", customer).otherwise(key)).cast("string").alias("fingerprint"))
        .select(
            names.source_key(F.col("kind"), name).alias("source_key"),
            "kind",
            "fingerprint",
            (name != "1997-03").alias("has_cache"),
        )
    )
    return discovered, manifest


@query(
    "join03_deleted_sources",
    f"WITH {SOURCES_SQL} SELECT source_key, kind FROM manifest WHERE source_key NOT IN (SELECT source_key FROM discovered)",
)
def join03(spark, sf_dir):
    discovered, manifest = sources(spark, sf_dir)
    return manifest.select("source_key", "kind").join(discovered, "source_key", "left_anti")


ACTIONS_SQL = f"""{SOURCES_SQL}, actions AS (
  SELECT coalesce(d.source_key, m.source_key) AS source_key, coalesce(d.kind, m.kind) AS kind,
         CASE WHEN d.source_key IS NULL THEN 'deleted'
              WHEN m.source_key IS NULL OR d.fingerprint <> m.fingerprint OR NOT m.has_cache THEN 'processed'
              ELSE 'cached' END AS action
  FROM discovered d FULL JOIN manifest m ON d.source_key = m.source_key)"""


@query("join04_source_compare", f"WITH {ACTIONS_SQL} SELECT source_key, kind, action FROM actions")
def join04(spark, sf_dir):
    return changes.classify(*sources(spark, sf_dir)).select("source_key", "kind", "action")


@query(
    "join05_missing_outputs",
    f"""{v.WITH_CANDLES}, outputs AS (SELECT DISTINCT symbol, timeframe FROM candles WHERE timestamp < TIMESTAMP '2024-01-01')
        SELECT DISTINCT symbol, timeframe FROM candles
        WHERE (symbol, timeframe) NOT IN (SELECT symbol, timeframe FROM outputs)""",
)
def join05(spark, sf_dir):
    rows = v.candles(spark, sf_dir)
    outputs = rows.where(F.col("timestamp") < ntz(datetime(2024, 1, 1))).select("symbol", "timeframe").distinct()
    return rows.select("symbol", "timeframe").distinct().join(outputs, ["symbol", "timeframe"], "left_anti")


OLD_NEW_SQL = f"""{v.WITH_CANDLES}, old AS (SELECT DISTINCT symbol FROM candles WHERE timeframe = 'day'),
  new AS (SELECT DISTINCT symbol FROM candles WHERE timeframe = '1m')"""


def old_and_new(spark, sf_dir):
    rows = v.candles(spark, sf_dir)
    return (
        sets.universe(rows.where(F.col("timeframe") == "day")),
        sets.universe(rows.where(F.col("timeframe") == "1m")),
    )


SYMMETRIC = """(SELECT symbol FROM old EXCEPT SELECT symbol FROM new)
   UNION ALL (SELECT symbol FROM new EXCEPT SELECT symbol FROM old)"""


@query("join08_universe_difference", f"{OLD_NEW_SQL} {SYMMETRIC}")
def join08(spark, sf_dir):
    return sets.added_or_removed(*old_and_new(spark, sf_dir))


@query("ord01_by_timestamp", f"{v.WITH_D1} SELECT symbol, timestamp, close FROM d1 ORDER BY symbol, timestamp")
def ord01(spark, sf_dir):
    return v.d1(spark, sf_dir).select("symbol", "timestamp", "close").orderBy("symbol", "timestamp")


@query("ord02_newest_first", f"{v.WITH_M1} SELECT symbol, timestamp, close FROM m1 ORDER BY timestamp DESC")
def ord02(spark, sf_dir):
    return v.m1(spark, sf_dir).select("symbol", "timestamp", "close").orderBy(F.desc("timestamp"))


@query("ord03_by_symbol", f"{v.WITH_CANDLES} SELECT symbol, timeframe, count(*) AS n FROM candles GROUP BY 1, 2 ORDER BY 1, 2")
def ord03(spark, sf_dir):
    counted = v.candles(spark, sf_dir).groupBy("symbol", "timeframe").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("symbol", "timeframe")


@query(
    "ord04_tail",
    f"""{v.WITH_CANDLES} SELECT symbol, timestamp, close FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS k FROM candles WHERE timeframe = 'day')
        WHERE k <= 5""",
)
def ord04(spark, sf_dir):
    day = v.candles(spark, sf_dir).where(F.col("timeframe") == "day").select("symbol", "timestamp", "close")
    return ops.last_rows(day, 5, "timestamp")


@query("ord05_first_symbols", f"{v.WITH_CANDLES} SELECT DISTINCT symbol FROM candles ORDER BY symbol LIMIT 20")
def ord05(spark, sf_dir):
    return sets.universe(v.candles(spark, sf_dir)).orderBy("symbol").limit(20)


@query(
    "set01_union_all",
    f"{v.WITH_CANDLES} SELECT symbol, timestamp, close FROM dm UNION ALL SELECT symbol, timestamp, close FROM d1",
)
def set01(spark, sf_dir):
    columns = ["symbol", "timestamp", "close"]
    return v.dm(spark, sf_dir).select(*columns).unionByName(v.d1(spark, sf_dir).select(*columns))


@query(
    "set02_union_by_name",
    f"{v.WITH_CANDLES} SELECT symbol, close, delivery FROM d1 UNION ALL BY NAME SELECT close, symbol FROM m1",
)
def set02(spark, sf_dir):
    minutes = v.m1(spark, sf_dir).select("close", "symbol")
    return v.d1(spark, sf_dir).select("symbol", "close", "delivery").unionByName(minutes, allowMissingColumns=True)


@query("set03_affected_symbols", f"{OLD_NEW_SQL} SELECT symbol FROM old UNION SELECT symbol FROM new")
def set03(spark, sf_dir):
    old, new = old_and_new(spark, sf_dir)
    return old.union(new).distinct()


@query("set04_difference", f"{OLD_NEW_SQL} SELECT symbol FROM old EXCEPT SELECT symbol FROM new")
def set04(spark, sf_dir):
    old, new = old_and_new(spark, sf_dir)
    return old.subtract(new)


@query("set05_symmetric_difference", f"{OLD_NEW_SQL} {SYMMETRIC}")
def set05(spark, sf_dir):
    old, new = old_and_new(spark, sf_dir)
    return old.subtract(new).union(new.subtract(old))


@query("set06_sorted_symbols", f"{v.WITH_CANDLES} SELECT DISTINCT symbol FROM candles ORDER BY symbol")
def set06(spark, sf_dir):
    return sets.universe(v.candles(spark, sf_dir)).orderBy("symbol")
