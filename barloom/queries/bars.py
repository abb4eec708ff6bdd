"""Bars: aggregation (AGG), resampling and point-in-time (TS)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from barloom.functions import calendar as cal
from barloom.operators import bars as ops
from barloom.operators.bars import closing, opening
from barloom.queries import views as v
from barloom.queries.registry import query

# An as-of moment inside the minute data, and its day.
AS_OF = datetime(2024, 1, 17, 13, 30, 59)
AS_OF_SQL = "TIMESTAMP '2024-01-17 13:30:59'"


def resample(interval: str):
    source, prefix = ("m1", v.WITH_M1) if cal.INTERVALS[interval].minutes else ("d1", v.WITH_D1)

    @query(f"ts01_resample_{interval.lower()}", f"{prefix} {v.sql_bars(source, interval)}")
    def run(spark, sf_dir):
        return ops.aggregate_bars(getattr(v, source)(spark, sf_dir), interval)

    return run


for _interval in cal.INTERVALS:
    resample(_interval)


@query(
    "agg01_group_by_bucket",
    f"{v.WITH_M1} SELECT symbol, {v.BUCKETS['5m']} AS bucket, count(*) AS n FROM m1 GROUP BY 1, 2",
)
def agg01(spark, sf_dir):
    bucket = cal.period_start(F.col("timestamp"), "5m").alias("bucket")
    return v.m1(spark, sf_dir).groupBy("symbol", bucket).agg(F.count(F.lit(1)).alias("n"))


# Some opens and closes are NULL here, so that skipping and keeping NULLs differ.
HOLES_SQL = f"""{v.WITH_M1}, holes AS (
  SELECT symbol, timestamp, CASE WHEN event_id % 3 <> 0 THEN open END AS open,
         CASE WHEN event_id % 4 <> 0 THEN close END AS close FROM m1)"""


def holes(spark, sf_dir):
    rows = v.m1(spark, sf_dir, with_id=True)
    return rows.select(
        "symbol",
        "timestamp",
        F.when(F.col("event_id") % 3 != 0, F.col("open")).alias("open"),
        F.when(F.col("event_id") % 4 != 0, F.col("close")).alias("close"),
    )


@query(
    "agg02_open_first_known",
    f"{HOLES_SQL} SELECT symbol, {v.BUCKETS['15m']} AS bucket, arg_min(open, timestamp) AS open FROM holes GROUP BY 1, 2",
)
def agg02(spark, sf_dir):
    bucket = cal.period_start(F.col("timestamp"), "15m").alias("bucket")
    return holes(spark, sf_dir).groupBy("symbol", bucket).agg(opening(F.col("open"), F.col("timestamp")).alias("open"))


@query(
    "agg03_close_last_known",
    f"{HOLES_SQL} SELECT symbol, {v.BUCKETS['15m']} AS bucket, arg_max(close, timestamp) AS close FROM holes GROUP BY 1, 2",
)
def agg03(spark, sf_dir):
    bucket = cal.period_start(F.col("timestamp"), "15m").alias("bucket")
    return holes(spark, sf_dir).groupBy("symbol", bucket).agg(closing(F.col("close"), F.col("timestamp")).alias("close"))


@query(
    "agg04_ordered_first_last",
    f"""{HOLES_SQL} SELECT symbol, {v.BUCKETS['15m']} AS bucket, first(open ORDER BY timestamp) AS open,
        last(close ORDER BY timestamp) AS close FROM holes GROUP BY 1, 2""",
)
def agg04(spark, sf_dir):
    bucket = cal.period_start(F.col("timestamp"), "15m").alias("bucket")
    return (
        holes(spark, sf_dir)
        .groupBy("symbol", bucket)
        .agg(F.min_by("open", "timestamp").alias("open"), F.max_by("close", "timestamp").alias("close"))
    )


@query(
    "agg05_high_low",
    f"{v.WITH_D1} SELECT symbol, {v.BUCKETS['Month']} AS bucket, max(high) AS high, min(low) AS low FROM d1 GROUP BY 1, 2",
)
def agg05(spark, sf_dir):
    bucket = cal.period_start(F.col("timestamp"), "Month").alias("bucket")
    return v.d1(spark, sf_dir).groupBy("symbol", bucket).agg(F.max("high").alias("high"), F.min("low").alias("low"))


@query(
    "agg06_volume_delivery_sums",
    f"""{v.WITH_D1} SELECT symbol, {v.BUCKETS['Month']} AS bucket, CAST(sum(volume) AS BIGINT) AS volume,
        CAST(sum(delivery) AS BIGINT) AS delivery FROM d1 GROUP BY 1, 2""",
)
def agg06(spark, sf_dir):
    bucket = cal.period_start(F.col("timestamp"), "Month").alias("bucket")
    return (
        v.d1(spark, sf_dir)
        .groupBy("symbol", bucket)
        .agg(F.sum("volume").alias("volume"), F.sum("delivery").alias("delivery"))
    )


@query(
    "agg07_all_or_null_delivery",
    f"""{v.WITH_D1} SELECT symbol, {v.BUCKETS['Week']} AS bucket,
        CASE WHEN count(delivery) = count(*) THEN CAST(sum(delivery) AS BIGINT) END AS delivery FROM d1 GROUP BY 1, 2""",
)
def agg07(spark, sf_dir):
    bucket = cal.period_start(F.col("timestamp"), "Week").alias("bucket")
    total = ops.all_or_null_sum(F.col("delivery")).alias("delivery")
    return v.d1(spark, sf_dir).groupBy("symbol", bucket).agg(total)


@query("agg08_guarded_percent", f"{v.WITH_D1} SELECT symbol, timestamp, volume, delivery, {v.PERCENT} FROM (SELECT * EXCLUDE (del_percent) FROM d1)")
def agg08(spark, sf_dir):
    rows = v.d1(spark, sf_dir).select("symbol", "timestamp", "volume", "delivery")
    return rows.withColumn("del_percent", ops.delivery_percent(F.col("delivery"), F.col("volume")))


@query(
    "agg09_counts",
    f"{v.WITH_CANDLES} SELECT timeframe, symbol, count(*) AS n FROM candles GROUP BY ROLLUP (timeframe, symbol)",
)
def agg09(spark, sf_dir):
    return v.candles(spark, sf_dir).rollup("timeframe", "symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg10_coverage",
    f"""{v.WITH_CANDLES} SELECT symbol, timeframe, min(timestamp) AS first_date, max(timestamp) AS last_date,
        count(*) AS n FROM candles GROUP BY 1, 2""",
)
def agg10(spark, sf_dir):
    return (
        v.candles(spark, sf_dir)
        .groupBy("symbol", "timeframe")
        .agg(
            F.min("timestamp").alias("first_date"),
            F.max("timestamp").alias("last_date"),
            F.count(F.lit(1)).alias("n"),
        )
    )


@query(
    "agg11_having_repeated",
    f"""{v.WITH_M1} SELECT symbol, date_trunc('minute', timestamp) AS minute, count(*) AS occurrences
        FROM m1 GROUP BY 1, 2 HAVING count(*) > 1""",
)
def agg11(spark, sf_dir):
    minute = cal.period_start(F.col("timestamp"), "1m").alias("minute")
    counted = v.m1(spark, sf_dir).groupBy("symbol", minute).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where(F.col("occurrences") > 1)


@query("agg12_distinct", f"{v.WITH_CANDLES} SELECT DISTINCT symbol, timeframe FROM candles")
def agg12(spark, sf_dir):
    return v.candles(spark, sf_dir).select("symbol", "timeframe").distinct()


@query(
    "agg13_symbol_list_digest",
    f"""{v.WITH_CANDLES} SELECT md5(string_agg(symbol, ',' ORDER BY symbol)) AS digest, count(*) AS symbols
        FROM (SELECT DISTINCT symbol FROM candles WHERE timeframe = 'day')""",
)
def agg13(spark, sf_dir):
    from barloom.operators.sets import symbol_list_digest

    day = v.candles(spark, sf_dir).where(F.col("timeframe") == "day")
    return symbol_list_digest(day.select("symbol").distinct())


@query(
    "agg14_describe",
    f"""{v.WITH_D1}, long AS (
          SELECT symbol, 'close' AS field, close AS x FROM d1
          UNION ALL SELECT symbol, 'volume', CAST(volume AS DOUBLE) FROM d1
          UNION ALL SELECT symbol, 'delivery', CAST(delivery AS DOUBLE) FROM d1)
        SELECT symbol, field, count(x) AS n, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, min(x) AS min,
               round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
               round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max
        FROM long GROUP BY 1, 2""",
)
def agg14(spark, sf_dir):
    from barloom.operators.stats import describe

    return describe(v.d1(spark, sf_dir), ["close", "volume", "delivery"])


for _interval in ("Week", "Month", "Quarter", "Year"):

    def _roll(interval: str):
        @query(f"agg15_roll_up_{interval.lower()}", f"{v.WITH_D1} {v.sql_roll_up('d1', interval, 'timestamp')}")
        def run(spark, sf_dir):
            return ops.roll_up(v.d1(spark, sf_dir), interval, time="timestamp")

    _roll(_interval)


AS_OF_ROWS = f"""{v.WITH_CANDLES}, known AS (
  SELECT symbol, timestamp, open, high, low, close, volume, delivery FROM candles
  WHERE timeframe = 'day' AND timestamp < CAST({AS_OF_SQL} AS DATE)
  UNION ALL
  SELECT symbol, CAST(CAST({AS_OF_SQL} AS DATE) AS TIMESTAMP), arg_min(open, timestamp), max(high), min(low),
         arg_max(close, timestamp), sum(volume), sum(delivery)
  FROM candles WHERE timeframe = '1m' AND timestamp >= CAST({AS_OF_SQL} AS DATE) AND timestamp <= {AS_OF_SQL}
    AND symbol IN (SELECT symbol FROM candles WHERE timeframe = 'day')
  GROUP BY 1)"""

for _interval in ("Day", "Week", "Month"):

    def _as_of(interval: str):
        @query(f"ts02_as_of_{interval.lower()}", f"{AS_OF_ROWS} {v.sql_bars('known', interval)}")
        def run(spark, sf_dir):
            return ops.bars(v.candles(spark, sf_dir), interval, AS_OF)

    _as_of(_interval)


@query(
    "ts03_as_of_intraday",
    f"""{v.WITH_M1}, known AS (SELECT * FROM m1 WHERE timestamp <= {AS_OF_SQL}) {v.sql_bars('known', '15m')}""",
)
def ts03(spark, sf_dir):
    return ops.bars(v.candles(spark, sf_dir), "15m", AS_OF)


@query(
    "ts04_as_of_normalized",
    f"""{v.WITH_M1} SELECT event_id, make_timestamp(year(timestamp), month(timestamp), day(timestamp),
        hour(timestamp), minute(timestamp), 59.0) AS as_of FROM m1""",
)
def ts04(spark, sf_dir):
    stamp = F.col("timestamp")
    as_of = cal.as_of_column(stamp, F.hour(stamp), F.minute(stamp))
    return v.m1(spark, sf_dir, with_id=True).select("event_id", as_of.alias("as_of"))


@query(
    "ts05_timeframe_fallback",
    f"""{v.WITH_CANDLES}, days AS (SELECT * FROM candles WHERE timeframe = 'day'),
        minutes AS (SELECT * FROM candles WHERE timeframe = '1m'
                    AND symbol NOT IN (SELECT symbol FROM candles WHERE timeframe = 'day'))
        SELECT *, 'Week' AS interval FROM ({v.sql_bars('days', 'Week')})
        UNION ALL SELECT *, '1m' FROM ({v.sql_bars('minutes', '1m')})""",
)
def ts05(spark, sf_dir):
    return ops.bars_with_fallback(v.candles(spark, sf_dir), "Week")


@query(
    "ts06_comparison_fallback",
    f"""{v.WITH_CANDLES}, days AS (SELECT * FROM candles WHERE timeframe = 'day'),
        minutes AS (SELECT * FROM candles WHERE timeframe = '1m'
                    AND symbol NOT IN (SELECT symbol FROM candles WHERE timeframe = 'day')),
        minute_bars AS ({v.sql_bars('minutes', '1m')})
        {v.sql_bars('days', 'Day')}
        UNION ALL {v.sql_roll_up('minute_bars', 'Day')}""",
)
def ts06(spark, sf_dir):
    return ops.comparison_bars(v.candles(spark, sf_dir), "Day")


@query(
    "ts07_period_start",
    f"{v.WITH_M1} SELECT event_id, "
    + ", ".join(f"{sql} AS p_{name.lower()}" for name, sql in v.BUCKETS.items())
    + " FROM m1",
)
def ts07(spark, sf_dir):
    starts = [cal.period_start(F.col("timestamp"), name).alias(f"p_{name.lower()}") for name in cal.INTERVALS]
    return v.m1(spark, sf_dir, with_id=True).select("event_id", *starts)


_NEXT_SQL = {
    "Day": "INTERVAL 1 DAY",
    "Week": "INTERVAL 7 DAY",
    "Month": "INTERVAL 1 MONTH",
    "Quarter": "INTERVAL 3 MONTH",
    "Year": "INTERVAL 1 YEAR",
}


@query(
    "ts08_next_period_start",
    f"{v.WITH_D1} SELECT symbol, timestamp, "
    + ", ".join(f"{v.BUCKETS[name]} + {step} AS n_{name.lower()}" for name, step in _NEXT_SQL.items())
    + " FROM d1",
)
def ts08(spark, sf_dir):
    stamp = F.col("timestamp")
    ends = [cal.next_period_start(cal.period_start(stamp, n), n).alias(f"n_{n.lower()}") for n in _NEXT_SQL]
    return v.d1(spark, sf_dir).select("symbol", "timestamp", *ends)


@query(
    "ts09_bar_cutoff",
    f"""{v.WITH_D1}, b AS ({v.sql_bars('d1', 'Month')})
        SELECT symbol, bucket, coalesce(lead(bucket) OVER (PARTITION BY symbol ORDER BY bucket) - INTERVAL 1 MINUTE,
               {AS_OF_SQL}) AS cutoff FROM b""",
)
def ts09(spark, sf_dir):
    month = ops.aggregate_bars(v.d1(spark, sf_dir), "Month")
    return ops.bar_cutoff(month, "Month", AS_OF).select("symbol", "bucket", "cutoff")


@query(
    "ts11_visible_window",
    f"""{v.WITH_M1}, b AS ({v.sql_bars('m1', '5m')}),
        r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bucket DESC) AS back FROM b WHERE bucket <= {AS_OF_SQL})
        SELECT * EXCLUDE (back), row_number() OVER (PARTITION BY symbol ORDER BY bucket) AS slot FROM r WHERE back <= 280""",
)
def ts11(spark, sf_dir):
    rows = ops.visible(ops.aggregate_bars(v.m1(spark, sf_dir), "5m"), end=AS_OF)
    return rows.withColumn("slot", F.col("slot").cast("bigint"))


_MATRIX = {"1m": 0, "5m": 1, "15m": 2, "Day": 3, "Week": 4, "Month": 5, "Quarter": 6, "Year": -1}


@query(
    "ts12_applicability",
    f"""{v.WITH_M1}, ranks(interval, rank) AS (VALUES {", ".join(f"('{k}', {r})" for k, r in _MATRIX.items())}),
        pairs AS (SELECT c.interval AS chart, t.interval AS timeframe,
          CASE WHEN c.interval IN ('1m', '5m', '15m') THEN t.rank >= c.rank
               WHEN c.interval = 'Day' THEN t.interval IN ('Day', 'Week', 'Month', 'Quarter')
               ELSE c.interval = t.interval END AS applies FROM ranks c, ranks t)
        SELECT symbol, chart, timeframe, applies
        FROM (SELECT DISTINCT symbol FROM m1), pairs""",
)
def ts12(spark, sf_dir):
    from barloom.plans.specs import applicability

    return applicability(v.m1(spark, sf_dir).select("symbol").distinct())
