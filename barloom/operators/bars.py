"""Bars of any interval from stored candles, at any point in time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.calendar import INTERVALS, ntz, period_start
from barloom.operators.sets import join_symbols

BAR_COLUMNS = ["symbol", "bucket", "open", "high", "low", "close", "volume", "delivery", "del_percent"]

DEFAULT_VISIBLE_BARS = 280


def opening(value: Column, order: Column) -> Column:
    """The first non-null value by `order` (a bare `min_by` would keep a NULL)."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def closing(value: Column, order: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), order))


def all_or_null_sum(value: Column) -> Column:
    """NULL as soon as one input is NULL."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def delivery_percent(delivery: Column, volume: Column) -> Column:
    return F.when((volume > 0) & delivery.isNotNull(), delivery.cast("double") * F.lit(100.0) / volume)


def with_bucket(rows: DataFrame, interval: str) -> tuple[DataFrame, Column]:
    """Rows and the start of their bar. A tumbling window is plain integer arithmetic in
    generated code, several times cheaper than taking stamps apart."""
    minutes = INTERVALS[interval].minutes
    if not minutes:
        return rows, period_start(F.col("timestamp"), interval)
    return rows.withColumn("_window", F.window("timestamp", f"{minutes} minutes")), F.col("_window.start")


def aggregate_bars(rows: DataFrame, interval: str) -> DataFrame:
    """`(symbol, bucket)` bars; partial aggregation keeps the shuffle at bar size.

    Delivery is known only where every row of the bar has it.
    """
    stamp = F.col("timestamp")
    rows, bucket = with_bucket(rows, interval)
    grouped = rows.groupBy("symbol", bucket.alias("bucket")).agg(
        opening(F.col("open"), stamp).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        closing(F.col("close"), stamp).alias("close"),
        F.sum("volume").alias("volume"),
        all_or_null_sum(F.col("delivery")).alias("delivery"),
    )
    return grouped.withColumn("del_percent", delivery_percent(F.col("delivery"), F.col("volume"))).select(*BAR_COLUMNS)


def bars(candles: DataFrame, interval: str, as_of: datetime | None = None) -> DataFrame:
    """Bars of every symbol in the candle table (`symbol`, `timeframe` + 8 columns).

    With `as_of`, only what was known then: intraday rows up to the cutoff; days
    before the cutoff's day plus one partial bar of that day, built from its
    minutes, for symbols that have daily data.
    """
    timeframe = INTERVALS[interval].timeframe
    rows = candles.where(F.col("timeframe") == timeframe)
    if as_of is None:
        return aggregate_bars(rows, interval)
    if timeframe == "1m":
        return aggregate_bars(rows.where(F.col("timestamp") <= ntz(as_of)), interval)
    midnight = ntz(datetime(as_of.year, as_of.month, as_of.day))
    columns = ["symbol", "timestamp", "open", "high", "low", "close", "volume", "delivery"]
    complete = rows.where(F.col("timestamp") < midnight).select(*columns)
    minutes = candles.where(
        (F.col("timeframe") == "1m") & (F.col("timestamp") >= midnight) & (F.col("timestamp") <= ntz(as_of))
    )
    stamp = F.col("timestamp")
    partial = (
        minutes.groupBy("symbol")
        .agg(
            opening(F.col("open"), stamp).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            closing(F.col("close"), stamp).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("delivery").alias("delivery"),
        )
        .withColumn("timestamp", midnight)
        .join(rows.select("symbol").distinct(), "symbol", "left_semi")
        .select(*columns)
    )
    return aggregate_bars(complete.unionByName(partial), interval)


def roll_up(rows: DataFrame, interval: str, time: str = "bucket") -> DataFrame:
    """Bars to coarser bars. Delivery is the sum of the parts that are known.

    First and last row count even if their price is NULL, and the percentage
    divides by the volume of all rows.
    """
    stamp = F.col(time)
    grouped = rows.groupBy("symbol", period_start(stamp, interval).alias("period")).agg(
        F.min_by("open", stamp).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", stamp).alias("close"),
        F.sum(F.coalesce(F.col("volume"), F.lit(0))).alias("volume"),
        F.sum("delivery").alias("delivery"),
    )
    percent = F.when(
        (F.col("volume") != 0) & F.col("delivery").isNotNull(),
        F.col("delivery").cast("double") * F.lit(100.0) / F.col("volume"),
    )
    return grouped.withColumnRenamed("period", "bucket").withColumn("del_percent", percent).select(*BAR_COLUMNS)


def availability(candles: DataFrame) -> DataFrame:
    """Per symbol, which stored timeframes it has."""
    return candles.groupBy("symbol").agg(
        F.max(F.col("timeframe") == "day").alias("has_day"),
        F.max(F.col("timeframe") == "1m").alias("has_1m"),
    )


def bars_with_fallback(candles: DataFrame, interval: str, as_of: datetime | None = None) -> DataFrame:
    """Bars plus the interval actually used: day-based intervals fall back to 1m bars
    for symbols that have minutes only."""
    wanted = bars(candles, interval, as_of).withColumn("interval", F.lit(interval))
    if INTERVALS[interval].timeframe == "1m":
        return wanted
    daily = candles.where(F.col("timeframe") == "day").select("symbol").distinct()
    minutes = bars(join_symbols(candles, daily, "left_anti"), "1m", as_of).withColumn("interval", F.lit("1m"))
    return wanted.unionByName(minutes)


def comparison_bars(candles: DataFrame, interval: str, as_of: datetime | None = None) -> DataFrame:
    """Bars where symbols without daily data get day-or-coarser bars rolled up from minutes."""
    wanted = bars(candles, interval, as_of)
    if INTERVALS[interval].timeframe == "1m":
        return wanted
    daily = candles.where(F.col("timeframe") == "day").select("symbol").distinct()
    minutes = bars(join_symbols(candles, daily, "left_anti"), "1m", as_of)
    return wanted.unionByName(roll_up(minutes, interval))


def bar_cutoff(day_bars: DataFrame, interval: str, as_of: datetime) -> DataFrame:
    """The as-of moment each bar stands for.

    Intraday bars: their own stamp. Day and coarser: a minute before the next bar,
    `as_of` for the last. A symbol has at most 366 such bars a year, so the window
    per symbol is bounded by the calendar.
    """
    if INTERVALS[interval].minutes:
        return day_bars.withColumn("cutoff", F.col("bucket"))
    following = F.lead("bucket").over(Window.partitionBy("symbol").orderBy("bucket"))
    before = following - F.expr("INTERVAL '1' MINUTE")
    return day_bars.withColumn("cutoff", F.coalesce(before, ntz(as_of)))


def up_to(rows: DataFrame, end: datetime) -> DataFrame:
    """Only bars an analysis at `end` may see; apply before any indicator."""
    return rows.where(F.col("bucket") <= ntz(end))


def visible(rows: DataFrame, count: int = DEFAULT_VISIBLE_BARS, end: datetime | None = None) -> DataFrame:
    """The last `count` bars of every symbol, `slot` 1 being the oldest.

    A descending rank with a limit: up to the session's
    `spark.sql.optimizer.windowGroupLimitThreshold` (see `build_session`), Spark drops all
    but `count` rows per symbol before the shuffle; beyond it the rows are the same.
    """
    if end is not None:
        rows = up_to(rows, end)
    newest = Window.partitionBy("symbol").orderBy(F.desc("bucket"))
    kept = rows.withColumn("_from_end", F.row_number().over(newest)).where(F.col("_from_end") <= count)
    slot = F.row_number().over(Window.partitionBy("symbol").orderBy("bucket"))
    return kept.withColumn("slot", slot).drop("_from_end")


def last_rows(rows: DataFrame, count: int, time: str) -> DataFrame:
    """The newest `count` rows of every symbol."""
    newest = Window.partitionBy("symbol").orderBy(F.desc(time))
    return rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= count).drop("_rank")
