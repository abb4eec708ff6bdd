"""Data-quality checks. Each returns the offending (or summary) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.schema import CANDLE_TYPES

KEYS = ["timeframe", "symbol", "timestamp"]


def schema_problems(rows: DataFrame) -> DataFrame:
    """Contract columns that are missing, of another type or out of place, and extra ones."""
    wanted = [(i, name, kind.simpleString()) for i, (name, kind) in enumerate(CANDLE_TYPES.items())]
    found = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(rows.schema.fields)]
    spark = rows.sparkSession
    contract = spark.createDataFrame(wanted, "position int, column_name string, wanted_type string")
    actual = spark.createDataFrame(found, "found_position int, column_name string, found_type string")
    both = contract.join(actual, "column_name", "full_outer")
    problem = (
        F.when(F.col("found_type").isNull(), "missing")
        .when(F.col("wanted_type").isNull(), "unexpected")
        .when(F.col("wanted_type") != F.col("found_type"), "type")
        .when(F.col("position") != F.col("found_position"), "order")
    )
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull()).select("column_name", "problem")


def duplicate_stamps(rows: DataFrame) -> DataFrame:
    """Keys that occur more than once. Counts are combined before the shuffle."""
    counted = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where(F.col("occurrences") > 1)


def ohlc_broken() -> Column:
    opened, high, low, close = (F.col(c) for c in ("open", "high", "low", "close"))
    return (high < F.greatest(opened, low, close)) | (low > F.least(opened, high, close))


def delivery_broken() -> Column:
    share = F.col("del_percent")
    return (F.col("delivery") < 0) | (share < 0) | (share > 100)


def ohlc_violations(rows: DataFrame) -> DataFrame:
    return rows.where(ohlc_broken())


def delivery_violations(rows: DataFrame) -> DataFrame:
    return rows.where(delivery_broken())


def minute_delivery(rows: DataFrame) -> DataFrame:
    """Minute rows must not carry delivery figures."""
    known = F.col("delivery").isNotNull() | F.col("del_percent").isNotNull()
    return rows.where((F.col("timeframe") == "1m") & known)


def negative_volume(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("volume") < 0)


def timeframe_rows(rows: DataFrame, timeframes: tuple[str, ...] = ("day", "1m")) -> DataFrame:
    """Rows per expected timeframe, 0 where there are none."""
    counts = [F.count_if(F.col("timeframe") == t).alias(t) for t in timeframes]
    return rows.agg(*counts).unpivot([], list(timeframes), "timeframe", "rows")


# What a file of the candle table is called.
TABLE_FILE = r"/timeframe=(day|1m)/symbol_group=[a-z0-9_]/symbol=[^/]+/[^/]+\.parquet$"


def unexpected_files(listing: DataFrame, pattern: str = TABLE_FILE) -> DataFrame:
    """Files (with `path`) that do not belong to the table."""
    return listing.where(~F.col("path").rlike(pattern))


def percent_mismatch(rows: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Published against recomputed delivery percentage."""
    computed = F.when(F.col("volume") != 0, F.col("delivery").cast("double") * F.lit(100.0) / F.col("volume"))
    return rows.withColumn("computed", computed).where(F.abs(F.col("del_percent") - F.col("computed")) > tolerance)


def build_summary(rows: DataFrame, sources: DataFrame, files: DataFrame) -> DataFrame:
    """(metric, value): sources, equities, day rows, minute rows, files."""
    frame = F.col("timeframe")
    kinds = rows.groupBy(F.when(frame == "day", "day_rows").otherwise("minute_rows").alias("metric"))
    equities = rows.where(frame == "day").select("symbol").distinct()
    parts = [(sources, "sources"), (equities, "equities"), (files, "files")]
    out = kinds.agg(F.count(F.lit(1)).alias("value"))
    for part, metric in parts:
        out = out.unionByName(part.agg(F.count(F.lit(1)).alias("value")).withColumn("metric", F.lit(metric)))
    return out


def coverage(rows: DataFrame) -> DataFrame:
    """First and last day and number of distinct days per symbol and timeframe."""
    days = rows.select("timeframe", "symbol", F.col("timestamp").cast("date").alias("day")).distinct()
    return days.groupBy("timeframe", "symbol").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("days")
    )


def missing_days(rows: DataFrame) -> DataFrame:
    """Days on which others of the timeframe traded, within a symbol's own span, but not it.

    Every day gets its number in the timeframe's calendar; a jump in a symbol's numbers
    is a gap. So only missing days are produced, never all pairs of symbol and day. The
    windows run over days: at most 366 rows a year per symbol.
    """
    days = rows.select("timeframe", "symbol", F.col("timestamp").cast("date").alias("day")).distinct()
    number = F.row_number().over(Window.partitionBy("timeframe").orderBy("day"))
    calendar = days.select("timeframe", "day").distinct().withColumn("number", number)
    previous = F.lag("number").over(Window.partitionBy("timeframe", "symbol").orderBy("number"))
    gaps = days.join(calendar, ["timeframe", "day"]).withColumn("previous", previous)
    gaps = gaps.where(F.col("number") - F.col("previous") > 1).select(
        "timeframe", "symbol", F.explode(F.sequence(F.col("previous") + 1, F.col("number") - 1)).alias("number")
    )
    return gaps.join(calendar, ["timeframe", "number"]).select("timeframe", "symbol", "day")
