"""Raw text rows to candle rows, one function per kind of source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import casts
from barloom.functions.names import EQUITY_SUFFIX, strip_ticker
from barloom.operators.sets import join_symbols

DAILY_EQUITY = [
    "symbol", "series", "date1", "open_price", "high_price", "low_price", "close_price",
    "ttl_trd_qnty", "deliv_qty", "deliv_per",
]
DAILY_INDEX = [
    "index_name", "index_date", "open_index_value", "high_index_value", "low_index_value",
    "closing_index_value", "volume",
]
MINUTE = ["ticker", "date", "time", "open", "high", "low", "_close", "volume"]

SOURCE_ROW = ["path", "timeframe", "symbol", "timestamp", "open", "high", "low", "close", "volume", "delivery", "del_percent"]


def daily_equity(raw: DataFrame) -> DataFrame:
    """EQ series only. Prices and volume must be numbers; delivery fields may be `-`."""
    kept = raw.where((F.upper(F.trim("series")) == "EQ") & (F.trim("symbol") != ""))
    return kept.select(
        "path",
        F.lit("day").alias("timeframe"),
        F.trim("symbol").alias("symbol"),
        casts.strict_timestamp(F.trim("date1"), casts.DAY_PATTERN).alias("timestamp"),
        *[casts.strict_double(F.col(f"{c}_price")).alias(c) for c in ("open", "high", "low", "close")],
        casts.strict_bigint(F.col("ttl_trd_qnty")).alias("volume"),
        casts.lenient_bigint(F.col("deliv_qty")).alias("delivery"),
        casts.lenient_double(F.col("deliv_per")).alias("del_percent"),
    )


def daily_index(raw: DataFrame) -> DataFrame:
    """Unknown open, high or low fall back to the close; rows without name, date or close go."""
    close = casts.lenient_double(F.col("closing_index_value"))
    prices = [F.coalesce(casts.lenient_double(F.col(f"{c}_index_value")), close).alias(c) for c in ("open", "high", "low")]
    rows = raw.where(F.trim("index_name") != "").select(
        "path",
        F.lit("day").alias("timeframe"),
        F.upper(F.trim("index_name")).alias("symbol"),
        casts.lenient_day(F.trim("index_date")).alias("timestamp"),
        *prices,
        close.alias("close"),
        casts.lenient_bigint(F.replace("volume", F.lit(","), F.lit(""))).alias("volume"),
        F.lit(None).cast("bigint").alias("delivery"),
        F.lit(None).cast("double").alias("del_percent"),
    )
    return rows.where(F.col("timestamp").isNotNull() & F.col("close").isNotNull())


def minutes(
    raw: DataFrame, suffix: str = EQUITY_SUFFIX, universe: DataFrame | None = None, require_suffix: bool = False
) -> DataFrame:
    """Minute rows; with `universe`, only its symbols."""
    if require_suffix:
        raw = raw.where(F.col("ticker").rlike(suffix))
    named = raw.withColumn("symbol", strip_ticker(F.col("ticker"), suffix))
    if universe is not None:
        named = join_symbols(named, universe, "left_semi")
    stamp = F.concat(F.trim("date"), F.lit(" "), F.trim("time"))
    return named.select(
        "path",
        F.lit("1m").alias("timeframe"),
        "symbol",
        casts.strict_timestamp(stamp, casts.MINUTE_PATTERN).alias("timestamp"),
        *[casts.strict_double(F.col(c)).alias(c) for c in ("open", "high", "low")],
        casts.strict_double(F.col("_close")).alias("close"),
        casts.strict_bigint(F.col("volume")).alias("volume"),
        F.lit(None).cast("bigint").alias("delivery"),
        F.lit(None).cast("double").alias("del_percent"),
    )
