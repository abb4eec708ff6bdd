"""The candle contract: column names and types."""

from __future__ import annotations

from pyspark.sql import types as T

CANDLE_COLUMNS = ["timestamp", "open", "high", "low", "close", "volume", "delivery", "del_percent"]
KEY_COLUMNS = ["timeframe", "symbol"]
PARTITION_COLUMNS = ["timeframe", "symbol_group", "symbol"]
TIMEFRAMES = ("day", "1m")

CANDLE_TYPES = {
    "timestamp": T.TimestampNTZType(),
    "open": T.DoubleType(),
    "high": T.DoubleType(),
    "low": T.DoubleType(),
    "close": T.DoubleType(),
    "volume": T.LongType(),
    "delivery": T.LongType(),
    "del_percent": T.DoubleType(),
}

CANDLE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in CANDLE_TYPES.items()])
TABLE_SCHEMA = T.StructType(
    [T.StructField(n, t) for n, t in CANDLE_TYPES.items()]
    + [T.StructField(n, T.StringType()) for n in PARTITION_COLUMNS]
)
