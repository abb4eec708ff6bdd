"""Registered source kinds. A new one is an `Adapter` in `ADAPTERS`."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.names import EQUITY_SUFFIX, INDEX_SUFFIX, cache_id, source_key
from barloom.sources import candles, files

Reader = Callable[[SparkSession, list[str], DataFrame | None], DataFrame]


@dataclass(frozen=True)
class Adapter:
    """How one kind of source file is found, identified and read.

    `read(spark, paths, universe)` returns a lazy DataFrame of candle rows with the
    `path` they came from. Raise `version` when its result changes. An `optional` kind
    need not be configured.
    """

    kind: str
    glob: str
    version: int
    timeframe: str
    read: Reader
    optional: bool = False
    folder_may_be_missing: bool = False
    needs_universe: bool = False

    def discover(self, spark: SparkSession, folder: str | None, fingerprint: str = "content") -> DataFrame:
        """source_key, kind, path, cache_id, fingerprint of every file in the folder."""
        listed = files.list_files(spark, folder, self.glob, self.optional)
        found = files.fingerprints(listed, self.version, fingerprint)
        return found.select(
            source_key(self.kind, F.col("name")).alias("source_key"),
            F.lit(self.kind).alias("kind"),
            "path",
            cache_id(F.col("path")).alias("cache_id"),
            "fingerprint",
        )


def read_daily_equity(spark: SparkSession, paths: list[str], universe: DataFrame | None = None) -> DataFrame:
    """Daily CSV files, and workbooks that carry a `.csv` name."""
    workbooks, texts = files.inspect(spark, paths)
    raw = files.csv_rows(spark, texts, candles.DAILY_EQUITY)
    if workbooks:
        raw = raw.unionByName(files.workbook_rows(files.read_paths(spark, workbooks), candles.DAILY_EQUITY))
    return candles.daily_equity(raw)


def read_daily_index(spark: SparkSession, paths: list[str], universe: DataFrame | None = None) -> DataFrame:
    return candles.daily_index(files.csv_rows(spark, files.inspect(spark, paths)[1], candles.DAILY_INDEX))


def read_minutes(spark: SparkSession, paths: list[str], universe: DataFrame | None = None) -> DataFrame:
    raw = files.archive_rows(files.read_paths(spark, paths), candles.MINUTE)
    return candles.minutes(raw, EQUITY_SUFFIX, universe)


def read_index_minutes(spark: SparkSession, paths: list[str], universe: DataFrame | None = None) -> DataFrame:
    raw = files.archive_rows(files.read_paths(spark, paths), candles.MINUTE)
    return candles.minutes(raw, INDEX_SUFFIX)


ADAPTERS = {
    a.kind: a
    for a in (
        Adapter("day", "delivery_*.csv", 2, "day", read_daily_equity),
        Adapter("day_idx", "ind_close_all_*.csv", 2, "day", read_daily_index, optional=True, folder_may_be_missing=True),
        Adapter("minute", "*.zip", 3, "1m", read_minutes, needs_universe=True),
        Adapter("minute_idx", "*.zip", 1, "1m", read_index_minutes, optional=True),
    )
}
