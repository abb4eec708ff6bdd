"""A candle table in versions: data folders that never change, and lists that name them.

    timeframe=T/period=P/build=B/symbol_group=G/symbol=S/*.parquet
    _versions/N/    (timeframe, period, build, symbol, rows) of every live folder

A period is a year. A build writes new folders next to the old ones, so a new source adds its
own rows and rewrites none; where rows are to go, their period is written again. A version
counts once its list is complete. Readers resolve the newest one when they start and keep
reading it: folders are deleted only when the last two versions name them no more.

Folders of about equal size are merged when a period has many of them, so a row is written
again about as often as the logarithm of its period's rows.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.names import symbol_group
from barloom.schema import CANDLE_COLUMNS, TABLE_SCHEMA
from barloom.session import delete, hadoop_path

LISTS = "_versions"
LIST_SCHEMA = "timeframe string, period string, build string, symbol string, rows bigint"
FOLDER = ["timeframe", "period", "build"]
VERSIONED_SCHEMA = T.StructType([*TABLE_SCHEMA.fields, T.StructField("period", T.StringType()), T.StructField("build", T.StringType())])

#: So many folders of one size are merged; versions whose folders are kept.
MERGE, KEPT = 8, 2


@dataclass(frozen=True)
class Folder:
    timeframe: str
    period: str
    build: str
    rows: int = 0

    def path(self, table: str) -> str:
        return f"{table}/timeframe={self.timeframe}/period={self.period}/build={self.build}"


def period_of(stamp: Column) -> Column:
    return F.substring(stamp.cast("string"), 1, 4)


def children(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names below `path` that match a glob, relative to it."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    base = fs.makeQualified(root).toUri().getPath().rstrip("/")
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, pattern))
    return [status.getPath().toUri().getPath()[len(base) + 1 :] for status in found or []]


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    return sorted(int(name.split("/")[0]) for name in children(spark, f"{path}/{LISTS}", "*/_SUCCESS"))


def current(spark: SparkSession, path: str) -> int | None:
    """The newest version of a table, None where it has no versions."""
    return max(numbers(spark, path), default=None)


def listed(spark: SparkSession, path: str, number: int | None) -> DataFrame:
    if number is None:
        return spark.createDataFrame([], LIST_SCHEMA)
    return spark.read.schema(LIST_SCHEMA).parquet(f"{path}/{LISTS}/{number}")


def folders(live: DataFrame) -> list[Folder]:
    """The folders that a list names; a few for each year and timeframe.

    A list has a row a folder and symbol, little enough for one task.
    """
    return [Folder(*row) for row in live.coalesce(1).groupBy(*FOLDER).agg(F.sum("rows")).collect()]


def read_folders(spark: SparkSession, path: str, chosen: list[Folder], below: str = "") -> DataFrame:
    if not chosen:
        return spark.createDataFrame([], VERSIONED_SCHEMA)
    paths = sorted(folder.path(path) + below for folder in chosen)
    return spark.read.schema(VERSIONED_SCHEMA).option("basePath", path).parquet(*paths)


def read(spark: SparkSession, path: str, number: int) -> DataFrame:
    return read_folders(spark, path, folders(listed(spark, path, number))).drop("period", "build")


def read_symbol(spark: SparkSession, path: str, number: int, symbol: str, timeframe: str) -> DataFrame:
    """One symbol's rows; the list says which folders hold it, no other is listed."""
    held = listed(spark, path, number).where((F.col("symbol") == symbol) & (F.col("timeframe") == timeframe))
    rows = read_folders(spark, path, folders(held))
    return rows.where((F.col("symbol") == symbol) & (F.col("symbol_group") == symbol_group(F.lit(symbol))))


def mergeable(live: list[Folder], periods: set[tuple[str, str]]) -> list[Folder]:
    """Folders of `periods` that share their size (to a factor of `MERGE`) with enough others.

    The rows that are about to be written count as one more.
    """
    sizes: dict[tuple[str, str, int], list[Folder]] = {}
    for folder in live:
        if (folder.timeframe, folder.period) in periods:
            tier = int(math.log(max(folder.rows, 1), MERGE))
            sizes.setdefault((folder.timeframe, folder.period, tier), []).append(folder)
    return [folder for group in sizes.values() if len(group) >= MERGE - 1 for folder in group]


def write(rows: DataFrame, path: str, compression: str, rows_per_file: int) -> DataFrame:
    """Write rows as new folders and return their list."""
    spark, build = rows.sparkSession, uuid.uuid4().hex
    keyed = rows.select(
        *CANDLE_COLUMNS,
        "timeframe",
        period_of(F.col("timestamp")).alias("period"),
        F.lit(build).alias("build"),
        symbol_group(F.col("symbol")).alias("symbol_group"),
        "symbol",
    )
    balanced = keyed.hint("rebalance", F.col("timeframe"), F.col("period"), F.col("symbol"))
    own = [*FOLDER, "symbol_group", "symbol"]
    (
        balanced.sortWithinPartitions(*own, "timestamp")
        .write.mode("append")
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*own)
        .parquet(path)
    )
    made = [name.split("/") for name in children(spark, path, f"timeframe=*/period=*/build={build}")]
    new = [Folder(*(part.split("=", 1)[1] for part in parts)) for parts in made]
    # No data column is read: the rows are counted from the footers.
    return read_folders(spark, path, new).groupBy(*FOLDER, "symbol").agg(F.count(F.lit(1)).alias("rows"))


def publish(spark: SparkSession, path: str, live: DataFrame) -> int:
    """Make `live` the newest version; its list counts when it is complete."""
    found = children(spark, f"{path}/{LISTS}", "*")
    number = max((int(name) for name in found if name.isdigit()), default=0) + 1
    live.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{LISTS}/{number}")
    return number


def gone(spark: SparkSession, path: str, named: list[Folder]) -> list[Folder]:
    """Folders that a list names but the table doesn't hold any more."""
    held = set(children(spark, path, "timeframe=*/period=*/build=*"))
    return [f for f in named if f.path(path)[len(path) + 1 :] not in held]


def of_folders(live: DataFrame, some: list[Folder], how: str = "left_semi") -> DataFrame:
    rows = [(f.timeframe, f.period, f.build) for f in some]
    return live.join(live.sparkSession.createDataFrame(rows, "timeframe string, period string, build string"), FOLDER, how)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete all but the newest versions' lists, and the folders that no kept list names."""
    kept = numbers(spark, path)[-KEPT:]
    for name in children(spark, f"{path}/{LISTS}", "*"):
        if name.isdigit() and int(name) not in kept:
            delete(spark, f"{path}/{LISTS}/{name}")
    named = {f.path(path)[len(path) + 1 :] for number in kept for f in folders(listed(spark, path, number))}
    stale = [name for name in children(spark, path, "timeframe=*/period=*/build=*") if name not in named]
    for name in stale:
        delete(spark, f"{path}/{name}")
    return len(stale)
