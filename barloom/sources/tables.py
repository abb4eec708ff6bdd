"""The stored candle table: write, read, describe, list, drop."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.names import decode_symbol, encode_symbol, symbol_group
from barloom.schema import CANDLE_COLUMNS, CANDLE_SCHEMA, PARTITION_COLUMNS, TABLE_SCHEMA
from barloom.session import delete, exists
from barloom.sources import versions
from barloom.sources.flat import FlatFiles
from barloom.sources.streams import located, opened, with_columns

# Accepted compression names and what Spark calls them.
CODECS = {"zstd": "zstd", "snappy": "snappy", "gzip": "gzip", "lz4": "lz4", "uncompressed": "none"}
ROWS_PER_FILE = 20_000_000


def codec(name: str) -> str:
    if name.lower() not in CODECS:
        raise ValueError(f"Unsupported compression: {name}")
    return CODECS[name.lower()]


def arranged(rows: DataFrame) -> DataFrame:
    """Rows laid out for a partitioned write.

    A rebalance on (timeframe, symbol) brings a symbol's rows together, so that small
    symbols give one file each; adaptive execution splits a partition that turns out
    large (a busy symbol) and merges small ones. Sorting is local.
    """
    keyed = rows.withColumn("symbol_group", symbol_group(F.col("symbol"))).select(*CANDLE_COLUMNS, *PARTITION_COLUMNS)
    balanced = keyed.hint("rebalance", F.col("timeframe"), F.col("symbol"))
    return balanced.sortWithinPartitions(*PARTITION_COLUMNS, "timestamp")


def write_candles(rows: DataFrame, path: str, compression: str = "zstd", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Overwrite the (timeframe, symbol) partitions that occur in `rows`, no others."""
    (
        arranged(rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec(compression))
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """The candle table; filters on timeframe and symbol prune whole folders.

    Of a table with versions (a build's), the newest one when this is called.
    """
    number = versions.current(spark, path)
    return spark.read.schema(TABLE_SCHEMA).parquet(path) if number is None else versions.read(spark, path, number)


def read_symbol(spark: SparkSession, path: str, symbol: str, timeframe: str) -> DataFrame:
    number = versions.current(spark, path)
    if number is not None:
        return versions.read_symbol(spark, path, number, symbol, timeframe).select(*CANDLE_COLUMNS)
    rows = read_candles(spark, path)
    one = (F.col("timeframe") == timeframe) & (F.col("symbol") == symbol)
    return rows.where(one & (F.col("symbol_group") == symbol_group(F.lit(symbol)))).select(*CANDLE_COLUMNS)


def file_path() -> Column:
    """Path of a row's file, with the listing's own URI encoding undone."""
    return decode_symbol(F.col("_metadata.file_path"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Rows per file. No data column is read, so counts come from the file footers."""
    files = read_candles(spark, path).select(file_path().alias("file"), "timeframe", "symbol")
    return files.groupBy("file", "timeframe", "symbol").agg(F.count(F.lit(1)).alias("rows"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length and time of every file below `path`, whatever it is; nothing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", "modificationTime")


def footers(spark: SparkSession, folders: list[str]) -> DataFrame:
    """path and rows of every Parquet file below some folders, from the footers alone."""

    def look(path: str) -> dict:
        with opened(path) as stream:
            return {"rows": pq.read_metadata(stream).num_rows}

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return with_columns(found.load(folders).select("path"), look, "rows long")


def totals(files: DataFrame) -> DataFrame:
    return files.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))


def describe(rows: DataFrame) -> DataFrame:
    """column_name and column_type, in order."""
    found = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(rows.schema.fields)]
    return rows.sparkSession.createDataFrame(found, "position int, column_name string, column_type string")


def catalog(rows: DataFrame) -> DataFrame:
    """Symbols with the timeframes they have. Reads partition values only."""
    return rows.groupBy("symbol").agg(F.sort_array(F.collect_set("timeframe")).alias("timeframes"))


def partitions(rows: DataFrame) -> DataFrame:
    return rows.select("timeframe", "symbol").distinct()


def drop_partitions(spark: SparkSession, path: str, stale: DataFrame) -> int:
    """Delete the folders of `stale` (timeframe, symbol) pairs; dynamic overwrite keeps them.

    Only the stale folders' names reach the driver.
    """
    if not exists(spark, path):
        return 0
    found = read_candles(spark, path).select("timeframe", "symbol", file_path().alias("file"))
    folder = F.regexp_replace("file", "/[^/]*$", "").alias("folder")
    folders = found.join(stale, ["timeframe", "symbol"], "left_semi").select(folder).distinct().collect()
    for row in folders:
        delete(spark, row["folder"])
    return len(folders)


def flat_files(pairs: DataFrame) -> DataFrame:
    """`file` of (timeframe, symbol) pairs: `<group>/<symbol>/<timeframe>.parquet`."""
    return pairs.select(flat_file().alias("file"))


def flat_file() -> Column:
    symbol = F.col("symbol")
    return F.concat_ws("/", symbol_group(symbol), encode_symbol(symbol), F.concat("timeframe", F.lit(".parquet")))


def listed_flat(spark: SparkSession, path: str) -> DataFrame:
    """`file` of what a consumer layout holds; no file is opened."""
    found = spark.read.format("binaryFile").load(f"{path}/[a-z0-9_]/*/*.parquet")
    return found.select(F.regexp_extract("path", "([^/]+/[^/]+/[^/]+)$", 1).alias("file"))


def write_flat(rows: DataFrame, path: str, compression: str = "zstd") -> None:
    """The consumer layout: one file per symbol and timeframe that occurs in `rows`, no others.

    One shuffle brings a file's rows together in order; the task that has them streams them
    out and puts the file in place (`sources.flat`). A file is one symbol's history by the
    layout's own rule; the candle table is the form that splits it.
    """
    spark = rows.sparkSession
    spark.dataSource.register(FlatFiles)
    keyed = rows.select(flat_file().alias("file"), *CANDLE_COLUMNS)
    ordered = keyed.repartition("file").sortWithinPartitions("file", "timestamp")
    ordered.write.format(FlatFiles.name()).mode("append").option("path", path).option("compression", codec(compression)).save()


def drop_files(path: str, files: DataFrame) -> None:
    """Delete the named files below `path` where they exist; tasks do it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, file = located(f"{path}/{name}")
                if system.get_file_info(file).is_file:
                    system.delete_file(file)
            yield batch

    files.select("file").mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()


def read_flat(spark: SparkSession, path: str, timeframe: str) -> DataFrame:
    """All symbols of one timeframe in the consumer layout, with symbol and timeframe.

    Columns are matched by name; files that lack one give NULL.
    """
    rows = spark.read.schema(CANDLE_SCHEMA).option("mergeSchema", True).parquet(f"{path}/[a-z0-9_]/*/{timeframe}.parquet")
    folder = F.regexp_extract(F.col("_file"), f"/([^/]+)/{timeframe}\\.parquet(?:/[^/]*)?$", 1)
    return rows.select(*CANDLE_COLUMNS, file_path().alias("_file")).select(
        *CANDLE_COLUMNS, decode_symbol(folder).alias("symbol"), F.lit(timeframe).alias("timeframe"), "_file"
    ).withColumnRenamed("_file", "filename")
