"""Bounded pieces of long series.

Bars are unique per (symbol, bucket), so a slab of calendar days holds a bounded
number of them, at most `CHUNK_BARS`. Ordered work is done per (symbol, slab), never
per symbol: one busy symbol is spread over as many tasks as it has slabs.

Day and coarser bars have at most 366 rows a year and symbol; they are one slab.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.calendar import INTERVALS

CHUNK_BARS = 43_200
CHUNK = "_chunk"
HALO = "_halo"
FIRST = "_first"


def slab() -> Window:
    return Window.partitionBy("symbol", CHUNK).orderBy("bucket")


def slab_days(interval: str, chunk_bars: int = CHUNK_BARS) -> int | None:
    """Days per slab so that no slab exceeds `chunk_bars` bars; None = one slab is enough."""
    per_day = INTERVALS[interval].bars_per_day
    if per_day == 1 and chunk_bars >= CHUNK_BARS:
        return None
    return max(1, chunk_bars // per_day)


def with_chunk(rows: DataFrame, days: int | None) -> DataFrame:
    if days is None:
        return rows.withColumn(CHUNK, F.lit(0))
    number = F.floor(F.unix_date(F.col("bucket").cast("date")) / F.lit(days)).cast("int")
    return rows.withColumn(CHUNK, number)


def with_halo(rows: DataFrame, count: int, days: int | None) -> DataFrame:
    """Rows with slab number, plus copies of the `count` bars before each slab (`_halo`).

    Only the last `count` bars of a slab leave it (limited before the shuffle), and
    the per-symbol window runs over one row per slab. The copies keep all columns, so
    that both branches need the same shuffled bars and Spark computes them once.
    """
    own = with_chunk(rows, days).withColumn(HALO, F.lit(False))
    if days is None or count == 0:
        return own
    newest = Window.partitionBy("symbol", CHUNK).orderBy(F.desc("bucket"))
    payload = F.struct("bucket", *[c for c in rows.columns if c not in ("symbol", "bucket")])
    tails = (
        with_chunk(rows, days)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= count)
        .groupBy("symbol", CHUNK)
        .agg(F.sort_array(F.collect_list(payload)).alias("tail"))
    )
    earlier = Window.partitionBy("symbol").orderBy(CHUNK).rowsBetween(-count, -1)
    past = F.flatten(F.collect_list("tail").over(earlier))
    copies = (
        tails.withColumn("past", past)
        .withColumn("past", F.slice("past", F.greatest(F.size("past") - F.lit(count), F.lit(0)) + 1, F.lit(count)))
        .select("symbol", CHUNK, F.inline("past"))
        .withColumn(HALO, F.lit(True))
    )
    return own.unionByName(copies)


def drop_halo(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col(HALO)).drop(HALO)
