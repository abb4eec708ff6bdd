"""Exact positions in an order, of rows in ranges that tasks share evenly."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import scratch


def in_ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows`, distinct in `order`, written in ranges of it; `_range` counts the ranges from 0.

    The table fixes the ranges: their bounds come from a sample, which another run of
    the same plan could draw otherwise. A long run of rows of one key spans many ranges.
    """
    path = scratch(rows.sparkSession, "ranges", uuid.uuid4().hex)
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    return rows.sparkSession.read.schema(ranged.schema).parquet(path)


def dense_ids(rows: DataFrame, column: str, name: str = "id") -> DataFrame:
    """Distinct values of `column` with their rank from 0 in ascending order; null comes first.

    Rows are counted per range, and a row's rank is the count of all ranges before its own
    and its place inside. The driver sees one count for each range.
    """
    ranged = in_ranges(rows.select(column).distinct(), [column])
    before, offsets = 0, []
    for r in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).sort("_range").collect():
        offsets.append((r["_range"], before))
        before += r["n"]
    offset = rows.sparkSession.createDataFrame(offsets, "_range int, _before long")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    placed = ranged.withColumn("_within", within).join(F.broadcast(offset), "_range")
    return placed.select(column, (F.col("_before") + F.col("_within")).alias(name))


def quantiles(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Exact quantiles of the non-null values of each key, interpolated between neighbours.

    Columns: `keys` and the names of `wanted`, which gives each its fraction from 0 to 1.
    Equal values are counted once, before the shuffle as well. The counted values go into
    ranges of (keys, value); the counts of a key's ranges tell which of them hold a wanted
    position, and only those are put in order, each by itself. NaN is the greatest value.
    Keys may be null; a key without values has no row.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = in_ranges(counted, [*keys, "_x"])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_size"))
    spans = sizes.select(
        *keys,
        "_range",
        "_size",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy(*keys)).alias("_total"),
    )

    def position(fraction: float):
        return F.lit(float(fraction)) * (F.col("_total") - 1)

    # The two neighbours of each wanted position.
    places = F.array(*[f(position(p)).cast("long") for p in wanted.values() for f in (F.floor, F.ceil)])
    spans = spans.withColumn("_places", F.filter(F.array_distinct(places), lambda i: (i >= F.col("_before")) & (i < F.col("_before") + F.col("_size"))))
    spans = spans.where(F.size("_places") > 0)

    same = F.lit(True)
    for k in [*keys, "_range"]:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
    held = ranged.alias("r").join(spans.alias("s"), same).select("r.*", "_before", "_total", "_places")
    inside = Window.partitionBy(*keys, "_range").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ended = held.withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
    hit = F.filter("_places", lambda i: (i >= F.col("_end") - F.col("_n")) & (i < F.col("_end")))
    found = ended.select(*keys, "_total", "_x", F.explode(hit).alias("_place"))

    def at(place):
        return F.max(F.when(F.col("_place") == place.cast("long"), F.col("_x")))

    picked = []
    for name, p in wanted.items():
        low, high = at(F.floor(position(p))), at(F.ceil(position(p)))
        share = F.max(position(p) - F.floor(position(p)))
        picked.append(F.when(low == high, low).otherwise(low + (high - low) * share).alias(name))
    return found.groupBy(*keys).agg(*picked)
