"""Comparing series: exact-stamp alignment, relative move, latest value."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.bars import DEFAULT_VISIBLE_BARS, up_to, visible
from barloom.operators.indicators import Rsi, with_indicators


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & ~F.abs(value).eqNullSafe(F.lit(float("inf")))


def align(target: DataFrame, source: DataFrame, value: str, order: str | None = None) -> DataFrame:
    """Left join on the exact `bucket`; misses are NULL.

    `source` is one series (`bucket`, `value`). Where it repeats a stamp, the row
    that is last by `order` counts.
    """
    if order is not None:
        source = source.groupBy("bucket").agg(F.max_by(value, order).alias(value))
    return target.join(source.select("bucket", value), "bucket", "left")


def relative_move(shown: DataFrame, comparison: DataFrame, name: str) -> DataFrame:
    """Percent move of `comparison` since its first usable value among the shown bars.

    `shown` comes from `visible`, `comparison` holds the bars of one symbol. The window
    covers the shown bars of a symbol, at most 5000 rows.
    """
    source = comparison.select("bucket", F.col("close").alias("_close"))
    rows = align(shown, source, "_close")
    usable = finite(F.col("_close")) & (F.col("_close") != 0)
    slots = Window.partitionBy("symbol").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    base = F.first(F.when(usable, F.col("_close")), ignorenulls=True).over(slots)
    move = F.when(finite(F.col("_close")), (F.col("_close") / F.col("_base") - 1.0) * 100.0)
    return rows.withColumn("_base", base).withColumn(name, move).select(*shown.columns, name)


def relative_close(
    chart: DataFrame,
    comparison: DataFrame,
    name: str,
    count: int = DEFAULT_VISIBLE_BARS,
    end: datetime | None = None,
) -> DataFrame:
    """`relative_move` over the last `count` bars up to `end`."""
    return relative_move(visible(chart, count, end), comparison, name)


def comparison_rsi(
    chart: DataFrame, comparison: DataFrame, spec: Rsi, interval: str, end: datetime | None = None
) -> DataFrame:
    """RSI of another symbol's bars, cut at the analysis end, on the chart's stamps."""
    if end is not None:
        chart, comparison = up_to(chart, end), up_to(comparison, end)
    values = with_indicators(comparison, [spec], interval)
    return align(chart, values, spec.name)


def latest_finite(rows: DataFrame, values: list[str], time: str = "bucket") -> DataFrame:
    """Per symbol, the last finite value of each series: a plain partial aggregation."""
    latest = [F.max_by(v, F.when(finite(F.col(v)), F.col(time))).alias(v) for v in values]
    return rows.groupBy("symbol").agg(*latest)
