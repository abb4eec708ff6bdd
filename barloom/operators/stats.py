"""Descriptive statistics per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.ranks import quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(rows: DataFrame, fields: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per symbol and field, in long form.

    One unpivot; the moments aggregate partially in every task, the quartiles are selected
    by rank from ranges of values, so no buffer or task holds the values of a symbol.
    """
    values = rows.select("symbol", *[F.col(f).cast("double").alias(f) for f in fields])
    long = values.unpivot(["symbol"], fields, "field", "x")
    x = F.col("x")
    moments = long.groupBy("symbol", "field").agg(
        F.count(x).alias("n"),
        F.round(F.avg(x), 4).alias("mean"),
        F.round(F.stddev_samp(x), 4).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    ranked = quantiles(long, ["symbol", "field"], "x", QUARTILES).alias("q")
    same = F.col("m.symbol").eqNullSafe(F.col("q.symbol")) & (F.col("m.field") == F.col("q.field"))
    quartiles = [F.round(F.col(f"q.{name}"), 6).alias(name) for name in QUARTILES]
    return moments.alias("m").join(ranked, same, "left").select("m.symbol", "m.field", "n", "mean", "std", "min", *quartiles, "max")
