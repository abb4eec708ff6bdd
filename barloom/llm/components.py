"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.store import Store


def _only_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one smaller node at most, and holds none if it hangs on one."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("a").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.where("hangs > 1 OR hangs > 0 AND holds > 0").agg(F.count("*")).first()[0] == 0


def components(store: Store, name: str, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is its smallest node.

    Large-star hangs a node's larger neighbours on its smallest neighbour, small-star the
    smaller ones; the edges end as one star per component after about log(nodes) rounds.
    Minima are combined before the shuffle; a hub's rows are split by adaptive skew joins.
    """
    stars = store.put(f"{name}-0", edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    turn = 0
    while not _only_stars(stars):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a != b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(least, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), "b"))).alias("e"))
            .select("e.a", "e.b")
            .where("a != b")
            .distinct()
        )
        turn += 1
        stars = store.put(f"{name}-{turn}", small)
        store.drop(f"{name}-{turn - 1}")
    return stars.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
