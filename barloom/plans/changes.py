"""What happened to the sources since the last build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.sources.adapters import ADAPTERS

PROCESSED, CACHED, DELETED, UPGRADED = "processed", "cached", "deleted", "cache fingerprint upgraded"
WORK = (PROCESSED, DELETED)

# Kinds whose fingerprints of an older scheme are replaced without a new read.
UPGRADABLE = ("day", "minute", "minute_idx")


def classify(
    discovered: DataFrame,
    manifest: DataFrame,
    old_scheme: bool = False,
    reprocess_kinds: tuple[str, ...] = (),
) -> DataFrame:
    """One row per source ever seen, with its `action`.

    `discovered`: source_key, kind, fingerprint and more. `manifest`: the same plus
    `has_cache`; its columns come back with the prefix `old_`. A source is processed when it is new, changed, its cache is gone or
    its kind is to be reprocessed; a fingerprint of an old scheme is replaced
    without reading the source again.
    """
    renamed = [F.col(c).alias(f"old_{c}") for c in manifest.columns if c not in ("source_key", "has_cache")]
    old = manifest.select("source_key", "has_cache", *renamed)
    both = discovered.join(old, "source_key", "full_outer")
    forced = F.col("kind").isin(*reprocess_kinds) if reprocess_kinds else F.lit(False)
    cached = F.coalesce(F.col("has_cache"), F.lit(False))
    upgraded = F.lit(old_scheme) & cached & F.col("kind").isin(*UPGRADABLE)
    same = F.col("fingerprint").eqNullSafe(F.col("old_fingerprint")) & cached
    action = (
        F.when(F.col("kind").isNull(), F.lit(DELETED))
        .when(forced, F.lit(PROCESSED))
        .when(upgraded, F.lit(UPGRADED))
        .when(same, F.lit(CACHED))
        .otherwise(F.lit(PROCESSED))
    )
    return both.withColumn("action", action).withColumn("kind", F.coalesce("kind", "old_kind")).drop("old_kind")


def reprocessed(actions: DataFrame, kinds: list[str]) -> DataFrame:
    """Classified sources, those of some kinds processed again unless they are gone."""
    again = F.col("kind").isin(kinds) & (F.col("action") != DELETED)
    return actions.withColumn("action", F.when(again, F.lit(PROCESSED)).otherwise(F.col("action")))


def timeframe_of(kind: Column) -> Column:
    pairs = [F.lit(x) for a in ADAPTERS.values() for x in (a.kind, a.timeframe)]
    return F.create_map(*pairs)[kind]


def dirty_timeframes(actions: DataFrame) -> DataFrame:
    """Timeframes whose output must be rewritten."""
    touched = actions.where(F.col("action").isin(*WORK))
    return touched.select(timeframe_of(F.col("kind")).alias("timeframe")).distinct()


def affected_symbols(old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """(timeframe, symbol) of changed sources, before and after."""
    keys = ["timeframe", "symbol"]
    return old_rows.select(*keys).unionByName(new_rows.select(*keys)).distinct()


def summary(actions: DataFrame) -> DataFrame:
    """Counts per kind: discovered, new or changed, deleted, unchanged."""
    action = F.col("action")
    return actions.groupBy("kind").agg(
        F.count_if(action != DELETED).alias("discovered"),
        F.count_if(action == PROCESSED).alias("changed"),
        F.count_if(action == DELETED).alias("deleted"),
        F.count_if(action.isin(CACHED, UPGRADED)).alias("unchanged"),
    )
