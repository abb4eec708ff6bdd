"""Symbol sets: universe, differences, digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.ranks import dense_ids


# A set of symbols up to this size (some tens of megabytes) may be broadcast.
SMALL_SET = 1_000_000


def join_symbols(rows: DataFrame, symbols: DataFrame, how: str) -> DataFrame:
    """Join candle rows with a set of symbols.

    The set is counted first (one narrow column). A small one is broadcast, so that the
    rows are not shuffled and a busy symbol stays spread out. Spark cannot know this
    size when it plans, and would shuffle the rows before it finds out. A large set
    takes the shuffle join, where adaptive execution splits skewed keys.
    """
    small = symbols.limit(SMALL_SET + 1).count() <= SMALL_SET
    return rows.join(F.broadcast(symbols) if small else symbols, "symbol", how)


def universe(candles: DataFrame) -> DataFrame:
    return candles.select("symbol").distinct()


def added_or_removed(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows in exactly one of two sets (both distinct)."""
    keys = keys or old.columns
    return old.join(new, keys, "left_anti").unionByName(new.join(old, keys, "left_anti"))


def surrogate_ids(symbols: DataFrame) -> DataFrame:
    """Distinct symbols with their rank from 0 in binary order."""
    return dense_ids(symbols, "symbol")


def symbol_list_digest(symbols: DataFrame) -> DataFrame:
    """md5 of the sorted, comma-joined list of distinct symbols, and how many there are.

    The list is as long as the exchange's symbol directory, not as the data.
    """
    return symbols.agg(
        F.md5(F.expr("listagg(symbol, ',') WITHIN GROUP (ORDER BY symbol)").cast("binary")).alias("digest"),
        F.count(F.lit(1)).alias("symbols"),
    )


def set_digest(rows: DataFrame, column: str) -> DataFrame:
    """One text that changes with the set: count, XOR and sum of 64-bit hashes.

    Needs no order, so it aggregates partially in every task.
    """
    hashed = F.xxhash64(column)
    parts = [
        F.count(F.lit(1)).cast("string"),
        F.coalesce(F.bit_xor(hashed), F.lit(0)).cast("string"),
        F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0)).cast("string"),
    ]
    return rows.agg(F.md5(F.concat_ws(":", *parts).cast("binary")).alias("digest"))
