"""Text to number and text to timestamp, strict and lenient.

Integers written as decimals (`1000.6`, `1e3`) are rounded half-up; a plain
Spark cast would reject them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day patterns index files use, tried in this order.
INDEX_DATE_PATTERNS = ("d-M-yyyy", "d-MMM-yyyy", "d/M/yyyy")
DAY_PATTERN = "d-MMM-yyyy"
MINUTE_PATTERN = "d/M/yyyy H:m:s"


def checked(text: Column, value: Column, kind: str) -> Column:
    """`value`, but text that gave none stops the job, whether or not Spark is in ANSI mode."""
    problem = F.raise_error(F.concat(F.lit(f"Not a {kind}: "), text)).cast(kind)
    return F.coalesce(value, F.when(text.isNotNull(), problem))


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def strict_double(text: Column) -> Column:
    return checked(text, lenient_double(text), "double")


def lenient_bigint(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.round(text.try_cast("double")).try_cast("bigint"))


def strict_bigint(text: Column) -> Column:
    return checked(text, lenient_bigint(text), "bigint")


def strict_timestamp(text: Column, pattern: str) -> Column:
    return checked(text, F.to_timestamp_ntz(text, F.lit(pattern)), "timestamp_ntz")


def lenient_day(text: Column, patterns: tuple[str, ...] = INDEX_DATE_PATTERNS) -> Column:
    """Midnight of the day by the first pattern that fits, else NULL."""
    return F.coalesce(*[F.try_to_date(text, p) for p in patterns]).cast("timestamp_ntz")
