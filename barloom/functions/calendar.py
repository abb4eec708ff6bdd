"""Bar intervals and period boundaries on zone-less timestamps.

Everything goes through DATE arithmetic, which keeps TIMESTAMP_NTZ and does not
depend on the session time zone (`date_trunc` would return a zoned timestamp).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, time

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Interval:
    """One bar width: where its rows come from and how many bars a day can hold."""

    name: str
    timeframe: str
    unit: str
    minutes: int = 0

    @property
    def bars_per_day(self) -> int:
        return 1440 // self.minutes if self.minutes else 1


INTERVALS = {
    i.name: i
    for i in (
        Interval("1m", "1m", "minute", 1),
        Interval("5m", "1m", "minute", 5),
        Interval("15m", "1m", "minute", 15),
        Interval("Day", "day", "day"),
        Interval("Week", "day", "week"),
        Interval("Month", "day", "month"),
        Interval("Quarter", "day", "quarter"),
        Interval("Year", "day", "year"),
    )
}

# Ranks that decide which indicator timeframe fits which chart.
TIMEFRAME_RANK = {"1m": 0, "5m": 1, "15m": 2, "Day": 3, "Week": 4, "Month": 5, "Quarter": 6}


def period_start(stamp: Column, interval: str) -> Column:
    """Start of the bar or period that holds `stamp` (weeks start on Monday)."""
    spec = INTERVALS[interval]
    day = stamp.cast("date")
    if spec.minutes:
        minute = F.minute(stamp)
        if spec.minutes > 1:
            minute = F.floor(minute / F.lit(spec.minutes)).cast("int") * F.lit(spec.minutes)
        return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(stamp), minute)
    if spec.unit != "day":
        day = F.trunc(day, spec.unit)
    return day.cast("timestamp_ntz")


def next_period_start(start: Column, interval: str) -> Column:
    spec = INTERVALS[interval]
    if spec.minutes:
        return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(spec.minutes))
    day = start.cast("date")
    months = {"month": 1, "quarter": 3, "year": 12}.get(spec.unit)
    if months:
        return F.add_months(day, months).cast("timestamp_ntz")
    return F.date_add(day, 7 if spec.unit == "week" else 1).cast("timestamp_ntz")


def normalize_as_of(day, hour: int, minute: int) -> datetime:
    """A chosen day and minute mean the whole minute: second 59."""
    return datetime.combine(day, time(hour, minute, 59))


def as_of_column(day: Column, hour: Column, minute: Column) -> Column:
    return day.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, minute, F.lit(59))


def ntz(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _pairs() -> frozenset[tuple[str, str]]:
    """(chart interval, indicator timeframe) that go together."""
    every = set(TIMEFRAME_RANK)
    same = {(t, t) for t in INTERVALS}
    intraday = {(c, t) for c in ("1m", "5m", "15m") for t in every if TIMEFRAME_RANK[c] <= TIMEFRAME_RANK[t]}
    over_days = {("Day", t) for t in ("Week", "Month", "Quarter")}
    # A Day chart shows everything coarser but years.
    return frozenset(same | intraday | over_days)


APPLICABLE = _pairs()


def indicator_applies(chart: str, timeframe: str) -> bool:
    """May an indicator of `timeframe` be drawn over bars of interval `chart`?"""
    return timeframe == "chart" or (chart, timeframe) in APPLICABLE
