"""Bars: properties that hold for any candles, NULL rules, plans."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.functions import calendar as cal
from barloom.operators import align as al
from barloom.operators import bars as ops
from barloom.operators import quality

SCHEMA = (
    "symbol string, timeframe string, timestamp timestamp_ntz, open double, high double, low double, "
    "close double, volume bigint, delivery bigint, del_percent double"
)


def make(symbol, timeframe, count, seed, start=datetime(2023, 12, 28, 9, 15, 59)):
    rng, rows, stamp = random.Random(seed), [], start
    for _ in range(count):
        stamp += timedelta(minutes=rng.choice([1, 1, 1, 7, 700])) if timeframe == "1m" else timedelta(days=rng.choice([1, 1, 3]))
        when = stamp if timeframe == "1m" else stamp.replace(hour=0, minute=0, second=0)
        a, b = rng.uniform(90, 110), rng.uniform(90, 110)
        delivery = rng.choice([None, 3, 4]) if timeframe == "day" else None
        rows.append((symbol, timeframe, when, a, max(a, b) + rng.random(), min(a, b) - rng.random(), b, rng.randrange(50), delivery, None))
    return rows


@pytest.fixture(scope="module")
def candles(spark):
    rows = make("BOTH", "1m", 400, 1) + make("BOTH", "day", 200, 2, datetime(2023, 6, 1)) + make("MINUTES", "1m", 300, 3)
    return spark.createDataFrame(rows + make("DAYS", "day", 100, 4, datetime(2023, 6, 1)), SCHEMA).cache()


@pytest.mark.parametrize("interval", list(cal.INTERVALS))
def test_bars_keep_bounds_and_volume(candles, interval):
    rows = candles.where(F.col("timeframe") == cal.INTERVALS[interval].timeframe)
    bars = ops.bars(candles, interval)
    assert quality.ohlc_violations(bars).count() == 0
    total = rows.agg(F.sum("volume")).first()[0]
    assert bars.agg(F.sum("volume")).first()[0] == total
    assert bars.groupBy("symbol", "bucket").count().where("count > 1").count() == 0


@pytest.mark.parametrize("interval", ["1m", "15m"])
def test_intraday_as_of_equals_bars_of_earlier_rows(candles, interval):
    cut = datetime(2024, 1, 10, 11, 2, 59)
    early = candles.where(F.col("timestamp") <= cal.ntz(cut))
    assert sorted(ops.bars(candles, interval, cut).collect()) == sorted(ops.bars(early, interval).collect())


def test_daily_as_of_builds_the_partial_day_from_minutes(candles):
    minutes = candles.where("timeframe = '1m' AND symbol = 'BOTH'").orderBy("timestamp").collect()
    cut = minutes[200]["timestamp"]
    today = [r for r in minutes if r["timestamp"].date() == cut.date() and r["timestamp"] <= cut]
    bars = {(r["symbol"], r["bucket"]): r for r in ops.bars(candles, "Day", cut).collect()}
    bar = bars["BOTH", datetime(cut.year, cut.month, cut.day)]
    assert (bar["open"], bar["close"]) == (today[0]["open"], today[-1]["close"])
    assert bar["high"] == max(r["high"] for r in today) and bar["volume"] == sum(r["volume"] for r in today)
    assert bar["delivery"] is None
    assert max(b for _, b in bars).date() == cut.date()
    assert not any(symbol == "MINUTES" for symbol, _ in bars)


def test_open_and_close_skip_nulls_but_roll_up_keeps_them(spark):
    base = datetime(2024, 1, 1)
    rows = [("S", base + timedelta(days=i), o, 5.0, 1.0, c, v, d) for i, (o, c, v, d) in enumerate([(None, 2.0, 10, 4), (3.0, None, None, None)])]
    frame = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint, delivery bigint")
    bar = ops.aggregate_bars(frame, "Week").first()
    assert (bar["open"], bar["close"], bar["delivery"], bar["del_percent"]) == (3.0, 2.0, None, None)
    rolled = ops.roll_up(frame, "Week", time="timestamp").first()
    assert (rolled["open"], rolled["close"], rolled["volume"], rolled["delivery"], rolled["del_percent"]) == (None, None, 10, 4, 40.0)


def test_fallbacks(candles):
    used = {(r["symbol"], r["interval"]) for r in ops.bars_with_fallback(candles, "Day").collect()}
    assert used == {("BOTH", "Day"), ("DAYS", "Day"), ("MINUTES", "1m")}
    symbols = {r["symbol"] for r in ops.comparison_bars(candles, "Month").collect()}
    assert symbols == {"BOTH", "DAYS", "MINUTES"}


def test_availability(candles):
    found = {r["symbol"]: (r["has_day"], r["has_1m"]) for r in ops.availability(candles).collect()}
    assert found == {"BOTH": (True, True), "DAYS": (True, False), "MINUTES": (False, True)}


def test_visible_returns_the_bars_asked_for(candles):
    bars = ops.bars(candles, "1m")
    for count, wanted in ((1, 1), (5, 5), (50, 50), (6000, 300)):
        shown = ops.visible(bars, count).where("symbol = 'MINUTES'").orderBy("slot").collect()
        assert [r["slot"] for r in shown] == list(range(1, min(wanted, bars.where("symbol = 'MINUTES'").count()) + 1))
    all_bars = sorted(r["bucket"] for r in bars.where("symbol = 'MINUTES'").collect())
    assert [r["bucket"] for r in ops.visible(bars, 50).where("symbol = 'MINUTES'").orderBy("slot").collect()] == all_bars[-50:]


def test_visible_limits_before_the_shuffle(candles):
    plan = ops.visible(ops.bars(candles, "1m"), 5000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_partial_aggregation_comes_before_the_shuffle(candles):
    plan = ops.bars(candles, "5m")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_min_by") and "SortAggregate" not in plan


def test_bar_cutoffs(spark):
    rows = [("S", datetime(2024, m, 1)) for m in (1, 2, 4)]
    frame = spark.createDataFrame(rows, "symbol string, bucket timestamp_ntz")
    as_of = datetime(2024, 4, 9, 10, 0, 59)
    found = [r["cutoff"] for r in ops.bar_cutoff(frame, "Month", as_of).orderBy("bucket").collect()]
    assert found == [datetime(2024, 1, 31, 23, 59), datetime(2024, 3, 31, 23, 59), as_of]
    own = ops.bar_cutoff(frame, "5m", as_of).orderBy("bucket").collect()
    assert [r["cutoff"] for r in own] == [b for _, b in rows]


def test_period_edges(spark):
    edges = [datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 1, 1), datetime(2024, 2, 29, 12, 7, 31), datetime(2024, 4, 1)]
    frame = spark.createDataFrame([(e,) for e in edges], "t timestamp_ntz")
    for name, wanted in {
        "5m": [datetime(2023, 12, 31, 23, 55), datetime(2024, 1, 1), datetime(2024, 2, 29, 12, 5), datetime(2024, 4, 1)],
        "Week": [datetime(2023, 12, 25), datetime(2024, 1, 1), datetime(2024, 2, 26), datetime(2024, 4, 1)],
        "Quarter": [datetime(2023, 10, 1), datetime(2024, 1, 1), datetime(2024, 1, 1), datetime(2024, 4, 1)],
    }.items():
        assert [r[0] for r in frame.select(cal.period_start(F.col("t"), name)).collect()] == wanted
        bucketed, bucket = ops.with_bucket(frame.withColumnRenamed("t", "timestamp"), name)
        assert [r[0] for r in bucketed.select(bucket).collect()] == wanted


def test_as_of_minute():
    assert cal.normalize_as_of(datetime(2024, 1, 2).date(), 9, 30) == datetime(2024, 1, 2, 9, 30, 59)


def test_relative_close_without_any_match_is_null(spark):
    base = datetime(2024, 1, 1)
    chart = spark.createDataFrame([("A", base + timedelta(days=i), 1.0) for i in range(3)], "symbol string, bucket timestamp_ntz, close double")
    other = spark.createDataFrame([("N", base + timedelta(days=i), x) for i, x in ((1, 0.0), (2, 4.0))], chart.schema)
    found = [r["move"] for r in al.relative_close(chart, other, "move").orderBy("bucket").collect()]
    assert found == [None, -100.0, 0.0]


def test_latest_finite(spark):
    base = datetime(2024, 1, 1)
    values = [1.0, 7.0, float("nan"), float("inf"), None]
    frame = spark.createDataFrame([("A", base + timedelta(days=i), x) for i, x in enumerate(values)], "symbol string, bucket timestamp_ntz, x double")
    assert al.latest_finite(frame, ["x"]).first()["x"] == 7.0


def test_symbol_sets_are_broadcast_only_when_small(candles, monkeypatch):
    from barloom.operators import sets

    minutes = candles.where("timeframe = '1m'")
    listed = sets.universe(candles.where("timeframe = 'day'"))
    small = sets.join_symbols(minutes, listed, "left_semi")
    monkeypatch.setattr(sets, "SMALL_SET", 1)
    large = sets.join_symbols(minutes, listed, "left_semi")
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert small.count() == large.count() == 400
