"""Indicators against plain sequential formulas, with slabs small enough to cross."""

import math
import random
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.operators import indicators as ind
from barloom.operators import tree
from barloom.operators.recurrences import apply_pieces, band_pieces, compose, compose_all, compose_pieces, run_band, run_sides

SCHEMA = "symbol string, bucket timestamp_ntz, open double, high double, low double, close double, volume bigint"


def series(symbol, count, seed, minutes, jump=0.02):
    """A walk with gaps in time, jumps in price and some empty volumes."""
    rng = random.Random(seed)
    stamp, close, rows = datetime(2023, 12, 20), 100.0, []
    for _ in range(count):
        stamp += timedelta(minutes=minutes * rng.choice([1, 1, 1, 2, 400]))
        opened = close * (1 + rng.uniform(-jump, jump))
        close = opened * (1 + rng.uniform(-jump, jump) * rng.choice([1, 1, 6]))
        high, low = max(opened, close) * (1 + rng.random() * jump), min(opened, close) * (1 - rng.random() * jump)
        rows.append((symbol, stamp, opened, high, low, close, rng.choice([None, 0, 5, 70])))
    return rows


def expected_ema(values, period):
    a, out = 2 / (period + 1), []
    for x in values:
        out.append(x if not out else a * x + (1 - a) * out[-1])
    return out


def expected_rsi(closes, period):
    changes = [b - a for a, b in zip([closes[0], *closes], closes)]
    gains = expected_ema([max(c, 0) for c in changes], period)
    losses = expected_ema([max(-c, 0) for c in changes], period)
    return [100.0 if lo == 0 else 100 - 100 / (1 + g / lo) for g, lo in zip(gains, losses)]


def expected_ama(rows, n, fast, slow):
    prices = [sum(r[2:6]) / 4 for r in rows]
    af, as_, out = 2 / (fast + 1), 2 / (slow + 1), []
    for i, p in enumerate(prices):
        path = sum(abs(prices[j] - prices[j - 1]) for j in range(max(1, i - n + 1), i + 1))
        er = abs(p - prices[max(0, i - n + 1)]) / path if path else 0.0
        s = (er * (af - as_) + as_) ** 2
        out.append(p if not out else out[-1] + s * (p - out[-1]))
    return out


def expected_ranges(rows):
    closes = [r[5] for r in rows]
    return [max(r[3] - r[4], abs(r[3] - c), abs(r[4] - c)) for r, c in zip(rows, [closes[0], *closes])]


def expected_atr(rows, n):
    ranges = expected_ranges(rows)
    return [float(np.mean(ranges[max(0, i - n + 1) : i + 1])) for i in range(len(rows))]


def expected_trend(rows, n, mult):
    if len(rows) < n:
        return [None] * len(rows)
    out, rising, u, d = [], True, None, None
    for i, (r, atr) in enumerate(zip(rows, expected_atr(rows, n))):
        mid, before = (r[3] + r[4]) / 2, rows[i - 1][5]
        bu, bl = mid + mult * atr, mid - mult * atr
        if i == 0 or bu < u or before > u:
            u = bu
        if i == 0 or bl > d or before < d:
            d = bl
        rising = not r[5] < d if rising else r[5] > u
        out.append(d if rising else u)
    return out


def expected_vwap(rows, start):
    out, period, worth, volume = [], None, 0.0, 0.0
    for r in rows:
        if start(r[1]) != period:
            period, worth, volume = start(r[1]), 0.0, 0.0
        typical = (r[3] + r[4] + r[5]) / 3
        worth, volume = worth + typical * (r[6] or 0), volume + (r[6] or 0)
        out.append(worth / volume if volume else typical)
    return out


STARTS = {
    "Day": lambda t: t.date(),
    "Week": lambda t: t.isocalendar()[:2],
    "Month": lambda t: (t.year, t.month),
    "Quarter": lambda t: (t.year, (t.month - 1) // 3),
    "Year": lambda t: t.year,
}
SPECS = [
    ind.Ema(1), ind.Ema(5), ind.Ema(200), ind.Rsi(14), ind.Rsi(1), ind.Ama(), ind.Ama(1, 1, 2), ind.Ama(40, 3, 9),
    ind.SuperTrend(), ind.SuperTrend(3, 0.5), ind.SuperTrend(300, 2.0), *[ind.Vwap(a) for a in ind.ANCHORS],
]


def expected(rows, spec):
    closes = [r[5] for r in rows]
    if isinstance(spec, ind.Ema):
        return expected_ema(closes, spec.period)
    if isinstance(spec, ind.Rsi):
        return expected_rsi(closes, spec.period)
    if isinstance(spec, ind.Ama):
        return expected_ama(rows, spec.efficiency_period, spec.fast_period, spec.slow_period)
    if isinstance(spec, ind.SuperTrend):
        return expected_trend(rows, spec.period, spec.multiplier)
    return expected_vwap(rows, STARTS[spec.anchor])


def same(found, wanted):
    if found is None or wanted is None:
        return found is None and wanted is None
    return math.isclose(found, wanted, rel_tol=1e-9, abs_tol=1e-9)


# (interval, minutes between bars, bars per slab): one slab, then many slabs, some
# of them shorter than the look-back.
CASES = [("1m", 1, 43_200), ("1m", 1, 1_440), ("15m", 15, 96), ("Day", 1_440, 43_200), ("Day", 1_440, 7)]


@pytest.mark.parametrize("interval,minutes,chunk_bars", CASES)
def test_indicators_match_sequential_formulas(spark, interval, minutes, chunk_bars):
    data = {"BUSY": series("BUSY", 600, 1, minutes), "CALM": series("CALM", 40, 2, minutes, 0.002)}
    data["ONE"] = series("ONE", 1, 3, minutes)
    if minutes == 1_440:
        data = {s: [(*r[:1], r[1].replace(hour=0, minute=0), *r[2:]) for r in rows] for s, rows in data.items()}
    rows = spark.createDataFrame([r for part in data.values() for r in part], SCHEMA).repartition(3)
    frame = ind.with_indicators(rows, SPECS, interval, chunk_bars)
    found = {(r["symbol"], r["bucket"]): r for r in frame.collect()}
    assert len(found) == sum(map(len, data.values()))
    for symbol, part in data.items():
        for spec in SPECS:
            for r, wanted in zip(part, expected(part, spec)):
                value = found[symbol, r[1]][spec.name]
                assert same(value, wanted), (symbol, spec.name, r[1], value, wanted)


def test_five_thousand_slabs_of_one_symbol(spark):
    """A bar a day in slabs of a day: states come down a tree of two levels."""
    part = [(*r[:1], datetime(2000, 1, 1) + timedelta(days=i), *r[2:]) for i, r in enumerate(series("S", 5_000, 9, 1))]
    specs = [ind.Ema(50), ind.Rsi(14), ind.SuperTrend(2, 1.0), ind.Vwap("Quarter")]
    frame = ind.with_indicators(spark.createDataFrame(part, SCHEMA).repartition(4), specs, "1m", 1_440)
    found = {r["bucket"]: r for r in frame.collect()}
    for spec in specs:
        for r, wanted in zip(part, expected(part, spec)):
            assert same(found[r[1]][spec.name], wanted), (spec.name, r[1])
    # What is partitioned by symbol alone has a bounded frame.
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and re.search(r"\], \[symbol#\d+\], \[", line)]
    assert windows and not any("unboundedpreceding" in line for line in windows)
    assert plan.count("_parent") and tree.depth(1, tree.FAN) == 2 and tree.depth(30, tree.FAN) == 1


@pytest.mark.parametrize("fan", [2, 3])
def test_deep_trees_give_the_same_rows(spark, monkeypatch, fan):
    monkeypatch.setattr(tree, "FAN", fan)
    monkeypatch.setattr(tree, "DAYS", 27 if fan == 3 else 15)  # three to four levels; the top takes what is left
    part = series("S", 60, 4, 1)
    specs = [ind.Ema(5), ind.SuperTrend(3, 0.5), ind.SuperTrend(10, 3.0), ind.Vwap("Week")]
    found = {r["bucket"]: r for r in ind.with_indicators(spark.createDataFrame(part, SCHEMA), specs, "1m", 1_440).collect()}
    for spec in specs:
        for r, wanted in zip(part, expected(part, spec)):
            assert same(found[r[1]][spec.name], wanted), (spec.name, r[1])


def test_atr_and_window_vwap(spark):
    part = series("S", 300, 7, 1)
    rows = spark.createDataFrame(part, SCHEMA).repartition(3)
    atr = {r["bucket"]: r for r in ind.with_atr(rows, 10, "1m", 1_440).collect()}
    vwap = {r["bucket"]: r for r in ind.with_vwap(rows).collect()}
    for r, range_, mean in zip(part, expected_ranges(part), expected_atr(part, 10)):
        assert same(atr[r[1]]["true_range"], range_) and same(atr[r[1]]["atr"], mean)
    for anchor, start in STARTS.items():
        for r, wanted in zip(part, expected_vwap(part, start)):
            assert same(vwap[r[1]][f"vwap_{anchor.lower()}"], wanted)


def test_known_sequences(spark):
    base = datetime(2024, 1, 1)
    shapes = {"FLAT": [5.0] * 6, "UP": [1.0, 2.0, 3.0, 4.0], "DOWN": [4.0, 3.0, 2.0, 1.0]}
    rows = [
        (s, base + timedelta(days=i), x, x, x, x, 10) for s, xs in shapes.items() for i, x in enumerate(xs)
    ]
    specs = [ind.Ema(3), ind.Rsi(3), ind.Ama(), ind.Vwap("Year"), ind.SuperTrend()]
    frame = ind.with_indicators(spark.createDataFrame(rows, SCHEMA), specs, "Day").orderBy("bucket").collect()
    flat = [r for r in frame if r["symbol"] == "FLAT"]
    assert all(same(r[c], 5.0) for r in flat for c in ("ema_3", "ama_10_2_30", "vwap_year"))
    assert all(r["rsi_3"] == 100.0 for r in flat)
    assert all(r["supertrend_10_3"] is None for r in frame)
    assert [r["rsi_3"] for r in frame if r["symbol"] == "UP"] == [100.0] * 4
    assert [r["rsi_3"] for r in frame if r["symbol"] == "DOWN"] == [100.0, 0.0, 0.0, 0.0]


steps = st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6)), min_size=1, max_size=25)


@settings(max_examples=300, deadline=None)
@given(steps, st.integers(-8, 8))
def test_band_pieces_equal_the_run(pairs, start):
    before = np.array([p for p, _ in pairs], float)
    basic = np.array([b for _, b in pairs], float)
    for u in (float(start), start + 0.5):
        assert apply_pieces(band_pieces(before, basic), u) == run_band(before, basic, u)[-1]


@settings(max_examples=500, deadline=None)
@given(st.lists(steps, min_size=1, max_size=6))
def test_composed_pieces_equal_the_run(parts):
    whole = None
    for pairs in parts:
        one = band_pieces(*(np.array(x, float) for x in zip(*pairs)))
        whole = one if whole is None else compose_pieces(whole, one)
    before, basic = (np.array(x, float) for x in zip(*(pair for pairs in parts for pair in pairs)))
    for u in [*range(-8, 9), *(i + 0.5 for i in range(-8, 8))]:
        assert apply_pieces(whole, float(u)) == run_band(before, basic, float(u))[-1]
    values = whole[3::2]
    assert all(a != b for a, b in zip(values, values[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.floats(-5, 5)), min_size=1, max_size=40), st.floats(-9, 9))
def test_compose_equals_the_run(pairs, start):
    factor, term = compose(np.array([f for f, _ in pairs]), np.array([t for _, t in pairs]))
    y = start
    for i, (f, t) in enumerate(pairs):
        y = f * y + t
        assert math.isclose(factor[i] * start + term[i], y, rel_tol=1e-9, abs_tol=1e-9)
    whole, added = compose_all(np.array([f for f, _ in pairs]), np.array([t for _, t in pairs]))
    assert math.isclose(whole * start + added, y, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 4)] * 3), min_size=1, max_size=30), st.booleans())
def test_sides_equal_the_run(rows, rising):
    close, upper, lower = (np.array(x, float) for x in zip(*rows))
    side, wanted = rising, []
    for c, u, d in rows:
        side = not c < d if side else c > u
        wanted.append(side)
    assert run_sides(close, upper, lower, rising).tolist() == wanted


def test_raw_rows_are_read_once(spark):
    """All passes start from the same shuffled bars; no window holds a whole symbol's bars."""
    from conftest import DATA

    from barloom.operators import bars
    from barloom.queries import views

    rows = bars.aggregate_bars(views.m1(spark, DATA), "1m")
    frame = ind.with_indicators(rows, SPECS, "1m", 1_440)
    assert frame.count() > 0
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    windows = [line for line in plan.splitlines() if " Window [" in line]
    per_symbol = [line for line in windows if "_chunk#" not in line.rsplit("], [", 2)[1]]
    assert windows and all("collect_list(" in line for line in per_symbol)
