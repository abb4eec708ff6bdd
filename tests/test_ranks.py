"""Ranks and quantiles against sorting in one place."""

import math
import random

import numpy as np
import pytest

from barloom.operators.ranks import dense_ids, in_ranges, quantiles
from barloom.operators.sets import surrogate_ids
from barloom.operators.stats import describe

WANTED = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}


@pytest.fixture(scope="module")
def values(spark):
    """One symbol has most rows, one has one value many times, some have one row or none but nulls."""
    rng = random.Random(5)
    rows = [("BIG", round(rng.gauss(100, 30), 2)) for _ in range(20000)]
    rows += [("TIED", 7.0)] * 500 + [("TIED", 8.0)] * 499
    rows += [("ONE", -1.5), ("PAIR", 1.0), ("PAIR", 2.0), ("VOID", None), (None, 3.0), (None, 9.0), ("BIG", None), ("ZERO", 0.0), ("ZERO", -0.0)]
    rows += [(f"S{i}", rng.random()) for i in range(200) for _ in range(i % 7)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "symbol string, x double").repartition(5)


def test_quantiles_equal_sorting(spark, values):
    got = {r["symbol"]: r for r in quantiles(frame(spark, values), ["symbol"], "x", WANTED).collect()}
    groups = {}
    for symbol, x in values:
        if x is not None:
            groups.setdefault(symbol, []).append(x)
    assert got.keys() == groups.keys()
    for symbol, xs in groups.items():
        for name, p in WANTED.items():
            assert got[symbol][name] == pytest.approx(np.quantile(xs, p), rel=1e-12, abs=1e-12)


def test_nan_and_infinity(spark):
    rows = [("A", 1.0), ("A", math.nan), ("A", 2.0), ("B", math.inf), ("B", math.inf), ("C", -math.inf), ("C", 5.0), ("C", 6.0)]
    got = {r["symbol"]: (r["p50"], r["p100"]) for r in quantiles(frame(spark, rows), ["symbol"], "x", {"p50": 0.5, "p100": 1.0}).collect()}
    assert got["A"][0] == 2.0 and math.isnan(got["A"][1])
    assert got["B"] == (math.inf, math.inf) and got["C"] == (5.0, 6.0)


def test_quantiles_of_nothing(spark):
    assert quantiles(frame(spark, [("A", None)]), ["symbol"], "x", WANTED).count() == 0
    assert quantiles(frame(spark, []), ["symbol"], "x", WANTED).count() == 0


def test_a_symbol_with_most_rows_spans_ranges(spark, values):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = in_ranges(frame(spark, values).where("x IS NOT NULL").distinct(), ["symbol", "x"])
        sizes = [r["count"] for r in ranged.where("symbol = 'BIG'").groupBy("_range").count().collect()]
        got = {r["symbol"]: r["p50"] for r in quantiles(frame(spark, values), ["symbol"], "x", {"p50": 0.5}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)
    assert got["BIG"] == pytest.approx(np.median([x for s, x in values if s == "BIG" and x is not None]))


def test_ids_are_dense_and_ordered(spark):
    names = [f"{'SAME PREFIX ' if i % 3 else ''}{i * 7919 % 5000:04}é" for i in range(5000)]
    names = list(dict.fromkeys(names))
    rows = spark.createDataFrame([(n,) for n in names + names[:50]], "symbol string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["symbol"]: r["id"] for r in surrogate_ids(rows).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {n: i for i, n in enumerate(sorted(names, key=str.encode))}
    assert [tuple(r) for r in dense_ids(spark.createDataFrame([("b",), (None,), ("a",)], "v string"), "v", "n").sort("n").collect()] == [(None, 0), ("a", 1), ("b", 2)]
    assert surrogate_ids(rows.limit(0)).count() == 0


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_plans_hold_no_value_buffer_and_no_window_over_all(spark, values):
    rows = frame(spark, values)
    assert "percentile" not in plan(describe(rows, ["x"]))
    ids = surrogate_ids(rows.select("symbol"))
    windows = [line for line in plan(ids).splitlines() if "Window" in line]
    assert windows and all("_range" in line for line in windows)


def test_describe_keeps_fields_without_values(spark):
    rows = spark.createDataFrame([("A", 1.0, None), ("A", 4.0, None)], "symbol string, x double, y double")
    got = {r["field"]: r for r in describe(rows, ["x", "y"]).collect()}
    assert (got["x"]["n"], got["x"]["p25"], got["x"]["p50"], got["x"]["max"]) == (2, 1.75, 2.5, 4.0)
    assert got["y"]["n"] == 0 and got["y"]["p50"] is None
