"""Recurrences over every symbol's bars, slab by slab, with exact carries.

Pass 1 sums up each slab as a function of the state before it; the few numbers per
slab are composed in a tree (`operators.tree`), which gives the state before each; the
last pass runs each slab from its exact state. The sides of trends need the finished
bands, hence one pass and one tree in between. All passes read the same shuffled input,
which Spark computes once (exchange reuse).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.recurrences import (
    Smooth,
    Total,
    Trend,
    apply_pieces,
    band_pieces,
    compose,
    compose_all,
    compose_pieces,
    numbers,
    run_band,
    run_sides,
)
from barloom.operators.slabs import CHUNK
from barloom.operators.tree import Row, states_before

KEY = f"symbol string, {CHUNK} int"
SUMMARY = f"{KEY}, bars long, factors array<double>, terms array<double>, upper array<array<double>>, lower array<array<double>>"
SIDES = f"{KEY}, from_falling array<boolean>, from_rising array<boolean>"

DOUBLES, FLAGS = pa.list_(pa.float64()), pa.list_(pa.bool_())
PIECES = pa.list_(DOUBLES)
KINDS = {
    pa.string(): "string", pa.int32(): "int", pa.int64(): "long",
    DOUBLES: "array<double>", FLAGS: "array<boolean>", PIECES: "array<array<double>>",
}
PART = pa.schema([("bars", pa.int64()), ("factors", DOUBLES), ("terms", DOUBLES), ("upper", PIECES), ("lower", PIECES)])
STATE = pa.schema([("carry", DOUBLES), ("upper", DOUBLES), ("lower", DOUBLES), ("symbol_bars", pa.int64())])
SIDES_PART = pa.schema([("from_falling", FLAGS), ("from_rising", FLAGS)])
SIDES_STATE = pa.schema([("rising", FLAGS)])


def in_order(table: pa.Table) -> pa.Table:
    """By bucket. After the windows rows arrive in this order, but Spark promises only groups."""
    stamps = table["bucket"].to_numpy()
    return table if bool(np.all(stamps[:-1] <= stamps[1:])) else table.sort_by("bucket")


def one_row(table: pa.Table, **values) -> pa.Table:
    return pa.table({"symbol": table["symbol"][:1], CHUNK: table[CHUNK][:1], **values})


def summarise(table: pa.Table, scans: list[Smooth | Total], trends: list[Trend]) -> pa.Table:
    table = in_order(table)
    ends = [compose_all(*scan.steps(table)) for scan in scans]
    return one_row(
        table,
        bars=[table.num_rows],
        factors=pa.array([[factor for factor, _ in ends]], DOUBLES),
        terms=pa.array([[term for _, term in ends]], DOUBLES),
        upper=pa.array([[band_pieces(*t.upper_steps(table)) for t in trends]], pa.list_(DOUBLES)),
        lower=pa.array([[band_pieces(*t.lower_steps(table)) for t in trends]], pa.list_(DOUBLES)),
    )


def after(first: Row, second: Row) -> Row:
    """Two neighbouring parts of a symbol's bars as one."""
    steps = list(zip(first["factors"], first["terms"], second["factors"], second["terms"]))
    return {
        "bars": first["bars"] + second["bars"],
        "factors": [g * f for f, _, g, _ in steps],
        "terms": [g * t + u for _, t, g, u in steps],
        **{side: [compose_pieces(p, q) for p, q in zip(first[side], second[side])] for side in ("upper", "lower")},
    }


def advance(state: Row, part: Row) -> Row:
    return {
        "carry": [f * y + t for f, t, y in zip(part["factors"], part["terms"], state["carry"])],
        **{side: [apply_pieces(p, u) for p, u in zip(part[side], state[side])] for side in ("upper", "lower")},
        "symbol_bars": state["symbol_bars"],
    }


def fresh(whole: Row) -> Row:
    """The state before a symbol's first bar; it counts for nothing there."""
    zeros = [0.0] * len(whole["upper"])
    return {"carry": [0.0] * len(whole["factors"]), "upper": zeros, "lower": zeros, "symbol_bars": whole["bars"]}


def sides_after(first: Row, second: Row) -> Row:
    return {
        start: [rise if up else fall for up, fall, rise in zip(first[start], second["from_falling"], second["from_rising"])]
        for start in ("from_falling", "from_rising")
    }


def advance_sides(state: Row, part: Row) -> Row:
    return {"rising": [rise if up else fall for up, fall, rise in zip(state["rising"], part["from_falling"], part["from_rising"])]}


def bands(table: pa.Table, trend: Trend, upper: float, lower: float) -> tuple[np.ndarray, np.ndarray]:
    return run_band(*trend.upper_steps(table), upper), -run_band(*trend.lower_steps(table), lower)


def summarise_sides(table: pa.Table, state: pa.Table, trends: list[Trend]) -> pa.Table:
    """The side each trend ends on from either side."""
    table, start = in_order(table), state.to_pylist()[0]
    close = numbers(table, "close")
    ends: dict[bool, list[bool]] = {False: [], True: []}
    for trend, upper, lower in zip(trends, start["upper"], start["lower"]):
        both = bands(table, trend, upper, lower)
        for side, found in ends.items():
            found.append(bool(run_sides(close, *both, side)[-1]))
    return one_row(table, from_falling=pa.array([ends[False]], FLAGS), from_rising=pa.array([ends[True]], FLAGS))


def finish(table: pa.Table, start: dict, scans: list[Smooth | Total], trends: list[Trend]) -> pa.Table:
    table = in_order(table)
    for scan, before in zip(scans, start["carry"]):
        factor, term = compose(*scan.steps(table))
        table = table.append_column(scan.output, pa.array(factor * before + term))
    for trend, u, d, side in zip(trends, start["upper"], start["lower"], start["rising"]):
        upper, lower = bands(table, trend, u, d)
        rising = run_sides(numbers(table, "close"), upper, lower, side)
        unknown = np.full(table.num_rows, start["symbol_bars"] < trend.period)
        table = table.append_column(trend.output, pa.array(np.where(rising, lower, upper), mask=unknown))
    return table


def run_scans(rows: DataFrame, scans: list[Smooth | Total], trends: list[Trend], days: int | None) -> DataFrame:
    """Add one DOUBLE column per recurrence to rows with `_chunk` and `_first`."""
    added = [T.StructField(r.output, T.DoubleType()) for r in [*scans, *trends]]
    schema = T.StructType([*rows.schema.fields, *added])
    slabs = rows.groupBy("symbol", CHUNK)
    if days is None:
        first = {"carry": [0.0] * len(scans), "upper": [0.0] * len(trends), "lower": [0.0] * len(trends)}
        first["rising"] = [True] * len(trends)
        return slabs.applyInArrow(lambda table: finish(table, {**first, "symbol_bars": table.num_rows}, scans, trends), schema)
    summary = slabs.applyInArrow(lambda table: summarise(table, scans, trends), SUMMARY)
    state = states_before(summary, days, after, advance, fresh, PART, STATE, KINDS)
    if trends:
        ends = slabs.cogroup(state.groupBy("symbol", CHUNK)).applyInArrow(
            lambda table, start: summarise_sides(table, start, trends), SIDES
        )
        rising = {"rising": [True] * len(trends)}
        sides = states_before(ends, days, sides_after, advance_sides, lambda _: rising, SIDES_PART, SIDES_STATE, KINDS)
        state = state.join(sides, ["symbol", CHUNK])
    else:
        state = state.withColumn("rising", F.array().cast("array<boolean>"))
    return slabs.cogroup(state.groupBy("symbol", CHUNK)).applyInArrow(
        lambda table, start: finish(table, start.to_pylist()[0], scans, trends), schema
    )
