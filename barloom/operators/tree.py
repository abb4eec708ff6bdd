"""Prefix compositions over the slabs of a symbol, as a tree of bounded groups.

Slabs are numbered by their days; node n of one level is the parent of the nodes of the
level below whose number divided by `FAN` is n. Going up, the summaries of a parent's nodes
are composed; at the top a symbol has at most `FAN` nodes, whose states follow from the first
one; going down, a parent's state gives those of its nodes. No task holds more than the
`FAN` small summaries of one parent, however many slabs a symbol has. The depth is the
logarithm of the slabs that `DAYS` have: slabs of 30 days, the shortest in production, fit
below one node, shorter ones take more levels. Dates further apart are as right; only the
top node of their symbol then has more below it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.slabs import CHUNK

FAN = 4096
#: 328 years.
DAYS = 120_000
PARENT = "_parent"

Row = dict


def depth(days: int, fan: int) -> int:
    """Levels so that the highest has at most `fan` nodes a symbol (one more where they don't start at a multiple)."""
    levels, nodes = 1, -(-DAYS // days)
    while nodes > fan:
        levels, nodes = levels + 1, -(-nodes // fan)
    return levels


def _rows(table: pa.Table) -> list[Row]:
    return table.sort_by(CHUNK).to_pylist()


def states_before(
    summaries: DataFrame,
    days: int,
    then: Callable[[Row, Row], Row],
    advance: Callable[[Row, Row], Row],
    start: Callable[[Row], Row],
    part: pa.Schema,
    state: pa.Schema,
    kinds: dict[pa.DataType, str],
) -> DataFrame:
    """(symbol, slab, state columns): the state before each slab.

    `summaries` holds symbol, slab and the columns of `part`. `then(a, b)` composes two
    neighbouring summaries, `advance(s, a)` gives the state after a, `start(all)` the state
    before a symbol's first slab from the composition of all its slabs.
    """
    fan = FAN
    key = [pa.field("symbol", pa.string()), pa.field(CHUNK, pa.int32())]
    part_rows, state_rows = pa.schema([*key, *part]), pa.schema([*key, *state])
    part_ddl, state_ddl = (", ".join(f"{f.name} {kinds[f.type]}" for f in schema) for schema in (part_rows, state_rows))

    def parents(frame: DataFrame) -> DataFrame:
        return frame.select(*part_rows.names, F.floor(F.col(CHUNK) / F.lit(fan)).cast("int").alias(PARENT))

    def up(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        return pa.Table.from_pylist([{**reduce(then, rows), "symbol": rows[0]["symbol"], CHUNK: rows[0][PARENT]}], part_rows)

    def along(rows: list[Row], before: Row) -> pa.Table:
        found = []
        for row in rows:
            found.append({**before, "symbol": row["symbol"], CHUNK: row[CHUNK]})
            before = advance(before, row)
        return pa.Table.from_pylist(found, state_rows)

    def top(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        return along(rows, start(reduce(then, rows)))

    def down(table: pa.Table, above: pa.Table) -> pa.Table:
        return along(_rows(table), above.to_pylist()[0])

    levels = [parents(summaries)]
    for _ in range(depth(days, fan) - 1):
        levels.append(parents(levels[-1].groupBy("symbol", PARENT).applyInArrow(up, part_ddl)))
    found = levels.pop().groupBy("symbol").applyInArrow(top, state_ddl)
    for level in reversed(levels):
        found = level.groupBy("symbol", PARENT).cogroup(found.groupBy("symbol", CHUNK)).applyInArrow(down, state_ddl)
    return found
