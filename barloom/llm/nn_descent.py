"""Operator 8: near duplicates of embeddings by nearest-neighbour descent.

Each vector keeps a list of its nearest neighbours found so far. A start puts each vector into the
cells of its nearest pivots (vectors drawn from the table), and within a cell, in one task, into
blocks about further pivots; a vector that lies about as near to a second pivot goes there too.
Vectors of a block are compared with one another. Those at the threshold are linked, all of them;
of the others each lists its nearest that are near enough to share a link. A round of the descent
compares the neighbours (in both directions) of each vector with one another and keeps what
improves a list, until few lists change. Pairs at the threshold are edges.

Links of a block are not bounded by a list's length, and lists hold only vectors outside the own
component of the links found so far: no list ends saturated, however many copies a group has.
Starts go on from other pivots until one adds next to nothing. Links inside a component are counted
in blocks that return counts, not pairs; equal vectors are compared once.

An audit compares a sample with all vectors, and a larger one until it holds enough links; a low
recall starts further rounds from new pivots, and the links that the descent missed are added.
Where links are too rare for any sample, the audit's is the whole table; where the recall stays
low, an audit of the whole table follows. The result is exact then. The descent runs whatever the
table's size, and no size chooses another method.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.components import components
from barloom.llm.store import Store, shuffle_partitions

THRESHOLD = 0.9

#: Two vectors that link with a third have this cosine or more, so lists hold no lower ones.
REACH = 2 * THRESHOLD**2 - 1

#: Neighbours kept, pivots that a vector goes to at most, vectors of a block about a pivot.
LIST, DIRECTIONS, BLOCK = 10, 3, 512

#: Vectors of a cell; a vector goes to a pivot that is less near than its nearest by no more than SLACK / sqrt(width).
CELL, SLACK = 16384, 0.25

#: Bytes of vectors that a task of cells gets, and ids at most that are broadcast.
CELL_BYTES, BROADCAST_IDS = 16 << 20, 1_000_000

#: Rounds end when fewer than this share of the entries changed, or after so many.
CHANGED, ROUNDS = 0.02, 5

#: Audited vectors at first, the recall they must show, and starts at most that miss it.
AUDITED, RECALL, STARTS = 256, 0.98, 3

#: Links that an audit must hold, and by how much its sample grows until it does.
AUDIT_LINKS, AUDIT_GROWTH = 100, 16

#: Starts at most, whatever they find, and the share of new links below which they end; else an audit of the whole table follows.
ALL_STARTS, SETTLED = 12, 0.0005

#: Bytes and vectors of a block when an audit compares many vectors.
EXACT_BYTES, EXACT_ROWS = 2 << 20, 4096

#: Vectors of one block when a component is counted.
COUNT_BLOCK = 2048

#: Vectors of a tile when a block is compared.
TILE = 256

#: Bits of a vector's hash in the key that sorts the rows of a task, below its cell.
HASH_BITS = 44

_PAIRS = "u long, w long, s double"


def _pairs(u: np.ndarray, w: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(w, pa.int64()), pa.array(s, pa.float64())], names=["u", "w", "s"])


def _raw(blobs: pa.Array) -> np.ndarray:
    """Rows of a binary column as bytes; all have one length."""
    if not len(blobs):
        return np.zeros((0, 0), np.uint8)
    ends = np.frombuffer(blobs.buffers()[1], np.int64 if pa.types.is_large_binary(blobs.type) else np.int32)[blobs.offset : blobs.offset + len(blobs) + 1]
    return np.frombuffer(blobs.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(blobs), -1)


def _unit(raw: np.ndarray, kind: str) -> np.ndarray:
    """Vectors of length 1 from the bytes of their elements."""
    if not len(raw):
        return np.zeros((0, 0))
    x = np.ascontiguousarray(raw).view(kind).astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _cosines(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (x[i], y[j]) in full precision."""
    return np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", x[i[k : k + 65536]], y[j[k : k + 65536]]) for k in range(0, len(i), 65536))])


def _margin(width: int) -> float:
    """What a cosine in single precision may be off at most."""
    return 1e-6 + 1.2e-7 * width


def _linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs reach the threshold: single precision decides, but for those near it."""
    s, margin = x.astype(np.float32) @ y.astype(np.float32).T, _margin(x.shape[1])
    links = s >= THRESHOLD + margin
    near = s >= THRESHOLD - margin
    if near.any():
        i, j = np.nonzero(near ^ links)
        links[i, j] = _cosines(x, i, y, j) >= THRESHOLD
    return links


def _at_least(s: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Where a table has this or more; quick where few rows do."""
    some = s >= least
    rows = np.flatnonzero(some.any(1))
    i, j = np.nonzero(some[rows])
    return rows[i], j


def _links(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) that reach the threshold, for few of them among many."""
    single, margin, found = x.astype(np.float32), _margin(x.shape[1]), [np.zeros((2, 0), np.int64)]
    for k in range(0, len(y), TILE):
        i, j = _at_least(single @ y[k : k + TILE].astype(np.float32).T, THRESHOLD - margin)
        links = _cosines(x, i, y, j + k) >= THRESHOLD
        found.append(np.stack([i[links], j[links] + k]))
    i, j = np.concatenate(found, 1)
    return i, j


def _nearest(ids: np.ndarray, x: np.ndarray, own: np.ndarray, worst: np.ndarray | float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The LIST best of other components for each row within a block, if better than its `worst`."""
    s = x @ x.T
    s[own[:, None] == own[None, :]] = -2
    k = min(LIST, len(ids) - 1)
    best = np.argpartition(-s, k - 1, axis=1)[:, :k]
    top = np.take_along_axis(s, best, 1)
    i, j = np.nonzero(top > np.broadcast_to(worst, len(ids))[:, None])
    return ids[i], ids[best[i, j]], top[i, j]


def _best(u: np.ndarray, w: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The LIST best pairs of each u."""
    order = np.lexsort((w, -s, u))
    u, w, s = u[order], w[order], s[order]
    new = np.flatnonzero(np.r_[True, u[1:] != u[:-1]][: len(u)])
    rank = np.arange(len(u)) - np.repeat(new, np.diff(np.r_[new, len(u)]))
    keep = rank < LIST
    return u[keep], w[keep], s[keep]


def _merged(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the least row of its component) after the links (i, j)."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _pivoted(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, pivot): each row with its nearest pivot and with up to DIRECTIONS of them that are about as near."""
    rows, ways = [], []
    for at in range(0, len(x), 4096):
        s = x[at : at + 4096] @ pivots.T
        every = np.arange(len(s))
        least = s.max(1) - SLACK / x.shape[1] ** 0.5
        for _ in range(min(DIRECTIONS, len(pivots))):
            way = s.argmax(1)
            near = np.flatnonzero(s[every, way] >= least)
            rows.append(near + at)
            ways.append(way[near])
            s[every, way] = -9
    return np.concatenate(rows), np.concatenate(ways)


def _parted(x: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of blocks of about BLOCK vectors that are near one another."""
    rng, todo = np.random.default_rng(len(x)), [np.arange(len(x))]
    while todo:
        block = todo.pop()
        if len(block) <= 2 * BLOCK:
            yield block
            continue
        pivots = x[rng.choice(block, min(256, -(-2 * len(block) // BLOCK)), replace=False)]
        rows, ways = _pivoted(x[block], pivots)
        order = np.argsort(ways, kind="stable")
        for part in np.split(block[rows[order]], np.flatnonzero(np.diff(ways[order])) + 1):
            if len(part) > 0.9 * len(block):  # no pivot tells these apart
                yield part
            elif len(part) > 1:
                todo.append(part)


def _block(x: np.ndarray, single: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Labels of what the links of a block of rows connect; the LIST best of other labels of each, as (u, w, s)."""
    label, lists, margin, single = np.arange(len(rows)), [], _margin(x.shape[1]), single[rows]
    for p in range(0, len(rows), TILE):
        for q in range(p, len(rows), TILE):
            s = single[p : p + TILE] @ single[q : q + TILE].T
            if p == q:
                np.fill_diagonal(s, -2)
            i, j = _at_least(s, REACH)
            if not len(i):
                continue
            s, i, j = s[i, j].astype(np.float64), i + p, j + q
            if p == q:
                s, i, j = s[i < j], i[i < j], j[i < j]
            close = np.flatnonzero(np.abs(s - THRESHOLD) <= margin)
            if len(close):
                s[close] = _cosines(x, rows[i[close]], x, rows[j[close]])
            links = s >= THRESHOLD
            label = _merged(label, i[links], j[links])
            apart = ~links & (label[i] != label[j])
            if apart.any():
                i, j, s = i[apart], j[apart], s[apart]
                lists.append(_best(np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([s, s])))
    return label, lists


def _cell(ids: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What the blocks of a cell connect, as (u, w, null), and each row's list in the cell, as (u, w, s)."""
    single, every = x.astype(np.float32), np.arange(len(x))
    none = np.zeros(0, np.int64)
    stars, lists = [(none, none)], [(none, none, np.zeros(0))]
    for rows in _parted(single):
        label, found = _block(x, single, rows)
        linked = np.flatnonzero(label != every[: len(rows)])
        stars.append((rows[label[linked]], rows[linked]))
        if found:
            u, w, s = (np.concatenate(column) for column in zip(*found))
            apart = label[u] != label[w]
            u, w, s = _best(u[apart], w[apart], s[apart])
            lists.append((rows[u], rows[w], s))
    label = _merged(every, *(np.concatenate(column) for column in zip(*stars)))
    linked = np.flatnonzero(label != every)
    if len(linked):
        yield pa.RecordBatch.from_arrays([pa.array(ids[label[linked]]), pa.array(ids[linked]), pa.nulls(len(linked), pa.float64())], names=["u", "w", "s"])
    u, w, s = (np.concatenate(column) for column in zip(*lists))
    # Two blocks may hold the same pair.
    once = np.unique(u * len(x) + w, return_index=True)[1]
    once = once[label[u[once]] != label[w[once]]]
    if len(once):
        u, w, s = _best(u[once], w[once], s[once])
        yield _pairs(ids[u], ids[w], s)


def _cells(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """From rows (vec_id, vector, key), sorted by the key of cell and hash; equal vectors follow one another and count once."""
    held, ids, raws, last = None, [], [], None

    def ended() -> Iterator[pa.RecordBatch]:
        if sum(map(len, ids)) > 1:
            yield from _cell(np.concatenate(ids), _unit(np.concatenate(raws), kind))

    for batch in batches:
        for cell, first, rows in zip(*(c.tolist() for c in np.unique(batch.column(2).to_numpy() >> HASH_BITS, return_index=True, return_counts=True))):
            part = batch.slice(first, rows)
            if cell != held:
                yield from ended()
                held, ids, raws, last = cell, [], [], None
            names, raw, code = part.column(0).to_numpy(), _raw(part.column(1)), part.column(2).to_numpy()
            if last is not None:
                names, raw, code = np.r_[last[0], names], np.concatenate([last[1], raw]), np.r_[last[2], code]
            again = np.zeros(len(names), bool)
            alike = np.flatnonzero(code[1:] == code[:-1]) + 1
            again[alike] = (raw[alike] == raw[alike - 1]).all(1)
            first_of = names[np.maximum.accumulate(np.where(again, 0, np.arange(len(names))))]
            if again.any():
                yield pa.RecordBatch.from_arrays([pa.array(first_of[again]), pa.array(names[again]), pa.nulls(int(again.sum()), pa.float64())], names=["u", "w", "s"])
            new = ~again
            new[0] &= last is None
            ids.append(names[new])
            raws.append(raw[new])
            last = first_of[-1:], raw[-1:], code[-1:]
    yield from ended()


def _local_join(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """From (v, [(neighbour, vector, its component, its list's worst)]): better pairs among the neighbours."""
    for batch in batches:
        us, ws, ss = [], [], []
        for group in batch.column(1):
            rows = group.values
            ids = rows.field("u").to_numpy()
            if len(ids) < 2:
                continue
            found = _nearest(ids, _unit(_raw(rows.field("vector")), kind), rows.field("component").to_numpy(), rows.field("worst").to_numpy())
            for kept, new in zip((us, ws, ss), found):
                kept.append(new)
        if us:
            yield _pairs(np.concatenate(us), np.concatenate(ws), np.concatenate(ss))


def _once(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u", "w").agg(F.max("s").alias("s"))


def _lists(once: DataFrame) -> DataFrame:
    """The LIST best of each vector: (u, near array<struct<s, w>>), nearest first; no pair may occur twice."""
    # The rank's limit acts before the shuffle, so a vector that many list costs each task LIST rows.
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "w"))
    best = once.withColumn("rank", rank).where(F.col("rank") <= LIST)
    return best.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("s", "w")), asc=False).alias("near"))


def _descend(store: Store, name: str, vectors: DataFrame, pairs: DataFrame, kind: str) -> DataFrame:
    """Pairs (u, w, s) of the lists after the rounds that start from `pairs`."""
    lists = store.put(f"{name}-0", _lists(_once(pairs)))
    total = lists.count() * LIST
    for turn in range(1, ROUNDS + 1 if total else 1):
        flat = lists.select("u", F.explode("near").alias("e")).select("u", "e.w", "e.s")
        # Of those that list a vector, the LIST nearest take part, as in sampled NN-descent.
        reverse = _lists(flat.select(F.col("w").alias("u"), F.col("u").alias("w"), "s")).select("u", F.explode("near").alias("e")).select("u", "e.w", "e.s")
        around = flat.select("u", "w").unionByName(reverse.select("u", "w")).unionByName(lists.select("u", F.col("u").alias("w"))).distinct()
        worst = lists.select("u", F.when(F.size("near") < LIST, F.lit(REACH)).otherwise(F.col("near")[LIST - 1]["s"]).alias("worst"))
        known = vectors.join(worst, F.col("vec_id") == F.col("u"), "left").select(F.col("vec_id").alias("w"), "vector", "component", F.coalesce("worst", F.lit(REACH)).alias("worst"))
        groups = around.join(known, "w").groupBy("u").agg(F.collect_list(F.struct(F.col("w").alias("u"), "vector", "component", "worst")).alias("rows"))
        better = _once(groups.mapInArrow(partial(_local_join, kind=kind), _PAIRS))
        fresh = store.put(f"{name}-fresh-{turn}", better.join(flat.select("u", "w"), ["u", "w"], "left_anti"))
        lists = store.put(f"{name}-{turn}", _lists(flat.unionByName(fresh)))
        if fresh.count() < CHANGED * total:
            break
    return lists.select("u", F.explode("near").alias("e")).select("u", "e.w", "e.s")


def _counted(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Links of the vectors of two blocks, (vec_id, n), from rows (component, i, j, side, vec_id, vector, copies) sorted by the first four."""
    held, key = [], None

    def counted() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        ids, copies, left = rows["vec_id"].to_numpy(), rows["copies"].to_numpy(), rows["side"].to_numpy() == 0
        x, n = _unit(_raw(rows["vector"].combine_chunks()), kind), np.zeros(len(ids), np.int64)
        if key[1] == key[2]:  # a block with itself: a vector's own copies are links
            links = _linked(x, x)
            np.fill_diagonal(links, True)
            n += links @ copies
        elif left.any() and not left.all():
            links = _linked(x[left], x[~left])
            n[left], n[~left] = links @ copies[~left], links.T @ copies[left]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["vec_id", "n"])

    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
        for p, q in pairwise([0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]):
            if q > p:
                if held and key != keys[p].tolist():
                    yield counted()
                    held = []
                key = keys[p].tolist()
                held.append(batch.slice(p, q - p))
    if held:
        yield counted()


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as rows (block, ids, vectors) of EXACT_ROWS or about EXACT_BYTES at most."""
    task, n = TaskContext.get().partitionId() << 32, 0
    ids: list[bytes] = []
    blobs: list[bytes] = []

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([task + n], pa.int64()), pa.array([b"".join(ids)], pa.binary()), pa.array([b"".join(blobs)], pa.binary())], names=["block", "ids", "vectors"])

    for batch in batches:
        for name, blob in zip(batch.column(0).to_numpy(), batch.column(1).to_pylist()):
            ids.append(name.astype("<i8").tobytes())
            blobs.append(blob)
            if len(ids) >= EXACT_ROWS or len(ids) * len(blob) >= EXACT_BYTES:
                yield block()
                ids, blobs, n = [], [], n + 1
    if ids:
        yield block()


def _forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) that connect what all links of a table left x right connect; fewer than its rows and columns."""
    rows, columns = [], []
    new_row, new_column = links.any(1), np.ones(links.shape[1], bool)
    for first in np.flatnonzero(new_row):
        if not new_row[first]:
            continue
        new_row[first] = False
        level = np.array([first])
        while len(level):
            reached = np.flatnonzero(links[level].any(0) & new_column)
            new_column[reached] = False
            rows.append(level[links[np.ix_(level, reached)].argmax(0)])
            columns.append(reached)
            level = np.flatnonzero(links[:, reached].any(1) & new_row)
            new_row[level] = False
            rows.append(level)
            columns.append(reached[links[np.ix_(level, reached)].argmax(1)] if len(level) else reached[:0])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *columns])


def _compared(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """From two blocks each: (a, b, null) of connecting links and (a, null, links of a); a block with itself counts once."""
    for batch in batches:
        for row in batch.to_pylist():
            u, w = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["ids2"], "<i8")
            x, y = (_unit(np.frombuffer(row[k], np.uint8).reshape(n, -1), kind) for k, n in (("vectors", len(u)), ("vectors2", len(w))))
            links = _linked(x, y) & (u[:, None] != w[None, :])
            if not links.any():
                continue
            i, j = _forest(links)
            counts = [(u, links.sum(1))] + ([(w, links.sum(0))] if row["mirrored"] else [])
            a = np.concatenate([u[i], *(ids[n > 0] for ids, n in counts)])
            n = np.concatenate([n[n > 0] for _, n in counts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.concat_arrays([pa.array(w[j]), pa.nulls(len(n), pa.int64())]), pa.concat_arrays([pa.nulls(len(i), pa.int64()), pa.array(n.astype(np.int64))])], names=["a", "b", "n"]
            )


def _blocks(store: Store, name: str, vectors: DataFrame, width: int) -> DataFrame:
    """Vectors as blocks, of one size and spread over as many partitions."""
    total = vectors.count()
    spread = vectors.repartition(max(1, -(-total * width * 8 // EXACT_BYTES), -(-total // EXACT_ROWS)))
    return store.put(name, spread.mapInArrow(_in_blocks, "block long, ids binary, vectors binary"))


def _search(store: Store, name: str, left: DataFrame, right: DataFrame, mirrored: bool, kind: str) -> DataFrame:
    """(a, b, n) of all block pairs; `mirrored` if both sides are the same blocks, so each pair is compared once."""
    pairs = left.crossJoin(right.toDF("block2", "ids2", "vectors2"))
    if mirrored:
        pairs = pairs.where("block <= block2")
    pairs = pairs.withColumn("mirrored", F.lit(mirrored) & (F.col("block") != F.col("block2")))
    return store.put(name, pairs.mapInArrow(partial(_compared, kind=kind), "a long, b long, n long"))


def _whole(store: Store, vectors: DataFrame, width: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """The audit of the whole table: links (u, w) that connect what all do, and (vec_id, n), each vector's links."""
    blocks = _blocks(store, "all-blocks", vectors, width)
    found = _search(store, "whole", blocks, blocks, True, kind)
    links = found.where("b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("w"))
    return links, found.where("n IS NOT NULL").groupBy(F.col("a").alias("vec_id")).agg(F.sum("n").alias("n"))


def near_duplicates(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", exact: int = 0) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row, by cosine of THRESHOLD or more.

    `n_links` counts the links found with other vectors, `component_id` is the smallest id
    reachable by links, `kept` marks the row that has that id. Vectors that are null, zero or hold null or
    non-finite components link with nothing, nor do null ids (their component is null); an id
    that occurs twice counts once and comes back twice. An empty table gives an empty one.
    Vectors must have one length; further columns are ignored. The audit that follows the descent
    takes `exact` vectors at least, all of them in tables that have no more.
    """
    spark = embeddings.sparkSession
    store = Store(spark, "nn_descent")
    element = "float" if embeddings.schema[vector_column].dataType.simpleString() == "array<float>" else "double"
    kind = {"float": "<f4", "double": "<f8"}[element]
    vectors = _vectors(store, embeddings, id_column, vector_column, element)
    everything = embeddings.select(F.col(id_column).cast("long").alias("vec_id"))
    first = vectors.select("vector").first()
    edges, counts = spark.createDataFrame([], "a long, b long"), None
    if first is not None:
        edges, counts = _edges(store, vectors, len(first["vector"]) // np.dtype(kind).itemsize, vectors.count(), exact, kind)
    found = store.put("found", components(store, "components", edges))
    if counts is None:
        counts = _counts(store, vectors, found, kind)
    known = found.join(counts, found["node"] == counts["vec_id"], "left").select(F.col("node").alias("vec_id"), "component", "n")
    out = everything.join(known, "vec_id", "left").select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _vectors(store: Store, embeddings: DataFrame, id_column: str, vector_column: str, element: str) -> DataFrame:
    """(vec_id, vector) of the usable rows, one of each id, as the bytes of their elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().fill_null(np.nan).to_numpy()
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(1)).to_numpy())])
            good = np.logical_and.reduceat(np.isfinite(x), ends[:-1]) & np.logical_or.reduceat(x != 0, ends[:-1])
            blobs = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])
            yield pa.RecordBatch.from_arrays([batch.column(0), blobs], names=["vec_id", "vector"]).filter(pa.array(good))

    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(f"array<{element}>").alias("v"))
    rows = store.put("vectors", rows.where("vec_id IS NOT NULL AND size(v) > 0").mapInArrow(run, "vec_id long, vector binary"))
    # Vectors are shuffled by their ids only if an id occurs twice.
    if rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        return rows
    return store.put("vectors-once", rows.dropDuplicates(["vec_id"]))


def _audit(store: Store, vectors: DataFrame, width: int, total: int, least: int, kind: str) -> DataFrame | None:
    """Links (u, w) of a sample of `least` vectors or more, that holds AUDIT_LINKS of them, with all vectors; None if only the whole table does."""

    def audit(sample: pa.Table, name: str) -> DataFrame:
        ids, x = sample["vec_id"].to_numpy(), _unit(_raw(sample["vector"].combine_chunks()), kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    other, (i, j) = batch.column(0).to_numpy(), _links(x, _unit(_raw(batch.column(1)), kind))
                    i, j = i[ids[i] != other[j]], j[ids[i] != other[j]]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(other[j])], names=["u", "w"])

        return store.put(name, vectors.mapInArrow(run, "u long, w long"))

    size = AUDITED
    true = audit(vectors.orderBy(F.xxhash64(F.lit(8), "vec_id")).limit(AUDITED).toArrow(), "audit")
    blocks = None
    while size < least or true.count() < AUDIT_LINKS:
        size = max(least, size * AUDIT_GROWTH)
        if size >= total:
            return None
        sample = vectors.where(F.pmod(F.xxhash64(F.lit(8), "vec_id"), F.lit(total)) < size)
        if size <= EXACT_ROWS:
            if (rows := sample.toArrow()).num_rows:
                true = audit(rows, f"audit-{size}")
            continue
        blocks = blocks or _blocks(store, "blocks", vectors, width)
        found = _search(store, f"audit-{size}-search", _blocks(store, f"audit-{size}-blocks", sample, width), blocks, False, kind)
        true = found.where("b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("w"))
    return true


def _start(vectors: DataFrame, pool: np.ndarray, cells: int, start: int, total: int, kind: str) -> DataFrame:
    """(u, w, null) of what the cells of a start connect, and (u, w, s) of their lists; pivots are drawn from the pool."""
    rng = np.random.default_rng(start)
    pivots = pool[rng.permutation(len(pool))[:cells]].astype(np.float32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _unit(_raw(batch.column(1)), kind).astype(np.float32)
                rows, ways = _pivoted(x, pivots) if len(pivots) > 1 else (np.arange(len(x)), np.zeros(len(x), np.int64))
                keys = (ways << HASH_BITS) | (batch.column(2).to_numpy()[rows].view(np.uint64) >> (64 - HASH_BITS)).astype(np.int64)
                placed = batch.select([0, 1]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*placed.columns, pa.array(keys), pa.array(ways.astype(np.int32))], names=["vec_id", "vector", "key", "cell"])

    # The hash differs by start, so blocks of a start have pivots of their own.
    placed = vectors.select("vec_id", "vector", F.xxhash64(F.lit(start), "vector").alias("hash")).mapInArrow(place, "vec_id long, vector binary, key long, cell int")
    size = total * pool.shape[1] * np.dtype(kind).itemsize * 2
    tasks = max(min(cells, shuffle_partitions(vectors.sparkSession)), int(size // CELL_BYTES))
    return placed.repartition(tasks, "cell").drop("cell").sortWithinPartitions("key").mapInArrow(partial(_cells, kind=kind), _PAIRS)


def _apart(pairs: DataFrame, joined: DataFrame, u: str, w: str) -> DataFrame:
    """The pairs whose ends aren't in one component."""
    both = pairs.join(joined.toDF(u, "c1"), u, "left").join(joined.toDF(w, "c2"), w, "left")
    return both.where(F.coalesce("c1", u) != F.coalesce("c2", w)).select(pairs.columns)


def _edges(store: Store, vectors: DataFrame, width: int, total: int, least: int, kind: str) -> tuple[DataFrame, DataFrame | None]:
    """Edges (a, b) with the components of the descent's links and the audit's; (vec_id, n) if that was of the whole table."""
    spark = store.spark
    true = _audit(store, vectors, width, total, least, kind)
    cells = max(-(-total // CELL), min(shuffle_partitions(spark), total // BLOCK), 1)
    drawn = vectors.where(F.pmod(F.xxhash64(F.lit(9), "vec_id"), F.lit(total)) < 4 * cells).toArrow().sort_by("vec_id")
    pool = _unit(_raw(drawn["vector"].combine_chunks()), kind).reshape(-1, width)
    pairs = spark.createDataFrame([], _PAIRS)
    joined = spark.createDataFrame([], "node long, component long")
    missed, ended = 0, False

    def join(name: str, edges: DataFrame) -> int:
        """Adds edges between components; how many there were."""
        nonlocal joined
        if more := edges.count():
            joined = components(store, name, edges.unionByName(joined.select(F.col("component").alias("a"), F.col("node").alias("b"))))
        return more

    # What one start leaves out, an audit of the whole table has.
    for start in range(1 if true is None else ALL_STARTS):
        near = store.put(f"near-{start}", _start(vectors, pool, cells, start, total, kind))
        links = near.where("s IS NULL").select(F.col("u").alias("a"), F.col("w").alias("b")).distinct()
        more = join(f"links-{start}", store.put(f"blocks-{start}", _apart(links, joined, "a", "b")))
        # Of the pairs so far, those between two components still count.
        pairs = store.put(f"pairs-{start}", _apart(_once(pairs.unionByName(near.where("s IS NOT NULL"))), joined, "u", "w"))
        listed = store.put(f"listed-{start}", pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("w").alias("node"))).distinct())
        some = F.broadcast(listed) if listed.count() <= BROADCAST_IDS else listed
        own = vectors.join(some, F.col("vec_id") == F.col("node"), "left_semi").join(joined, F.col("vec_id") == F.col("node"), "left")
        own = store.put(f"own-{start}", own.select("vec_id", "vector", F.coalesce("component", "vec_id").alias("component")))
        pairs = _descend(store, f"lists-{start}", own, pairs, kind)
        edges = store.put(f"edges-{start}", pairs.where(F.col("s") >= THRESHOLD).select(F.col("u").alias("a"), F.col("w").alias("b")))
        more += join(f"descent-{start}", edges)
        store.tidy()
        if true is None:
            break
        # A link counts as found if both ends are in one component: counting finds it there.
        both = true.join(joined.toDF("u", "c1"), "u", "left").join(joined.toDF("w", "c2"), "w", "left")
        row = both.agg(F.count("*").alias("n"), F.sum((F.col("c1") == F.col("c2")).cast("long")).alias("hit")).first()
        reached = (row["hit"] or 0) >= RECALL * row["n"]
        ended = reached and more <= SETTLED * joined.count()
        missed += not reached
        if ended or missed == STARTS:
            break
    counts = None
    if not ended:
        true, counts = _whole(store, vectors, width, kind)
    # A star per component and the audited edges connect what all edges would.
    return joined.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(true.select(F.col("u").alias("a"), F.col("w").alias("b"))), counts


def _counts(store: Store, vectors: DataFrame, found: DataFrame, kind: str) -> DataFrame:
    """(vec_id, n): links of each vector inside its component, compared block by block; equal vectors are compared once."""
    members = store.put("members", vectors.join(found, F.col("vec_id") == F.col("node")).select("component", "vec_id", "vector"))
    once = store.put("once", members.groupBy("component", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")))
    sizes = once.groupBy("component").agg(F.ceil(F.count("*") / COUNT_BLOCK).cast("int").alias("blocks"))
    rows = once.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    columns = "vec_id", "vector", "copies"
    left = rows.select("component", F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"), *columns)
    right = rows.where("block > 0").select("component", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"), *columns)
    tiles = left.unionByName(right).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "side")
    counted = tiles.mapInArrow(partial(_counted, kind=kind), "vec_id long, n long").groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))
    of = once.join(store.put("counted", counted), "vec_id").select("component", "vector", "n")
    return members.join(of, ["component", "vector"]).select("vec_id", "n")
