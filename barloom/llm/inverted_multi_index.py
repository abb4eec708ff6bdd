"""Operator 9: nearest neighbours by largest inner product over an inverted multi-index.

The two halves of the vectors have a codebook each; a cell is a pair of centroids. A query's
inner product with a cell is the sum of its halves' products with the two centroids, so a heap
over the two sorted lists of products gives the cells from the nearest on. The cells' vectors
are reranked by the exact product. How many candidates a query gathers is calibrated: on a
bounded sample of queries, against all vectors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.store import Store
from barloom.llm.vectors import as_doubles, matrix

#: Vectors that the codebooks are fitted on, centroids of a half, vectors of one block of a list.
SAMPLE, CENTROIDS, BLOCK = 10_000, 512, 4096

#: Queries that are compared with a block at once, and queries (about) that one task holds.
TILE, QUERIES = 256, 16_384

#: Queries of the calibration, and the share of their true neighbours that it has to reach.
PROBES, WANTED = 48, 0.97


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids of at most `k` clusters after ten rounds of Lloyd's algorithm."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(10):
        near = nearest(x, centres)
        n = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, x[:, j], len(centres)) for j in range(x.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


class Index:
    """Codebooks of both halves and the number of vectors in each cell."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.left, self.right, self.half = left, right, left.shape[1]
        self.sizes = np.zeros((len(left), len(right)), np.int64)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, : self.half], self.left), nearest(x[:, self.half :], self.right)

    def traverse(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells by falling sum of the two halves' inner products; each cell once."""
        a, b = self.left @ query[: self.half], self.right @ query[self.half :]
        rows, columns = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[rows].tolist(), b[columns].tolist()
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(rows[i]), int(columns[j])
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))

    def visits(self, query: np.ndarray, wanted: int) -> dict[int, list[int]]:
        """The right cells to visit by left cell, until they hold `wanted` vectors."""
        out: dict[int, list[int]] = {}
        got = 0
        for i, j in self.traverse(query):
            if got >= wanted:
                break
            if self.sizes[i, j]:
                out.setdefault(i, []).append(j)
                got += int(self.sizes[i, j])
        return out


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


_HIT = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]


def _hits(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    n = [len(r[1]) for r in rows]
    columns = [np.repeat(np.array([r[0] for r in rows], np.int64), n), *(np.concatenate([r[i] for r in rows]) if rows else np.zeros(0) for i in (1, 2))]
    return pa.table([pa.array(c).cast(t) for c, (_, t) in zip(columns, _HIT)], names=[x for x, _ in _HIT])


def _exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed alike whatever else is in the block."""
    return np.einsum("qd,vd->qv", queries, vectors, optimize=False)


def _search(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return _hits([])
        ids, c2 = vectors["vec_id"].to_numpy(), vectors["c2"].to_numpy()
        x = matrix(vectors["vector"].combine_chunks())
        q_ids, q = queries["query_id"].to_numpy(), matrix(queries["query"].combine_chunks())
        lists = [np.asarray(cells.values) for cells in queries["cells"].combine_chunks()]
        # Queries that visit alike cells share a tile, so that a tile meets few vectors that it needn't.
        order = sorted(range(len(lists)), key=lambda n: (len(lists[n]), lists[n][:4].tolist()))
        out = []
        for at in range(0, len(order), TILE):
            tile = order[at : at + TILE]
            cells = np.unique(np.concatenate([lists[n] for n in tile]))
            visited = np.zeros((len(tile), len(cells)), bool)
            for row, n in enumerate(tile):
                visited[row, np.searchsorted(cells, lists[n])] = True
            near = np.flatnonzero(np.isin(c2, cells))
            out += _tile(q_ids[tile], q[tile], ids[near], x[near], visited[:, np.searchsorted(cells, c2[near])], k)
        return _hits(out)

    return run


def _tile(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, visited: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's `k` best of the vectors it visits; a matrix product finds who can be among them."""
    # A product of either kind is off by far less than this, so no vector of the best is left out.
    slack = 1e-12 * np.linalg.norm(q, axis=1) * (np.linalg.norm(x, axis=1).max() if len(x) else 0.0)
    rough = np.where(visited & (ids[None, :] != q_ids[:, None]), q @ x.T, -np.inf)
    edge = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(q), -np.inf)
    out = []
    for n in range(len(q)):
        some = np.flatnonzero((rough[n] >= edge[n] - slack[n]) & (rough[n] > -np.inf))
        if len(some):
            scores = _exact(q[n : n + 1], x[some])[0]
            best = _top(ids[some], scores, k)
            out.append((int(q_ids[n]), ids[some][best], scores[best]))
    return out


def _brute(q_ids: np.ndarray, q: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            rows = []
            for n, scores in enumerate(_exact(q, x)):
                other = ids != q_ids[n]
                best = _top(ids[other], scores[other], k)
                rows.append((int(q_ids[n]), ids[other][best], scores[other][best]))
            yield from _hits(rows).to_batches()

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    embeddings: DataFrame, k: int = 20, query_every: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", wanted: float = WANTED
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each query, by inner product.

    Queries are the rows whose id is divisible by `query_every`, candidates all rows but the
    query's own; ties go to the smaller id. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do null ids; an id counts once. A query with fewer
    candidates than `k` gets them all; an empty table gives no rows. Codebooks are fitted on at
    most SAMPLE vectors and reach the driver with the cells' sizes (CENTROIDS squared at most);
    all vectors are indexed, and lists of any length are searched in blocks.
    """
    spark = embeddings.sparkSession
    store = Store(spark, "multi_index")
    vectors = store.put("vectors", as_doubles(embeddings, id_column, vector_column, unit=False))
    n = vectors.count()
    hits = "query_id long, vec_id long, score double"
    if n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chance = F.xxhash64(F.lit(9), "vec_id")
    sample = matrix(vectors.orderBy(chance).limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks())
    half = sample.shape[1] // 2 or 1
    # About 12 vectors a cell, as long as the number of cells is bounded.
    size = min(CENTROIDS, max(1, round(math.sqrt(n / 12))))
    index = Index(kmeans(sample[:, :half], size, 1), kmeans(sample[:, half:], size, 2) if sample.shape[1] > half else np.zeros((1, 0)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c1, c2 = index.cells(matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32))], names=["vec_id", "vector", "c1", "c2"])

    lists = store.put("lists", vectors.mapInArrow(assign, "vec_id long, vector binary, c1 int, c2 int"))
    for r in lists.groupBy("c1", "c2").count().collect():
        index.sizes[r["c1"], r["c2"]] = r["count"]

    queries = vectors.where(F.col("vec_id") % query_every == 0)
    probes = queries.orderBy(chance).limit(PROBES).toArrow()
    if not probes.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    q_ids, q = probes["vec_id"].to_numpy(), matrix(probes["vector"].combine_chunks())
    true = _best(vectors.mapInArrow(_brute(q_ids, q, k), hits), k).join(lists.select("vec_id", "c1", "c2"), "vec_id").select("query_id", "c1", "c2").collect()
    by_query: dict[int, list[tuple[int, int]]] = {}
    for r in true:
        by_query.setdefault(r["query_id"], []).append((r["c1"], r["c2"]))
    needs: list[int] = []
    for query_id, query in zip(q_ids.tolist(), q):
        # Candidates gathered by the time each true neighbour's cell has been reached.
        got, left = 0, by_query.get(query_id, [])
        for cell in index.traverse(query):
            got += int(index.sizes[cell])
            needs += [got] * left.count(cell)
            left = [c for c in left if c != cell]
            if not left:
                break
    gather = max(2 * k, math.ceil(float(np.quantile(needs, wanted, method="higher"))) if needs else 0)

    blocks = [-(-int(row.sum()) // BLOCK) or 1 for row in index.sizes]
    of_list = F.element_at(F.array(*map(F.lit, blocks)), F.col("c1") + 1)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for query_id, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for c1, cells in index.visits(np.frombuffer(blob, np.float64), gather).items():
                    rows += [(query_id, blob, c1, b, cells) for b in range(blocks[c1])]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "query", "c1", "block", "cells"])

    visits = queries.mapInArrow(plan, "query_id long, query binary, c1 int, block int, cells array<int>")
    parts = lists.withColumn("block", F.pmod(F.xxhash64("vec_id"), of_list).cast("int"))
    # Queries are dealt to groups of bounded size, so that a list meets them in several tasks.
    turns = -(-queries.count() // QUERIES)
    parts = parts.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    visits = visits.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int"))
    keys = ["c1", "block", "turn"]
    found = parts.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(lambda v, u: _search(k)(v, u), hits)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
