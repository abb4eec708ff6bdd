"""Operator 11: exact top-k search by tiled matrix products.

Vectors are dealt to shards and queries to blocks of bounded size. A tile is one block against
one shard: a task multiplies the two matrices, selects each query's best k of the tile and
returns only those. The lists of a query are then merged as a tree: 32 shards' lists give one,
until one is left. Components become floor(scale * x), so that scores are whole numbers:
products are summed exactly, whatever the order and the tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.store import Store, shuffle_partitions

#: Most vectors of a shard and queries of a block, queries multiplied at once, lists merged into one.
SHARD, BLOCK, STRIP, FAN = 8192, 8192, 256, 32

#: Smaller shards than this aren't made to occupy more tasks: each gives a list a query.
LEAST = 512

_HIT = "query_id long, node long, vec_id long, score long"


def _whole(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            with np.errstate(over="ignore"):
                x = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            if not (np.abs(x) < 2.0**63).all():
                raise ValueError("A component times the scale is too large for a long")
            ends = np.zeros(len(lists) + 1, np.int64)
            np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), out=ends[1:])
            offsets = pa.py_buffer((ends * 8).astype(np.int32))
            blobs = pa.Array.from_buffers(pa.binary(), len(lists), [None, offsets, pa.py_buffer(x.astype(np.int64))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), blobs], names=["id", "dim", "vector"])

    return run


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """(id, dim, vector) of the rows that take part; vector is floor(scale * x) as bytes of longs."""
    rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & finite).mapInArrow(_whole(scale), "id long, dim long, vector binary")


def _matrix(blobs: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), np.int64).reshape(len(blobs), dim)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; in doubles where all sums stay below 2**53, else in longs."""
    bound = float(np.abs(queries.astype(np.float64)).max(0, initial=0.0) @ np.abs(vectors.astype(np.float64)).max(0, initial=0.0))
    if bound < 2.0**52:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if bound < 2.0**62:
        return queries @ vectors.T
    raise ValueError("An inner product can be too large for a long")


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k largest of each row (all, if fewer); of equal ones the first columns."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
    above, level = scores > edge, scores == edge
    return above | level & (np.cumsum(level, axis=1) <= k - above.sum(1, keepdims=True))


def _tile(k: int):
    none = np.iinfo(np.int64).min

    def run(key: tuple, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        dim, shard = key[0].as_py(), key[2].as_py()
        hits: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
        if vectors.num_rows and queries.num_rows:
            ids = vectors["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], _matrix(vectors["vector"], dim)[order]
            firsts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            ids = ids[firsts]
            q_ids, q = queries["id"].to_numpy(), _matrix(queries["vector"], dim)
            for at in range(0, len(q), STRIP):
                strip = q_ids[at : at + STRIP]
                scores = products(q[at : at + STRIP], x)
                if len(firsts) < len(x):  # rows of one id: the best one counts
                    scores = np.maximum.reduceat(scores, firsts, axis=1)
                own = np.minimum(np.searchsorted(ids, strip), len(ids) - 1)
                rows = np.flatnonzero(ids[own] == strip)
                scores[rows, own[rows]] = none
                rows, columns = np.nonzero(select(scores, k) & (scores > none))
                hits.append((strip[rows], ids[columns], scores[rows, columns]))
        q_id, vec_id, score = (np.concatenate([h[i] for h in hits]) for i in range(3))
        return pa.table([q_id, np.full(len(q_id), shard, np.int64), vec_id, score], names=["query_id", "node", "vec_id", "score"])

    return run


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """Of each (query_id, node) the k best distinct vectors, ranked."""
    best = lists.repartition("query_id", "node").groupBy("query_id", "node", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def exact_top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, scale: float = 1024, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of every query the k vectors of other ids with the largest product.

    Both tables hold ids and arrays; components count as floor(scale * x). Scores are exact; ties
    go to the smaller id. All vectors are compared with all queries, in tiles of bounded size,
    which are dealt by their number: a shard is read once for each block of queries, a block
    once for each shard, and no key of the data decides where a row goes.

    Rows whose id or vector is null, or whose vector holds a null or a component that isn't
    finite, take no part; zero vectors do. Rows of one id count once, with their best score, as
    queries too. Vectors of different length aren't compared. A query with fewer than k others
    gets all; without any it gives no row, and so does an empty table. Products that could leave
    the range of a long are an error. Further columns are not read.
    """
    spark = vectors.sparkSession
    store = Store(spark, "exact_topk")
    number = F.monotonically_increasing_id().alias("number")
    v = store.put("vectors", whole_vectors(vectors, id_column, vector_column, scale).select("*", number))
    q = store.put("queries", whole_vectors(queries, id_column, vector_column, scale).select("*", number))
    n = v.count()
    shards = max(-(-n // SHARD), min(-(-n // LEAST), 2 * shuffle_partitions(spark)), 1)
    blocks = max(-(-q.count() // BLOCK), 1)

    # Consecutive numbers go to different shards, and so to different tasks.
    v = v.select("id", "dim", "vector", (F.col("number") % shards).alias("shard"), _numbers(blocks).alias("block"))
    q = q.select("id", "dim", "vector", (F.col("number") % blocks).alias("block"), _numbers(shards).alias("shard"))
    tile = ["dim", "block", "shard"]
    lists = store.put("lists-0", v.groupBy(*tile).cogroup(q.groupBy(*tile)).applyInArrow(_tile(k), _HIT))
    turn = 0
    while shards > FAN:
        shards, turn = -(-shards // FAN), turn + 1
        above = lists.withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
        lists = store.put(f"lists-{turn}", _merged(above, k).drop("rank"))
    return _merged(lists.withColumn("node", F.lit(0).cast("long")), k).select("query_id", "rank", "vec_id", "score")
