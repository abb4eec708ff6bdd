"""Operator 12: a Merkle manifest of a table, its proofs by checkpoint and recompute.

Rows are leaves; each group (source) has a tree over its leaves by key, and the groups' roots
have one tree above them. Three consecutive nodes give one of the next level. Only every fourth
level is stored, as blocks of 81 consecutive nodes: a block is the base of one aligned subtree
whose four levels are made again from it wherever they are needed and then forgotten.

Building climbs from stored level to stored level. Proofs descend: a block takes the proof of
the node above it, makes its subtree's inner nodes again and gives each of its nodes the
siblings of four levels followed by that proof. At the leaves' level the proof is used up in
the task that made it. No step holds more than a block, however large a group is.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.store import Store

#: Nodes of a run, levels between stored ones, nodes of a stored block, characters of a digest.
FAN, LEVELS = 3, 4
SPAN = FAN**LEVELS
DIGEST = 64


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def up(nodes: list[str]) -> list[str]:
    """The next level over a level's nodes."""
    return [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]


def height(n: int) -> int:
    """Levels above a level of n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def siblings(nodes: list[str], levels: int) -> list[str]:
    """For each node of an aligned block, the others of its run, level by level, as one string."""
    out = ["" for _ in nodes]
    for level in range(levels):
        for j in range(len(out)):
            i = j // FAN**level
            first = i // FAN * FAN
            out[j] += "".join(nodes[first:i] + nodes[i + 1 : first + FAN])
        nodes = up(nodes)
    return out


def fold(node: str, place: int, n: int, proof: str) -> tuple[str, str]:
    """(top node, rest of the proof) of the leaf or node at `place` of a level of n nodes."""
    while n > 1:
        first = place // FAN * FAN
        others = DIGEST * (min(FAN, n - first) - 1)
        mine = DIGEST * (place - first)
        node = digest(proof[:mine] + node + proof[mine:others])
        proof, place, n = proof[others:], place // FAN, -(-n // FAN)
    return node, proof


def leaf(*values: Column) -> Column:
    """The digest of a row: `-` for null, else the value's bytes in UTF-8, a colon and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _placed(store: Store, name: str, rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` (tree, ...) with place (from 0, in its tree by `order`) and n (rows of its tree).

    Rows are sorted by ranges, so a large tree lies in many partitions; a place is the row's
    position in its partition and the rows of the tree in the partitions before.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = store.put(name, ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    runs = ranged.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n"))
    return ranged.join(runs, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _blocks(rows: DataFrame, *carried: str) -> DataFrame:
    """Rows (tree, n, place, node, carried) as one row a block, its nodes in order."""
    member = F.struct("place", "node", *carried)
    by = ["tree", "n", F.floor(F.col("place") / SPAN).cast("long").alias("block")]
    return rows.groupBy(*by).agg(F.array_sort(F.collect_list(member)).alias("members"))


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 32) -> Iterator[pa.RecordBatch]:
    """A few blocks at a time: their proofs are longer than they are."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _climb(blocks: DataFrame) -> DataFrame:
    """The next stored level: (tree, n, place, node), one node a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, counts = [], []
            for n, nodes in zip(batch["n"].to_pylist(), batch["nodes"].to_pylist()):
                levels = min(LEVELS, height(n))
                for _ in range(levels):
                    nodes, n = up(nodes), -(-n // FAN)
                tops.append(nodes[0])
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch["tree"], pa.array(counts, pa.int64()), batch["block"], pa.array(tops, pa.string())], names=["tree", "n", "place", "node"])

    return blocks.select("tree", "n", "block", F.col("members.node").alias("nodes")).mapInArrow(run, "tree string, n long, place long, node string")


def _stored_levels(store: Store, name: str, rows: DataFrame, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """Every fourth level of all trees, as blocks, and the trees' top nodes (tree, node)."""
    levels = []
    while True:
        if levels and not rows.where("n > 1").head(1):
            return levels, rows.select("tree", "node")
        levels.append(store.put(f"{name}-{len(levels)}", _blocks(rows, *(carried if not levels else ()))))
        rows = store.put(f"{name}-{len(levels)}-tops", _climb(levels[-1]))


def _descend(blocks: DataFrame, above: DataFrame, tops: list[str]) -> DataFrame:
    """Proofs (tree, place, proof, tops) of a stored level's nodes, from the proofs of the level above it."""
    joined = blocks.join(above, (blocks["tree"] == above["tree"]) & (blocks["block"] == above["place"]))
    joined = joined.select(blocks["tree"], *tops, "n", F.col("members")[0]["place"].alias("base"), F.col("members.node").alias("nodes"), F.col("proof").alias("above"))
    own = ["tree", *tops]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            rows, places, proofs = [], [], []
            for k, (n, base, nodes, rest) in enumerate(zip(*(batch[c].to_pylist() for c in ("n", "base", "nodes", "above")))):
                for j, proof in enumerate(siblings(nodes, min(LEVELS, height(n)))):
                    rows.append(k)
                    places.append(base + j)
                    proofs.append(proof + rest)
            take = pa.array(rows, pa.int64())
            columns = [*(batch[c].take(take) for c in own), pa.array(places, pa.int64()), pa.array(proofs, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*own, "place", "proof"])

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    return joined.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in own) + ", place long, proof string")


def _proofs(store: Store, name: str, levels: list[DataFrame], above: DataFrame, tops: list[str]) -> DataFrame:
    """Proofs of the lowest of `levels`, each level's from the one above it."""
    for turn, blocks in reversed(list(enumerate(levels))):
        above = store.put(f"{name}-{turn}-proofs", _descend(blocks, above, tops))
    return above


#: What all leaves of a tree share.
TOPS = ["subroot", "root", "source_place", "n_sources"]

_LEAF = "doc_id long, source string, place long, n_leaves long, leaf string, subroot string, root string, source_place long, n_sources long, proof string, folded_root string, verified boolean"


def manifest(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """The tree over `leaves` (source, doc_id, leaf, claimed) with a proof of every leaf.

    Per leaf: doc_id, source, its place among the n_leaves of its source, leaf, subroot, root, the
    source's place among n_sources, proof (the siblings' digests as hex text, level by level up to
    the root, each run from left to right), folded_root (the root that the proof gives for
    `claimed`) and verified (that it equals root).

    Leaves ascend by doc_id in their source, null ids first and equal ids by their digest, so
    repeated rows are leaves of their own and the manifest doesn't depend on the rows' order.
    Sources ascend by their UTF-8 bytes, the null one first. An empty table has no leaf and gives
    no row. A lone leaf is its source's subroot and a lone source's subroot is the root; their
    proof is what is above them, or empty. Further columns are not read.
    """
    store = Store(spark, "merkle")
    tree = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")).alias("tree")
    rows = leaves.select(tree, F.col("doc_id").cast("long").alias("doc_id"), F.col("leaf").alias("node"), "claimed")
    rows = store.put("leaves-hashed", rows)  # sorting by ranges reads its input twice
    levels, subroots = _stored_levels(store, "leaves", _placed(store, "leaves-in-order", rows, ["doc_id", "node", "claimed"]), "doc_id", "claimed")

    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    upper, root = _stored_levels(store, "sources", _placed(store, "sources-in-order", sources, ["name"]), "name")
    top = root.select("tree", F.lit(0).cast("long").alias("place"), F.lit("").alias("proof"), F.col("node").alias("root"))
    found = _proofs(store, "sources", upper, top, ["root"])
    named = upper[0].select(F.col("n").alias("n_sources"), F.explode("members").alias("m")).select("n_sources", F.col("m.place").alias("source_place"), F.col("m.name").alias("tree"), F.col("m.node").alias("subroot"))
    above = named.join(found.drop("tree"), named["source_place"] == found["place"]).drop("place").withColumn("place", F.lit(0).cast("long"))
    above = store.put("sources-proofs", above.select("tree", "place", "proof", *TOPS))

    return _audited(levels[0], _proofs(store, "leaves", levels[1:], above, TOPS))


def _audited(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The leaves of each block with their proofs, and the root folded from what each leaf claims."""
    joined = blocks.join(above, (blocks["tree"] == above["tree"]) & (blocks["block"] == above["place"]))
    joined = joined.select(blocks["tree"], "n", "members", "proof", *TOPS)
    schema = pa.schema([(name, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[kind]) for name, kind in map(str.split, _LEAF.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            out: list[tuple] = []
            for block in batch.to_pylist():
                n, members, source = block["n"], block["members"], block["tree"][1:] if block["tree"] else None
                for m, own in zip(members, siblings([m["node"] for m in members], min(LEVELS, height(n)))):
                    proof = own + block["proof"]
                    got, rest = fold(m["claimed"], m["place"], n, proof)
                    got = fold(got, block["source_place"], block["n_sources"], rest)[0]
                    out.append((m["doc_id"], source, m["place"], n, m["node"], *(block[c] for c in TOPS), proof, got, got == block["root"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return joined.mapInArrow(run, _LEAF)
