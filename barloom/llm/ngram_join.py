"""Operator 2: Jaccard self-join of word-shingle sets with PartEnum signatures.

Sets fall into size bands; a band's instance divides the feature domain into first-level
parts of three second-level parts each. Two sets of a link differ in at most k features, so
with more than k / 2 first-level parts one of them differs in at most one feature, and two of
its three second-level parts are equal: every set emits, for each part, the three pairs of
second-level parts as signatures. A set also emits for the instances of smaller partners.

Signatures of no feature would join unrelated sets. A part is strong for a set if none of its
three signatures is empty; a set with enough strong parts has a strong one among the equal
parts of any link, so it leaves its empty signatures out. Sets with too few emit them too.

Equal sets count as one class from the start. Signature groups are linked first as stars
around their smallest member; after the check, only groups that still span several components
are compared pair by pair. No link between different components is missed that way, and a
large family of near copies costs a star, not all its pairs.

A candidate is first held against parity sketches: two bit strings in which each feature flips
one bit differ in no more bits than the sets have different features, so pairs beyond the
bound can't link. What is left is checked on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.components import components
from barloom.llm.store import Store, parts_for, text_bytes
from barloom.llm.words import mix, shingle_sets, slices

#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80

#: Text bytes per signature bucket; a bucket's signatures take about as much memory.
BUCKET_BYTES = 16 << 20

#: Rows of one family's groups that a task compares.
FAMILY_ROWS = 10_000

#: Rows of a block of a larger group, documents of a tile's side, compared pairs that a task remembers.
GROUP_ROWS, TILE, SEEN = 2048, 1024, 1 << 22

_INFO = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.int64()), ("fp2", pa.int64()), ("sketch", pa.binary())])
_BLOB = pa.schema([("bucket", pa.int64()), ("sets", pa.binary()), ("counts", pa.binary()), ("signatures", pa.binary())])
_MEMBER = pa.schema([("gid", pa.int64()), ("fp", pa.int64())])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _fingerprint(s: np.ndarray, salt: int) -> int:
    return int(np.add.reduce(mix(s, salt)))


def band_of(sizes: np.ndarray) -> np.ndarray:
    """The band of each set size: lower bounds 4, 5, 6, 7, 8, 10, 12, ... by a quarter."""
    return np.searchsorted(_BOUNDS, sizes, "right") - 1


def _bounds() -> np.ndarray:
    out = [4]
    while out[-1] < 2**40:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return np.array(out, dtype=np.int64)


_BOUNDS = _bounds()


def parts_of(band: int) -> tuple[int, int]:
    """(first-level parts, parts that must be strong) of a band's instance."""
    smaller = int(_BOUNDS[band + 1]) - 1
    larger = smaller * 100 // PERCENT
    k = (smaller + larger) * (100 - PERCENT) // (100 + PERCENT)
    need = k // 2 + 1 if k else 0
    return need + (need + 19) // 20 if need > 1 else need, need


def set_signatures(sets: list[np.ndarray]) -> list[np.ndarray]:
    """PartEnum signatures of each set of mixed 64-bit features, computed band by band for all sets.

    Sets of fewer than four features have none: they link with equal sets only.
    """
    order = sorted((i for i, s in enumerate(sets) if len(s) >= 4), key=lambda i: len(sets[i]))
    if not order:
        return [np.zeros(0, np.uint64) for _ in sets]
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    ends = np.r_[0, np.cumsum(sizes)]
    features = np.concatenate([sets[i] for i in order])
    mixed = mix(features, 7)
    low, high = band_of(np.maximum(4, -(-sizes * PERCENT // 100))), band_of(sizes)
    found, owners = [], []
    for band in range(int(low[0]), int(high[-1]) + 1):
        parts, need = parts_of(band)
        # Both ends of a set's bands grow with its size, so the sets of a band are neighbours.
        a, b = int(np.searchsorted(high, band)), int(np.searchsorted(low, band, "right"))
        if not parts or a >= b:
            continue
        own = slice(int(ends[a]), int(ends[b]))
        # High bits choose the cell: the multiply-shift of 32 bits has no modulo bias to speak of.
        cell = (((features[own] >> np.uint64(32)) * np.uint64(3 * parts)) >> np.uint64(32)).astype(np.int64)
        cell += np.repeat(np.arange(b - a) * (3 * parts), sizes[a:b])
        sums = np.zeros((b - a) * 3 * parts, np.uint64)
        np.add.at(sums, cell, mixed[own])
        full = (np.bincount(cell, minlength=len(sums)) > 0).reshape(b - a, parts, 3)
        sums = mix(sums, 8).reshape(b - a, parts, 3)
        number = np.arange(parts, dtype=np.uint64) * np.uint64(3)
        sig = np.empty((b - a, 3, parts), np.uint64)
        some = np.empty((b - a, 3, parts), bool)
        for j, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
            sig[:, j] = mix(sums[:, :, x] * np.uint64(3) + sums[:, :, y] + mix(number + np.uint64(j), 100 + band))
            some[:, j] = full[:, :, x] | full[:, :, y]
        kept = some | (some.all(1).sum(1) < need)[:, None, None]
        found.append(sig[kept])
        owners.append(np.repeat(np.arange(a, b), kept.sum((1, 2))))
    out = [np.zeros(0, np.uint64) for _ in sets]
    if found:
        owner = np.concatenate(owners)
        counts = np.bincount(owner, minlength=len(order))
        flat = np.concatenate(found)[np.argsort(owner, kind="stable")]
        for i, own in zip(order, np.split(flat, np.cumsum(counts)[:-1])):
            out[i] = own
    return out


#: Bits of a parity sketch: a power of two, about four a feature between these.
SKETCH_BITS = 256, 4096


def sketch(s: np.ndarray) -> bytes:
    """Parities of the features in each cell of a power of two of cells."""
    bits = min(max(SKETCH_BITS[0], 1 << (4 * len(s)).bit_length()), SKETCH_BITS[1])
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """A sketch as it would be with `size` bytes."""
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)


def _info(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(_signed(np.array([_fingerprint(s, 1) for s in sets], np.uint64))),
                    pa.array(_signed(np.array([_fingerprint(s, 2) for s in sets], np.uint64))),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ],
                schema=_INFO,
            )


def _blobs(buckets: int):
    """Signatures by bucket: for each set its fingerprint and how many signatures follow."""

    def write(sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not sets:
            return
        counts = np.array([len(x) for x in sets.values()])
        sig = np.concatenate(list(sets.values()))
        who = np.repeat(np.array(list(sets), np.uint64), counts)
        bucket = ((sig >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sig, who, bucket = sig[order], who[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            runs = np.flatnonzero(np.r_[True, who[a + 1 : b] != who[a : b - 1], True])
            rows.append((int(bucket[a]), who[a:b][runs[:-1]].tobytes(), np.diff(runs).astype(np.uint32).tobytes(), sig[a:b].tobytes()))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BLOB.types)], schema=_BLOB)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for part in slices(batch, "text"):
                fresh = {_fingerprint(s, 1): s for s in shingle_sets(part.column(0)) if len(s) >= 4}
                fresh = {key: s for key, s in fresh.items() if key not in held}  # copies count once for each written batch
                for key, own in zip(fresh, set_signatures(list(fresh.values()))):
                    held[key] = own
                    size += len(own)
                if size >= 3 << 20:
                    yield from write(held)
                    held, size = {}, 0
        yield from write(held)

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets that share a signature, once for each different group of them in the partition."""
    sigs, whos = [], []
    for batch in batches:
        for sets, counts, sig in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            sigs.append(np.frombuffer(sig, np.uint64))
            whos.append(np.repeat(np.frombuffer(sets, np.uint64), np.frombuffer(counts, np.uint32)))
    if not sigs:
        return
    sig = np.concatenate(sigs)
    del sigs
    order = np.argsort(sig, kind="stable")
    sig = sig[order]
    shared = np.r_[False, sig[1:] == sig[:-1]]
    shared[:-1] |= shared[1:]
    who = np.concatenate(whos)[order[shared]]
    sig = sig[shared]
    del whos, order, shared
    order = np.lexsort((who, sig))
    sig, who = sig[order], who[order]
    new = np.r_[True, (sig[1:] != sig[:-1]) | (who[1:] != who[:-1])] if len(sig) else np.zeros(0, bool)
    sig, who = sig[new], who[new]
    if not len(sig):
        return
    starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    lengths = np.diff(np.r_[starts, len(sig)])
    gid = np.add.reduceat(mix(who, 9), starts)
    gid = mix(gid + lengths.astype(np.uint64), 10)
    _, first = np.unique(gid, return_index=True)
    first = first[lengths[first] > 1]
    for at in range(0, len(first), 1 << 16):
        some = first[at : at + (1 << 16)]
        n = lengths[some]
        index = np.repeat(starts[some], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield pa.RecordBatch.from_arrays([pa.array(_signed(np.repeat(gid[some], n))), pa.array(_signed(who[index]))], schema=_MEMBER)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in shingle_sets(part.column(1))], pa.binary())], names=["rep", "features"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(s, t, assume_unique=True))
            hit.append(100 * both >= PERCENT * (len(s) + len(t) - both))
        kept = pa.array(hit, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in (0, 1)], names=["a", "b"])


def _possible(n1, n2, apart):
    """Whether sizes and the sketches' distance (never above the true one) allow a link."""
    return (100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2)) & ((100 + PERCENT) * apart <= (100 - PERCENT) * (n1 + n2))


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n1, n2, s1, s2) that sizes and sketches allow."""
    for batch in batches:
        apart = []
        for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
            size = min(len(x), len(y))
            apart.append(int(np.bitwise_count(folded(np.frombuffer(x, np.uint8), size) ^ folded(np.frombuffer(y, np.uint8), size)).sum()))
        kept = pa.array(_possible(batch.column(2).to_numpy(), batch.column(3).to_numpy(), np.array(apart)))
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in (0, 1)], names=["a", "b"])


def _tiles(unit: np.ndarray, side: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents to compare with documents, at most `TILE` each, of every unit in turn."""
    cuts = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]).any(1), True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        left = np.unique(doc[a:b][side[a:b] != 1])
        right = np.unique(doc[a:b][side[a:b] != 0])
        for at in range(0, len(left), TILE):
            for to in range(at if side[a] == 2 else 0, len(right), TILE):
                yield left[at : at + TILE], right[to : to + TILE]


def _cross_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (gid, i, j, side, rep, component, n, sketch), sorted by the first three: pairs of a
    unit in different components that sizes and sketches allow.

    A unit is a group, or two blocks of a large one. Pairs are made tile by tile and forgotten;
    of the last `SEEN` ones is known that they were compared, so a pair of several groups mostly
    is compared once.
    """
    columns: list[list] = [[] for _ in range(8)]
    for batch in batches:
        for held, column in zip(columns, batch.columns):
            held.append(column.to_numpy(zero_copy_only=False) if held is not columns[7] else np.array(column.to_pylist(), dtype=object))
    if not columns[0]:
        return
    gid, low, high, side, rep, comp, n, bits = (np.concatenate(c) for c in columns)
    reps, first, doc = np.unique(rep, return_index=True, return_inverse=True)
    comp, n, bits = comp[first], n[first], bits[first]
    size = np.array([len(x) for x in bits])
    small = {int(w): np.stack([folded(np.frombuffer(x, np.uint8), w) if len(x) >= w else np.zeros(w, np.uint8) for x in bits]).view(np.uint64) for w in np.unique(size).tolist()}

    def likely(codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(codes), 1 << 18):
            i, j = np.divmod(codes[start : start + (1 << 18)], len(reps))
            width = np.minimum(size[i], size[j])
            apart = np.zeros(len(i), np.int64)
            for w, folded_bits in small.items():
                own = np.flatnonzero(width == w)
                for at in range(0, len(own), 1 << 14):
                    some = own[at : at + (1 << 14)]
                    apart[some] = np.bitwise_count(folded_bits[i[some]] ^ folded_bits[j[some]]).sum(1, dtype=np.int64)
            ok = _possible(n[i], n[j], apart)
            yield pa.RecordBatch.from_arrays([pa.array(reps[i[ok]]), pa.array(reps[j[ok]])], names=["a", "b"])

    seen, waiting, held = np.zeros(0, np.int64), [], 0
    for left, right in _tiles(np.stack([gid, low, high], axis=1), side, doc):
        i, j = np.meshgrid(left, right, indexing="ij")
        some = (i != j) & (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
        i, j = i[some], j[some]
        waiting.append(np.minimum(i, j) * len(reps) + np.maximum(i, j))
        held += len(i)
        if held > 1 << 18 or len(waiting) > 4096:
            fresh = np.setdiff1d(np.concatenate(waiting), seen)
            yield from likely(fresh)
            seen = np.union1d(seen, fresh) if len(seen) + len(fresh) <= SEEN else fresh
            waiting, held = [], 0
    if waiting:
        yield from likely(np.setdiff1d(np.concatenate(waiting), seen))


def ngram_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): near-duplicate components of documents.

    Documents link when the Jaccard similarity of their sets of 5-word shingles (words
    `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased) is at least 0.8; component_id is the smallest id
    reachable. A document with fewer than five words has its whole sequence as the one shingle;
    null, empty and blank texts have none and stay alone. Rows with a null id are compared like
    others under the id null and never are a component's smallest; repeated rows come back
    repeated. An empty table gives an empty one. Further columns are ignored.
    """
    spark = docs.sparkSession
    store = Store(spark, "ngram_join")
    text = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    info = store.put("info", text.mapInArrow(_info, "doc_id long, n_shingles long, fp long, fp2 long, sketch binary"))
    classes = store.put(
        "classes",
        info.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
    )

    buckets = parts_for(spark, text_bytes(text, "text"), BUCKET_BYTES)
    blobs = text.where("doc_id IS NOT NULL").select("text").mapInArrow(_blobs(buckets), "bucket long, sets binary, counts binary, signatures binary")
    members = blobs.repartition(buckets, "bucket").mapInArrow(_groups, "gid long, fp long").distinct()
    members = store.put("members", members.join(classes.select("fp", "rep"), "fp").select("gid", "rep"))
    sketches = classes.select("rep", "n", "sketch")

    def verified(name: str, pairs: DataFrame) -> DataFrame:
        """The links among `pairs`, on sets made anew from the texts of their documents alone."""
        pairs = store.put(f"{name}-pairs", pairs)
        ids = store.put(f"{name}-ids", pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
        own = text.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        feats = store.put(f"{name}-feats", own.select("doc_id", "text").mapInArrow(_features, "rep long, features binary"))
        with_a = pairs.join(feats.select(F.col("rep").alias("a"), F.col("features").alias("x")), "a")
        with_b = with_a.join(feats.select(F.col("rep").alias("b"), F.col("features").alias("y")), "b")
        return store.put(f"{name}-links", with_b.select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long"))

    pivots = members.groupBy("gid").agg(F.min("rep").alias("a"))
    stars = members.join(pivots, "gid").where("rep > a").select("a", F.col("rep").alias("b")).distinct()
    stars = stars.join(sketches.toDF("a", "n1", "s1"), "a").join(sketches.toDF("b", "n2", "s2"), "b")
    stars = stars.where(f"100 * least(n1, n2) >= {PERCENT} * greatest(n1, n2)").select("a", "b", "n1", "n2", "s1", "s2")
    linked = verified("star", stars.mapInArrow(_likely, "a long, b long"))
    found = store.put("found", components(store, "first", linked))

    labelled = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    spans = labelled.groupBy("gid").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.min("rep").alias("pivot"), F.count("*").alias("m")).where("c1 < c2")
    # Groups of one family have the same smallest member most of the time, so they meet in a
    # task; a large family's groups are dealt to as many tasks as its rows ask for.
    rows = spans.groupBy("pivot").agg(F.sum("m").alias("rows"))
    parts = spans.join(rows, "pivot").select("gid", "pivot", F.pmod(F.xxhash64("gid"), F.ceil(F.col("rows") / FAMILY_ROWS)).alias("part"), F.ceil(F.col("m") / GROUP_ROWS).alias("k"))
    mixed = labelled.join(parts, "gid").join(sketches, "rep")
    # A large group's members are dealt to k blocks, and each pair of blocks is a task's unit.
    own = F.pmod(F.xxhash64("rep"), F.col("k"))
    dealt = mixed.select("pivot", "part", "gid", "rep", "component", "n", "sketch", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")
    dealt = dealt.select("pivot", "part", "gid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side, "rep", "component", "n", "sketch")
    families = dealt.repartition(buckets, "pivot", "part", "i", "j").sortWithinPartitions("gid", "i", "j").drop("pivot", "part")
    more = verified("cross", families.mapInArrow(_cross_pairs, "a long, b long").distinct())
    last = components(store, "last", linked.unionByName(more)).select(F.col("node").alias("rep"), "component")

    classes = classes.join(last, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return info.join(classes, "fp", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
