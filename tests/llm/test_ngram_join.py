import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import ngram_join as module
from barloom.llm.ngram_join import ngram_join


def brute(rows):
    sets = []
    for _, text in rows:
        words = [w for w in _words(text or "")]
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
        sets.append(grams)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def _words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    common = [rng.choice(vocabulary) for _ in range(12)]
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 8, 9, 12, 20, 40, 90, 300]))]
        if rng.random() < 0.4:
            base = common + base
        for _ in range(rng.choice([1, 1, 2, 5, 9])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [words[at], rng.choice(vocabulary)]])
                words = words or ["x"]
            rows.append((n * 3 + 1, rng.choice([" ", "\n"]).join(words).upper() if rng.random() < 0.2 else " ".join(words)))
            n += 1
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "É é x a b c"), (5004, "a  b\x0bc d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in ngram_join(docs).collect()) == brute(rows)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    """The same components where groups are split into blocks of three rows, and tasks forget early."""
    for name, size in (("GROUP_ROWS", 3), ("TILE", 2), ("SEEN", 5), ("FAMILY_ROWS", 40)):
        monkeypatch.setattr(module, name, size)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for n in range(70):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(["x", "y", "z"])
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in ngram_join(docs).collect()) == brute(rows)


def _group(count, blocks=1):
    """One signature group of unlinked sets of equal size, as the units of its blocks."""
    rng = np.random.default_rng(0)
    bits = [rng.integers(0, 256, 64, dtype=np.uint8).tobytes() for _ in range(count)]
    rows = []
    for rep in range(count):
        for other in range(blocks):
            own = rep % blocks
            rows.append((7, min(own, other), max(own, other), 2 if own == other else int(own > other), rep, rep, 100, bits[rep]))
    rows.sort(key=lambda r: r[:3])
    names = ["gid", "i", "j", "side", "rep", "component", "n", "sketch"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def test_tiles_make_every_pair_once(monkeypatch):
    monkeypatch.setattr(module, "_possible", lambda n1, n2, apart: np.ones(len(n1), bool))
    monkeypatch.setattr(module, "TILE", 16)
    for blocks in (1, 3):
        found = [(a, b) for batch in module._cross_pairs(iter([_group(70, blocks)])) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
        assert sorted(found) == [(a, b) for a in range(70) for b in range(a + 1, 70)]


def test_memory_of_a_group_of_unlinked_sets_is_bounded():
    """Nine times the pairs take hardly more memory."""
    peaks = []
    for count in (2_000, 6_000):
        batch = _group(count)
        tracemalloc.start()
        assert sum(b.num_rows for b in module._cross_pairs(iter([batch]))) == 0
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 3 * peaks[0] and peaks[1] < 300 << 20


def test_repeated_rows_extra_columns_and_long_texts(spark):
    long = " ".join(f"v{i}" for i in range(50_000))
    rows = [(1, long, 9, "x"), (2, long + " end", 9, "x"), (2, long + " end", 9, "x"), (None, long, 1, None), (7, "a b c d e f", 0, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, component_id string")
    got = sorted((r for r in ngram_join(docs).collect()), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id) for r in got] == [(1, 1), (2, 1), (2, 1), (7, 7), (None, 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join(docs).count() == 0
