import random
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from conftest import DATA

from barloom.llm.periodic_runs import kept, periodic_runs, runs_of
from barloom.llm.queries import QUERIES, looped


def brute(words, least=24, periods=3):
    """Every stretch that matches at a lag, held against the definition word by word."""
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            smaller = (all(words[t] == words[t - d] for t in range(start + d, start + length)) for d in range(1, q))
            if length >= max(least, periods * q) and not any(smaller):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(words):
    numbers = {}
    return runs_of(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64))


def sequence(rng):
    words, kinds = [], rng.choice([1, 2, 2, 3, 5, 50])
    while len(words) < rng.randint(0, 260):
        if rng.random() < 0.5:
            words += [rng.randrange(kinds) for _ in range(rng.randint(1, 30))]
        else:
            block = [rng.randrange(kinds) for _ in range(rng.randint(1, 60))]
            words += (block * 5)[: rng.randint(1, len(block) * 5)]
        if rng.random() < 0.1:
            words += words[-rng.randint(1, len(words)) :]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_random_sequences_equal_a_plain_search(seed):
    rng = random.Random(seed)
    total = 0
    for _ in range(150):
        words = sequence(rng)
        wanted = brute(words)
        total += len(wanted)
        assert found(words) == wanted
    assert total > 50


def test_bounds_of_length_and_periods():
    other = [*range(100, 130)]
    assert found(other + [0] * 23 + [1]) == []
    assert found(other + [0] * 24 + [1]) == [(30, 24, 1)]
    for q in (8, 9, 15, 16, 17, 31, 64, 100):
        for length in (3 * q - 1, 3 * q, 3 * q + 1):
            for shift in (0, 1, 7, 13):
                words = [-1 - i for i in range(shift)] + [i % q for i in range(length)] + [-100 - i for i in range(9)]
                assert found(words) == ([(shift, length, q)] if length >= max(24, 3 * q) else [])


def test_long_texts_take_little_more_time_than_their_words():
    assert found([0] * 200_000) == [(0, 200_000, 1)]
    assert found(([0] * 1000 + [1]) * 200)[:2] == [(0, 1000, 1), (0, 200_200, 1001)]
    line = [*range(20)]
    assert found([w for i in range(5000) for w in [*line, 100 + i]]) == []


def wanted_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None:
        number = crc32(str(doc_id).encode())
        if number % 10 == 0 and n:
            a = number // 10 % n
            p = 1 + (n - a) // (3 + number // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    stays = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha256(lines.encode()).hexdigest(), sha256(stays).hexdigest())


def test_documents_equal_a_plain_search(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r.text or "") < 20_000]
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, DATA).collect()}
    assert len(got) == len(docs)
    assert [got[r.doc_id] for r in short] == [wanted_row(r.doc_id, r.text) for r in short]
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_odd_rows(spark, tmp_path):
    block = "a b c d e f g h i "
    ten = next(i for i in range(1000) if crc32(str(i).encode()) % 10 == 0)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\f\r"), (4, block * 3), (4, block * 3), (None, block * 4), (5, "w x w x  " * 40), (6, "é\x00 " * 30), (ten, "one"), (ten, " ".join(map(str, range(100)))), (9, "same " * 100_000)]
    spark.createDataFrame([(*r, [1], "k") for r in rows], "doc_id long, text string, runs array<int>, collapsed string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    short = [r for r in rows if r[0] != 9]
    assert sorted((r for r in got if r[0] != 9), key=str) == sorted((wanted_row(*r) for r in short), key=str)
    assert next(r for r in got if r[0] == 9)[:6] == (9, 1, 0, 100_000, 1, 100_000_000)


def test_an_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_operator_gives_runs_and_texts(spark):
    row = periodic_runs(spark.createDataFrame([(1, "x " + "a b " * 20 + "y")], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 40, 2)] and row.collapsed == "x a b y" and row.n_words == 42


def test_overlapping_runs_keep_what_only_first_periods_hold():
    assert kept(10, [(0, 6, 2), (4, 6, 2)]).tolist() == [True, True, False, False, False, False, False, False, False, False]


def test_looped_leaves_nine_in_ten():
    words = [str(i).encode() for i in range(50)]
    changed = [i for i in range(2000) if looped(i, words) != words]
    assert 120 < len(changed) < 280 and all(len(looped(i, words)) == 50 for i in changed)
