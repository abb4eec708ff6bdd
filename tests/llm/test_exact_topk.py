import numpy as np
import pytest
from conftest import DATA

import barloom.llm.exact_topk as topk
from barloom.llm.exact_topk import exact_top_k, products, select
from barloom.llm.queries import QUERIES
from check import compare, connect


def brute(queries, vectors, k=10, scale=1024):
    def whole(rows):
        return [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]

    found = {}
    for q, x in whole(queries):
        for i, y in whole(vectors):
            if i != q and len(x) == len(y):
                score = sum(a * b for a, b in zip(x, y))
                found[q, i] = max(found.get((q, i), score), score)
    out = {}
    for (q, i), score in found.items():
        out.setdefault(q, []).append((-score, i))
    return {(q, n + 1, i, -s) for q, hits in out.items() for n, (s, i) in enumerate(sorted(hits)[:k])}


def rows(frame):
    found = [tuple(r) for r in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_query_equals_sql(spark):
    assert compare(spark, connect(DATA), DATA, "op11_exact_topk") == ""


SCHEMA = "vec_id long, embedding array<double>, score string, node int"


def odd(spark):
    """Ties, repeats, one id with two vectors, useless vectors, several lengths and clashing names."""
    rng = np.random.default_rng(5)
    some = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 1024]) for i in range(120)]
    same = [(i, [1.0, 0.0, 0.0, 1.0]) for i in range(300, 340)] + [(300, [1.0, 0.0, 0.0, 1.0])] * 30
    two = [(100, [0.5, 0.25, 0.0, -1.0]), (7, [9.0, 9.0, 9.0, 9.0])]
    useless = [(400, None), (401, [1.0, None, 0.0, 0.0]), (500, [float("nan"), 0.0, 0.0, 1.0]), (600, [float("-inf"), 0.0, 0.0, 1.0]), (None, [1.0] * 4)]
    others = [(700, [0.0] * 4), (800, [1.0, 2.0]), (801, [2.0, 1.0]), (900, []), (901, []), (1000, [1.0]), (-100, [-0.3, 0.1, 0.2, 0.9])]
    data = some + same + two + useless + others
    return data, spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA)


def test_odd_rows_equal_a_plain_search(spark):
    data, frame = odd(spark)
    queries = [r for r in data if r[0] is not None and r[0] % 100 == 0]
    wanted = brute(queries, data)
    assert rows(exact_top_k(frame.where("vec_id % 100 = 0"), frame)) == wanted
    assert {q for q, *_ in wanted} == {-100, 0, 100, 300, 700, 800, 900}


def test_the_same_rows_whatever_the_tiles(spark, monkeypatch):
    data, frame = odd(spark)
    wanted = brute(data, data, k=3)
    for name, size in (("SHARD", 7), ("BLOCK", 11), ("STRIP", 4), ("FAN", 2)):
        monkeypatch.setattr(topk, name, size)
    assert rows(exact_top_k(frame, frame, k=3)) == wanted


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    assert rows(exact_top_k(few.where("vec_id = 0"), few)) == {(0, 1, 1, 5 * 1024**2), (0, 2, 2, -(1024**2))}
    assert exact_top_k(few.limit(0), few).count() == 0 == exact_top_k(few, few.limit(0)).count()
    assert exact_top_k(few.limit(1), few.limit(1)).count() == 0


def test_products_are_exact_in_longs_and_refused_beyond():
    big = np.array([[2**30 + 1, 3]], np.int64)
    assert products(big, big)[0, 0] == (2**30 + 1) ** 2 + 9
    with pytest.raises(ValueError):
        products(np.array([[2**40]]), np.array([[2**40]]))


def test_selection_takes_the_first_of_equal_scores():
    scores = np.array([[5, 7, 5, 5, 9], [1, 1, 1, 1, 1]])
    assert select(scores, 3).tolist() == [[True, True, False, False, True], [True, True, True, False, False]]


def test_registered():
    assert "op11_exact_topk" in QUERIES
