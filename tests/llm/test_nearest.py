import numpy as np
from conftest import DATA

from barloom.llm import inverted_multi_index
from barloom.llm.inverted_multi_index import Index, nearest_neighbours


def brute(rows, k=20, every=20):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    out = {}
    for q in good:
        if q % every == 0:
            ranked = sorted((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q)
            out[q] = [(i, -s) for s, i in ranked[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, wanted):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) / len(wanted[q]) for q in wanted])


def test_recall_against_brute_force(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    got, wanted = found(nearest_neighbours(e)), brute(rows)
    assert set(got) == set(wanted) and all(len(v) == 20 for v in got.values())
    assert recall(got, wanted) >= 0.9
    vectors = dict(rows)
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        assert all(abs(s - float(np.dot(np.array(vectors[q], float), np.array(vectors[i], float)))) < 1e-12 for i, s in hits)


def test_ties_repeats_and_useless_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.0, 1.0]) for i in range(60)] + [(100, None), (101, [0.0] * 4), (120, [1.0, None, 0.0, 0.0]), (140, [float("nan"), 0.0, 0.0, 1.0]), (160, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0] * 4), (5, [1.0, 0.0, 0.0, 1.0])]
    e = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = found(nearest_neighbours(e))
    assert set(got) == {0, 20, 40}
    assert [i for i, _ in got[20]] == [*range(20)] and [i for i, _ in got[0]] == [*range(1, 21)]
    assert nearest_neighbours(e.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [i for i, _ in found(nearest_neighbours(few))[0]] == [1, 2]


def test_rows_do_not_depend_on_tiles_and_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    e = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(1500, 8)))], "vec_id long, embedding array<double>")
    whole = found(nearest_neighbours(e))
    monkeypatch.setattr(inverted_multi_index, "QUERIES", 10)
    monkeypatch.setattr(inverted_multi_index, "TILE", 3)
    assert found(nearest_neighbours(e)) == whole


def test_traversal_is_ordered_and_complete():
    rng = np.random.default_rng(0)
    index = Index(rng.normal(size=(6, 3)), rng.normal(size=(5, 3)))
    q = rng.normal(size=6)
    cells = list(index.traverse(q))
    sums = [index.left[i] @ q[:3] + index.right[j] @ q[3:] for i, j in cells]
    assert len(set(cells)) == 30 and all(a >= b - 1e-12 for a, b in zip(sums, sums[1:]))
