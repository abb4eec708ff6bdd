import numpy as np
import pyarrow as pa
from conftest import DATA

from barloom.llm import nn_descent
from barloom.llm.nn_descent import near_duplicates


def brute(rows):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0):
            good[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    ids = sorted(good)
    x = np.stack([good[i] for i in ids])
    links = x @ x.T >= 0.9
    np.fill_diagonal(links, False)
    label = np.arange(len(ids))
    while True:
        least = np.array([min([label[i], *label[links[i]]]) for i in range(len(ids))])
        if (least == label).all():
            break
        label = least
    return {i: (int(links[n].sum()), ids[label[n]]) for n, i in enumerate(ids)}


def families(rng, sizes, width=16):
    rows, at = [], 0
    for size in sizes:
        base = rng.normal(size=width)
        for _ in range(size):
            rows.append((at * 7 % 100003, (base + rng.normal(size=width) * 0.08).tolist()))
            at += 1
    return rows


def test_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = families(rng, [1] * 300 + [2] * 30 + [5] * 10 + [40, 150])
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    wanted = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e).collect()}
    assert set(got) == set(wanted)
    total = sum(n for n, _ in wanted.values())
    assert sum(min(got[i][0], wanted[i][0]) for i in wanted) >= 0.99 * total
    assert all(got[i][0] <= wanted[i][0] for i in wanted)
    assert np.mean([got[i][1] == wanted[i][1] for i in wanted]) >= 0.99


def test_given_vectors_have_no_links(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = near_duplicates(e).collect()
    wanted = brute([(r.vec_id, r.embedding) for r in e.collect()])
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == wanted
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_odd_rows(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(3, same), (9, [2.0, 4.0, 6.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 1.0]), (7, [None, 1.0, 1.0]), (8, [-1.0, 0.0, 0.0]), (9, [2.0, 4.0, 6.0]), (None, same)]
    e = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, kept string")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(e).collect()), key=str)
    assert got == sorted([(3, 1, 3, True), (9, 1, 3, False), (9, 1, 3, False), *((i, 0, i, True) for i in (4, 5, 6, 7, 8)), (None, 0, None, False)], key=str)
    assert near_duplicates(e.limit(0)).count() == 0


def test_groups_of_more_copies_than_a_list_holds_are_linked(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "AUDITED", 8)
    monkeypatch.setattr(nn_descent, "AUDIT_LINKS", 0)
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 64)))]
    one = rng.normal(size=64)
    one /= np.linalg.norm(one)
    side = rng.normal(size=64)
    side -= one * (side @ one)
    side /= np.linalg.norm(side)
    other = 0.95 * one + (1 - 0.95**2) ** 0.5 * side
    rows += [(1000 + i, one.tolist()) for i in range(20)] + [(2000 + i, other.tolist()) for i in range(20)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e, exact=0).collect()}
    assert got == brute(rows)


def test_rare_links_are_all_found(spark, monkeypatch):
    # Pairs at cosine 0.92 among unstructured vectors: too few for a sample of 8, too far apart for short lists.
    monkeypatch.setattr(nn_descent, "AUDITED", 8)
    monkeypatch.setattr(nn_descent, "BLOCK", 8)
    monkeypatch.setattr(nn_descent, "ROUNDS", 0)
    monkeypatch.setattr(nn_descent, "DIRECTIONS", 1)
    monkeypatch.setattr(nn_descent, "EXACT_BYTES", 64 * 8 * 500)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=(30, 64))
    side -= x[:30] * (side * x[:30]).sum(1)[:, None]
    side /= np.linalg.norm(side, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, 0.92 * x[:30] + (1 - 0.92**2) ** 0.5 * side]))]
    wanted = brute(rows)
    assert sum(n for n, _ in wanted.values()) == 60
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for options in ({}, {"exact": 0}):
        assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e, **options).collect()} == wanted


def test_the_descent_runs_whatever_the_size(spark, monkeypatch):
    runs = []
    descend = nn_descent._descend

    def counted(store, name, *rest):
        runs.append(name)
        return descend(store, name, *rest)

    monkeypatch.setattr(nn_descent, "_descend", counted)
    rng = np.random.default_rng(3)
    few, many = families(rng, [1] * 100 + [2] * 3), families(rng, [1] * 20 + [30, 40])
    for rows in (few, many):
        wanted = brute(rows)
        e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
        got = []
        for options in ({}, {"exact": len(rows)}):
            runs.clear()
            got.append({r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e, **options).collect()})
            assert runs
        assert got == [wanted, wanted]


def test_a_low_recall_is_made_up_for(spark, monkeypatch):
    # No start reaches this recall: what an audit of all vectors finds is added to the descent's links.
    monkeypatch.setattr(nn_descent, "RECALL", 2)
    monkeypatch.setattr(nn_descent, "STARTS", 1)
    rows = families(np.random.default_rng(6), [1] * 50 + [3] * 10 + [40])
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e).collect()} == brute(rows)


def test_forest_connects_what_all_links_connect():
    rng = np.random.default_rng(2)
    for share in (0, 0.02, 0.1, 1):
        links = rng.random((40, 50)) < share
        i, j = nn_descent._forest(links)
        assert links[i, j].all() and len(i) < 90

        def groups(table):
            near = np.eye(90, dtype=bool)
            near[:40, 40:], near[40:, :40] = table, table.T
            for _ in range(7):
                near = near @ near
            return near

        own = np.zeros_like(links)
        own[i, j] = True
        assert (groups(own) == groups(links)).all()


def beside(rng, x, cosine):
    side = rng.normal(size=x.shape)
    side -= x * (side * x).sum(1)[:, None]
    return cosine * x + (1 - cosine**2) ** 0.5 * side / np.linalg.norm(side, axis=1)[:, None]


def test_starts_find_scattered_pairs_without_an_audit_of_the_whole_table(spark, monkeypatch):
    def whole(*_):
        raise AssertionError("all vectors were compared with all")

    joined = []
    descend = nn_descent._descend

    def counted(store, name, vectors, *rest):
        joined.append(vectors.count())
        return descend(store, name, vectors, *rest)

    monkeypatch.setattr(nn_descent, "_whole", whole)
    monkeypatch.setattr(nn_descent, "_descend", counted)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, beside(rng, x[:300], 0.95)]))]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e).collect()} == brute(rows)
    # Vectors with no neighbour near enough to share a link aren't moved in the rounds.
    assert joined and max(joined) < 600


def test_components_of_many_blocks_with_copies_are_counted(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "COUNT_BLOCK", 4)
    monkeypatch.setattr(nn_descent, "BLOCK", 8)
    monkeypatch.setattr(nn_descent, "TILE", 4)
    rows = families(np.random.default_rng(5), [1] * 20 + [2] * 5 + [9, 30])
    rows += [(200000 + i, rows[-1][1]) for i in range(25)] + [(300000 + i, rows[0][1]) for i in range(3)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e).collect()} == brute(rows)


def test_single_precision_does_not_decide_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    both = np.concatenate([x, *(beside(rng, x[k::4], 0.9 + d) for k, d in enumerate((-3e-7, -3e-8, 3e-8, 3e-7)))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(both)]
    wanted = brute(rows)
    assert 150 < sum(n for n, _ in wanted.values()) < 250
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(e).collect()} == wanted


def test_equal_vectors_of_several_batches_count_once():
    x = np.random.default_rng(1).normal(size=(3, 8))
    rows = [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 2), (6, 2)]
    keys = np.array([(1 << nn_descent.HASH_BITS) + 7 + v // 2 for _, v in rows])  # the first two vectors have one hash
    table = pa.table([pa.array([i for i, _ in rows]), pa.array([x[v].tobytes() for _, v in rows]), pa.array(keys)], names=["vec_id", "vector", "key"])
    found = [r for b in nn_descent._cells(iter(table.to_batches(max_chunksize=2)), "<f8") for r in b.to_pylist()]
    assert [(r["u"], r["w"], r["s"]) for r in found] == [(0, 1, None), (0, 2, None), (0, 3, None), (5, 6, None)]
