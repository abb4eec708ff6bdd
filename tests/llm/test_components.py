import numpy as np

from barloom.llm.components import components
from barloom.llm.store import Store


def smallest(edges):
    label = {n: n for e in edges for n in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            least = min(label[a], label[b])
            moved |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


def found(spark, edges):
    rows = components(Store(spark, "test"), "c", spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


def test_equals_label_passing(spark):
    rng = np.random.default_rng(2)
    chain = [(i, i + 1) for i in range(100, 140)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    hub = [(950, i) for i in range(900, 940)]
    loose = [tuple(p) for p in rng.integers(300, 420, (90, 2)).tolist() if p[0] != p[1]]
    edges = [(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(chain + ring + hub + loose + hub)]
    assert found(spark, edges) == smallest(edges)


def test_stars_and_nothing(spark):
    stars = [(1, 5), (1, 6), (1, 9), (2, 7)]
    assert found(spark, stars) == smallest(stars)
    assert found(spark, []) == {}
    assert found(spark, [(4, 4)]) == {}
