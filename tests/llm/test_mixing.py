import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from barloom.llm.mixing import PIECES, described, mix, rated, repeated

TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def tokens(text):
    return (text.count(" ") + text.count("\n") + 1) if text else 0


@pytest.fixture(scope="module")
def result(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labelled = docs.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id", "left_semi").select("doc_id", F.col("lang").alias("domain"))
    about = described(docs)
    model, rates = mix(about, labelled, TARGETS)
    return docs, model, rates, rated(about, model, rates).collect()


def test_expected_totals_meet_the_targets(result):
    docs, model, rates, rows = result
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == tokens(text[r.doc_id]) for r in rows)
    p = np.array([[r[f"p_{d}"] for d in TARGETS] for r in rows])
    t = np.array([r.n_tokens for r in rows], float)
    rate = np.array([r.rate for r in rows])
    assert np.allclose(p.sum(1), 1) and (rate >= 0).all()
    got = (rate * t) @ p
    assert np.allclose(got / got.sum(), list(TARGETS.values()), atol=1e-3)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)


def test_posteriors_find_the_language(result):
    docs, _, _, rows = result
    lang = {r.doc_id: r.lang for r in docs.collect()}
    hits = [max(TARGETS, key=lambda d: r[f"p_{d}"]) == lang[r.doc_id] for r in rows]
    assert np.mean(hits) > 0.9


def test_rates_equal_a_plain_projected_gradient(result):
    _, _, rates, rows = result
    p = np.array([[r[f"p_{d}"] for d in TARGETS] for r in rows])
    t = np.array([r.n_tokens for r in rows], float)
    start, gram = t @ p, (p * t[:, None]).T @ p
    goal = np.array(list(TARGETS.values()))
    goal = goal * (start / goal).max()
    scale = 1 / np.diag(gram)
    bound = (scale[:, None] * gram).sum(1).max()
    r = np.ones(len(t))
    for _ in rates.steps:
        r = np.maximum(0, r - p @ (((r * t) @ p - goal) * scale / bound))
    assert np.allclose(r, [x.rate for x in rows], rtol=1e-6)


def test_odd_rows(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "the thing with that " * 5_000, "x", 1), (3, "the thing", "x", 1), (None, "schön für", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate string, copies int")
    labelled = spark.createDataFrame([(3, "en"), (9, "de"), (None, "de"), (1, "xx")], "doc_id long, domain string")
    about = described(docs)
    model, rates = mix(about, labelled, {"en": 1, "de": 1})
    assert rated(about, model, rates).count() == len(rows)
    out = repeated(docs, model, rates)
    assert out.schema == docs.schema
    assert len(model.logs[0]) == len(PIECES)
    # No domain has to lose tokens, so no document goes.
    assert {r.doc_id for r in out.collect()} == {1, 2, 3, None}
    none = described(docs.limit(0))
    assert rated(none, *mix(none, labelled, {"en": 1})).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_smaller_budget_thins(spark):
    docs = spark.createDataFrame([(i, "the thing with that" if i % 2 else "schön für öde") for i in range(400)], "doc_id long, text string")
    labelled = docs.selectExpr("doc_id", "CASE WHEN doc_id % 2 = 1 THEN 'en' ELSE 'de' END AS domain")
    about = described(docs)
    model, rates = mix(about, labelled, {"en": 3, "de": 1}, budget=300.0)
    rows = rated(about, model, rates).collect()
    assert abs(sum(r.rate * r.n_tokens for r in rows) - 300) < 1
    assert all(r.rate < 1 for r in rows)
