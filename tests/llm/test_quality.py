import random
import zlib

import numpy as np

from barloom.llm.quality import FEATURES, document_statistics, fit, keep_good, score, statistics, train

import pyarrow as pa


def corpus(spark, n=600):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(5, 80))]
        good = rng.random() < 0.7
        docs.append((i, " ".join(words) if good else " ".join(w + "###" for w in words), "x", 3))
        labels.append((i, int(good)))
    docs += [(n, None, None, None), (n + 1, "", "", 0), (n + 2, "word " * 30_000, "", 0), (None, "a b", "", 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, quality string, score int"), spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, quality int")


def test_held_out_accuracy_and_shape(spark):
    docs, labels = corpus(spark)
    stats = document_statistics(docs)
    model = train(stats, labels)
    rows = score(stats, model).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    kept = keep_good(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = corpus(spark, 200)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    stats = document_statistics(docs)
    one, two = train(stats, labels), train(stats, flipped)
    assert np.array_equal(one.value, two.value) and np.array_equal(one.threshold, two.threshold)


def test_no_labels_give_one_score(spark):
    docs, labels = corpus(spark, 10)
    stats = document_statistics(docs)
    assert {r.score for r in score(stats, train(stats, labels.limit(0))).collect()} == {0.5}
    assert score(document_statistics(docs.limit(0)), fit(np.zeros((0, len(FEATURES))), np.zeros(0))).count() == 0


def test_statistics_do_not_depend_on_neighbours():
    texts = ["a b\n\nC d!!", "", None, "x", "x x x\nx x x\n", "é ü ### a"]
    together = statistics(pa.array(texts, pa.string()))
    alone = np.concatenate([statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone)
