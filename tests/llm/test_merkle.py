from hashlib import sha256
from zlib import crc32

import duckdb
import pytest
from conftest import DATA
from pyspark.sql import functions as F

import barloom.llm.merkle as merkle
from barloom.llm.merkle import fold, height, leaf, manifest, siblings, up
from barloom.llm.queries import ORACLES, QUERIES
from check import canonical, compare, connect


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """(top, for every node its siblings and their places, level by level)."""
    proofs = [[] for _ in nodes]
    where = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for k, i in enumerate(where):
            proofs[k].append((i % 3, [x for j, x in enumerate(runs[i // 3]) if j != i % 3]))
            where[k] = i // 3
        nodes = [h(*run) for run in runs]
    return nodes[0] if nodes else None, proofs


def climb(node, proof):
    for place, others in proof:
        node = h(*others[:place], node, *others[place:])
    return node


def brute(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    by_source = {}
    for d in docs:
        copy = list(d)
        if d[4] is not None and d[0] is not None and crc32(str(d[0]).encode()) % 2 == 0:
            copy[4] = d[4].replace("\n", "")
        by_source.setdefault(d[1], []).append((d[0], h(*map(part, d)), h(*map(part, copy))))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r[0] is not None, r))
        trees[s] = tree([r[1] for r in by_source[s]])
    root, upper = tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, upper):
        for (doc_id, own, claimed), proof in zip(by_source[s], trees[s][1]):
            whole = proof + above
            folded = climb(claimed, whole)
            out.append((doc_id, own, trees[s][0], root, h(*(x for _, others in whole for x in others)), folded, folded == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def hashed(spark, docs):
    frame = spark.createDataFrame([(*d, "x", 3) for d in docs], SCHEMA + ", place string, tree int")
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    copy = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    leaves = frame.select("*", leaf(*row, F.col("text")).alias("leaf"), leaf(*row, copy).alias("claimed"))
    got = manifest(spark, leaves).select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root", "verified")
    return [tuple(r) for r in got.collect()]


def ordered(rows):
    return sorted(rows, key=str)


def odd():
    docs = [(i, "hot" if i % 3 else f"s{i % 60}", "en", i, f"text {i}\nmore\n" * (i % 4)) for i in range(700)]
    docs += [(5, "hot", "en", 5, "same\n")] * 9 + [(5, "hot", None, None, None)]
    docs += [(None, None, None, None, None)] * 2 + [(None, "hot", "de", 1, ""), (7, None, "fr", 2, "x\ny"), (8, "", "fr", -2, "é\n"), (-9, "Ünï", "fr", 2, "z" * 10**6 + "\n")]
    return docs


def test_query_equals_sql(spark):
    assert compare(spark, connect(DATA), DATA, "op12_merkle_manifest") == ""


def test_documents_equal_a_plain_manifest(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = [tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, DATA).collect()]
    assert ordered(got) == ordered(brute(docs))
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_odd_rows_equal_a_plain_manifest(spark):
    assert ordered(hashed(spark, odd())) == ordered(brute(odd()))


def test_odd_rows_equal_sql(spark):
    connection = duckdb.connect()
    connection.register("documents", spark.createDataFrame(odd(), SCHEMA).toArrow())
    result = connection.execute(ORACLES["op12_merkle_manifest"])
    columns = [d[0] for d in result.description]
    assert canonical(columns, result.fetchall()) == canonical(["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"], brute(odd()))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 81, 82, 163, 244])
def test_lone_sources_of_all_heights(spark, n):
    docs = [(i, "a", "en", i, f"{i}\n") for i in range(n)]
    assert ordered(hashed(spark, docs)) == ordered(brute(docs))


def test_many_sources(spark):
    docs = [(i, f"s{i % 250}", "en", i, f"{i}\n") for i in range(500)]
    assert ordered(hashed(spark, docs)) == ordered(brute(docs))


def test_no_rows(spark):
    assert hashed(spark, []) == []


def test_only_every_fourth_level_is_stored(spark):
    docs = spark.createDataFrame([(i, "a", f"{i:064x}", f"{i:064x}") for i in range(500)], "doc_id long, source string, leaf string, claimed string")
    stored = []

    class Seen(merkle.Store):
        def put(self, name, frame):
            stored.append(name)
            return super().put(name, frame)

    plain, merkle.Store = merkle.Store, Seen
    try:
        assert manifest(spark, docs).where("verified").count() == 500
    finally:
        merkle.Store = plain
    assert [n for n in stored if n.startswith("leaves-") and n[7:].isdigit()] == ["leaves-0", "leaves-1"]
    assert height(500) == 6


def test_folding_gives_the_top_from_every_place():
    for n in (1, 2, 5, 27, 80):
        nodes = [h(str(i)) for i in range(n)]
        top = nodes
        while len(top) > 1:
            top = up(top)
        for i, proof in enumerate(siblings(nodes, height(n))):
            assert fold(nodes[i], i, n, proof + "rest") == (top[0], "rest")
