"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.exact_topk import exact_top_k
from barloom.llm.html_extract import extract
from barloom.llm.inverted_multi_index import nearest_neighbours
from barloom.llm.licenses import scan_licenses
from barloom.llm.line_dedup import line_dedup
from barloom.llm.merkle import leaf, manifest
from barloom.llm.mixing import described, mix, rated
from barloom.llm.ngram_join import ngram_join
from barloom.llm.nn_descent import near_duplicates
from barloom.llm.packing import pack
from barloom.llm.periodic_runs import periodic_runs
from barloom.llm.quality import document_statistics, score, train
from barloom.llm.store import Store
from barloom.llm.token_scan import count_tokens, write_token_files

#: Wanted shares of the languages' tokens.
MIX_TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_sort(F.array_distinct(F.col("matches.license"))).alias("licenses"), F.size("matches").alias("n_matches"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = Store(spark, "quality").put("stats", document_statistics(table(spark, sf_dir, "documents")))
    return score(stats, train(stats, table(spark, sf_dir, "labels")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Store(spark, 'token_files').base}/tokens"
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("piece_bpe_32k.model"))
    counted = count_tokens(spark, path)
    return counted.withColumn("file", F.substring_index("file", "/", -1))


def domains(docs: DataFrame) -> list[str]:
    """The languages that occur; few, whatever the number of documents."""
    return sorted(r[0] for r in docs.select("lang").where("lang IS NOT NULL").distinct().collect())


def labelled_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, domain): the language of the documents that the labels cover."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id")


def op6_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    about = Store(spark, "mixing").put("about", described(docs))
    model, rates = mix(about, labelled_domains(spark, docs, sf_dir), MIX_TARGETS)
    return rated(about, model, rates)


def op7_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors.where("vec_id % 100 = 0"), vectors, k=10, scale=1024)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' manifest; each proof is held against a copy some of whose texts lost their line feeds."""
    docs = table(spark, sf_dir, "documents")
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    copy = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)
    leaves = docs.select("source", "doc_id", leaf(*row, text).alias("leaf"), leaf(*row, copy).alias("claimed"))
    return manifest(spark, leaves).select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def looped(doc_id: int, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten, from one of them on repeated with a period."""
    h = crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), alter=looped)
    runs = F.col("runs")
    best = F.reduce(runs, runs[0], lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", "runs", "collapsed", F.when(F.size(runs) > 0, best).alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_wrappers": op1_html_wrappers,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_license_scan": op3_license_scan,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_token_counts": op5_token_counts,
    "op6_mix_to_targets": op6_mix_to_targets,
    "op7_lexical_packing": op7_lexical_packing,
    "op8_nn_descent": op8_nn_descent,
    "op9_inverted_multi_index": op9_inverted_multi_index,
    "op10_line_dedup": op10_line_dedup,
    "op11_exact_topk": op11_exact_topk,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}

#: DuckDB counterparts of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op11_exact_topk": """
        WITH v AS (
            SELECT CAST(vec_id AS BIGINT) AS id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        ), scored AS (
            SELECT q.id AS query_id, c.id AS vec_id,
                   max(CAST(coalesce(list_sum(list_transform(range(1, len(q.z) + 1), lambda i: q.z[i] * c.z[i])), 0) AS BIGINT)) AS score
            FROM v q JOIN v c ON q.id <> c.id AND len(q.z) = len(c.z)
            WHERE q.id % 100 = 0
            GROUP BY q.id, c.id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    # Trees are named '' (the root's), '+' and the source, or '-' for the null one.
    "op12_merkle_manifest": """
        WITH RECURSIVE docs AS (
            SELECT *, row_number() OVER () AS id, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS tree,
                list_reduce(
                    [CAST(4294967295 AS BIGINT)] || list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)),
                    lambda c, b: list_reduce(
                        [xor(c, b)] || list_transform(range(8), lambda z: CAST(0 AS BIGINT)),
                        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))
                ) & 1 = 1 AS altered
            FROM documents
        ), fields AS (
            SELECT id, doc_id, tree, list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)], lambda v: coalesce(strlen(v) || ':' || v, '-')) AS f,
                text, CASE WHEN altered THEN replace(text, chr(10), '') ELSE text END AS copy
            FROM docs
        ), leaves AS (
            SELECT id, doc_id, tree, sha256(array_to_string(f, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                sha256(array_to_string(f, '') || coalesce(strlen(copy) || ':' || copy, '-')) AS claimed
            FROM fields
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS place FROM leaves
        ), levels AS (
            SELECT tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY tree
            UNION ALL
            SELECT tree, level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
            FROM levels WHERE len(nodes) > 1
        ), sources AS (
            SELECT tree, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY tree <> '-', tree) - 1 AS place FROM levels WHERE len(nodes) = 1
        ), upper_levels AS (
            SELECT '' AS tree, 0 AS level, list(subroot ORDER BY place) AS nodes FROM sources
            UNION ALL
            SELECT tree, level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
            FROM upper_levels WHERE len(nodes) > 1
        ), tops AS (
            SELECT level AS height, nodes[1] AS root FROM upper_levels WHERE len(nodes) = 1
        ), others AS (
            SELECT tree, level, unnest(list_transform(range(len(nodes)), lambda i: {
                'place': i,
                'before': array_to_string(nodes[3 * (i // 3) + 1:i], ''),
                'after': array_to_string(nodes[i + 2:3 * (i // 3) + 3], '')
            }), recursive := true)
            FROM (SELECT * FROM levels UNION ALL SELECT * FROM upper_levels) WHERE len(nodes) > 1
        ), inner_folds AS (
            SELECT id, tree, 0 AS level, place, claimed AS node, '' AS proof FROM placed
            UNION ALL
            SELECT f.id, f.tree, f.level + 1, f.place // 3, sha256(o.before || f.node || o.after), f.proof || o.before || o.after
            FROM inner_folds f JOIN others o ON o.tree = f.tree AND o.level = f.level AND o.place = f.place
        ), outer_folds AS (
            SELECT f.id, 0 AS level, s.place, f.node, f.proof FROM inner_folds f JOIN sources s ON s.tree = f.tree AND s.height = f.level
            UNION ALL
            SELECT f.id, f.level + 1, f.place // 3, sha256(o.before || f.node || o.after), f.proof || o.before || o.after
            FROM outer_folds f JOIN others o ON o.tree = '' AND o.level = f.level AND o.place = f.place
        )
        SELECT CAST(p.doc_id AS BIGINT) AS doc_id, p.leaf, s.subroot, t.root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = t.root AS verified
        FROM placed p JOIN sources s ON s.tree = p.tree CROSS JOIN tops t JOIN outer_folds f ON f.id = p.id AND f.level = t.height
    """,
}
