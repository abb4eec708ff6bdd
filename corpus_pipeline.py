"""The corpus pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.line_dedup import line_dedup
from barloom.llm.mixing import described, mix, repeated
from barloom.llm.ngram_join import ngram_join
from barloom.llm.packing import pack
from barloom.llm.quality import document_statistics, keep_good, train
from barloom.llm.queries import MIX_TARGETS, domains, labelled_domains
from barloom.llm.store import Store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = Store(spark, "quality").put("stats", document_statistics(docs))
    return keep_good(docs, train(stats, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated chunks of lines go; every document stays."""
    return line_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays.

    Texts without words are linked with nothing and stay, and so do null ids.
    """
    found = ngram_join(docs)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat by their fitted rates, which are at least 1: none goes."""
    about = Store(spark, "mixing").put("about", described(docs))
    present = domains(docs)
    if not present:
        return docs
    model, rates = mix(about, labelled_domains(spark, docs, sf_dir), {d: MIX_TARGETS.get(d, min(MIX_TARGETS.values())) for d in present}, floor=1.0)
    return repeated(docs, model, rates)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, their ids as little-endian 32-bit numbers."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: SQL expresses neither the fitted trees nor the content-defined chunks; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.put(name, stage(spark, docs, sf_dir))
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = run(spark, sf_dir)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def pipeline_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
