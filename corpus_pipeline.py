"""The corpus pipeline: stages over the documents, each written as Parquet and read again by the next.

All stages but the last return the columns they were given. A row without an id passes the first four
stages like any other, except that near duplicates are told by id: such a row counts as its own group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontamination, pu_quality, semi_markov_pii, speculative_bpe, tensored_minhash
from tidelog.llm.common import fresh_name, landed, table
from tidelog.llm.queries import vocabulary_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, trained on what is given, does not reject."""
    return pu_quality.good(docs, pu_quality.train(docs, table(spark, sf_dir, "labels")))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; repeated rows count as one."""
    found = tensored_minhash.near_duplicates(docs, size=5, similarity=80)
    staying = landed(found.where("kept and doc_id is not null").select("doc_id").distinct(), "staying")
    text = fresh_name(docs, "text_hash")
    kept = docs.join(staying, "doc_id", "left_semi").withColumn(text, F.xxhash64("text"))
    return kept.dropDuplicates(["doc_id", text]).drop(text).select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents none of whose passages holds a benchmark item."""
    return decontamination.clean(docs, decontamination.indexes(table(spark, sf_dir, "benchmark")))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars counted anew."""
    masked = semi_markov_pii.masked(docs, semi_markov_pii.train(docs))
    counted = F.length("text").cast("long")
    return masked.withColumn("n_chars", counted) if "n_chars" in docs.columns else masked


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their number."""
    ids = speculative_bpe.encode(docs, vocabulary_file("word_bpe_49k.json"))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("near_dedup", near_deduplicated),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("bpe_encoding", encoded),
]

#: The stages hold models and vocabularies that SQL cannot express; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
