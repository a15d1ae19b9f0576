"""Documents to token ids: the stages, each written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.llm import language_id, mixing, ngram_join, quality_rules
from tapeloom.llm.byte_bpe import encoded, serialized_ranks

# Near duplicates here: five words, four fifths of the union.
NEAR = ngram_join.Settings(words=5, percent=80)
# Nine tenths of the words there are, each document once at most.
MIX = mixing.Targets(
    weights={"domain": {"crawl": 3, "books": 4, "forums": 3}, "lang": {"en": 5, "fr": 2, "de": 2, "es": 1}},
    per_mille=900,
    epochs=1,
)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, by a model of the documents' own labels."""
    return language_id.known_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs, NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights of domains and languages."""
    return mixing.mixed_documents(docs, MIX)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of each whole text."""
    ids = encoded(docs, serialized_ranks())
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("ngram_join", near_duplicates),
    ("mixing", mix),
    ("byte_bpe", token_ids),
]

# The stages train, hash and encode in ways that SQL does not express; tests/llm compares them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
