"""One query per operator over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeloom import scratch
from tapeloom.llm.byte_bpe import round_trip, serialized_ranks
from tapeloom.llm import (
    decontamination,
    filter_audit,
    language_id,
    license_scan,
    lm_score,
    lz_fingerprint,
    mixing,
    ngram_join,
    quality_rules,
    url_filters,
    whitening,
)
from tapeloom.llm.token_files import tokens_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.compared_with_edits(_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_round_trip(_table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filters.judged(url_filters.captures_of(pages), url_filters.entries_of(pages))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), serialized_ranks())


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Words are counted once; what follows reads the small table.
    leaves = scratch.keep(mixing.leaves_of(_table(spark, sf_dir, "documents")), "leaves")
    return mixing.selected(leaves, mixing.TARGETS)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(_table(spark, sf_dir, "documents"))


def quality_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule rejects alone, under the base rules and two versions of a policy, from one ledger."""
    entries = quality_rules.ledger(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality_rules.ablation(entries, [quality_rules.BASE, quality_rules.STANDARD, quality_rules.ANY_LANGUAGE])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_lz_fingerprint": op2_lz_fingerprint,
    "op3_token_files": op3_token_files,
    "op4_url_filters": op4_url_filters,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_lm_score": op6_lm_score,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_license_scan": op10_license_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_whitening": op12_whitening,
    "op13_decontamination": op13_decontamination,
    "quality_rule_ablation": quality_rule_ablation,
}

ORACLE: dict[str, str] = {
    "op4_url_filters": url_filters.ORACLE_SQL,
    "op8_quality_rules": quality_rules.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op13_decontamination": decontamination.ORACLE_SQL,
    "quality_rule_ablation": quality_rules.ABLATION_SQL,
}
