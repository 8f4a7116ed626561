"""Registered queries of the llm operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procwarden.llm import (
    filter_audit,
    fixity,
    jaccard_join,
    language,
    line_templates,
    metric_join,
    mixing,
    personal_data,
    sentencepiece_scan,
    token_counts,
    toxicity,
    turn_repair,
)
from procwarden.llm.common import table
from procwarden.llm.fingerprint import fingerprint_documents
from procwarden.session import cut_lineage


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.in_training_order(mixing.mix_documents(table(spark, sf_dir, "documents")))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents"))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op2_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    first = cut_lineage(fixity.records_of_pages(pages))
    second = cut_lineage(fixity.records_of_pages(fixity.damaged(pages)))
    return fixity.audit(first, second)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_scan.tokenize(table(spark, sf_dir, "documents"), sentencepiece_scan.load())


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


def op9_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.link_vectors(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.load())


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(table(spark, sf_dir, "conversations")), F.col("present"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_document_fingerprints": op1_document_fingerprints,
    "op2_fixity_audit": op2_fixity_audit,
    "op3_curriculum_mix": op3_curriculum_mix,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_line_templates": op5_line_templates,
    "op6_language_id": op6_language_id,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_personal_data": op8_personal_data,
    "op9_metric_range_join": op9_metric_range_join,
    "op10_toxicity": op10_toxicity,
    "op11_token_counts": op11_token_counts,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}
CHECKS: dict[str, str] = {
    "op2_fixity_audit": fixity.ORACLE,
    "op3_curriculum_mix": mixing.oracle_sql(),
    "op5_line_templates": line_templates.ORACLE,
    "op9_metric_range_join": metric_join.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
