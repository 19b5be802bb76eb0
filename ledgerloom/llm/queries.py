"""Queries over the document tables, one for each operator, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, conversation_repair, decontaminate, embedding_dedup, hard_negatives, html_extract, jaccard_join, language_id, license_scan, line_dedup, ngram_lm, quality_rules, sql, url_reputation
from ledgerloom.llm.text import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# The rules of the url query.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, folder, "documents"))


def op2_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score_documents(table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_reputation.judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest_documents(table(spark, folder, "documents"), VOCABULARY)


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = language_id.fit_languages(docs.where(~F.col("held_out")).select("text", "lang"))
    return language_id.predict_languages(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, folder, "pages"))


def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return conversation_repair.repair_conversations(conversation_repair.damaged(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_ngram_lm, op3_line_dedup, op4_decontamination, op5_url_reputation, op6_license_scan, op7_bpe, op8_language_id, op9_jaccard_join, op10_html_extraction, op11_embedding_dedup, op12_hard_negatives, op13_conversation_repair)
}

SQL: dict[str, str] = {
    "op1_quality_rules": sql.OP1_QUALITY_RULES,
    "op3_line_dedup": sql.OP3_LINE_DEDUP,
    "op5_url_reputation": sql.op5_url_reputation(URL_RULES, url_reputation.TWO_PART_SUFFIXES),
    "op6_license_scan": sql.op6_license_scan(license_scan.TEMPLATES),
    "op11_embedding_dedup": sql.OP11_EMBEDDING_DEDUP,
    "op12_hard_negatives": sql.OP12_HARD_NEGATIVES,
}
