"""Cleaning pipeline: language, repeated lines, near duplicates, benchmark passages, tokens.

Every stage takes (spark, docs, sf_dir), where docs has the columns of the
``documents`` table, and works on all rows it is given. ``run`` writes what a
stage returns as Parquet in the shared folder and gives the next one what it
reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontaminate, jaccard_join, language_id, line_dedup
from ledgerloom.llm.queries import VOCABULARY, remainder
from ledgerloom.llm.text import table
from ledgerloom.session import cut_lineage, scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without letters or without a clear language (score below one half) go."""
    docs = docs.select(*COLUMNS)
    model = language_id.fit_languages(docs.where(remainder(F.col("doc_id"), 4) != 2).select("text", "lang"))
    named = language_id.predict_languages(docs, model)
    return named.where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5)).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines an earlier document has; a document of nothing else goes."""
    rest = line_dedup.dedup_lines(docs.select(*COLUMNS))
    empty = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")) == 0
    return rest.where((F.col("n_dropped") == 0) | ~empty).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document, that with the smallest id; rows without an id stay.

    Rows are told apart by id and text, so rows that repeat an id are
    documents of their own, and repeated rows are one. Documents without words
    are groups of their own.
    """
    docs = docs.select(*COLUMNS).withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    groups = jaccard_join.jaccard_components(docs)
    # An id that is not the smallest of its group goes; where several texts of a group have it, one of them stays.
    group = F.coalesce(F.col("component").cast("string"), "digest")
    stays = groups.where("doc_id = component_id").groupBy("doc_id", group).agg(F.min("digest").alias("digest")).select("doc_id", "digest").distinct()
    repeated = groups.groupBy("doc_id", "digest").count().where("count > 1")
    kept = docs.join(stays, ["doc_id", "digest"], "left_semi")
    once = kept.join(repeated, ["doc_id", "digest"], "left_anti")
    several = kept.join(repeated, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
    return once.select(*COLUMNS).union(several.select(*COLUMNS)).union(docs.where("doc_id is null").select(*COLUMNS))


# Shorter benchmark items are everyday phrases, which would take ordinary documents out.
MIN_ITEM_WORDS = 5


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark table; items below ``MIN_ITEM_WORDS`` words are not looked for."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), min_words=MIN_ITEM_WORDS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text again."""
    coded = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), VOCABULARY)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), same.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

# Walks, tokens and language scores have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch_scope(spark):
            docs = cut_lineage(stage(spark, docs, sf_dir), outlive=True)
    return STAGES[-1][1](spark, docs, sf_dir)
