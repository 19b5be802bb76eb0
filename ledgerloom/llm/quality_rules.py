"""Quality rules: statistics of a text, and lines that many documents of a host share.

Lines are normalised (lower case, runs of anything but letters and digits as
one blank) and hashed. For each host (``source``) the distinct documents with a
line are counted, where documents with equal texts count as one: copies are
duplicates, not boilerplate. A line is boilerplate where the count exceeds both
``min_docs`` and ``max_share`` of the host's distinct documents, and is left out
of the text. A document is depleted, and rejected, if less than ``min_left`` of its words or fewer than
``min_words`` words are left without such lines.

Counts are made of distinct (host, line, text) rows and then of partial sums,
so a host with a third of all rows or a line in all of them is spread over all
tasks. Boilerplate lines are joined back with a salt, by copies of the (few)
boilerplate lines; texts move once, to meet the places of theirs. Null texts have no words and fail the base rules, null hosts
are one host, rows that repeat an id are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import SPACES, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
SALTS = 16


def repeat_words(text_words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more, the first occurrence included.

    Windows are hashed. Only if two are equal they are sorted with their
    places; sorted places of repeated windows then give the words they cover.
    """
    n = F.size(text_words) - WINDOW + 1
    hashed = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(text_words, i, WINDOW)))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(sorted_: Column) -> Column:
            kept = F.filter(sorted_, lambda x, k: x["h"].eqNullSafe(F.get(sorted_, k - 1)["h"]) | x["h"].eqNullSafe(F.get(sorted_, k + 1)["h"]))
            return F.sort_array(F.transform(kept, lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last"))
        total = F.aggregate(let(placed, repeated), start, lambda acc, i: F.struct((acc["words"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("words"), i.alias("last")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total["words"]).otherwise(0)

    return F.when(n < 2, 0).otherwise(let(hashed, covered)).cast("bigint")


def text_statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    text = F.coalesce(text, F.lit(""))
    listed = words(text)
    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    bare = F.regexp_replace(text, SPACES, "")
    return {
        "n_words": F.size(listed).cast("bigint"),
        "word_chars": F.length(bare).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint"),
        "n_dup_lines": let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": let(listed, repeat_words),
    }


def document_lines(docs: DataFrame) -> DataFrame:
    """host, text_id, doc_id, place and line_id of every line with a letter or digit."""
    lines = docs.select(F.col("source").alias("host"), F.xxhash64("text").alias("text_id"), "doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    plain = F.trim(F.regexp_replace(F.lower("line"), r"[^\p{L}\p{N}]+", " "))
    lines = lines.select("host", "text_id", "doc_id", "place", plain.alias("plain")).where("plain <> ''")
    return lines.select("host", "text_id", "doc_id", "place", F.xxhash64("plain").alias("line_id"))


def boilerplate(lines: DataFrame, docs: DataFrame, min_docs: int = 20, max_share: float = 0.01) -> DataFrame:
    """(host, line_id, n_docs) of lines in more distinct documents of the host than both limits allow."""
    counted = lines.select("host", "line_id", "text_id").distinct().groupBy("host", "line_id").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
    sizes = docs.where("text is not null").select(F.col("source").alias("of"), F.xxhash64("text").alias("text_id")).distinct().groupBy("of").agg(F.count("*").alias("of_docs"))
    joined = counted.join(sizes, F.col("host").eqNullSafe(F.col("of")))
    return joined.where(F.col("n_docs") > F.col("of_docs") * max_share).select("host", "line_id", "n_docs")


def drop_boilerplate(docs: DataFrame, min_docs: int = 20, max_share: float = 0.01) -> DataFrame:
    """All columns of ``docs``, with the text without boilerplate lines, and boilerplate_lines: their places from 0, in order."""
    docs = docs.drop("boilerplate_lines")
    lines = document_lines(docs)
    common = boilerplate(lines, docs, min_docs, max_share)
    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_id"), F.lit(SALTS)).cast("int"))
    match = dealt["host"].eqNullSafe(salted["host"]) & (dealt["line_id"] == salted["line_id"]) & (dealt["salt"] == salted["salt"])
    lost = dealt.join(salted, match, "left_semi").select(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text"), F.col("host").alias("of_host"), "place")
    # Rows that repeat id, text and host have the same lines; each counts once.
    lost = lost.groupBy("of", "of_text", "of_host").agg(F.sort_array(F.collect_set("place")).alias("gone"))
    same = F.col("d.doc_id").eqNullSafe(F.col("g.of")) & (F.xxhash64("d.text") == F.col("g.of_text")) & F.col("d.source").eqNullSafe(F.col("g.of_host"))
    joined = docs.alias("d").join(lost.alias("g"), same, "left")
    left = let(F.split("d.text", "\n"), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("g.gone")), lambda i: F.get(x, i)))
    text = F.when(F.col("g.gone").isNull(), F.col("d.text")).otherwise(F.array_join(left, "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns]
    return joined.select(*columns, F.coalesce("g.gone", F.array().cast("array<int>")).alias("boilerplate_lines"))


def quality_verdicts(docs: DataFrame, min_docs: int = 20, max_share: float = 0.01, min_left: float = 0.3, min_words: int = 20) -> DataFrame:
    """One row per document: its statistics, base_failed, boilerplate_words and kept; what is left is the text of ``drop_boilerplate``."""
    docs = docs.select("doc_id", "text", "source")
    cleaned = drop_boilerplate(docs.withColumns(text_statistics(F.col("text"))), min_docs, max_share)
    left = F.size(words(F.col("text"))).cast("bigint")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = cleaned.withColumns({"base_failed": failed, "left": left})
    enough = (F.col("left") >= min_words) & (F.col("left") >= min_left * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & enough).alias("kept"), (F.col("n_words") - F.col("left")).alias("boilerplate_words"),
    )
