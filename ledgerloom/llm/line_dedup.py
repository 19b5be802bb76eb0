"""Line deduplication: a line goes if an earlier one is equal or one word away.

Lines are compared without case and punctuation. Two lines are one word edit
apart (a word put in, left out or changed) if they have a variant in common:
the line itself, or the line without its i-th word. So distinct lines emit
their deletion variants as hashed keys; equal keys meet in a join; the distance
is then verified on the words, and the earliest line stays.

Not every line needs variants. Of two lines within one edit, two of three
parts are the same, so only lines that share two parts with another one emit
any, and only those without a word of the part left. Variants made by
leaving out the same word position are all within one edit of each other, so
each needs to be compared with the earliest of its key only: no pairs within a
key are made, and keys are counted with partial sums.

A line's words are one string, parted by single spaces. What is shuffled are
hashes and places: lines are named by 128 bits where equality decides and by 64
where a verification on the words follows.
Texts move twice, once to look the words of the lines up that need variants and
once to leave lines out.

Lines are ordered by doc_id and line; a null id comes first, and a line that
occurs twice in one document stays once. Every line with a word is compared for
equality, whatever its length (``min_words`` can ask for more). One edit is
meant from ``near_words`` words on, where it leaves four fifths of the words;
both lines must have that many. Null texts stay null, empty ones empty. Line
breaks are \\n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import let
from ledgerloom.session import cut_lineage, scratch_scope

NOT_WORD = r"[^\p{L}\p{N}\n]+"
PARTS = 3


def plain_lines(text: Column) -> Column:
    """Lines of a text with their runs of letters and digits in lower case, parted by one space (and one at the ends, perhaps)."""
    return F.split(F.regexp_replace(F.lower(text), NOT_WORD, " "), "\n")


def _n_words(words: Column) -> Column:
    """Of a line that is not empty: words are parted by one space."""
    return F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit(""))) + 1


def _ends(words: Column, front: Column, back: Column) -> tuple[Column, Column]:
    """The first ``front`` words, and the last ``back`` ones."""
    return tuple(F.call_function("substring_index", words, F.lit(" "), n.cast("int")) for n in (front, -back))


def lines_of(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """doc_id, digest of its text, line (from 0), id, its other half and part keys of every line with enough words.

    Words are made for a whole text at a time and stay one string, so that all
    that follows are string functions in generated code.
    """
    raw = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.posexplode(plain_lines(F.col("text"))).alias("line", "raw"))
    lines = raw.select("doc_id", "text_id", "line", F.trim("raw").alias("words")).where("words <> ''")
    lines = lines.withColumn("n", _n_words(F.col("words")))
    if min_words > 1:
        lines = lines.where(F.col("n") >= min_words)
    keys = F.when(F.col("n") >= near_words, _part_keys(F.col("words"), F.col("n")))
    return lines.select("doc_id", "text_id", "line", F.xxhash64("words").alias("id"), _half(F.col("words")).alias("half"), keys.alias("keys"))


def _half(words: Column) -> Column:
    """The second 64 bits of a line's name."""
    return F.xxhash64(F.lit(1), words)


def _place() -> Column:
    """Order of lines. The digest tells rows with the same doc_id apart."""
    return F.struct("doc_id", "text_id", "line")


def _part_keys(words: Column, n: Column) -> Column:
    """A key for each of ``PARTS`` parts: a hash of all words but those of the part, whose number the last two bits hold.

    Partners differ by one in length at most, so parts are laid out for the
    shorter length m, which is this line's or one less: what is before a part
    is counted from the front, what is behind it from the back.
    """

    def of(m: Column) -> list[Column]:
        q = F.floor(m / PARTS).cast("int")
        ends = [(part * q, m - (part + 1) * q if part + 1 < PARTS else F.lit(0)) for part in range(PARTS)]
        return [F.xxhash64(m, *_ends(words, front, back)).bitwiseAND(F.lit(~3)).bitwiseOR(F.lit(part)) for part, (front, back) in enumerate(ends)]

    return F.array(*of(n), *of(n - 1))


def _edited(n: Column, parts: Column) -> Column:
    """Positions of the words that are outside of what the line shares with a partner, in any of its parts."""

    def places(m: Column, part: Column) -> Column:
        q = F.floor(m / PARTS).cast("int")
        back = F.when(part == PARTS - 1, F.lit(0)).otherwise(m - (part + 1) * q)
        return F.sequence(part * q + 1, n - back)

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, lambda part: F.concat(places(n, part), places(n - 1, part))))))


def _without(words: Column, n: Column, i: Column) -> Column:
    """The words without the i-th one."""
    front, back = _ends(words, i - 1, n - i)
    return F.trim(F.concat(front, F.lit(" "), back))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are at most one word edit apart: their common ends leave one word at most."""
    least = F.least(F.size(a), F.size(b))
    longest = F.greatest(F.size(a), F.size(b))
    places = F.sequence(F.lit(0), least - 1)
    differs = F.filter(places, lambda i: F.get(a, i) != F.get(b, i))
    front = F.coalesce(F.get(differs, F.lit(0)), least)
    tail = F.filter(places, lambda i: F.get(a, F.size(a) - 1 - i) != F.get(b, F.size(b) - 1 - i))
    back = F.coalesce(F.get(tail, F.lit(0)), least)
    return (longest - least <= 1) & (front + back >= longest - 1)


def _words_at(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, first, parts and words of the wanted lines, which come as (first, id, parts); texts are read once more."""
    listed = wanted.groupBy(F.col("first.doc_id").alias("of"), F.col("first.text_id").alias("of_text")).agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "id", "parts")).alias("lines"))
    joined = docs.select("doc_id", "text").join(listed, F.col("doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("of_text")))
    # Words are looked up before lines are dealt out, which would repeat the text for each of them.
    worded = let(plain_lines(F.col("text")), lambda plain: F.transform("lines", lambda l: F.struct(l["line"].alias("line"), l["id"].alias("id"), l["parts"].alias("parts"), F.trim(F.get(plain, l["line"])).alias("words"))))
    each = joined.select("doc_id", F.col("of_text").alias("text_id"), F.explode(worded).alias("l"))
    return each.select("l.id", F.struct("doc_id", "text_id", F.col("l.line").alias("line")).alias("first"), "l.parts", "l.words").dropDuplicates(["id"])


def repeated_lines(docs: DataFrame, min_words: int = 1, near_words: int = 5) -> DataFrame:
    """(doc_id, text_id, line) of the lines to drop."""
    # Lines are named by a hash of their words from here on; equal ones are settled by their first place.
    named = cut_lineage(lines_of(docs, min_words, near_words))
    firsts = cut_lineage(named.groupBy("id", "half").agg(F.min(_place()).alias("first"), F.count("*").alias("n")))

    keys = named.where("keys is not null").select("id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("key")
    part = F.col("key").bitwiseAND(F.lit(3)).cast("int")
    parts = keys.join(shared, "key").groupBy("id").agg(F.collect_set(part).alias("parts"))
    suspects = cut_lineage(_words_at(docs, firsts.select("id", "first").join(parts, "id")))

    counted = suspects.select("id", "words", "parts", _n_words(F.col("words")).alias("n"))
    # The line itself is the variant at 0.
    each = counted.select("id", "words", "n", F.explode(F.concat(F.array(F.lit(0)), _edited(F.col("n"), F.col("parts")))).alias("at"))
    variant = F.when(F.col("at") == 0, F.col("id")).otherwise(F.xxhash64(_without(F.col("words"), F.col("n"), F.col("at"))))
    # Written, since they are counted by key and then joined with the keys that occur twice.
    variants = cut_lineage(each.select("id", "at", variant.alias("key")))
    several = variants.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("key")
    meeting = cut_lineage(variants.join(several, "key").join(suspects.select("id", "first"), "id"))

    # A word changed: leaving out the same position gives the same key.
    left_out = meeting.where("at > 0")
    earliest = left_out.groupBy("key", "at").agg(F.min(F.struct("first", "id")).alias("e"))
    changed = left_out.join(earliest, ["key", "at"]).where("e.first < first").select("id", F.col("e.id").alias("other"))
    # A word more or less: one line's variant is the other line.
    whole = meeting.where("at = 0").select("key", F.col("id").alias("other"), F.col("first").alias("other_first"))
    later = F.col("other_first") < F.col("first")
    longer = left_out.join(whole, "key").select(F.when(later, F.col("id")).otherwise(F.col("other")).alias("id"), F.when(later, F.col("other")).otherwise(F.col("id")).alias("other"))
    pairs = changed.union(longer).distinct()

    texts = suspects.select("id", _half(F.col("words")).alias("half"), F.split("words", " ").alias("words"))
    checked = pairs.join(texts, "id").join(texts.select(F.col("id").alias("other"), F.col("words").alias("other_words")), "other")
    near = checked.where(one_edit(F.col("words"), F.col("other_words"))).select("id", "half", F.lit(True).alias("near")).distinct()

    # Lines that occur once and have no partner stay without another look. The rest is written, so that the join may split a very common line.
    settled = cut_lineage(firsts.join(near, ["id", "half"], "left").where("n > 1 or near").select("id", "half", "first", "near"))
    dropped = named.select("id", "half", _place().alias("place")).join(settled, ["id", "half"]).where(F.col("near") | (F.col("first") != F.col("place")))
    return dropped.select("place.*")


def dedup_lines(docs: DataFrame, min_words: int = 1, near_words: int = 5) -> DataFrame:
    """All columns of ``docs``, with the text without repeated lines, and n_lines and n_dropped.

    Rows that repeat doc_id and text are one document, with one result for each row.
    """
    with scratch_scope(docs.sparkSession):
        lines = repeated_lines(docs, min_words, near_words)
        gone = cut_lineage(lines.groupBy(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text")).agg(F.collect_set("line").alias("gone")), outlive=True)
    docs = docs.drop("n_lines", "n_dropped")
    match = F.col("d.doc_id").eqNullSafe(F.col("g.of")) & (F.xxhash64("d.text") == F.col("g.of_text"))
    joined = docs.alias("d").join(gone.alias("g"), match, "left")
    kept = let(F.split("d.text", "\n"), lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("g.gone")), lambda i: F.get(lines, i)))
    text = F.when(F.col("g.gone").isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns]
    n_lines = F.when(F.col("d.text").isNull(), 0).otherwise(F.size(F.split("d.text", "\n")))
    return joined.select(*columns, n_lines.cast("bigint").alias("n_lines"), F.when(F.col("g.gone").isNull(), 0).otherwise(F.size("g.gone")).cast("bigint").alias("n_dropped"))
