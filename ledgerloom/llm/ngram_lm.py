"""Bigram language model in Elias-Fano tries, one for each shard of the vocabulary.

The model is a hierarchical Dirichlet one: P(w | c) = (n(c, w) + m P(w)) / (n(c) + m)
with P(w) = (n(w) + 0.1) / (N + 0.1 (V + 1)). Its numerator depends on the
predicted word's own counts only, and its denominator is a number for each word
in its role as context. So all tokens are dealt once, by the predicted word, to
shards; a shard counts its part of the corpus, builds its trie and scores its
part of every document; sums per document are added up at the end.

A trie has words (hashes) in its first level, with pointers to the contexts
each was seen after in the second. Words, pointers and contexts are monotone
sequences in Elias-Fano code; contexts are made monotone by the rank of their
word, and a query is a successor search from the word's first context to its
last. Each word and bigram of a shard is looked up once, and its number goes to
all its tokens. Log probabilities are quantised to 8 bits with a codebook for each shard.
Levels are files that the task maps into memory and removes at its end; a lost
task builds its trie anew from the shuffle.

Shards hold about ``SHARD_TOKENS`` tokens however large the corpus is. Words
with more than a quarter of a shard's tokens are split by context; their counts
(at most four for each shard) are broadcast. Words are named by 64-bit hashes
and contexts within a word by 32 bits. Null and empty texts have one token, the
end. Rows that repeat id and text are all counted and all returned.
"""

from __future__ import annotations

import math
import os
import tempfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.elias_fano import EliasFano
from ledgerloom.llm.text import WordHashes, byte_words, mixed

SHARD_TOKENS = 4_000_000
LEAST_SHARDS = 48
COUNTED = 1 << 22  # tokens that are counted at a time
PACKED = 1 << 19  # tokens in one batch of packed rows
LOOKED_UP = 1 << 19  # bigrams that are looked up at a time
END, BEGIN = np.uint64(1), np.uint64(2)  # as words and contexts; hashes of words are above


@dataclass(frozen=True)
class Totals:
    tokens: int  # N: training tokens
    types: int  # V: distinct training tokens
    shards: int
    hot: np.ndarray  # words that are split, sorted
    hot_counts: np.ndarray  # their training counts


def tokens_of(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of the words and the end."""
    words = hashes.of(byte_words(text))
    return np.append(np.maximum(words, np.uint64(16)), END)


def held_out(doc_id, divisor: int = 10) -> bool:
    """Whether crc32 of the id as text is a multiple of divisor; a null id counts as an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % divisor == 0


def corpus_totals(docs: DataFrame, holds_out: Callable) -> Totals:
    """Counts of all words, of which N, V and the split words come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, size = WordHashes(), ([], []), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = tokens_of(text.as_py(), hashes)
                waiting[not holds_out(doc_id.as_py())].append(found)
                size += len(found)
                if size >= COUNTED:
                    yield counted(waiting)
                    waiting, size = ([], []), 0
        yield counted(waiting)

    def counted(waiting: tuple[list, list]) -> pa.RecordBatch:
        both = [np.unique(np.concatenate(x or [np.empty(0, np.uint64)]), return_counts=True) for x in waiting]
        words = np.concatenate([w for w, _ in both])
        trained = np.concatenate([np.zeros(len(both[0][0]), np.int64), both[1][1]])
        return pa.record_batch([pa.array(words.view(np.int64)), pa.array(trained), pa.array(np.concatenate([n for _, n in both]).astype(np.int64))], names=["word", "trained", "n"])

    partial = docs.select("doc_id", "text").mapInArrow(count, "word bigint, trained bigint, n bigint")
    words = partial.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("n").alias("n")).persist()
    try:
        total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("trained"), F.lit(0)), F.count_if(F.col("trained") > 0)).first()
        shards = max(LEAST_SHARDS, math.ceil(total[0] / SHARD_TOKENS))
        hot = words.where(F.col("n") > total[0] / shards / 4).select("word", "trained").toPandas()  # 4 x shards rows at most
    finally:
        words.unpersist()
    names = hot["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    return Totals(int(total[1]), int(total[2]), shards, names[order], hot["trained"].to_numpy(np.int64)[order])


PACK = "shard int, docs binary, trains binary, words binary, counts binary, contexts binary, owners binary"


def packed_tokens(docs: DataFrame, shared, holds_out: Callable) -> DataFrame:
    """Tokens with their contexts by shard: one row for each shard and batch of documents.

    A word's hash is there once for each row, followed by its contexts (32
    bits) and the documents they are in (positions in the row's list).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, hashes = shared.value, WordHashes()
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                ids.append((doc_id.as_py(), xxhash.xxh3_64_intdigest(b"" if text is None else text.encode("utf-8", "surrogatepass"))))
                texts.append(tokens_of(text, hashes))
                size += len(texts[-1])
                if size >= PACKED or len(ids) >= 60_000:
                    yield pack(ids, texts, totals)
                    ids, texts, size = [], [], 0
        if ids:
            yield pack(ids, texts, totals)

    def pack(ids: list, texts: list[np.ndarray], totals: Totals) -> pa.RecordBatch:
        word = np.concatenate(texts)
        context = np.roll(word, 1)
        lengths = np.array([len(t) for t in texts])
        context[np.r_[0, np.cumsum(lengths)[:-1]]] = BEGIN
        context = (mixed(context) >> np.uint64(32)).astype(np.uint32)
        owner = np.repeat(np.arange(len(texts), dtype=np.uint16), lengths)
        shard = (word % np.uint64(totals.shards)).astype(np.int32)
        split = np.isin(word, totals.hot)
        shard[split] = ((word[split] + context[split]) % np.uint64(totals.shards)).astype(np.int32)
        order = np.lexsort((word, shard))
        word, context, owner, shard = word[order], context[order], owner[order], shard[order]
        keys = np.array([(0 if i is None else i, h) for i, h in ids], [("id", "<i8"), ("text", "<u8")])
        nulls = np.array([i is None for i, _ in ids], np.uint8)
        trains = np.array([not holds_out(i) for i, _ in ids], np.uint8) + 2 * nulls
        rows = []
        for s, low, high in _runs(shard):
            local, place = np.unique(owner[low:high], return_inverse=True)
            starts = np.array([x for _, x, _ in _runs(word[low:high])])
            counts = np.diff(np.r_[starts, high - low]).astype(np.uint32)
            rows.append((int(s), keys[local].tobytes(), trains[local].tobytes(), word[low:high][starts].tobytes(), counts.tobytes(), context[low:high].tobytes(), place.astype(np.uint16).tobytes()))
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), [pa.int32(), *[pa.binary()] * 6])], names=["shard", "docs", "trains", "words", "counts", "contexts", "owners"])

    return docs.select("doc_id", "text").mapInArrow(run, PACK)


def _runs(values: np.ndarray) -> list[tuple]:
    """(value, start, end) of each run of equal values."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return list(zip(values[starts].tolist(), starts.tolist(), np.r_[starts[1:], len(values)].tolist()))


class ShardTrie:
    """Two levels over the training tokens of a shard, in files mapped into memory."""

    def __init__(self, folder: str, word: np.ndarray, context: np.ndarray, totals: Totals, strength: float):
        """word and context of the training tokens."""
        self.words, rank = np.unique(word, return_inverse=True)
        pairs, seen = np.unique((rank.astype(np.uint64) << np.uint64(32)) | context, return_counts=True)
        counts = np.bincount(rank, minlength=len(self.words)).astype(np.int64)
        if len(totals.hot):  # a split word's own count is that of the whole corpus
            at = np.minimum(np.searchsorted(totals.hot, self.words), len(totals.hot) - 1)
            counts = np.where(totals.hot[at] == self.words, totals.hot_counts[at], counts)
        firsts = np.searchsorted(pairs, np.arange(len(self.words) + 1, dtype=np.uint64) << np.uint64(32))
        unigram = (counts + 0.1) / (totals.tokens + 0.1 * (totals.types + 1))
        exact = np.log10(seen + strength * unigram[(pairs >> np.uint64(32)).astype(np.int64)])
        self.codes, codebook = quantised(exact)
        self.codebook = codebook
        sequences = [
            (self.words, 1 << 64),  # first level: words
            (firsts.astype(np.uint64), len(pairs) + 1),  # pointers
            (np.r_[0, np.cumsum(counts)].astype(np.uint64), int(counts.sum()) + 1),  # counts of words
            (pairs, max(1, len(self.words)) << 32),  # second level: contexts above the rank of their word
        ]
        self.levels = [self._mapped(folder, i, EliasFano.of(v, universe)) for i, (v, universe) in enumerate(sequences)]
        np.save(os.path.join(folder, "codes.npy"), self.codes)
        self.codes = np.load(os.path.join(folder, "codes.npy"), mmap_mode="r")
        del self.words

    @staticmethod
    def _mapped(folder: str, level: int, coded: EliasFano) -> EliasFano:
        arrays = []
        for i, array in enumerate(coded.arrays()):
            path = os.path.join(folder, f"{level}-{i}.npy")
            np.save(path, array)
            arrays.append(np.load(path, mmap_mode="r"))
        return EliasFano(*arrays, coded.n, coded.width)

    def counts(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (-1 if unknown) and training count of each word."""
        level, _, counts, _ = self.levels
        if not level.n:
            return np.full(len(words), -1), np.zeros(len(words), np.int64)
        rank, known = level.successor(words, np.zeros(len(words), np.int64), np.full(len(words), level.n))
        rank = np.where(known, rank, 0)
        n = (counts.values(rank + 1) - counts.values(rank)).astype(np.int64)
        return np.where(known, rank, -1), np.where(known, n, 0)

    def ranges(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the contexts of each word start and end in the second level, by the pointers; nowhere for unknown words."""
        _, pointers, _, level = self.levels
        if not level.n:
            return np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        own = np.maximum(rank, 0)
        return tuple(np.where(rank >= 0, pointers.values(own + after).astype(np.int64), 0) for after in (0, 1))

    def log_numerators(self, rank: np.ndarray, context: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quantised log10 of n(c, w) + m P(w) where word and context are in the trie, and whether they are; ``low`` and ``high`` are the word's range."""
        level = self.levels[3]
        values, seen = np.zeros(len(rank)), np.zeros(len(rank), bool)
        known = np.flatnonzero(rank >= 0)
        if not len(known) or not level.n:
            return values, seen
        wanted = (rank[known].astype(np.uint64) << np.uint64(32)) | context[known]
        at, equal = level.successor(wanted, low[known], high[known])
        seen[known] = equal
        values[known[equal]] = self.codebook[self.codes[at[equal]]]
        return values, seen


def quantised(values: np.ndarray, bits: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Codes and codebook: bins of equal width, represented by the mean of their values."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1)
    low, width = values.min(), max(float(np.ptp(values)), 1e-9) / ((1 << bits) - 1)
    codes = np.rint((values - low) / width).astype(np.uint8)
    book = np.bincount(codes, weights=values, minlength=1 << bits) / np.maximum(np.bincount(codes, minlength=1 << bits), 1)
    return codes, book


SUMS = "doc_id bigint, no_id boolean, text_id bigint, n_tokens bigint, n_known bigint, n_end bigint, base double, score double"


def score_shard(table: pa.Table, totals: Totals, strength: float) -> pa.Table:
    """Sums of each document over one shard's tokens: counts, log10(n(w) + 0.1), and log10 of the model without N and V."""
    rows = {c: [np.frombuffer(b, t) for b in table.column(c).to_pylist()] for c, t in (("docs", [("id", "<i8"), ("text", "<u8")]), ("trains", "u1"), ("words", "<u8"), ("counts", "<u4"), ("contexts", "<u4"), ("owners", "<u2"))}
    keys, flags = np.concatenate(rows["docs"]), np.concatenate(rows["trains"])
    words, which = np.unique(np.concatenate(rows["words"]), return_inverse=True)
    which = np.repeat(which.astype(np.uint32), np.concatenate(rows["counts"]))  # of each token, its place among the words
    context = np.concatenate(rows["contexts"])
    offsets = np.cumsum([0] + [len(d) for d in rows["docs"][:-1]])
    owner = np.concatenate([o.astype(np.int64) + x for o, x in zip(rows["owners"], offsets)])
    del rows, table
    n_docs = len(keys)
    trained = (flags & 1).astype(bool)[owner]
    with tempfile.TemporaryDirectory() as folder:
        trie = ShardTrie(folder, words[which[trained]], context[trained], totals, strength)
        del trained
        # Every word and every bigram is looked up once, however many tokens have it.
        pairs, place = np.unique((which.astype(np.uint64) << np.uint64(32)) | context, return_inverse=True)
        place = place.astype(np.uint32)
        del context
        rank, n = trie.counts(words)
        starts, ends = trie.ranges(rank)
        if len(totals.hot):  # known by the broadcast counts even if no training token came to this shard
            at = np.minimum(np.searchsorted(totals.hot, words), len(totals.hot) - 1)
            n = np.where(totals.hot[at] == words, totals.hot_counts[at], n)
        unigram = np.log10((n + 0.1) * strength / (totals.tokens + 0.1 * (totals.types + 1)))
        # A word is the context of the token after it; the begin has as many of those as there are ends.
        denominator = np.log10(n + strength)
        model = np.empty(len(pairs))
        for low in range(0, len(pairs), LOOKED_UP):
            part = pairs[low : low + LOOKED_UP]
            of = (part >> np.uint64(32)).astype(np.int64)
            value, seen = trie.log_numerators(rank[of], part & np.uint64(0xFFFFFFFF), starts[of], ends[of])
            model[low : low + LOOKED_UP] = np.where(seen, value, unigram[of]) - denominator[of]
        del trie, pairs
    sums = np.zeros((5, n_docs))
    per_word = (n > 0, words == END, np.log10(n + 0.1))
    for low in range(0, len(which), LOOKED_UP):
        part = slice(low, low + LOOKED_UP)
        own, of = owner[part], which[part]
        for i, x in enumerate((None, *(x[of] for x in per_word), model[place[part]])):
            sums[i] += np.bincount(own, weights=x, minlength=n_docs)
    whole = [pa.array(s.astype(np.int64)) for s in sums[:3]]
    return pa.table([pa.array(keys["id"]), pa.array(flags >= 2), pa.array(keys["text"].view(np.int64)), *whole, pa.array(sums[3]), pa.array(sums[4])], schema=pa.schema(
        [("doc_id", pa.int64()), ("no_id", pa.bool_()), ("text_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_end", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]))


def score_documents(docs: DataFrame, holds_out: Callable = held_out, strength: float = 50.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``holds_out(doc_id)`` tells which documents are not learned from; ``strength`` is m.
    """
    totals = corpus_totals(docs, holds_out)
    shared = docs.sparkSession.sparkContext.broadcast(totals)
    packed = packed_tokens(docs, shared, holds_out)
    partial = packed.groupBy("shard").applyInArrow(lambda table: score_shard(table, shared.value, strength), SUMS)
    names = ("n_tokens", "n_known", "n_end", "base", "score")
    summed = partial.groupBy("doc_id", "no_id", "text_id").agg(*[F.sum(c).alias(c) for c in names])
    # Rows that repeat id and text were added up; each text has one end.
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_end").cast("int"))))
    per = {c: F.col(c) / F.col("n_end") for c in names}
    n_tokens = per["n_tokens"].cast("bigint")
    doc_id = F.when(~F.col("no_id"), F.col("doc_id"))
    out = F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0 if holds_out is held_out else F.udf(holds_out, "boolean")(doc_id)
    floor = math.log10(totals.tokens + 0.1 * (totals.types + 1))
    return each.select(
        doc_id.alias("doc_id"), out.alias("held_out"), n_tokens.alias("n_tokens"), per["n_known"].cast("bigint").alias("n_known"), F.lit(totals.tokens).cast("bigint").alias("train_tokens"),
        (per["base"] - n_tokens * floor).alias("base_score"), per["score"].alias("score"),
    )
