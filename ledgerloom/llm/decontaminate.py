"""Benchmark decontamination: CGK embeddings and bit-sampling LSH over windows.

A benchmark item occurs in a document if some run of its words, of whatever
length, is within ``max_edits`` (a share of the item's words) of it in word edit
distance, so left-out and added words count once each. Windows and items are embedded by random walks: at step j the walk
writes the word it stands on and moves on or stays, by a random bit of j and
that word. After an edit two walks soon fall into step again, so a small edit
distance becomes a small Hamming distance. Each repetition draws another walk
and a few of its places; windows and items with equal words at these places are
candidates, and for every candidate the least edit distance of the item to any
run of words about the window is computed exactly. The number of repetitions
follows from the target recall. Windows are longer than their item by the edits
allowed, and end with the document where that is shorter.

Only windows that can match are embedded: within the bound, some run of words
between two edits is left whole, so the window has a short run of words in
common with the item at a place that says where the window starts.

The benchmark is a query set: it is taken in blocks of ``BLOCK`` items whose index
is broadcast and dropped one after the other, and documents are searched where they are read,
without a shuffle. Null and empty texts and items match nothing. Items or
documents that repeat are reported each on their own.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import WORD, WordHashes, byte_words, mixed, shingle_hashes
from ledgerloom.session import cut_lineage

BLOCK = 5000
LONGEST_RUN = 8
DRAWN = 2  # places of a walk in one key
SAMPLES = 4  # keys from one walk
MANY = 1 << 14  # windows that are embedded at a time
FILTER = 1 << 22

SCHEMA = "doc_id bigint, item_id bigint, start bigint, n_words bigint, distance bigint"


def repetitions(recall: float, max_edits: float) -> int:
    """Keys to draw so that a window at the bound meets its item with probability ``recall``.

    A word left out or added costs up to three places of a walk until it is in
    step again, so at the bound a drawn place differs with probability
    3 * max_edits at most. Keys drawn from one walk are alike, so three times as
    many are taken.
    """
    meets = (1 - min(0.9, 3 * max_edits)) ** DRAWN
    return 3 * math.ceil(math.log(1 - recall) / math.log(1 - meets))


def walk_keys(windows: np.ndarray, length: int, n_keys: int, seed: int = 17) -> np.ndarray:
    """Keys of each window (rows of word hashes) for items of ``length`` words: ``SAMPLES`` draws of places from each walk."""
    rows, width = windows.shape
    steps, each = 2 * length, np.arange(rows)
    padded = np.concatenate([windows, np.zeros((rows, 1), np.uint64)], axis=1)
    draw = np.random.default_rng([seed, length])
    keys = np.tile(np.arange(n_keys, dtype=np.uint64), (rows, 1))
    for first in range(0, n_keys, SAMPLES):
        salts = draw.integers(0, 1 << 63, steps, dtype=np.uint64)
        samples: dict[int, list[int]] = defaultdict(list)
        for k in range(first, min(first + SAMPLES, n_keys)):
            for j in draw.choice(steps, min(DRAWN, steps), replace=False).tolist():
                samples[j].append(k)
        at = np.zeros(rows, np.int64)
        for j in range(max(samples) + 1):
            word = padded[each, at]
            for k in samples.get(j, ()):
                keys[:, k] = mixed(keys[:, k] * np.uint64(31) + word)
            bit = ((word ^ salts[j]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)
            at = np.minimum(at + bit.astype(np.int64), width)
    return keys


def edit_distance(a: list, b: list, most: int) -> int:
    """Word edit distance, or most + 1 if it is larger; a band of the table is computed."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = [j if j <= most else most + 1 for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        new = [most + 1] * (len(b) + 1)
        new[0] = min(i, most + 1)
        for j in range(low, high + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row[max(0, low - 1) : high + 1]) > most:
            return most + 1
    return min(row[-1], most + 1)


def word_bits(item: list) -> dict:
    """For each word of an item, its places counted from the end, as bits."""
    bits: dict = defaultdict(int)
    for place, word in enumerate(reversed(item)):
        bits[word] |= 1 << place
    return dict(bits)


def best_match(bits: dict, n: int, text: list) -> tuple[int, int]:
    """(distance, start) of the run of words in ``text`` nearest to an item of n words, at its first start.

    Myers' bit-parallel columns from the last word to the first: after each one
    ``distance`` is that of the item to the best run that starts there.
    """
    mask, top = (1 << n) - 1, 1 << (n - 1)
    rises, falls, distance = mask, 0, n
    best = (n, len(text))
    for start in range(len(text) - 1, -1, -1):
        equal = bits.get(text[start], 0)
        down = equal | falls
        across = (((equal & rises) + rises) ^ rises) | equal
        up = (falls | ~(across | rises)) & mask
        less = rises & across
        distance += bool(up & top) - bool(less & top)
        up, less = up << 1, less << 1
        rises = (less | ~(down | up)) & mask
        falls = up & down & mask
        best = min(best, (distance, start))
    return best


class ItemIndex:
    """One block of items: their runs of words, and their keys by length."""

    def __init__(self, items: list[tuple[int, str]], max_edits: float, recall: float):
        self.n_keys, hashes = repetitions(recall, max_edits), WordHashes()
        self.max_edits, self.ids, self.words, self.most, self.bits = max_edits, [], [], [], []
        runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for item_id, text in items:
            words = hashes.of(byte_words(text))
            n = len(words)
            if not n:
                continue
            most = self.edits(n)
            size = min(LONGEST_RUN, math.ceil((n - most) / (most + 1)))
            for offset, run in enumerate(shingle_hashes(words, size).tolist()):
                runs[size].append((run, n, offset))
            self.ids.append(item_id)
            self.words.append(words.tolist())
            self.most.append(most)
            self.bits.append(word_bits(self.words[-1]))
        # For each size of run: sorted hashes with the length and offset of the items they come from.
        self.runs = {size: np.array(sorted(set(found)), np.dtype([("run", "<u8"), ("n", "<i8"), ("offset", "<i8")])) for size, found in runs.items()}
        self.filters = {}
        for size, found in self.runs.items():
            self.filters[size] = np.zeros(FILTER, bool)
            self.filters[size][found["run"] % FILTER] = True
        self.tables: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for n in {len(w) for w in self.words}:
            own = [i for i, w in enumerate(self.words) if len(w) == n]
            keys = walk_keys(np.array([self.words[i] for i in own], np.uint64), n, self.n_keys)
            table: dict[int, list[int]] = defaultdict(list)
            for i, row in zip(own, keys.tolist()):
                for key in row:
                    table[key].append(i)
            known = sorted(table)
            self.tables[n] = np.array(known, np.uint64), [table[key] for key in known]

    def edits(self, n: int) -> int:
        """Edits allowed in an item of n words."""
        return int(self.max_edits * n)

    def windows(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Length and starts of the windows that have a run of words in common with an item of that length."""
        for size, known in self.runs.items():
            if len(words) < size:
                continue
            runs = shingle_hashes(words, size)
            at = np.flatnonzero(self.filters[size][runs % np.uint64(FILTER)])
            low, high = (np.searchsorted(known["run"], runs[at], side) for side in ("left", "right"))
            for place, x, y in zip(at.tolist(), low.tolist(), high.tolist()):
                for n, offset in known[["n", "offset"]][x:y].tolist():
                    least = n - self.edits(n)
                    if len(words) >= least:
                        yield n, min(max(place - offset, 0), len(words) - least)

    def search(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, start, distance): items found in each text, by position, with the first best window."""
        waiting: dict[int, set[tuple[int, int]]] = defaultdict(set)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for i, words in enumerate(texts):
            for n, start in self.windows(words):
                waiting[n].add((i, start))
                if len(waiting[n]) >= MANY:
                    self._embed(texts, n, waiting.pop(n), found)
        for n, windows in waiting.items():
            self._embed(texts, n, windows, found)
        for (i, item), (distance, start) in sorted(found.items()):
            yield i, item, start, distance

    def _embed(self, texts: list[np.ndarray], n: int, windows: set[tuple[int, int]], found: dict[tuple[int, int], tuple[int, int]]) -> None:
        """Look the keys of windows for items of n words up, and keep the items that are close enough."""
        places, most = sorted(windows), self.edits(n)
        rows = np.zeros((len(places), n + most), np.uint64)
        for row, (i, start) in zip(rows, places):
            words = texts[i][start : start + n + most]
            row[: len(words)] = words
        keys, (known, owners) = walk_keys(rows, n, self.n_keys), self.tables[n]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        for row in np.flatnonzero((known[at] == keys).any(axis=1)).tolist():
            i, start = places[row]
            hits = at[row][known[at[row]] == keys[row]].tolist()
            # Words added or left out before the run that named the window move the start by as many.
            first = max(0, start - most)
            near = texts[i][first : start + n + 2 * most].tolist()
            for item in sorted({x for hit in hits for x in owners[hit]}):
                distance, begin = best_match(self.bits[item], n, near)
                if distance <= most and (distance, first + begin) < found.get((i, item), (distance + 1, 0)):
                    found[i, item] = (distance, first + begin)


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))


def short_items(benchmark: DataFrame, min_words: int) -> DataFrame:
    """Items with words, but fewer than ``min_words``: those that ``find_items`` leaves out."""
    return benchmark.where(n_words(F.col("text")).between(1, min_words - 1))


def find_items(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, recall: float = 0.99, min_words: int = 1) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance) for every item that occurs in a document, at its best window.

    Items of fewer than ``min_words`` words are not searched for; ``short_items`` lists them.
    """
    spark = docs.sparkSession
    docs, items = docs.select("doc_id", "text"), benchmark.select("item_id", "text").where(n_words(F.col("text")) >= max(1, min_words))
    blocks = math.ceil(items.count() / BLOCK)
    found = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(ItemIndex([tuple(r) for r in rows], max_edits, recall))
        matches = _find_block(docs, shared)
        if blocks > 1:  # written, so that one block's index is held at a time
            matches = cut_lineage(matches)
            shared.destroy()
        found.append(matches)
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], SCHEMA)


def _find_block(docs: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hashes = shared.value, WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = [hashes.of(byte_words(text.as_py())) for text in batch.column(1)]
                ids = batch.column(0)
                rows = [(ids[i].as_py(), index.ids[item], start, len(index.words[item]), distance) for i, item, start, distance in index.search(texts)]
                if rows:
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows)], names=["doc_id", "item_id", "start", "n_words", "distance"])

    return docs.mapInArrow(run, SCHEMA)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, recall: float = 0.99, min_words: int = 1) -> DataFrame:
    """The documents in which no item occurs. Rows that share a doc_id with such a document go too."""
    named = find_items(docs, benchmark, max_edits, recall, min_words).select(F.col("doc_id").alias("of")).distinct()
    return docs.alias("d").join(named.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.of")), "left_anti")
