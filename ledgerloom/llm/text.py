"""Shared pieces: words, lines and small literals."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the contracts: space and U+0009 to U+000D. bytes.split() without arguments cuts at just these.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once per row, also where a lambda uses it again and again."""
    return F.transform(F.array(value), body)[0]


def byte_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hash of each word, kept for the next time; emptied when full, so that its memory is bounded."""

    def __init__(self, entries: int = 1 << 19):
        super().__init__()
        self.entries = entries

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.entries:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in text order; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(total)])
    return total
