"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts the n-grams (runs of code points) of labelled texts per language
in each task and adds the counts up in Spark. The matrix of log probabilities is
broadcast: languages times buckets, so its size is bounded by the label values.
Scoring is a product of sparse rows (a text's buckets, repeated as often as they
occur) with that matrix, for a batch of texts at a time in numpy.

A text that is null or has no letter is ``und`` with score 0; letters are what
Unicode has in its letter categories, so neither digits nor number signs. Rows
without a label are not learned from; with no labelled row at all every text is
``und``. Equal scores go to the first language by name. Whole texts are used,
in pieces where they are very long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 18  # characters of a text that are hashed at a time
BATCH = 1 << 20  # n-grams that are scored at a time


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # buckets x languages, float32
    log_prior: np.ndarray
    orders: tuple[int, ...]


def hashed_ngrams(codes: np.ndarray, orders: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """Bucket of the n-gram of code points that starts at each place, one array for each order."""
    mixed = np.zeros(len(codes), np.uint32)
    for n in range(1, max(orders) + 1):
        mixed = mixed[: len(codes) - n + 1] if len(codes) >= n else mixed[:0]
        mixed = (mixed ^ codes[n - 1 :]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        if n in orders:
            yield (mixed + np.uint32(n * 0x2545F491 & 0xFFFFFFFF)) % np.uint32(buckets)


def text_buckets(text: str, orders: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, in lower case and between blanks; long texts piece by piece."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(codes), PIECE):
        for found in hashed_ngrams(codes[at : at + PIECE + max(orders) - 1], orders, buckets):
            yield found[:PIECE]


def _counted(text: str, orders: tuple[int, ...], buckets: int) -> np.ndarray:
    """How often each bucket occurs in a text."""
    return sum(np.bincount(found, minlength=buckets) for found in text_buckets(text, orders, buckets))


def fit_languages(docs: DataFrame, orders: tuple[int, ...] = (1, 2, 3), buckets: int = 1 << 15, smoothing: float = 0.5) -> LanguageModel:
    """Learn from all rows of ``docs`` (text, lang) whose lang is not null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                if has_letter(text):
                    seen[lang] = seen.get(lang, 0) + _counted(text, orders, buckets)
                    docs_of[lang] = docs_of.get(lang, 0) + 1
        for lang, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch(
                [pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], docs_of[lang]).astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    partial = docs.where("lang is not null").select("text", "lang").mapInArrow(count, "lang string, bucket int, n bigint")
    total = partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # As many rows as the matrix has cells that are not empty.
    table = total.toArrow()
    named, bucket, n = table.column("lang").to_pylist(), table.column("bucket").to_numpy(), table.column("n").to_numpy()
    languages = sorted(set(named))
    place = {lang: i for i, lang in enumerate(languages)}
    column = np.array([place[lang] for lang in named], np.int64)
    counts, n_docs = np.zeros((buckets, len(languages))), np.zeros(len(languages))
    counts[bucket[bucket >= 0], column[bucket >= 0]] = n[bucket >= 0]
    n_docs[column[bucket < 0]] = n[bucket < 0]
    learned = n_docs > 0
    counts, n_docs = counts[:, learned], n_docs[learned]
    log_prob = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * buckets)
    return LanguageModel([x for x, ok in zip(languages, learned) if ok], log_prob.astype(np.float32), np.log(n_docs / max(n_docs.sum(), 1)), orders)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs`` but those of that name, with lang_pred and score (the posterior of lang_pred)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    at = kept.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                langs, scores = _best(m, batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"]
                )

    return docs.select(*kept).mapInArrow(predict, schema)


def _joint(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Log probability of each text under each language, texts times languages.

    The sparse rows of the texts lie one after the other; their products with
    the matrix are sums of its rows.
    """
    joint = np.tile(model.log_prior, (len(texts), 1))
    parts: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def add() -> None:
        nonlocal held
        if held:
            starts = np.cumsum([0, *map(len, parts[:-1])])
            np.add.at(joint, owners, np.add.reduceat(model.log_prob[np.concatenate(parts)], starts, axis=0, dtype=np.float64))
            parts.clear()
            owners.clear()
            held = 0

    for i, text in enumerate(texts):
        for found in text_buckets(text, model.orders, len(model.log_prob)):
            if len(found):
                parts.append(found)
                owners.append(i)
                held += len(found)
            if held >= BATCH:
                add()
    add()
    return joint


def _best(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    known = [i for i, text in enumerate(texts) if has_letter(text)] if model.languages else []
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if known:
        joint = _joint(model, [texts[i] for i in known])
        best = joint.argmax(axis=1)
        sure = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
        for i, lang, score in zip(known, best, sure):
            langs[i], scores[i] = model.languages[lang], float(score)
    return langs, scores
