"""Byte-level BPE: encoding with a priority queue over a linked symbol list, decoding by vocabulary strings.

The vocabulary file is read on the driver and broadcast (its size does not
depend on the data). Documents are encoded where they are read, without a
shuffle. A null text is encoded like an empty one; the length of texts and of
single words is not limited, since merging takes n log n steps.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Unicode white space, and the published split pattern of byte-level BPE vocabularies.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"  # as a character class of re
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
# A run without white space, with the blank before it, is cut into pieces on its own: no piece crosses its ends.
RUNS = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b if b in set(plain) else next(other)) for b in range(256)]


class BpeCodec:
    """Encoder and decoder for the content of a tokenizer JSON file."""

    def __init__(self, content: str, cache_entries: int = 1 << 19):
        model = json.loads(content)
        vocab: dict[str, int] = model["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        alphabet = byte_alphabet()
        self.first = [vocab[c] for c in alphabet]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        to_byte = {c: b for b, c in enumerate(alphabet)}
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        strings = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items() if s not in special}
        strings |= {i: s.encode() for s, i in special.items()}
        self.strings = [strings.get(i, b"") for i in range(max(strings) + 1)]
        self.special = {s: i.to_bytes(4, "little") for s, i in special.items()}
        # The longest of several that fit at one place goes first.
        self.special_re = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pieces = regex.compile(PIECES)
        self.of_piece = _Cache(self.encode_piece, cache_entries)
        self.of_run = _Cache(self.encode_run, cache_entries)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece: the lowest rank first, the leftmost of equal ranks."""
        first, ranks = self.first, self.ranks
        ids = [first[b] for b in data]
        n = len(ids)
        # An entry is rank * n + position; it is stale unless the pair at its position still has that rank.
        queue = [ranks[pair] * n + i for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
        if not queue:
            return ids
        heapq.heapify(queue)
        after, before, made, pop, push = [*range(1, n), -1], [*range(-1, n - 1)], self.made, heapq.heappop, heapq.heappush
        while queue:
            rank, i = divmod(pop(queue), n)
            j = after[i]
            if j < 0 or ranks.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = made[rank], -1
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (found := ranks.get((ids[i], ids[k]))) is not None:
                    push(queue, found * n + i)
            if (p := before[i]) >= 0 and (found := ranks.get((ids[p], ids[i]))) is not None:
                push(queue, found * n + p)
        return [x for x in ids if x >= 0]

    def encode_run(self, run: str) -> bytes:
        if run.isalpha() or (run[0] == " " and run[1:].isalpha()):  # one piece of letters
            return self.of_piece[run]
        out, at = [], 0
        for m in self.pieces.finditer(run):
            if m.start() > at:  # white space
                out.append(self.of_piece[run[at : m.start()]])
            out.append(self.of_piece[m.group()])
            at = m.end()
        if at < len(run):
            out.append(self.of_piece[run[at:]])
        return b"".join(out)

    def encode_piece(self, piece: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.merge(piece.encode("utf-8", "surrogatepass")))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.special_re is None or not self.special_re.search(text):
            return b"".join(map(self.of_run.__getitem__, RUNS.findall(text)))
        out = []
        for part in self.special_re.split(text):
            out.append(self.special[part] if part in self.special else b"".join(map(self.of_run.__getitem__, RUNS.findall(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


class _Cache(dict):
    """Ids of strings seen before; emptied when full, so its memory is bounded. Long strings are not kept."""

    def __init__(self, encode: Callable[[str], bytes], entries: int):
        super().__init__()
        self.encode, self.entries = encode, entries

    def __missing__(self, key: str) -> bytes:
        ids = self.encode(key)
        if len(key) <= 64:
            if len(self) >= self.entries:
                self.clear()
            self[key] = ids
        return ids


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

_codecs: dict[int, BpeCodec] = {}


def _codec(shared) -> BpeCodec:
    """One codec for each Python worker and vocabulary."""
    content = shared.value
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = BpeCodec(content)
    return _codecs[key]


def _share(docs: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:  # a file of the driver
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """All columns of ``docs`` (but those of these names) with ids, little-endian unsigned 32-bit integers, and the decoded text."""
    shared = _share(docs, vocabulary)
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                ids = [codec.encode(text.as_py() or "") for text in batch.column(at)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())], names=[*kept, "ids", "decoded"])

    return docs.select(*kept).mapInArrow(run, docs.select(*kept).schema.add("ids", "binary").add("decoded", "string"))


def digest_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text, without moving either out of the task."""
    shared = _share(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for doc_ids, texts in _parts(batch):
                sizes, of_ids, of_text = [], [], []
                for text in texts:
                    ids = codec.encode(text)
                    sizes.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_text.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(sizes, pa.int64()), pa.array(of_ids), pa.array(of_text)], schema=DIGEST)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[pa.Array, Iterator[str]]]:
    """Short slices, so that only a few texts are Python strings at a time."""
    for at in range(0, batch.num_rows, rows):
        piece = batch.slice(at, rows)
        yield piece.column(0), (value.as_py() or "" for value in piece.column(1))
