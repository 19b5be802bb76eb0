"""Conversation structure repair: run-length dynamic programming over min-plus transitions.

A conversation should read ``(system? (user assistant)+)?``. Every row gets one
symbol: the class of its role, whether it is truncated, or that it must go
(blank, or a repeat of an earlier row). Equal consecutive symbols are collapsed
to runs. A symbol is a 4 x 4 matrix over min-plus: the cheapest edits that lead
from one place of the pattern to another. A run of n symbols is the n-th power,
put together from cached binary powers, and a stretch of a conversation is the
product of its runs. From the cost to go behind a stretch its choices are
unrolled row by row, the ASCII-least of the cheapest first.

Stretches are the rows of ``STRETCH`` consecutive turn numbers, so that a
conversation with a large part of all rows is worked on by many tasks: each
stretch gives its matrix, the matrices of a conversation (16 numbers each) are
chained, each stretch unrolls its choices for every state it may start in, and
the states are chained. Texts take no part in this; ``repaired_turns`` deals
them out by stretch as well. Only the hash of a whole conversation has to pass
through one task, as a stream that holds one row at a time.

Defined results: null ids, turns and roles are values of their own (null turns
come first); null role or text is one space. Rows of one turn are ordered by
role, then by the md5 of their text; equal rows are counted, not listed. A role
is told by its first character; an empty role fits nowhere. Extra columns are
left out. An empty table gives an empty result; texts may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.streams import Rows, by_key
from ledgerloom.session import cut_lineage

STRETCH_BITS = 12  # 4,096 turn numbers
NEVER = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States: nothing yet, after system, after user, after assistant. A conversation may end in the first and the last.
STATES = range(4)
FOLLOWS = (2, 2, 3, 2)  # where an inserted or re-roled row leads
CLASSES = {"s": 0, "u": 1, "a": 2}
OTHER, GONE = 3, 8  # class of other roles; symbol of rows that must go. Other symbols: class + 4 if truncated
NO_SLICE = -(1 << 62)

Matrix = tuple[tuple[int, ...], ...]


def _kept_state(symbol: int, state: int) -> int | None:
    """Where a kept row leads; None if it does not fit."""
    kind = symbol & 3
    if kind == 0:
        return 1 if state == 0 else None
    if kind == 1:
        return 2 if state != 2 else None
    return 3 if kind == 2 and state == 2 else None


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in STATES), NEVER) for j in STATES) for i in STATES)


def _applied(a: Matrix, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to go before a stretch from the cost to go behind it."""
    return tuple(min(min(a[i][k] + costs[k] for k in STATES), NEVER) for i in STATES)


IDENTITY: Matrix = tuple(tuple(0 if i == j else NEVER for j in STATES) for i in STATES)


def _inserts() -> Matrix:
    rows = [list(row) for row in IDENTITY]
    for state in STATES:
        at, cost = FOLLOWS[state], INSERT
        while cost < rows[state][at]:
            rows[state][at], at, cost = cost, FOLLOWS[at], cost + INSERT
    return tuple(map(tuple, rows))


INSERTS = _inserts()
# Cost to go behind the last row.
END = _applied(INSERTS, (0, NEVER, NEVER, 0))


@lru_cache(None)
def power(symbol: int, k: int) -> Matrix:
    """Transition of 2**k rows with this symbol, inserts before each row included."""
    if k:
        return _product(power(symbol, k - 1), power(symbol, k - 1))
    step = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        step[state][state] = DELETE
        if symbol != GONE:
            more = TRUNCATED if symbol & 4 else 0
            step[state][FOLLOWS[state]] = min(step[state][FOLLOWS[state]], REROLE + more)
            if (kept := _kept_state(symbol, state)) is not None:
                step[state][kept] = min(step[state][kept], KEEP + more)
    return _product(INSERTS, tuple(map(tuple, step)))


Runs = tuple[tuple[int, int], ...]


def run_matrix(symbol: int, n: int) -> Matrix:
    total, k = IDENTITY, 0
    while n >> k:
        if n >> k & 1:
            total = _product(total, power(symbol, k))
        k += 1
    return total


@lru_cache(1 << 14)
def _short_matrix(runs: Runs) -> Matrix:
    total = IDENTITY
    for symbol, n in runs:
        total = _product(total, run_matrix(symbol, n))
    return total


def stretch_matrix(runs: Runs) -> Matrix:
    return _short_matrix(runs) if len(runs) <= 16 else _short_matrix.__wrapped__(runs)


def _unrolled(runs: Runs, behind: tuple[int, ...], state: int) -> tuple[int, str]:
    """Last state and edits of the ASCII-least of the cheapest ways through a stretch."""
    ends = [behind]
    for symbol, n in reversed(runs):
        ends.append(_applied(run_matrix(symbol, n), ends[-1]))
    ends.reverse()
    edits: list[str] = []
    for (symbol, n), after in zip(runs, ends[1:]):
        if symbol == GONE:
            edits.append("D" * n)  # no edit sorts before it, and inserts may as well come later
            continue
        costs, step = [after], power(symbol, 0)
        for _ in range(n):
            costs.append(_applied(step, costs[-1]))
        more = TRUNCATED if symbol & 4 else 0
        for left in range(n, 0, -1):
            now, then = costs[left], costs[left - 1]
            while True:
                nxt, kept = FOLLOWS[state], _kept_state(symbol, state)
                if DELETE + then[state] == now[state]:
                    edits.append("D")
                elif INSERT + now[nxt] == now[state]:
                    edits.append("I")
                    state = nxt
                    continue
                elif kept is not None and KEEP + more + then[kept] == now[state]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = nxt
                break
    return state, "".join(edits)


_short_unrolled = lru_cache(1 << 14)(_unrolled)


def unrolled(runs: Runs, behind: tuple[int, ...], state: int) -> tuple[int, str]:
    return (_short_unrolled if len(runs) <= 16 else _unrolled)(runs, behind, state)


def closing(state: int) -> str:
    """Inserts after the last row."""
    edits = ""
    while state not in (0, 3):
        edits, state = edits + "I", FOLLOWS[state]
    return edits


def _key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), "n").otherwise(F.concat(F.lit("v"), conv_id.cast("string")))


def _filled(rows: DataFrame) -> DataFrame:
    """key, turn, role and text of every row, with the stretch it belongs to."""
    turn = F.col("turn").cast("bigint")
    return rows.select(
        _key(F.col("conv_id")).alias("key"),
        F.coalesce(F.shiftright(turn, STRETCH_BITS), F.lit(NO_SLICE)).alias("stretch"),
        turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.md5("text")))


def row_faults(rows: DataFrame) -> DataFrame:
    """One row for equal rows (key, stretch, turn, role, digest) with their number, and whether the first is blank, a repeat or truncated."""
    blank = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")) == 0
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    marked = _filled(rows).withColumns({"blank": blank, "cut": cut})
    equal = marked.groupBy("key", "stretch", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    again = equal.where(~F.col("blank")).groupBy("key", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    joined = equal.join(again.drop("turns"), ["key", "role", "digest"], "left")
    return joined.withColumn("again", F.col("first").isNotNull() & (F.col("first") != place)).drop("first")


STRETCH_SCHEMA = (
    "key string, stretch bigint, runs array<bigint>, matrix array<bigint>, low bigint, high bigint, turns bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string"
)


def _stretch(key: tuple, rows: Rows) -> Iterator[tuple]:
    """Runs, matrix and counts of a stretch; rows: key, stretch, turn, role, digest, blank, cut, n, again."""
    symbols: list[tuple[int, int]] = []
    blanks = repeats = cuts = illegal = 0
    tail = None
    for _, _, _, role, _, blank, cut, n, again in rows:
        initial = role[:1]
        illegal += n - 1 + (tail is not None and tail + initial not in ("su", "ua", "au"))
        tail = initial
        if blank:
            blanks += n
            symbols.append((GONE, n))
            continue
        repeats += n - 1 + again
        cuts += cut and not again
        if not again:
            symbols.append((CLASSES.get(initial, OTHER) + (4 if cut else 0), 1))
        if n - 1 + again:
            symbols.append((GONE, n - 1 + again))
    runs = tuple((s, sum(n for _, n in same)) for s, same in groupby(symbols, lambda x: x[0]))
    known = [row[2] for row in rows if row[2] is not None]
    yield (
        *key, [x for run in runs for x in run], [x for line in stretch_matrix(runs) for x in line],
        min(known, default=None), max(known, default=None), len(set(known)), blanks, repeats, cuts, illegal, rows[0][3][:1], tail,
    )


def _pairs(flat: list[int]) -> Runs:
    return tuple(zip(flat[::2], flat[1::2]))


def _chain(key: tuple, rows: Rows) -> Iterator[tuple]:
    """Cost to go behind every stretch; the sums of the conversation go with its first one."""
    behind, ends = END, []
    for row in reversed(rows):
        ends.append(behind)
        flat = row[2]
        behind = _applied(tuple(tuple(flat[i * 4 : i * 4 + 4]) for i in STATES), behind)
    borders = sum(a[10] + b[9] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    low, high = min((r[3] for r in rows if r[3] is not None), default=None), max((r[4] for r in rows if r[4] is not None), default=None)
    gaps = 0 if low is None else high - low + 1 - sum(r[5] for r in rows)
    sums = (gaps, *(sum(r[i] for r in rows) for i in (6, 7, 8)), sum(r[11] for r in rows) + borders, behind[0])
    for i, (row, end) in enumerate(zip(rows, reversed(ends))):
        yield (*row[:2], list(end), *(sums if i == 0 else (None,) * len(sums)))


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every state a stretch may start in, the state behind it and its edits."""
    for batch in batches:
        keys, stretches, runs, ends, firsts = (batch.column(c).to_pylist() for c in ("key", "stretch", "runs", "behind", "is_first"))
        found = [[unrolled(_pairs(r), tuple(e), s) if s == 0 or not first else (0, "") for s in STATES] for r, e, first in zip(runs, ends, firsts)]
        yield pa.record_batch(
            [pa.array(keys, pa.string()), pa.array(stretches, pa.int64()), pa.array([[s for s, _ in f] for f in found], pa.list_(pa.int64())), pa.array([[e for _, e in f] for f in found], pa.list_(pa.string()))],
            names=["key", "stretch", "leads", "edits"],
        )


def _picked(key: tuple, rows: Rows) -> Iterator[tuple]:
    """The way of every stretch that follows from the state before it; the last one gets the closing inserts."""
    state = 0
    for i, (_, stretch, leads, edits) in enumerate(rows):
        start, state = state, leads[state]
        yield key[0], stretch, start, edits[start] + (closing(state) if i == len(rows) - 1 else "")


def edit_stretches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, stretch, start, edits) of every stretch, and the counts and cost of every conversation."""
    sorted_by = ["turn", "role", "digest"]
    stretches = cut_lineage(by_key(row_faults(rows), ["key", "stretch"], sorted_by, _stretch, STRETCH_SCHEMA))
    chain_input = stretches.select("key", "stretch", "matrix", "low", "high", "turns", "blank", "duplicate", "truncated", "head", "tail", "illegal")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    chained = cut_lineage(by_key(chain_input, ["key"], ["stretch"], _chain, "key string, stretch bigint, behind array<bigint>, " + ", ".join(f"{c} bigint" for c in counts)))
    known = chained.select("key", "stretch", "behind", F.col("gaps").isNotNull().alias("is_first"))
    ways = stretches.select("key", "stretch", "runs").join(known, ["key", "stretch"]).mapInArrow(_ways, "key string, stretch bigint, leads array<bigint>, edits array<string>")
    picked = by_key(ways, ["key"], ["stretch"], _picked, "key string, stretch bigint, start bigint, edits string")
    return cut_lineage(picked), chained.where("gaps is not null").select("key", *counts)


TURN_SCHEMA = "key string, stretch bigint, place bigint, role string, text string"


def _replayed(key: tuple, rows: Rows) -> Iterator[tuple]:
    """Rows that stay, are re-roled or inserted. rows: key, stretch, kind, turn, role, digest, text; the first has the edits as its text and the start as its turn."""
    state, edits, at, place = rows[0][3], rows[0][6], 1, 0
    for edit in edits:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = rows[at][4], rows[at][6]
            state = {"s": 1, "u": 2}.get(role[0], 3)
        else:
            state = FOLLOWS[state]
            role, text = ("user", "assistant")[state == 3], rows[at][6] if edit == "R" else ""
        at += edit != "I"
        yield (*key, place, role, text)
        place += 1


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(key, stretch, place, role, text) of the repaired conversations, by their order; ``edits`` from ``edit_stretches``."""
    kept = _filled(rows).select("key", "stretch", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    first = edits.select("key", "stretch", F.lit(0).alias("kind"), F.col("start").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), F.col("edits").alias("text"))
    return by_key(first.union(kept), ["key", "stretch"], ["kind", "turn", "role", "digest"], _replayed, TURN_SCHEMA)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the rows of a key, read as a stream."""
    key = digest = None
    done: list[tuple[str, str]] = []

    def packed() -> pa.RecordBatch:
        return pa.record_batch([pa.array([k for k, _ in done], pa.string()), pa.array([d for _, d in done], pa.string())], names=["key", "sha256"])

    for batch in batches:
        for k, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text"))):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if len(done) >= 4096:
            yield packed()
            done.clear()
    if key is not None:
        done.append((key, digest.hexdigest()))
        yield packed()


def turn_hashes(turns: DataFrame) -> DataFrame:
    """(key, sha256) of ``role:text`` lines of every conversation."""
    placed = turns.repartition("key").sortWithinPartitions("key", "stretch", "place")
    return placed.select("key", "role", "text").mapInArrow(_hashed, "key string, sha256 string")


def repair_conversations(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Counts, cost, audit and hash of every conversation of ``rows``, or of every one in ``ids`` (conv_id) also if it has no row.

    audit: the edits in order, K(eep), R(erole), D(elete) and I(nsert).
    """
    edits, counts = edit_stretches(rows)
    whole = F.array_sort(F.collect_list(F.struct("stretch", "edits")))
    audits = edits.groupBy("key").agg(F.array_join(F.transform(whole, lambda x: x["edits"]), "").alias("audit"))
    hashes = turn_hashes(repaired_turns(rows, edits))
    everyone = (rows if ids is None else ids).select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    joined = everyone.join(counts, "key", "left").join(audits, "key", "left").join(hashes, "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return joined.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults: by crc32 of ``conv_id:turn`` rows are dropped, emptied, cut, repeated or given to the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), draw.alias("draw")).where("draw <> 0")
    changed = rows.withColumns(
        {
            "text": F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
            "role": F.when(F.col("draw") == 4, "user").otherwise(F.col("role")),
            "copy": F.explode(F.sequence(F.lit(1), F.when(F.col("draw") == 3, 2).otherwise(1))),
        }
    )
    return changed.select("conv_id", "turn", "role", "text")
