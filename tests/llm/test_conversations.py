"""Conversation repair against a search over edit sequences."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import conversation_repair as repair
from ledgerloom.llm.queries import op13_conversation_repair

DATA = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def harmed(rows):
    """The query's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def searched(rows):
    """Cheapest, then ASCII-least edits of (role, text, must go, truncated) rows, and the rows they leave."""
    ahead = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, at, last, left = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, edits, left
        name = {"u": "user", "a": "assistant"}[ahead[last]]
        heapq.heappush(heap, (cost + 5, edits + "I", at, ahead[last], (*left, (name, ""))))
        if at < len(rows):
            role, text, gone, cut = rows[at]
            heapq.heappush(heap, (cost + 2, edits + "D", at + 1, last, left))
            if not gone:
                heapq.heappush(heap, (cost + 1 + 5 * cut, edits + "R", at + 1, ahead[last], (*left, (name, text))))
                if role[:1] == ahead[last] or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (cost + 5 * cut, edits + "K", at + 1, role[:1], (*left, (role, text))))


def expected(rows, ids):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv in ids:
        own = sorted(of[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, marked, counts = set(), [], defaultdict(int)
        for _, role, text in own:
            letters = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, edits, left = searched(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, edits, digest))
    return out


def same(got, wanted):
    order = lambda r: (r[0] is None, str(r[0]))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=order) == sorted(wanted, key=order)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"key": F.lit(1), "stretch": F.lit("clash"), "digest": F.lit(2.0)})


def test_query_against_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(op13_conversation_repair(spark, DATA).collect(), expected(harmed(rows), {r[0] for r in rows}))


def test_random_conversations(spark):
    draw = random.Random(5)
    texts = ["Yes.", "No!", "cut off", "Why? ", "", " \t", "long " * 40 + "end."]
    rows = []
    for conv in range(400):
        for turn in range(draw.randint(1, 14)):
            at = None if draw.random() < 0.05 else turn * draw.choice([1, 1, 1, 3000]) - draw.choice([0, 0, 5])
            rows.append((conv if conv else None, at, draw.choice(["user", "assistant", "system", "tool", "", None, "u"]), draw.choice([*texts, None, f"Text {draw.random()}."])))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    same(repair.repair_conversations(table(spark, rows)).collect(), expected(rows, {r[0] for r in rows}))


def test_one_long_conversation_is_dealt_to_many_stretches(spark):
    draw = random.Random(6)
    rows = [(7, t, draw.choice(["user", "assistant", "assistant", "system"]), f"Text {t}{draw.choice(['.', ''])}") for t in range(-3000, 27_000)]
    rows += [(8, 0, "user", "x" * 1_000_000 + "."), (8, 1, "assistant", "y " * 500_000 + "!")]
    frame = table(spark, rows)
    edits, _ = repair.edit_stretches(frame)
    assert edits.where("key = 'v7'").count() >= 8
    got = {r.conv_id: r for r in repair.repair_conversations(frame).collect()}
    cost, audit, left = searched([(r[2], r[3], False, r[3][-1] != ".") for r in rows if r[0] == 7])
    assert (got[7].cost, got[7].audit) == (cost, audit) and got[8].audit == "KK"
    assert got[7].repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()


def test_equal_rows_and_empty_table(spark):
    rows = [(1, 4, "user", "Same.")] * 50_000 + [(1, 5, "assistant", "Reply.")]
    (got,) = repair.repair_conversations(table(spark, rows)).collect()
    assert (got.duplicate, got.cost, got.audit) == (49_999, 2 * 49_999, "K" + "D" * 49_999 + "K")
    assert repair.repair_conversations(table(spark, [])).count() == 0
    (none,) = repair.repair_conversations(table(spark, []), table(spark, [(3, 0, "user", "x")])).collect()
    assert (none.cost, none.audit, none.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("symbol", range(9))
def test_powers(symbol):
    step = repair.power(symbol, 0)
    total = repair.IDENTITY
    for n in range(1, 40):
        total = repair._product(total, step)
        assert repair.run_matrix(symbol, n) == total
