"""Hard-negative mining: exact integer scores by a residue number system, then windowed selection.

Components become integers, floor(256 x). A matrix of scores is one product of
float32 matrices for each of several primes: residues lie within half a prime
of zero, so that sums of a slice of the components stay below 2**24 and are
exact. Chinese remaindering (in mixed radix, all in 64-bit numbers) gives the
signed scores. Primes are taken until their product is more than twice the
largest score that the rows' sizes allow; that bound is found in one pass.

The anchors are a stated query set: every block of anchors meets every slice of
the rows in one task, first among equal labels for the positives, then, with
the windows known, among other labels. What a task returns for an anchor is its
best few rows, and a window function takes the best of these. Blocks and slices
have a bounded number of rows, also where one label has most of them; neither
passes through the driver. A row is shuffled once for each block of anchors.

Defined results: rows with a null label, vector or component, or a component
that is not finite, take no part, nor do rows without an id. Shorter vectors
count as filled up with zeros. A row is no partner of rows with its own id.
Where an id repeats, every row counts as a partner, and equal anchors count
once. Scores that do not fit 64 bits raise ArithmeticError, as sums do in ANSI
mode. Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import cut_lineage

BLOCK_BYTES = 1 << 24  # of the components of a block of anchors, or of a slice of rows, on average
TILE = 1 << 20  # scores that are held at a time
SCALE = 256
LARGEST_PRIME = 1 << 10
EXACT = 1 << 24  # whole numbers a float32 holds


def primes_for(bound: int, largest: int = LARGEST_PRIME) -> list[int]:
    """The largest primes below ``largest`` whose product exceeds 2 * bound."""
    found, total, n = [], 1, largest
    while total <= 2 * bound:
        n -= 1
        if n < 2:
            raise ArithmeticError(f"primes below {largest} do not reach {bound}")
        if all(n % d for d in range(2, math.isqrt(n) + 1)):
            found.append(n)
            total *= n
    return found


def centred(x: np.ndarray, prime: int) -> np.ndarray:
    """Residues between -prime/2 and prime/2."""
    rest = x % prime
    return rest - prime * (rest > prime // 2)


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [centred(x, p).astype(np.float32) for p in primes]


def _product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """a @ b.T modulo a prime, in slices of components that float32 sums exactly."""
    step = max(1, (EXACT - 1) // (prime // 2) ** 2)
    total = None
    for at in range(0, a.shape[1], step):
        part = centred((a[:, at : at + step] @ b[:, at : at + step].T).astype(np.int64), prime)
        total = part if total is None else centred(total + part, prime)
    return np.zeros((len(a), len(b)), np.int64) if total is None else total


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed inner products from residues, by mixed-radix Chinese remaindering.

    The digits are centred too, so that the sum is the signed score itself. All
    weights are at most twice the bound, so with a bound below 2**62 nothing
    leaves 64 bits.
    """
    parts = [_product(x, y, p) for x, y, p in zip(a, b, primes)]
    total, weight = parts[0].copy(), 1
    for i in range(1, len(primes)):
        p = primes[i]
        weight *= primes[i - 1]
        digit = centred(centred(parts[i] - total, p) * pow(weight, -1, p), p)
        total += digit * weight
    return total


def taking_part(rows: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and whole-number components of the rows that take part, as 64-bit bytes."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & fine)
    small = kept.select("vec_id", label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.append(0, vectors.value_lengths().to_numpy(zero_copy_only=False)))
            scaled = np.floor(flat * float(SCALE))
            if (np.abs(scaled) >= 1 << 31).any():
                raise ArithmeticError("scores of these vectors do not fit 64 bits")
            numbers = scaled.astype(np.int32)
            largest = [int(np.abs(numbers[a:b].astype(np.int64)).max(initial=0)) for a, b in zip(ends, ends[1:])]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([numbers[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()), pa.array(largest, pa.int64())],
                names=["vec_id", "label", "vector", "largest"],
            )

    return small.mapInArrow(whole, "vec_id bigint, label bigint, vector binary, largest bigint")


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, vector in enumerate(vectors.to_pylist()):
        out[i, : len(vector) // 4] = np.frombuffer(vector, np.int32)
    return out


def _tiles(anchors: np.ndarray, rows: np.ndarray, primes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of all rows with a few anchors at a time."""
    right = residues(rows, primes)
    height = max(1, TILE // max(len(rows), 1))
    for at in range(0, len(anchors), height):
        yield at, scores(residues(anchors[at : at + height], primes), right, primes)


def _ordered(ids: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places ``at`` by falling score, then id."""
    return at[np.lexsort((ids[at], -values[at]))]


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _sides(table: pa.Table, dim: int) -> tuple[pa.Table, np.ndarray, pa.Table, np.ndarray]:
    anchors, rows = table.filter(table.column("is_anchor")), table.filter(pc.invert(table.column("is_anchor")))
    return anchors, _matrix(anchors.column("vector"), dim), rows, _matrix(rows.column("vector"), dim)


def _result(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    schema = pa.schema([(name, pa.int64()) for name in names])
    return pa.table(dict(zip(names, map(list, zip(*rows)))), schema=schema) if rows else schema.empty_table()


POSITIVES = ("mark", "anchor_id", "positive_id", "positive_score")
NEGATIVES = (*POSITIVES, "negative_id", "negative_score")


def _best_positives(dim: int, primes: list[int], n: int):
    def run(table: pa.Table) -> pa.Table:
        anchors, a, rows, r = _sides(table, dim)
        (anchor_ids, marks), (ids,) = _columns(anchors, "vec_id", "mark"), _columns(rows, "vec_id")
        out: list[tuple] = []
        for at, tile in _tiles(a, r, primes):
            for i, values in enumerate(tile, at):
                values = np.where(ids == anchor_ids[i], np.iinfo(np.int64).min, values)
                if len(values) > n:  # all that reach the n-th best value, so that ties are told by id
                    places = np.flatnonzero(values >= np.partition(values, len(values) - n)[len(values) - n])
                else:
                    places = np.arange(len(values))
                for j in _ordered(ids, values, places)[:n]:
                    if ids[j] != anchor_ids[i]:
                        out.append((int(marks[i]), int(anchor_ids[i]), int(ids[j]), int(values[j])))
        return _result(out, POSITIVES)

    return run


def window_bounds(positive: int, low_percent: int) -> tuple[int, int]:
    """Least and largest score that 'low_percent * positive <= 100 * score <= 100 * positive' allows."""
    return -(-low_percent * positive // 100), positive


def _best_negatives(dim: int, primes: list[int], n: int, low_percent: int):
    def run(table: pa.Table) -> pa.Table:
        anchors, a, rows, r = _sides(table, dim)
        anchor_ids, anchor_labels, marks = _columns(anchors, "vec_id", "label", "mark")
        ids, labels = _columns(rows, "vec_id", "label")
        positives = anchors.column("positives").to_pylist()
        out: list[tuple] = []
        for at, tile in _tiles(a, r, primes):
            for i, values in enumerate(tile, at):
                windows = [(p["positive_id"], p["positive_score"], *window_bounds(p["positive_score"], low_percent)) for p in positives[i]]
                least, most = min(w[2] for w in windows), max(w[3] for w in windows)
                near = np.flatnonzero((values >= least) & (values <= most) & (labels != anchor_labels[i]) & (ids != anchor_ids[i]))
                if not len(near):
                    continue
                near = _ordered(ids, values, near)
                falling = -values[near]
                for positive, score, low, high in windows:
                    first = int(np.searchsorted(falling, -high))
                    for j in near[first : first + n]:
                        if values[j] >= low:
                            out.append((int(marks[i]), int(anchor_ids[i]), positive, score, int(ids[j]), int(values[j])))
        return _result(out, NEGATIVES)

    return run


def _dealt(anchors: DataFrame, rows: DataFrame, blocks: int, slices: int) -> DataFrame:
    """Anchors and rows as one table in which every block of anchors meets every slice of the rows."""
    part = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(n)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumns({"is_anchor": F.lit(True), "block": part(blocks), "slice": every(slices)})
    right = rows.withColumns({"is_anchor": F.lit(False), "slice": part(slices), "block": every(blocks)})
    return left.unionByName(right, allowMissingColumns=True)


def _schema(names: tuple[str, ...]) -> str:
    return ", ".join(f"{name} bigint" for name in names)


def mine_negatives(
    rows: DataFrame, is_anchor: Column, label: Column | None = None, n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, block_bytes: int = BLOCK_BYTES, slices: int | None = None
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels
    whose score lies between ``low_percent`` of the positive's and the positive's own.

    ``slices`` is how many tasks the rows are dealt to at least.
    """
    slices = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = cut_lineage(taking_part(rows, F.col("label") if label is None else label))
    size, largest, n_rows, n_anchors = whole.agg(F.max(F.octet_length("vector")), F.max("largest"), F.count("*"), F.count_if(is_anchor)).first()
    dim, largest = (size or 0) // 4, largest or 0
    bound = max(1, dim * largest * largest)
    if bound >= 1 << 62:
        raise ArithmeticError(f"scores up to {bound} do not fit 64 bits")
    primes = primes_for(bound)
    bytes_of = lambda n: -(-n * dim * 4 // block_bytes)
    blocks, slices = max(1, bytes_of(n_anchors)), max(slices, bytes_of(n_rows))
    vectors = whole.drop("largest")
    anchors = vectors.where(is_anchor).distinct().withColumn("mark", F.xxhash64("vec_id", "label", "vector"))

    meeting = _dealt(anchors, vectors, blocks, slices).groupBy("label", "block", "slice")
    found = meeting.applyInArrow(_best_positives(dim, primes, n_positives), _schema(POSITIVES))
    best = Window.partitionBy("anchor_id", "mark").orderBy(F.col("positive_score").desc(), "positive_id")
    positives = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n_positives)
    packed = positives.groupBy("mark", F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    known = cut_lineage(anchors.join(packed, ["vec_id", "mark"]))

    meeting = _dealt(known, vectors, blocks, slices).groupBy("block", "slice")
    near = meeting.applyInArrow(_best_negatives(dim, primes, n_negatives, low_percent), _schema(NEGATIVES))
    nearest = Window.partitionBy("anchor_id", "mark", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = near.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
