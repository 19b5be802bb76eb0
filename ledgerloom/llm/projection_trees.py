"""Random-projection trees with overlapping halves.

A node splits its vectors by their projection on a random direction, at the
sparsest place near the median; vectors close to the split go to both sides.
All nodes of one level of a tree share a direction, which follows from the
seed, so that a tree is its split points only. Nodes are numbered as in a heap
(root 1, children 2 k and 2 k + 1); a leaf's code has the tree above them.

``fit_forest`` fits on a bounded sample, and goes on adding trees until the
recall it expects reaches the one asked for. Nodes that hold too many vectors
of the whole table are split further by ``route``, each on a sample of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ledgerloom.session import cut_lineage

TREE_BITS = 56
MOST_TREES = 64
DEEPEST = 54
SAMPLE_BYTES = 1 << 24  # of the sample a forest is fitted on
NODE_SAMPLE = 1 << 10  # vectors a node is split further on
FEWEST = 16  # vectors of the sample that a leaf has at least


@dataclass
class Tree:
    number: int
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of the nodes that split, sorted
    low: np.ndarray = field(default_factory=lambda: np.zeros(0))  # right half: projection above it
    high: np.ndarray = field(default_factory=lambda: np.zeros(0))  # left half: projection up to it


@dataclass(frozen=True)
class Shape:
    """What all trees of a forest have in common."""

    dim: int
    leaf: int  # vectors of a leaf, about
    margin: float = 0.0  # half of the width of the overlap
    spread: float = 0.0  # standard deviation of the projected difference of two vectors at the similarity sought
    seed: int = 0


def direction(shape: Shape, tree: int, level: int) -> np.ndarray:
    drawn = np.random.default_rng([shape.seed, tree, level]).standard_normal(shape.dim)
    return drawn / max(np.linalg.norm(drawn), 1e-300)


def code(tree: int, node: int) -> int:
    return tree << TREE_BITS | node


def _missed(width: float, spread: float, density: float) -> float:
    """Share of pairs that a split with an overlap of this width takes apart."""
    if not spread:
        return 0.0
    z = width / spread
    beyond = 2 * spread * (math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - z * 0.5 * math.erfc(z / math.sqrt(2)))
    return min(1.0, beyond * density)


def _split(values: np.ndarray, shape: Shape) -> tuple[float, float, float] | None:
    """(low, high, middle) of a node's projections; None if they are all alike."""
    ranked = np.sort(values)
    if ranked[0] == ranked[-1]:
        return None
    tried = np.unique(ranked[(np.linspace(0.4, 0.6, 21) * (len(ranked) - 1)).astype(int)])
    tried = tried[tried < ranked[-1]]
    if not len(tried):
        tried = ranked[ranked < ranked[-1]][-1:]
    if not shape.margin:
        middle = tried[len(tried) // 2]
        return middle, middle, middle
    inside = np.searchsorted(ranked, tried + shape.margin, "right") - np.searchsorted(ranked, tried - shape.margin)
    places = np.flatnonzero(inside == inside.min())
    middle = tried[places[len(places) // 2]]
    third = (ranked[int(0.3 * (len(ranked) - 1))], ranked[int(0.7 * (len(ranked) - 1))])
    return min(middle, max(middle - shape.margin, third[0])), max(middle, min(middle + shape.margin, third[1])), middle


def fit_tree(units: np.ndarray, share: float, shape: Shape, number: int, root: int = 1) -> tuple[Tree, float]:
    """A tree over the vectors that a node's sample (``share`` of them) shows, and the share of near pairs that
    meet in some leaf of it, as far as the sample goes."""
    projections: dict[int, np.ndarray] = {}
    splits: list[tuple[int, float, float]] = []
    together, levels = np.ones(len(units)), np.zeros(len(units))
    open_nodes = [(root, np.arange(len(units)), np.ones(len(units), bool))]
    while open_nodes:
        node, at, main = open_nodes.pop()
        level = node.bit_length() - 1
        if len(at) <= shape.leaf * share or len(at) < 2 * FEWEST or level >= DEEPEST:
            continue
        if level not in projections:
            projections[level] = units @ direction(shape, number, level)
        values = projections[level][at]
        if (found := _split(values, shape)) is None:
            continue
        low, high, middle = found
        if shape.spread:
            density = ((values > middle - shape.spread / 2) & (values < middle + shape.spread / 2)).mean() / shape.spread
            together[at[main]] *= 1 - _missed(high - low, shape.spread, density)
        levels[at[main]] += 1
        splits.append((node, low, high))
        left, right = values <= high, values > low
        open_nodes.append((2 * node, at[left], (main & (values <= middle))[left]))
        open_nodes.append((2 * node + 1, at[right], (main & (values > middle))[right]))
    splits.sort()
    ids, lows, highs = (np.array(x) for x in zip(*splits)) if splits else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    kept = float(together.mean()) if len(units) else 1.0
    # Levels that follow on the whole table cost as much each as those seen here.
    wanted = math.log2(max(1.0, len(units) / max(share, 1e-300) / shape.leaf))
    seen = float(levels.mean()) if len(units) else 0.0
    return Tree(number, ids.astype(np.int64), lows, highs), kept ** max(1.0, wanted / seen if seen else 1.0)


def fit_forest(units: np.ndarray, share: float, shape: Shape, recall: float | None) -> tuple[list[Tree], float]:
    """Trees until the expected recall is reached (one tree if it is None), and that recall."""
    trees, missed = [], 1.0
    while len(trees) < MOST_TREES:
        tree, kept = fit_tree(units, share, shape, len(trees))
        trees.append(tree)
        missed *= 1 - kept
        if recall is None or 1 - missed >= recall:
            break
    return trees, 1 - missed


def leaves(units: np.ndarray, tree: Tree, shape: Shape, rows: np.ndarray | None = None, nodes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) of every leaf a vector falls into, from the root or from the given nodes on."""
    rows = np.arange(len(units)) if rows is None else rows
    nodes = np.ones(len(units), np.int64) if nodes is None else nodes
    done: list[tuple[np.ndarray, np.ndarray]] = []
    level_of = lambda x: np.frexp(x.astype(np.float64))[1] - 1  # noqa: E731  heap numbers stay below 2**53 or so
    while len(rows):
        at = np.searchsorted(tree.ids, nodes)
        splits = np.zeros(len(nodes), bool)
        inside = at < len(tree.ids)
        splits[inside] = tree.ids[at[inside]] == nodes[inside]
        done.append((rows[~splits], nodes[~splits]))
        rows, nodes, at = rows[splits], nodes[splits], at[splits]
        values, levels = np.zeros(len(rows)), level_of(nodes)
        for level in np.unique(levels):
            here = levels == level
            values[here] = units[rows[here]] @ direction(shape, tree.number, int(level))
        left, right = values <= tree.high[at], values > tree.low[at]
        rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
    return tuple(np.concatenate(x) for x in zip(*done)) if done else (rows, nodes)


def unit_vectors(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors of 64-bit floats as rows of length one, filled up with zeros."""
    out = np.zeros((len(vectors), dim))
    for i, vector in enumerate(vectors.to_pylist()):
        out[i, : len(vector) // 8] = np.frombuffer(vector, np.float64)
    out /= np.maximum(np.abs(out).max(axis=1, initial=0), 1e-300)[:, None]
    return out / np.maximum(np.linalg.norm(out, axis=1), 1e-300)[:, None]


def sampled(points: DataFrame, n: int, dim: int) -> tuple[np.ndarray, float]:
    """A sample of bounded size of the points (item, vector), by a hash of the item, and its share of all."""
    share = min(1.0, SAMPLE_BYTES // (8 * max(dim, 1)) / max(n, 1))
    draw = F.pmod(F.xxhash64("item", F.lit("sample")), F.lit(1 << 40)) < int(share * (1 << 40))
    found = points.where(draw).select("vector").toArrow().column("vector").combine_chunks()
    return unit_vectors(found, dim), share


def _codes(units: np.ndarray, trees: list[Tree], shape: Shape) -> list[np.ndarray]:
    found = [leaves(units, tree, shape) for tree in trees]
    rows = np.concatenate([r for r, _ in found])
    codes = np.concatenate([n | np.int64(t.number << TREE_BITS) for (_, n), t in zip(found, trees)])
    order = np.lexsort((codes, rows))
    return np.split(codes[order], np.searchsorted(rows[order], np.arange(1, len(units))))


def route(points: DataFrame, n: int, shape: Shape, recall: float | None = None) -> DataFrame:
    """Add ``leaves``, the sorted codes of all leaves a point (item, vector, ...) falls into."""
    units, share = sampled(points, n, shape.dim)
    trees, _ = fit_forest(units, share, shape, recall)
    shared = points.sparkSession.sparkContext.broadcast(trees)
    schema = StructType([*points.schema.fields, StructField("leaves", ArrayType(LongType()))])
    at = points.columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _codes(unit_vectors(batch.column(at), shape.dim), shared.value, shape) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "leaves"])

    placed = points.mapInArrow(run, schema)
    if share == 1.0:  # the trees have seen every point
        return placed
    return _deepened(cut_lineage(placed), shape)


def _deepened(placed: DataFrame, shape: Shape) -> DataFrame:
    """Split leaves with too many points further, until none is left or those left cannot be split."""
    while True:
        sizes = placed.select(F.explode("leaves").alias("code")).groupBy("code").count()
        large = sizes.where(F.col("count") > 2 * shape.leaf)
        each = placed.select("item", "vector", F.explode("leaves").alias("code"))
        draw = F.pmod(F.xxhash64("item", "code"), F.lit(1 << 40)) < F.col("share") * (1 << 40)
        shares = large.select("code", F.least(F.lit(1.0), F.lit(float(NODE_SAMPLE)) / F.col("count")).alias("share"))
        samples = each.join(shares, "code").where(draw).select("code", "share", "vector")
        subtrees = cut_lineage(samples.groupBy("code").applyInArrow(_fitted(shape), "code bigint, ids array<bigint>, low array<double>, high array<double>").where(F.size("ids") > 0))
        if subtrees.isEmpty():
            return placed
        moved = each.join(subtrees, "code", "left").mapInArrow(_rerouted(shape), "item binary, code bigint")
        lists = moved.groupBy("item").agg(F.sort_array(F.collect_set("code")).alias("leaves"))
        placed = cut_lineage(placed.drop("leaves").join(lists, "item"))


def _fitted(shape: Shape):
    def run(table: pa.Table) -> pa.Table:
        whole = table.column("code")[0].as_py()
        number, node = whole >> TREE_BITS, whole & ((1 << TREE_BITS) - 1)
        units = unit_vectors(table.column("vector").combine_chunks(), shape.dim)
        tree, _ = fit_tree(units, table.column("share")[0].as_py(), shape, number, node)
        return pa.table({"code": [whole], "ids": pa.array([tree.ids], pa.list_(pa.int64())), "low": pa.array([tree.low], pa.list_(pa.float64())), "high": pa.array([tree.high], pa.list_(pa.float64()))})

    return run


def _rerouted(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, codes, ids = batch.column("item"), batch.column("code").to_numpy(), batch.column("ids")
            units = unit_vectors(batch.column("vector"), shape.dim)
            at, out = [np.flatnonzero(np.asarray(ids.is_null()))], []
            out.append(codes[at[0]])
            for whole in np.unique(codes[np.asarray(ids.is_valid())]):
                rows = np.flatnonzero(codes == whole)
                own = int(rows[0])
                parts = [batch.column(c)[own].as_py() for c in ("ids", "low", "high")]
                tree = Tree(int(whole) >> TREE_BITS, np.array(parts[0], np.int64), np.array(parts[1]), np.array(parts[2]))
                found, nodes = leaves(units, tree, shape, rows, np.full(len(rows), int(whole) & ((1 << TREE_BITS) - 1), np.int64))
                at.append(found)
                out.append(nodes | np.int64(tree.number << TREE_BITS))
            yield pa.record_batch([items.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(out))], names=["item", "code"])

    return run
