"""Kd-cells of a table of points, and what can be told from their sums alone.

Coordinates are whole numbers (a fixed share of one unit), so that sums do not
depend on the order of the rows. The tree is fitted on a bounded sample; every
point falls into one of ``2 ** depth`` cells, and the points are laid out by
cell. What reaches the driver is one row for each cell.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

SAMPLE_ROWS = 1 << 16
UNIT_BITS = 20  # a coordinate of 1.0 is 2**20
OFFSET_BITS = 20  # resolution of squares within a cell


@dataclass(frozen=True)
class KdTree:
    """Splits in heap order (node 1 is the root): right where the coordinate of the axis is above the cut."""

    axis: np.ndarray
    cut: np.ndarray
    depth: int

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.cut[node])
        return node - (1 << self.depth)


def fit_kd(sample: np.ndarray, depth: int) -> KdTree:
    """Split the widest axis of every node at its median."""
    axis, cut = np.zeros(1 << depth, np.int64), np.full(1 << depth, np.iinfo(np.int64).max)
    open_nodes = [(1, sample)]
    while open_nodes:
        node, points = open_nodes.pop()
        if node >= 1 << depth or len(points) < 2:
            continue
        widths = points.max(axis=0) - points.min(axis=0)
        axis[node] = widths.argmax()
        values = points[:, axis[node]]
        if not widths[axis[node]]:
            continue
        middle = int(np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2])
        if middle == values.max():
            middle = int(values[values < middle].max())
        cut[node] = middle
        open_nodes += [(2 * node, points[values <= middle]), (2 * node + 1, points[values > middle])]
    return KdTree(axis, cut, depth)


@dataclass(frozen=True)
class Cells:
    """Points (key, cell, coordinates) laid out by cell, and the sums of every cell that has some."""

    points: DataFrame
    columns: tuple[str, ...]
    tree: KdTree
    sample: np.ndarray
    cell: np.ndarray
    count: np.ndarray
    total: np.ndarray
    low: np.ndarray
    high: np.ndarray
    fetched: dict[int, np.ndarray] = field(default_factory=dict)  # points of some cells, SAMPLE_ROWS of them at most


def _matrix(rows: list, names: Sequence[str]) -> np.ndarray:
    return np.array([[row[n] for n in names] for row in rows], np.int64).reshape(len(rows), len(names))


def make_cells(points: DataFrame, key: str, columns: Sequence[str], depth: int = 12) -> Cells:
    """Lay out points (key and whole-number coordinates) by cell; one written copy, read by all later passes."""
    columns = tuple(columns)
    n = points.count()
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    drawn = points.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(share * (1 << 40)))
    sample = _matrix(drawn.orderBy(F.xxhash64(key), key).select(*columns).collect(), columns)
    tree = fit_kd(sample, depth)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.column_stack([batch.column(c).to_numpy() for c in columns])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.cells(at))], names=[*batch.schema.names, "cell"])

    schema = ", ".join([f"{key} {dict(points.dtypes)[key]}", *[f"{c} bigint" for c in columns], "cell bigint"])
    found = points.select(key, *columns).mapInArrow(placed, schema)
    laid_out = cut_lineage(found.repartitionByRange("cell").sortWithinPartitions("cell"))
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("sum", F.sum), ("min", F.min), ("max", F.max))]
    rows = laid_out.groupBy("cell").agg(*sums).orderBy("cell").collect()
    part = lambda name: _matrix(rows, [f"{name}_{c}" for c in columns])
    return Cells(laid_out, columns, tree, sample, _matrix(rows, ["cell"])[:, 0], _matrix(rows, ["n"])[:, 0], part("sum"), part("min"), part("max"))


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre, the first one of equals."""
    return ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)


def owners(low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each box the centre that is nearest to all of it, or -1.

    A centre loses to another one on the whole box if it loses at the corner
    that lies furthest towards it. Boxes of one point always have an owner.
    """
    middle = (low + high) / 2
    best = nearest(middle, centres)
    wide = np.flatnonzero((high > low).any(axis=1))
    if not len(wide) or len(centres) == 1:
        return best
    apart = centres[None, :, :] - centres[best[wide]][:, None, :]
    corner = np.where(apart > 0, high[wide][:, None, :], low[wide][:, None, :])
    # |corner - other|^2 - |corner - best|^2, at the corner that favours the other one most
    gap = (apart * (apart - 2 * (corner - centres[best[wide]][:, None, :]))).sum(axis=2)
    gap[np.arange(len(wide)), best[wide]] = np.inf
    best[wide[gap.min(axis=1) <= 0]] = -1
    return best


def summed(cluster: np.ndarray, k: int, counts: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and whole-number totals added up by cluster."""
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.int64)
    return member @ counts, member @ totals


def cell_sums(cells: Cells, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(count, sum of coordinates) of every cluster of every model, in one job for all models.

    Cells that lie wholly with one centre give their sums; only points of other
    cells are read. Points of cells that stay open from one iteration to the
    next are kept on the driver where they are few (as many as the sample), so
    that late iterations need no job.
    """
    found, open_cells = {}, {}
    for model, centres in models.items():
        owner = owners(cells.low, cells.high, centres)
        mine = owner >= 0
        found[model] = summed(owner[mine], len(centres), cells.count[mine], cells.total[mine])
        if not mine.all():
            open_cells[model] = ~mine
    if open_cells:
        wanted = np.flatnonzero(np.logical_or.reduce(list(open_cells.values())))
        parts = _driver_sums if _fetch(cells, wanted) else _job_sums
        for model, cluster, n, total in parts(cells, models, open_cells, wanted):
            found[model][0][cluster] += n
            found[model][1][cluster] += total
    return found


def _fetch(cells: Cells, wanted: np.ndarray) -> bool:
    """Bring the points of these cells to the driver, unless all it would hold are more than the sample."""
    new = [int(i) for i in wanted if int(i) not in cells.fetched]
    if cells.count[wanted].sum() > SAMPLE_ROWS:
        return False
    if sum(map(len, cells.fetched.values())) + cells.count[new].sum() > SAMPLE_ROWS:
        cells.fetched.clear()
        new = [int(i) for i in wanted]
    if new:
        at = cells.points.where(F.col("cell").isin([int(cells.cell[i]) for i in new])).select("cell", *cells.columns).toArrow()
        where, points = at.column("cell").to_numpy(), np.column_stack([at.column(c).to_numpy() for c in cells.columns])
        cells.fetched.update({i: points[where == cells.cell[i]] for i in new})
    return True


Sums = Iterator[tuple[int, int, int, np.ndarray]]


def _driver_sums(cells: Cells, models: dict[int, np.ndarray], open_cells: dict[int, np.ndarray], wanted: np.ndarray) -> Sums:
    for model, flags in open_cells.items():
        rows = np.concatenate([cells.fetched[int(i)] for i in np.flatnonzero(flags)])
        k = len(models[model])
        counts, totals = summed(nearest(rows, models[model]), k, np.ones(len(rows), np.int64), rows)
        yield from zip([model] * k, range(k), counts, totals)


def _job_sums(cells: Cells, models: dict[int, np.ndarray], open_cells: dict[int, np.ndarray], wanted: np.ndarray) -> Sums:
    columns, width = cells.columns, len(cells.columns)
    flags_of = {}
    for model, flags in open_cells.items():
        flags_of[model] = np.zeros(1 << cells.tree.depth, bool)
        flags_of[model][cells.cell[flags]] = True

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: [np.zeros(len(models[m]), np.int64), np.zeros((len(models[m]), width), np.int64)] for m in flags_of}
        for batch in batches:
            at, where = np.column_stack([batch.column(c).to_numpy() for c in columns]), batch.column("cell").to_numpy()
            for model, flags in flags_of.items():
                rows = at[flags[where]]
                if len(rows):
                    counts, totals = summed(nearest(rows, models[model]), len(models[model]), np.ones(len(rows), np.int64), rows)
                    sums[model][0] += counts
                    sums[model][1] += totals
        names = ["model", "cluster", "n", *columns]
        rows = [(m, c, int(n), *map(int, total)) for m, (counts, totals) in sums.items() for c, (n, total) in enumerate(zip(counts, totals)) if n]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)

    # At most cells of the tree in this list.
    near = cells.points.where(F.col("cell").isin([int(c) for c in cells.cell[wanted]])).select("cell", *columns)
    parts = near.mapInArrow(partial, ", ".join(f"{c} bigint" for c in ("model", "cluster", "n", *columns)))
    for row in parts.groupBy("model", "cluster").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns]).collect():
        yield row["model"], row["cluster"], row["n"], np.array([row[c] for c in columns], np.int64)


@dataclass(frozen=True)
class Spread:
    """For every node of the tree (heap order): box, and for each cluster count, mean and mean squared distance from it."""

    low: np.ndarray
    high: np.ndarray
    count: np.ndarray
    mean: np.ndarray
    variance: np.ndarray


def cluster_spreads(cells: Cells, models: dict[int, np.ndarray]) -> dict[int, Spread]:
    """Sums by cell and cluster of every model, in one job, added up along the tree on the driver."""
    columns, depth = cells.columns, cells.tree.depth
    width, size = len(columns), 1 << depth
    low, high = np.zeros((size, width), np.int64), np.zeros((size, width), np.int64)
    low[cells.cell], high[cells.cell] = cells.low, cells.high
    # Squares are taken of offsets from the cell's corner, of so many bits that sums stay exact.
    shift = np.maximum(0, np.ceil(np.log2(np.maximum((high - low).max(axis=1), 1))).astype(np.int64) + 1 - OFFSET_BITS)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            at, where = np.column_stack([batch.column(c).to_numpy() for c in columns]), batch.column("cell").to_numpy()
            offset = (at - low[where]) >> shift[where][:, None]
            squares = (offset * offset).sum(axis=1)
            values = np.column_stack([np.ones(len(at), np.int64), squares, at])
            for model, centres in models.items():
                places, inverse = np.unique(where * len(centres) + nearest(at, centres), return_inverse=True)
                totals = np.zeros((len(places), width + 2), np.int64)
                np.add.at(totals, inverse, values)
                for place, total in zip(places.tolist(), totals):
                    key = (model, *divmod(place, len(centres)))
                    sums[key] = sums[key] + total if key in sums else total
        rows = [(*key, *map(int, total)) for key, total in sums.items()]
        names = ["model", "cell", "cluster", "n", "squares", *columns]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)

    parts = cells.points.select("cell", *columns).mapInArrow(partial, ", ".join(f"{c} bigint" for c in ("model", "cell", "cluster", "n", "squares", *columns)))
    summed = parts.groupBy("model", "cell", "cluster").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"), *[F.sum(c).alias(c) for c in columns])
    rows = summed.collect()  # cells x clusters at most
    boxes_low, boxes_high = np.full((2 * size, width), np.inf), np.full((2 * size, width), -np.inf)
    boxes_low[size + cells.cell], boxes_high[size + cells.cell] = cells.low, cells.high
    for node in range(size - 1, 0, -1):
        boxes_low[node] = np.minimum(boxes_low[2 * node], boxes_low[2 * node + 1])
        boxes_high[node] = np.maximum(boxes_high[2 * node], boxes_high[2 * node + 1])
    spreads = {}
    for model, centres in models.items():
        count, mean, around = np.zeros((2 * size, len(centres))), np.zeros((2 * size, len(centres), width)), np.zeros((2 * size, len(centres)))
        for row in rows:
            if row["model"] == model:
                cell, cluster, n = row["cell"], row["cluster"], row["n"]
                step = float(1 << int(shift[cell]))
                count[size + cell, cluster] = n
                mean[size + cell, cluster] = np.array([row[c] for c in columns]) / n
                offset = mean[size + cell, cluster] - low[cell]
                # Dropping bits moves a coordinate by less than a step.
                about = max(row["squares"] * step * step / n - (offset * offset).sum(), 0.0)
                around[size + cell, cluster] = 0.0 if n == 1 else about + (2 * step * np.sqrt(width) * np.linalg.norm(high[cell] - low[cell]) if step > 1 else 0.0)
        for node in range(size - 1, 0, -1):
            a, b = 2 * node, 2 * node + 1
            n = count[a] + count[b]
            some = np.maximum(n, 1)
            mean[node] = (count[a][:, None] * mean[a] + count[b][:, None] * mean[b]) / some[:, None]
            apart = ((mean[a] - mean[b]) ** 2).sum(axis=1)
            around[node] = (count[a] * around[a] + count[b] * around[b] + count[a] * count[b] / some * apart) / some
            count[node] = n
        spreads[model] = Spread(boxes_low, boxes_high, count, mean, around)
    return spreads


QUERY_LEVELS = 4  # points of a node this far above the cells are looked at together


def far_nodes(spread: Spread, query: int, size: int, ratio: float) -> np.ndarray:
    """Nodes that cover all points once: as large as their half diagonal stays below ``ratio`` of their distance from the query node."""
    low, high = spread.low[query], spread.high[query]
    taken, level = [], np.array([1])
    while len(level):
        level = level[spread.low[level, 0] <= spread.high[level, 0]]
        gap = np.maximum(0, np.maximum(spread.low[level] - high, low - spread.high[level]))
        half = np.linalg.norm(spread.high[level] - spread.low[level], axis=1) / 2
        fine = (level >= size) | (half <= ratio * np.linalg.norm(gap, axis=1))
        taken.append(level[fine])
        level = np.concatenate([2 * level[~fine], 2 * level[~fine] + 1])
    return np.concatenate(taken)


SCORE_BITS = 30


def silhouettes(cells: Cells, models: dict[int, np.ndarray], ratio: float = 0.25) -> dict[int, tuple[float, float]]:
    """(mean Euclidean silhouette, bound of its error) of every model, in one pass over the points.

    The mean distance from a point to the members of a node lies between its
    distance d to their mean and the root of d squared plus their variance. So a
    dual traversal (a node of points against nodes that are small as seen from
    it) gives every point bounds of its mean distance to each cluster, and
    these bound its silhouette.
    """
    spreads = cluster_spreads(cells, models)
    shared = cells.points.sparkSession.sparkContext.broadcast(spreads)  # cells x clusters at most
    columns, cells_depth, size = cells.columns, cells.tree.depth, 1 << cells.tree.depth

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Spread = next(iter(shared.value.values()))
        sums = {m: np.zeros(3, np.int64) for m in models}
        for batch in batches:
            at, where = np.column_stack([batch.column(c).to_numpy() for c in columns]), batch.column("cell").to_numpy()
            queries = (where + size) >> min(QUERY_LEVELS, cells_depth)
            for query in np.unique(queries):
                nodes, rows = far_nodes(known, int(query), size, ratio), at[queries == query]
                for model, centres in models.items():
                    sums[model] += np.rint(_bounds(rows, centres, shared.value[model], nodes) * (1 << SCORE_BITS)).astype(np.int64).sum(axis=0)
        rows = [(m, *map(int, s)) for m, s in sums.items()]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["model", "low", "middle", "high"])

    parts = cells.points.select("cell", *columns).mapInArrow(scored, "model bigint, low bigint, middle bigint, high bigint")
    rows = parts.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("low", "middle", "high")]).collect()
    n, one = max(int(cells.count.sum()), 1), float(1 << SCORE_BITS)
    return {r["model"]: (r["middle"] / one / n, max(r["high"] - r["middle"], r["middle"] - r["low"]) / one / n) for r in rows}


def _bounds(rows: np.ndarray, centres: np.ndarray, spread: Spread, nodes: np.ndarray) -> np.ndarray:
    """Least, middle and largest silhouette of each row; 0 in a cluster of one."""
    own, sizes = nearest(rows, centres), spread.count[1]
    node, cluster = np.nonzero(spread.count[nodes])
    weight, mean, variance = (x[nodes[node], cluster] for x in (spread.count, spread.mean, spread.variance))
    squared = ((rows[:, None, :] - mean[None, :, :]) ** 2).sum(axis=2)
    least, most = np.sqrt(squared), np.sqrt(squared + variance)
    to_cluster = np.zeros((len(weight), len(centres)))
    to_cluster[np.arange(len(weight)), cluster] = weight
    at = np.arange(len(rows))
    out = []
    for near, far in ((most, least), ((least + most) / 2,) * 2, (least, most)):
        inner = (near @ to_cluster)[at, own] / np.maximum(sizes[own] - 1, 1)
        outer = (far @ to_cluster) / np.maximum(sizes, 1)
        outer[:, sizes == 0] = np.inf
        outer[at, own] = np.inf
        other = outer.min(axis=1)
        score = np.where(np.isfinite(other), (other - inner) / np.maximum(np.maximum(inner, other), 1e-300), 0.0)
        out.append(np.where(sizes[own] > 1, score, 0.0))
    return np.clip(np.column_stack(out), -1.0, 1.0)
