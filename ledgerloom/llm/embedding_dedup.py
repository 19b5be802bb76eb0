"""Near duplicates of embeddings: a forest of random-projection trees, compared within leaves.

Vectors whose cosine reaches the threshold are linked; linked vectors form
components, and the row with the smallest id of a component is kept.

1. Equal vectors are one class, counted with partial sums.
2. Large tight groups are condensed. One tree without overlap deals the classes
   to leaves; in a leaf, ``dense`` or more classes within half the threshold's
   angle of their mean form a ball, any two members of which are linked. Balls
   are merged in the same way, level by level. So a group of near copies that
   holds a third of all rows is a few balls, whose links are a count.
3. The forest deals balls and remaining classes to leaves, with as many trees as
   the recall asked for at the threshold takes. Leaves are compared in double
   precision. A pair that shares several leaves counts in the first of them,
   which both sides tell from the leaves they carry, so that no pair has to
   leave its task: a leaf returns a count for each member and the edges of a
   spanning forest.
4. Two balls (or a ball and a class) that are neither surely linked nor surely
   apart are compared member by member, block against block.

Nothing grows into one task: leaves are split until they hold about ``leaf``
points, blocks have ``leaf`` rows.

Defined results: rows without an id, and vectors that are null, empty, zero or
hold null or non-finite components, link with nothing; their component is their
id. Shorter vectors count as filled up with zeros. Rows that repeat an id are
rows of their own. Very long vectors get smaller samples. An empty table gives
an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.projection_trees import Shape, route, unit_vectors
from ledgerloom.session import cut_lineage

LEAF = 1024
CHUNK = 512  # rows of a leaf that are compared with all of it at a time
SURE = 1e-6  # radians by which bounds on angles are kept apart from the threshold


def _keyed(rows: DataFrame) -> DataFrame:
    """vec_id, vector as 64-bit floats and its 128-bit digest; both null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, keys = [], []
            for known, vector in zip(batch.column(0).is_valid(), batch.column(1)):
                data = None
                if known.as_py() and vector.is_valid and vector.values.null_count == 0:
                    numbers = vector.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    if np.isfinite(numbers).all() and numbers.any():
                        data = np.trim_zeros(numbers, "b").tobytes()
                vectors.append(data)
                keys.append(data and xxhash.xxh3_128_digest(data))
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["vec_id", "key", "vector"])

    return rows.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id bigint, key binary, vector binary")


def _balls(table: pa.Table, dim: int, within: float, dense: int) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(members, centre, radius) of the tight groups of a leaf, the largest first."""
    radius = table.column("radius").to_numpy()
    units = unit_vectors(table.column("vector").combine_chunks(), dim)
    angles = np.arccos(np.clip(units @ units.T, -1.0, 1.0)) + radius[None, :]
    reach = angles <= within
    free = np.ones(len(units), bool)
    while free.any():
        counts = (reach & free).sum(axis=1) * free
        seed = int(counts.argmax())
        if counts[seed] < dense:
            return
        members = np.flatnonzero(reach[seed] & free)
        for _ in range(2):  # the mean of a group reaches members that one of its members does not
            centre = units[members].sum(axis=0)
            centre /= max(np.linalg.norm(centre), 1e-300)
            far = np.arccos(np.clip(units @ centre, -1.0, 1.0)) + radius
            members = np.flatnonzero((far <= within) & free)
            if len(members) < dense:
                break
        if len(members) < dense:
            free[seed] = False
            continue
        centre = units[members].sum(axis=0)
        centre /= max(np.linalg.norm(centre), 1e-300)
        far = np.arccos(np.clip(units @ centre, -1.0, 1.0)) + radius
        members = members[far[members] <= within]
        if len(members) >= dense:
            yield members, centre, float(far[members].max()) + SURE
        free[members] = False
        free[seed] = False


def _condensed(points: DataFrame, n: int, shape: Shape, within: float, dense: int) -> DataFrame:
    """(item, ball) for every point (item, vector, radius) in a ball; one row of each ball has its centre and radius."""
    dim = shape.dim

    def run(table: pa.Table) -> pa.Table:
        items = table.column("item").to_pylist()
        out: list[tuple] = []
        for members, centre, radius in _balls(table, dim, within, dense):
            ball = b"b" + min(items[i] for i in members)
            out += [(items[i], ball, centre.tobytes() if place == 0 else None, radius if place == 0 else None) for place, i in enumerate(members)]
        names, kinds = ("item", "ball", "centre", "radius"), (pa.binary(), pa.binary(), pa.binary(), pa.float64())
        columns = zip(*out) if out else ([],) * 4
        return pa.table({name: pa.array(list(c), kind) for name, kind, c in zip(names, kinds, columns)})

    placed = route(points, n, shape).withColumn("leaf", F.col("leaves")[0])
    return cut_lineage(placed.groupBy("leaf").applyInArrow(run, "item binary, ball binary, centre binary, radius double"))


def _in_balls(points: DataFrame, n: int, shape: Shape, within: float, dense: int) -> tuple[DataFrame, DataFrame] | None:
    """(item, ball) of all members and (ball, centre, radius), merged until nothing more is; None without any ball."""
    found = _condensed(points, n, shape, within, dense)
    member, balls = found.select("item", "ball"), found.where("centre is not null").select("ball", "centre", "radius")
    count = balls.count()
    if not count:
        return None
    seed = shape.seed
    while count > 1:
        seed += 1
        merged = _condensed(balls.select(F.col("ball").alias("item"), F.col("centre").alias("vector"), "radius"), count, Shape(shape.dim, shape.leaf, seed=seed), within, 2)
        new = merged.select(F.col("item").alias("ball"), F.col("ball").alias("whole"))
        member = member.join(new, "ball", "left").select("item", F.coalesce("whole", "ball").alias("ball"))
        rest = balls.join(new, "ball", "left_anti")
        balls = cut_lineage(rest.union(merged.where("centre is not null").select("ball", "centre", "radius")))
        before, count = count, balls.count()
        if count == before or before <= shape.leaf:
            break
    return member, balls


def _first_shared(lists: list[list[int]], leaf: int, rows: np.ndarray) -> np.ndarray:
    """Whether two of the rows share an earlier leaf than this one."""
    places: dict[int, list[int]] = {}
    for i, row in enumerate(rows):
        for other in lists[row]:
            if other < leaf:
                places.setdefault(other, []).append(i)
    shared = np.zeros((len(rows), len(rows)), bool)
    for at in places.values():
        if len(at) > 1:
            shared[np.ix_(at, at)] = True
    return shared


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest place that each place of a matrix of links reaches."""
    labels = np.arange(len(linked))
    reached = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(reached, labels[None, :], len(labels)).min(axis=1)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


COMPARED = "item binary, links bigint, root binary, unsure binary"


def _compared(dim: int, threshold: float):
    """For the members of a leaf: rows they are linked with, an edge to the first one they reach, and pairs that are unsure."""
    limit = math.acos(threshold)

    def run(table: pa.Table) -> pa.Table:
        leaf = table.column("leaf")[0].as_py()
        items, lists = table.column("item").to_pylist(), table.column("leaves").to_pylist()
        weights, radius = table.column("n").to_numpy(), table.column("radius").to_numpy()
        units = unit_vectors(table.column("vector").combine_chunks(), dim)
        # Few members of a leaf are near another one; only these are looked at closely.
        near = np.zeros(len(units), bool)
        reach = np.cos(np.minimum(limit + radius[:, None].max() + radius[None, :] + SURE, math.pi))
        for at in range(0, len(units), CHUNK):
            close = units[at : at + CHUNK] @ units.T >= np.minimum(reach, threshold)
            close[np.arange(len(close)), np.arange(at, at + len(close))] = False
            near[at : at + CHUNK] |= close.any(axis=1)
        rows = np.flatnonzero(near)
        if not len(rows):
            return pa.table({f: [] for f in ("item", "links", "root", "unsure")}, schema=SCHEMA)
        cosines = units[rows] @ units[rows].T
        wide = radius[rows, None] + radius[None, rows]
        linked, unsure = cosines >= threshold, np.zeros(cosines.shape, bool)
        if wide.any():
            angles = np.arccos(np.clip(cosines, -1.0, 1.0))
            surely, maybe = angles + wide <= limit - SURE, angles - wide <= limit + SURE
            linked, unsure = np.where(wide > 0, surely, linked), (wide > 0) & maybe & ~surely
        np.fill_diagonal(linked, False)
        np.fill_diagonal(unsure, False)
        fresh = ~_first_shared(lists, leaf, rows)
        links, roots = (linked & fresh) @ weights[rows], _roots(linked)
        out = [(items[i], int(n), items[rows[r]] if rows[r] != i else None, None) for i, n, r in zip(rows, links, roots) if n or rows[r] != i]
        out += [(items[rows[a]], 0, None, items[rows[b]]) for a, b in zip(*np.nonzero(np.triu(unsure & fresh)))]
        return pa.table({name: pa.array(list(c), SCHEMA.field(name).type) for name, c in zip(SCHEMA.names, zip(*out) if out else ([],) * 4)})

    return run


SCHEMA = pa.schema([("item", pa.binary()), ("links", pa.int64()), ("root", pa.binary()), ("unsure", pa.binary())])


def _member_links(dim: int, threshold: float):
    """Links between a block of a ball's members and a block of vectors that face the ball."""

    def run(table: pa.Table) -> pa.Table:
        mine = table.column("facing").to_numpy(zero_copy_only=False).astype(bool)
        keys, items, weights = table.column("key").to_pylist(), table.column("item").to_pylist(), table.column("n").to_numpy()
        units = unit_vectors(table.column("vector").combine_chunks(), dim)
        left, right = np.flatnonzero(mine), np.flatnonzero(~mine)
        linked = units[left] @ units[right].T >= threshold
        out = []
        for places, matrix, others in ((left, linked, right), (right, linked.T, left)):
            for i, n, first in zip(places, matrix @ weights[others], matrix.argmax(axis=1) if len(others) else []):
                if n:
                    out.append((keys[i], int(n), items[i], items[others[first]]))
        kinds = {"key": pa.binary(), "links": pa.int64(), "item": pa.binary(), "root": pa.binary()}
        return pa.table({name: pa.array(list(c), kinds[name]) for name, c in zip(kinds, zip(*out) if out else ([],) * 4)})

    return run


def _facing(pairs: DataFrame, members: DataFrame, dim: int, threshold: float, block: int) -> DataFrame:
    """(key, links, item, root) of the members of unsure pairs (item, unsure).

    All that face one ball are compared with it together: blocks of them with
    blocks of its members. A ball is the larger one of its pair.
    """
    sizes = members.groupBy("item").agg(F.count("*").alias("size"))
    known = pairs.join(sizes, "item").join(sizes.select(F.col("item").alias("unsure"), F.col("size").alias("size_b")), "unsure")
    first = (F.col("size") > F.col("size_b")) | ((F.col("size") == F.col("size_b")) & (F.col("item") > F.col("unsure")))
    faced = known.select(F.when(first, F.col("item")).otherwise(F.col("unsure")).alias("ball"), F.when(first, F.col("unsure")).otherwise(F.col("item")).alias("item"))
    faced = cut_lineage(faced.distinct())
    left = faced.join(members, "item").select("ball", "key", "n", "vector", "item")
    right = faced.select("ball").distinct().join(members.withColumnRenamed("item", "ball"), "ball").select("ball", "key", "n", "vector", F.col("ball").alias("item"))
    blocks = lambda side, name: side.groupBy("ball").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name))
    grid = cut_lineage(blocks(left, "rows").join(blocks(right, "columns"), "ball"))
    part = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(grid, "ball").withColumn("row", part("rows")).withColumn("column", every("columns")).withColumn("facing", F.lit(True))
    b = right.join(grid, "ball").withColumn("column", part("columns")).withColumn("row", every("rows")).withColumn("facing", F.lit(False))
    met = a.unionByName(b).drop("rows", "columns")
    return met.groupBy("ball", "row", "column").applyInArrow(_member_links(dim, threshold), "key binary, links bigint, item binary, root binary")


def near_duplicates(rows: DataFrame, threshold: float = 0.9, recall: float = 0.98, leaf: int = LEAF, overlap: float = 0.5, dense: int = 32, seed: int = 0) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row (vec_id, embedding).

    ``recall`` is what the trees are to reach for pairs just at the threshold;
    closer pairs are found more surely. ``overlap`` is half the width of a
    split's overlap, in standard deviations of such a pair's projected difference.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    keyed = cut_lineage(_keyed(rows))
    classes = cut_lineage(keyed.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"), F.any_value("vector").alias("vector")))
    n, longest = classes.agg(F.count("*"), F.max(F.octet_length("vector"))).first()
    dim = (longest or 8) // 8
    within = math.acos(threshold) / 2 - 2 * SURE
    points = classes.select(F.col("key").alias("item"), "vector", F.lit(0.0).alias("radius"))
    found = _in_balls(points, n, Shape(dim, leaf, seed=seed), within, dense) if n else None
    if found is None:
        members = classes.withColumn("item", F.col("key"))
        items = members.select("item", "n", "low", "vector", F.lit(0.0).alias("radius"))
    else:
        inside, balls = found
        members = cut_lineage(classes.join(inside.withColumnRenamed("item", "key"), "key", "left").withColumn("item", F.coalesce("ball", "key")))
        sums = members.where("ball is not null").groupBy("item").agg(F.sum("n").alias("n"), F.min("low").alias("low"))
        condensed = sums.join(balls.withColumnRenamed("ball", "item"), "item").select("item", "n", "low", F.col("centre").alias("vector"), "radius")
        items = cut_lineage(members.where("ball is null").select("item", "n", "low", "vector", F.lit(0.0).alias("radius")).union(condensed))
        n = items.count()
    chord = math.sqrt(2 - 2 * threshold) / math.sqrt(dim)
    forest = Shape(dim, leaf, overlap * chord, chord, seed + 1)
    placed = route(items.select("item", "n", "vector", "radius"), n, forest, recall) if n else None
    if placed is None:
        return _labelled(keyed, classes.withColumns({"n_links": F.lit(0).cast("bigint"), "component_id": F.col("low")}))
    compared = cut_lineage(placed.withColumn("leaf", F.explode("leaves")).groupBy("leaf").applyInArrow(_compared(dim, threshold), COMPARED))
    edges = compared.where("root is not null").select(F.col("item").alias("u"), F.col("root").alias("v"))
    links = compared.groupBy("item").agg(F.sum("links").alias("links"))
    unsure = compared.where("unsure is not null").select("item", "unsure").distinct()
    sums = items.select("item", F.col("n").alias("whole"), "low")
    linked = members.select("key", "item").join(sums.join(links, "item", "left"), "item")
    total = F.col("whole") - 1 + F.coalesce("links", F.lit(0))
    if found is not None and not unsure.isEmpty():
        faced = cut_lineage(_facing(unsure, members.select("item", "key", "n", "vector"), dim, threshold, leaf))
        edges = edges.union(faced.select(F.col("item").alias("u"), F.col("root").alias("v")))
        linked = linked.join(faced.groupBy("key").agg(F.sum("links").alias("more")), "key", "left")
        total = total + F.coalesce("more", F.lit(0))
    groups = components(edges)
    least = groups.join(sums.select(F.col("item").alias("node"), "low"), "node")
    least = least.join(least.groupBy("component").agg(F.min("low").alias("smallest")), "component").select(F.col("node").alias("item"), "smallest")
    named = linked.join(least, "item", "left").select("key", total.alias("n_links"), F.coalesce("smallest", "low").alias("component_id"))
    return _labelled(keyed, named)


def _labelled(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    joined = keyed.select("vec_id", "key").join(classes.select("key", "n_links", "component_id"), "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
