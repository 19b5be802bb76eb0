"""Hard negatives and near duplicates of embeddings against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import embedding_dedup, hard_negatives, projection_trees
from ledgerloom.llm.queries import op12_hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit("clash"), "mark": F.lit(1), "item": F.lit(2), "leaf": F.lit(3)})


def mined(rows, every=100):
    """Hard negatives by plain loops over (id, vector, label)."""
    fit = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, label in fit:
        if i % every:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in fit if j != i)
        for s, p, _ in [r for r in ranked if r[2] == label][:5]:
            window = [r for r in ranked if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s]
            out += [(i, p, rank, j, -s, -n) for rank, (n, j, _) in enumerate(window[:5], 1)]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in frame.collect())


def test_residue_scores():
    draw = np.random.default_rng(0)
    for largest, dim in [(1, 1), (200, 64), (1 << 20, 300), (1 << 27, 7)]:
        a, b = (draw.integers(-largest, largest + 1, (40, dim)) for _ in range(2))
        primes = hard_negatives.primes_for(dim * largest * largest)
        got = hard_negatives.scores(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
        assert (got == a @ b.T).all()
        extreme = np.full((1, dim), largest)
        for sign in (1, -1):
            got = hard_negatives.scores(hard_negatives.residues(extreme, primes), hard_negatives.residues(sign * extreme, primes), primes)
            assert got[0, 0] == sign * dim * largest * largest


def test_hard_negatives_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert rows_of(op12_hard_negatives(spark, folder)) == mined(rows)


@pytest.mark.parametrize("block_bytes, slices", [(1 << 24, 3), (600, 2)])
def test_hard_negatives_odd_rows(spark, block_bytes, slices):
    draw = random.Random(1)
    centre = [draw.gauss(0, 1) for _ in range(6)]
    near = lambda: [c + draw.gauss(0, 0.3) for c in centre]
    rows = [(i, near(), 0 if i % 3 else draw.randint(0, 2)) for i in range(1, 250)]
    rows += [(300 + i, rows[0][1], i % 2) for i in range(20)]  # ties
    rows += [(400, [0.0] * 6, 0), (401, [1.0, 2.0], 0), (402, [], 1), (403, near(), None), (404, None, 0), (405, [1.0, None], 0), (406, [float("nan")], 0)]
    rows += [(407, [float("inf")], 0), (None, near(), 0), (500, near(), 9), (-100, [-x for x in centre], 1)]
    got = hard_negatives.mine_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=block_bytes, slices=slices)
    assert rows_of(got) == mined(rows, 10)


def test_hard_negatives_limits(spark):
    assert hard_negatives.mine_negatives(table(spark, []), F.lit(True)).count() == 0
    alone = [(100, [1.0], 0), (100, [1.0], 0), (1, [1.0], 1)]
    assert hard_negatives.mine_negatives(table(spark, alone), F.col("vec_id") == 100).count() == 0
    twice = [*alone, (2, [1.0], 0)]
    assert rows_of(hard_negatives.mine_negatives(table(spark, twice), F.col("vec_id") == 100)) == [(100, 2, 1, 1, 65536, 65536)]
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mine_negatives(table(spark, [(100, [1e300], 0)]), F.lit(True)).count()


def linked(rows, threshold=0.9):
    """(id, links, component) by comparing all with all."""
    dim = max((len(v) for _, v in rows if v is not None), default=0)
    units = np.zeros((len(rows), dim))
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            units[i, : len(v)] = np.array(v) / max(map(abs, v))
            units[i] /= np.linalg.norm(units[i])
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    labels = list(range(len(rows)))

    def root(i):
        while labels[i] != i:
            labels[i] = i = labels[labels[i]]
        return i

    for i, j in zip(*np.nonzero(near)):
        labels[root(i)] = root(j)
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[root(i)] = min(least.get(root(i), vec_id), vec_id)
    return [(vec_id, int(near[i].sum()), least.get(root(i))) for i, (vec_id, _) in enumerate(rows)]


def around(draw, centre, cosine, n):
    """n unit vectors with the given cosine to a centre."""
    noise = draw.standard_normal((n, len(centre)))
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return cosine * centre + math.sqrt(1 - cosine * cosine) * noise


def unit(draw, dim, n=1):
    x = draw.standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def duplicates(spark, rows, **options):
    got = embedding_dedup.near_duplicates(table(spark, [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows]), **options).collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


@pytest.mark.parametrize("sample", [None, 200])
def test_near_duplicates_of_groups(spark, monkeypatch, sample):
    """Groups of all sizes, some spread over many leaves, one of equal vectors; all links are found."""
    if sample:
        monkeypatch.setattr(projection_trees, "SAMPLE_BYTES", sample * 8 * 32)
    draw = np.random.default_rng(3)
    parts = [unit(draw, 32, 900)]
    parts += [around(draw, unit(draw, 32)[0], 0.99, n) for n in (2, 3, 5, 20, 60, 700)]
    parts += [np.repeat(unit(draw, 32), 50, axis=0)]
    rows = list(enumerate(np.concatenate(parts)))
    assert duplicates(spark, rows, leaf=96) == sorted(linked(rows), key=str)


def test_balls_that_are_neither_linked_nor_apart(spark):
    """Two tight groups and a few vectors about 26 degrees away from each other, where members decide."""
    draw = np.random.default_rng(4)
    centre, side = unit(draw, 32, 2)
    side -= (side @ centre) * centre
    side /= np.linalg.norm(side)
    turned = lambda degrees: math.cos(math.radians(degrees)) * centre + math.sin(math.radians(degrees)) * side
    parts = [around(draw, centre, 0.995, 150), around(draw, turned(25.5), 0.995, 120), around(draw, turned(-24), 0.999, 9), unit(draw, 32, 300)]
    rows = list(enumerate(np.concatenate(parts)))
    wanted = linked(rows)
    assert 150 * 120 * 0.1 < sum(n for i, n, _ in wanted if i < 150) - 150 * 149 < 150 * 129 * 0.9
    assert duplicates(spark, rows, leaf=4096) == sorted(wanted, key=str)


def test_recall_at_the_threshold(spark, monkeypatch):
    """Pairs only just linked, in many leaves: found as often as asked for, and none made up."""
    monkeypatch.setattr(projection_trees, "SAMPLE_BYTES", 1500 * 8 * 48)
    draw = np.random.default_rng(5)
    seeds = unit(draw, 48, 3000)
    pairs = np.concatenate([around(draw, s, 0.905, 1) for s in seeds])
    rows = list(enumerate(np.concatenate([seeds, pairs])))
    wanted, got = dict((i, n) for i, n, _ in linked(rows)), duplicates(spark, rows, leaf=128, recall=0.95)
    assert all(n <= wanted[i] for i, n, _ in got)
    assert sum(n for _, n, _ in got) >= 0.93 * sum(wanted.values())


def test_near_duplicates_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0]), (3, [2e300, 1e299]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0])]
    rows += [(None, [1.0, 0.0]), (2, [1.0, 0.0]), (-5, [0.0, 1e-300]), (20, [0.0, 3.0, 0.0]), (21, [-0.0, 3.0])]
    assert duplicates(spark, rows) == sorted(linked(rows), key=str)
    assert duplicates(spark, []) == [] and duplicates(spark, [(1, None)]) == [(1, 0, 1)]
    assert duplicates(spark, [(i, [0.5, 0.5]) for i in range(100, 3000)])[0] == (100, 2899, 100)


def test_trees_reach_every_vector():
    draw = np.random.default_rng(6)
    units = unit(draw, 16, 2000)
    shape = projection_trees.Shape(16, 50, 0.05, 0.1)
    trees, recall = projection_trees.fit_forest(units, 1.0, shape, 0.9)
    assert recall >= 0.9
    for tree in trees:
        rows, nodes = projection_trees.leaves(units, tree, shape)
        assert set(rows) == set(range(2000)) and np.unique(nodes, return_counts=True)[1].max() <= 100
