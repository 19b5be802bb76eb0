"""Kd-cells: clustering and silhouettes against all points."""

import numpy as np
import pandas as pd
import pytest

from ledgerloom.operators import cells, segments

COLUMNS = ["a", "b", "c"]


def points_of(n, seed):
    draw = np.random.default_rng(seed)
    blobs = [draw.normal(centre, spread, (n // 3, 3)) for centre, spread in [((0, 0, 0), 1.0), ((3, 1, 0), 0.7), ((0, 4, 2), 1.5)]]
    found = np.concatenate(blobs)
    found[:4] *= 300.0  # far out
    found[4:40] = found[4]  # equal
    return np.rint(found * (1 << cells.UNIT_BITS)).astype(np.int64)


@pytest.fixture(scope="module", params=[4, 10])
def laid_out(spark, request):
    points = points_of(1500, request.param)
    frame = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(points)), **{c: points[:, i] for i, c in enumerate(COLUMNS)}}))
    return points, cells.make_cells(frame, "id", COLUMNS, request.param)


def test_cells_hold_every_point(laid_out):
    points, found = laid_out
    assert found.count.sum() == len(points) and (found.total.sum(axis=0) == points.sum(axis=0)).all()
    place = found.tree.cells(points)
    for at, cell in enumerate(found.cell):
        inside = points[place == cell]
        assert found.count[at] == len(inside) and (found.low[at] == inside.min(axis=0)).all() and (found.high[at] == inside.max(axis=0)).all()


@pytest.mark.parametrize("on_driver", [0, cells.SAMPLE_ROWS])
def test_one_job_serves_all_models(laid_out, monkeypatch, on_driver):
    points, found = laid_out
    monkeypatch.setattr(cells, "SAMPLE_ROWS", on_driver)
    draw = np.random.default_rng(1)
    models = {k: points[draw.choice(len(points), k, replace=False)].astype(float) for k in (1, 2, 5, 8)}
    for _ in range(4):
        sums = cells.cell_sums(found, models)
        for k, centres in models.items():
            label = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            assert (sums[k][0] == np.bincount(label, minlength=k)).all()
            assert all((sums[k][1][j] == points[label == j].sum(axis=0)).all() for j in range(k))
            models[k] = sums[k][1] / np.maximum(sums[k][0], 1)[:, None]


def brute_silhouette(points, label, k):
    apart = np.sqrt(((points[:, None].astype(float) - points[None]) ** 2).sum(axis=2))
    sums, sizes, at = np.stack([apart[:, label == j].sum(axis=1) for j in range(k)], axis=1), np.bincount(label, minlength=k), np.arange(len(points))
    inner = sums[at, label] / np.maximum(sizes[label] - 1, 1)
    outer = np.where(sizes > 0, sums / np.maximum(sizes, 1), np.inf)
    outer[at, label] = np.inf
    return np.where(sizes[label] > 1, (outer.min(axis=1) - inner) / np.maximum(outer.min(axis=1), inner), 0.0).mean()


def test_silhouettes_within_their_error(laid_out):
    points, found = laid_out
    draw = np.random.default_rng(2)
    models = {k: points[draw.choice(len(points), k, replace=False)].astype(float) for k in (2, 5)}
    models[3] = np.concatenate([models[2], [[1e15] * 3]])  # an empty cluster
    scored = cells.silhouettes(found, models)
    for k, centres in models.items():
        label = cells.nearest(points, centres)
        value, error = scored[k]
        assert abs(value - brute_silhouette(points, label, k)) <= error + 1e-6
        assert found.tree.depth < 10 or error < 0.02


def test_settled_centres_are_means(laid_out):
    points, found = laid_out
    starts = {i: segments._seeded(found.sample, 4, i) for i in range(3)}
    centres, sums, moving = segments.lloyd(found, starts, 200)
    assert not moving
    for model, at in centres.items():
        label = cells.nearest(points, at)
        assert all(np.allclose(at[j], points[label == j].mean(axis=0)) for j in range(4) if (label == j).any())
    assert {len(segments.lloyd(found, starts, 1)[2])} == {3}
