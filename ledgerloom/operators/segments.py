"""Customer segments: clustering, choice of k and personas."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.numbers import UNITS_PER_ONE, money_mean, money_sum, money_units, share_pct
from ledgerloom.operators.cells import UNIT_BITS, Cells, cell_sums, make_cells, nearest, silhouettes
from ledgerloom.operators.customers import fill_model_features
from ledgerloom.schemas import SEGMENT_FEATURES
from ledgerloom.session import cut_lineage, scratch_scope

# Persona names in display and fallback order.
PERSONAS = ["Champions", "Loyal Customers", "Regular", "At Risk", "Hibernating"]

MODEL_SCHEMA = (
    "cluster int, Recency double, Frequency double, Monetary double, size bigint, "
    "centre array<double>, mean array<double>, spread array<double>"
)


@dataclass
class Segmenter:
    """``model``: one row per cluster, see MODEL_SCHEMA. ``silhouettes``: Euclidean, by k, with the bound of their error."""

    model: DataFrame
    k: int
    silhouettes: dict[int, float]
    errors: dict[int, float]
    converged: bool

    @property
    def silhouette(self) -> float:
        return self.silhouettes[self.k]


def _scaling(filled: DataFrame) -> tuple[list[float], list[float]]:
    """Mean and population deviation of each feature, from sums of whole numbers."""
    units = [money_units(c).cast("decimal(38,0)") for c in SEGMENT_FEATURES]
    sums = [f for u in units for f in (F.sum(u), F.sum((u * u).cast("decimal(38,0)")))]
    n, *totals = filled.agg(F.count(F.lit(1)), *sums).first()
    if not n:
        raise RuntimeError("no customers to cluster")
    mean, spread = [], []
    for total, squares in zip(totals[::2], totals[1::2]):
        mean.append(int(total) / n / UNITS_PER_ONE)
        spread.append(math.sqrt(max(n * int(squares) - int(total) ** 2, 0)) / n / UNITS_PER_ONE or 1.0)
    return mean, spread


def _scaled(rows: DataFrame, mean: Sequence[float], spread: Sequence[float]) -> list[Column]:
    """Scaled features in whole 2**-20ths, so that their sums do not depend on the order of the rows."""
    return [
        F.rint((money_units(c).cast("double") / UNITS_PER_ONE - m) / s * (1 << UNIT_BITS)).cast("bigint").alias(c)
        for c, m, s in zip(SEGMENT_FEATURES, mean, spread)
    ]


def _seeded(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k starting centres, each drawn with odds of the squared distance from those before."""
    draw = np.random.default_rng([seed, k])
    points = sample.astype(float)
    centres = [points[draw.integers(len(points))]]
    gap = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        total = gap.cumsum()
        place = int(np.searchsorted(total, draw.random() * total[-1], "right")) if total[-1] else int(draw.integers(len(points)))
        centres.append(points[min(place, len(points) - 1)])
        gap = np.minimum(gap, ((points - centres[-1]) ** 2).sum(axis=1))
    return np.array(centres)


def lloyd(cells: Cells, starts: dict[int, np.ndarray], max_iter: int) -> tuple[dict[int, np.ndarray], dict[int, tuple], set[int]]:
    """Move the centres of all models together, one job an iteration, until no cluster changes.

    Returns centres, the last (count, sum) of their clusters, and the models that had not settled in time.
    """
    centres, sums, moving = dict(starts), {}, set(starts)
    for _ in range(max_iter):
        if not moving:
            break
        found = cell_sums(cells, {m: centres[m] for m in sorted(moving)})
        for model, (counts, totals) in found.items():
            if model in sums and all((a == b).all() for a, b in zip(sums[model], (counts, totals))):
                moving.discard(model)
            sums[model] = (counts, totals)
            filled = counts > 0
            centres[model] = np.where(filled[:, None], totals / np.maximum(counts, 1)[:, None], centres[model])
    return centres, sums, moving


def _compactness(counts: np.ndarray, totals: np.ndarray) -> float:
    """Sum of squares the centres explain; the squared distances to them are a constant less this."""
    return float(((totals.astype(float) ** 2).sum(axis=1) / np.maximum(counts, 1)).sum())


def fit_segmenter(
    rfm_table: DataFrame,
    k_min: int = 4,
    k_max: int = 8,
    n_init: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    depth: int = 12,
) -> Segmenter:
    """Cluster scaled recency, frequency and monetary value.

    Every k is fitted from ``n_init`` seeds, all of them together: each
    iteration is one job over the customers whose kd-cell lies between centres
    (see ``cells``). The closest fit of each k is judged by the mean Euclidean
    silhouette, whose error is bounded by the cells (``2 ** depth`` of them).
    Starting centres come from a bounded sample.
    """
    spark = rfm_table.sparkSession
    with scratch_scope(spark):
        filled = cut_lineage(fill_model_features(rfm_table, SEGMENT_FEATURES).select("CustomerID", *SEGMENT_FEATURES))
        mean, spread = _scaling(filled)
        cells = make_cells(filled.select("CustomerID", *_scaled(filled, mean, spread)), "CustomerID", SEGMENT_FEATURES, depth)
        wanted = {(k, i): _seeded(cells.sample, k, seed + i) for k in range(k_min, k_max + 1) for i in range(n_init)}
        names = dict(enumerate(wanted))
        centres, sums, moving = lloyd(cells, {n: wanted[key] for n, key in names.items()}, max_iter)
        best = {k: max((n for n, key in names.items() if key[0] == k), key=lambda n: (_compactness(*sums[n]), -n)) for k in range(k_min, k_max + 1)}
        judged = {k: n for k, n in best.items() if (sums[n][0] > 0).sum() > 1}
        if not judged:
            raise RuntimeError("no k gave at least two clusters")
        scored = silhouettes(cells, {k: centres[n] for k, n in judged.items()})
    chosen = max(scored, key=lambda k: (scored[k][0], -k))
    model = judged[chosen]
    rows = []
    for centre, size in zip(centres[model] / (1 << UNIT_BITS), sums[model][0]):
        raw = [float(c * s + m) for c, s, m in zip(centre, spread, mean)]
        rows.append((*raw, int(size), [float(c) for c in centre], mean, spread))
    rows.sort(key=lambda row: (-row[2], row[0], row[1]))
    table = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], MODEL_SCHEMA)
    return Segmenter(table, chosen, {k: s for k, (s, _) in scored.items()}, {k: e for k, (_, e) in scored.items()}, model not in moving)


def select_k(spark: SparkSession, segmenter: Segmenter) -> DataFrame:
    rows = [(k, float(s), float(segmenter.errors[k]), k == segmenter.k) for k, s in sorted(segmenter.silhouettes.items())]
    return spark.createDataFrame(rows, "k int, silhouette double, error double, chosen boolean")


def model_centroids(model: DataFrame) -> DataFrame:
    """Cluster centres in raw units; clusters are numbered by monetary value."""
    return model.select("cluster", *SEGMENT_FEATURES)


def centre_distances(model: DataFrame) -> Column:
    """(distance, cluster) of a row to every centre, nearest first; the model has a row for each cluster."""
    found = []
    for row in model.collect():
        scaled = [(money_units(c).cast("double") / UNITS_PER_ONE - m) / s for c, m, s in zip(SEGMENT_FEATURES, row["mean"], row["spread"])]
        squares = [F.pow(value - centre, 2) for value, centre in zip(scaled, row["centre"])]
        found.append(F.struct(F.sqrt(sum(squares[1:], squares[0])).alias("distance"), F.lit(row["cluster"]).alias("cluster")))
    return F.array_sort(F.array(*found))


def cluster_centroids(labelled: DataFrame) -> DataFrame:
    """Mean recency, frequency and monetary value per cluster label."""
    n = F.count(F.lit(1)).cast("double")
    return labelled.groupBy("cluster").agg(
        (F.sum("Recency").cast("double") / n).alias("Recency"),
        (F.sum("Frequency").cast("double") / n).alias("Frequency"),
        money_mean("Monetary").alias("Monetary"),
    )


def assign_personas(centroids: DataFrame) -> DataFrame:
    """(cluster, persona) from quartile rules over the centroids.

    Clusters are named in id order. A name already given is replaced by the
    first free one; when none is free the name repeats. The centroids are at
    most k rows, so they are folded as one array.
    """
    rows = F.array_sort(F.collect_list(F.struct("cluster", *SEGMENT_FEATURES)))
    packed = centroids.agg(
        rows.alias("rows"),
        F.percentile("Monetary", 0.75).alias("m75"),
        F.percentile("Frequency", 0.75).alias("f75"),
        F.percentile("Frequency", 0.5).alias("f50"),
        F.percentile("Recency", 0.25).alias("r25"),
        F.percentile("Recency", 0.75).alias("r75"),
    )
    names = F.array(*[F.lit(name) for name in PERSONAS])
    nothing = F.array().cast("array<struct<cluster:int,persona:string>>")

    def wish_of(row):
        rich, often = row["Monetary"] >= F.col("m75"), row["Frequency"] >= F.col("f75")
        fresh, stale = row["Recency"] <= F.col("r25"), row["Recency"] >= F.col("r75")
        seldom = row["Frequency"] < F.col("f50")
        return (
            F.when(rich & often & fresh, "Champions")
            .when(rich & often, "Loyal Customers")
            .when(rich & stale, "At Risk")
            .when(seldom & stale, "Hibernating")
            .otherwise("Regular")
        )

    def give(done, item):
        taken = F.transform(done, lambda d: d["persona"])
        free = F.filter(names, lambda name: ~F.array_contains(taken, name))
        wish = item["wish"]
        persona = F.when(F.array_contains(taken, wish), F.coalesce(F.get(free, 0), wish)).otherwise(wish)
        given = F.struct(item["cluster"].cast("int").alias("cluster"), persona.alias("persona"))
        return F.concat(done, F.array(given))

    wishes = F.transform("rows", lambda row: F.struct(row["cluster"].alias("cluster"), wish_of(row).alias("wish")))
    return packed.withColumn("wishes", wishes).select(F.inline(F.aggregate("wishes", nothing, give)))


def label_personas(labelled: DataFrame, personas: DataFrame, numbered_default: bool = False) -> DataFrame:
    """Add ``persona``; an unmapped cluster becomes ``Regular`` or ``cluster_N``."""
    other = F.concat(F.lit("cluster_"), F.col("cluster").cast("string")) if numbered_default else F.lit("Regular")
    # At most one row per cluster of a fitted model.
    joined = labelled.join(F.broadcast(personas), "cluster", "left")
    return joined.withColumn("persona", F.coalesce("persona", other))


def score_segments(model: DataFrame, customers: DataFrame) -> DataFrame:
    """Add ``cluster`` and ``persona`` to rows with R, F and M."""
    filled = fill_model_features(customers, SEGMENT_FEATURES)
    labelled = filled.withColumn("cluster", centre_distances(model)[0]["cluster"])
    return label_personas(labelled, assign_personas(model_centroids(model)))


def persona_order_join(summary: DataFrame) -> DataFrame:
    """Keep the present personas and add their display rank."""
    ranks = summary.sparkSession.createDataFrame(
        [(name, i) for i, name in enumerate(PERSONAS)], "persona string, persona_rank int"
    )
    return summary.join(ranks, "persona")


def persona_summary(labelled: DataFrame) -> DataFrame:
    n = F.count("CustomerID")
    per_persona = labelled.groupBy("persona").agg(
        n.alias("n_customers"),
        (F.sum("Recency").cast("double") / n).alias("avg_recency"),
        (F.sum("Frequency").cast("double") / n).alias("avg_frequency"),
        money_mean("Monetary").alias("avg_monetary"),
        money_sum("Monetary").alias("total_monetary"),
    )
    return _with_share(persona_order_join(per_persona), "n_customers")


def _with_share(personas: DataFrame, count: str) -> DataFrame:
    """Share of all customers; the rows are the personas."""
    everyone = F.sum(count).over(Window.partitionBy())
    return personas.withColumn("share_pct", share_pct(count, everyone))


def persona_distribution(labelled: DataFrame) -> DataFrame:
    counts = labelled.groupBy("persona").agg(F.count(F.lit(1)).alias("customers"))
    return _with_share(persona_order_join(counts), "customers")


def segment_headline(labelled: DataFrame) -> DataFrame:
    """Customers, clusters and personas; the small cells are counted last."""
    cells = labelled.groupBy("cluster", "persona").agg(F.count(F.lit(1)).alias("n"))
    return cells.agg(
        F.sum("n").alias("n_customers"),
        F.count_distinct("cluster").alias("n_clusters"),
        F.count_distinct("persona").alias("n_personas"),
    )


def centroid_distances(centroids: DataFrame) -> DataFrame:
    """Smallest and mean distance between centroids; at most k rows go in."""
    point = F.array(*[F.col(c).cast("double") for c in SEGMENT_FEATURES])
    packed = centroids.agg(F.array_sort(F.collect_list(F.struct("cluster", point.alias("at")))).alias("c"))

    def distance(a, b):
        squares = F.zip_with(a["at"], b["at"], lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))

    def to_later(a):
        later = F.filter("c", lambda b: b["cluster"] > a["cluster"])
        return F.transform(later, lambda b: distance(a, b))

    lengths = packed.select(F.size("c").alias("k"), F.explode(F.flatten(F.transform("c", to_later))).alias("d"))
    return lengths.groupBy("k").agg(F.min("d").alias("min_distance"), F.avg("d").alias("mean_distance"))
