"""Churn classifier: split, fit, score, importance."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.customers import fill_model_features
from ledgerloom.operators.evaluation import binary_metrics
from ledgerloom.operators.prefix import row_numbers
from ledgerloom.schemas import CHURN_FEATURES
from ledgerloom.session import shared_dir

# Columns of a scoring batch and their defaults.
SCORING_COLUMNS = {
    "recency": None,
    "frequency": None,
    "monetary": None,
    "avg_basket_size": 0.0,
    "unique_products": 0,
    "avg_days_between": 0.0,
    "is_uk": 0,
}


def check_scoring_rows(batch: DataFrame) -> DataFrame:
    """Fill defaults and add ``violation``: the first broken limit, or null."""
    filled = batch
    for name, default in SCORING_COLUMNS.items():
        if name not in batch.columns:
            if default is None:
                raise ValueError(f"scoring batch is missing required columns: ['{name}']")
            filled = filled.withColumn(name, F.lit(default))
        elif default is not None:
            filled = filled.withColumn(name, F.coalesce(name, F.lit(default)))
    problem = F.lit(None).cast("string")
    for name in reversed(list(SCORING_COLUMNS)):
        value = F.col(name)
        bad = value.isNull() | F.isnan(value.cast("double")) | (value < 0)
        if name == "is_uk":
            bad = bad | ~value.isin(0, 1)
        problem = F.when(bad, F.lit(name)).otherwise(problem)
    return filled.withColumn("violation", problem)


def broken_scoring_rows(batch: DataFrame) -> DataFrame:
    """Rows of a scoring batch that cannot be scored, with the first broken limit: the quarantine of ``scoring_features``."""
    return check_scoring_rows(batch).where(F.col("violation").isNotNull())


def scoring_features(batch: DataFrame) -> DataFrame:
    """A checked scoring batch under the feature names of the model; see ``broken_scoring_rows`` for the others."""
    good = check_scoring_rows(batch).where(F.col("violation").isNull()).drop("violation")
    names = {"recency": "Recency", "frequency": "Frequency", "monetary": "Monetary"}
    return good.withColumnsRenamed(names)


def stratified_split(
    table: DataFrame, label: str = "churned", key: str = "CustomerID", test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test`` with the same label shares on both sides.

    Rows are ordered by a seeded hash of the key and numbered per label in
    range partitions, so the split is exact and does not depend on how the
    input happens to be partitioned.
    """
    mixed = table.withColumn("_mix", F.xxhash64(F.col(key), F.lit(seed)))
    numbered = row_numbers(mixed, ["_mix", key], [label], "_row").drop("_mix")
    sizes = {r[label]: r["count"] for r in numbered.groupBy(label).count().collect()}
    wanted = _allot(sizes, math.ceil(sum(sizes.values()) * test_fraction))
    limit = F.lit(0)
    for value, count in wanted.items():
        limit = F.when(F.col(label) == F.lit(value), F.lit(count)).otherwise(limit)
    return numbered.withColumn("is_test", F.col("_row") <= limit).drop("_row")


def _allot(sizes: dict, total: int) -> dict:
    """Share ``total`` among classes in proportion, largest remainders first."""
    rows = sum(sizes.values())
    exact = {value: total * size / rows for value, size in sizes.items()}
    given = {value: int(share) for value, share in exact.items()}
    by_rest = sorted(exact, key=lambda value: (given[value] - exact[value], str(value)))
    for value in by_rest[: total - sum(given.values())]:
        given[value] += 1
    return given


def model_features(drop_recency: bool = False) -> list[str]:
    """The label is a function of Recency; leaving it out gives an honest model."""
    return [c for c in CHURN_FEATURES if not (drop_recency and c == "Recency")]


def _fit(train: DataFrame, learner, features: Sequence[str]) -> PipelineModel:
    spark = train.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    columns = [*features, "churned"]
    return Pipeline(stages=[assembler, learner]).fit(fill_model_features(train, list(features)).select(*columns))


def fit_churn(
    train: DataFrame,
    trees: int = 200,
    depth: int = 4,
    learning_rate: float = 0.05,
    subsample: float = 0.9,
    column_sample: float = 0.9,
    seed: int = 42,
    drop_recency: bool = False,
) -> PipelineModel:
    """Gradient-boosted trees on the churn features."""
    learner = GBTClassifier(
        labelCol="churned",
        maxIter=trees,
        maxDepth=depth,
        stepSize=learning_rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(column_sample),
        seed=seed,
    )
    return _fit(train, learner, model_features(drop_recency))


def fit_challenger(
    train: DataFrame, trees: int = 200, depth: int = 4, seed: int = 42, drop_recency: bool = False
) -> PipelineModel:
    learner = RandomForestClassifier(labelCol="churned", numTrees=trees, maxDepth=depth, seed=seed)
    return _fit(train, learner, model_features(drop_recency))


def score_churn(model: PipelineModel, rows: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """Add ``churn_probability`` and ``predicted_churn`` to feature rows."""
    features = model.stages[0].getInputCols()
    probability = vector_to_array("probability").getItem(1)
    scored = model.transform(fill_model_features(rows, features))
    return (
        scored.withColumn("churn_probability", probability)
        .withColumn("predicted_churn", F.col("churn_probability") >= cutoff)
        .drop("features", "rawPrediction", "probability", "prediction")
    )


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    """(feature, importance), one row per model input."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(weight)) for name, weight in zip(names, weights)], "feature string, importance double"
    )


def importance_sort(importance: DataFrame) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature")


def evaluate_churn(model: PipelineModel, split: DataFrame, name: str = "gbt") -> DataFrame:
    """One metrics row for the test side of a split table."""
    scored = score_churn(model, split.where("is_test"))
    sides = split.agg(
        F.struct(F.count_if(~F.col("is_test")).alias("train"), F.avg("churned").alias("rate"))
    ).scalar()
    return binary_metrics(scored).select(
        F.lit(name).alias("model"),
        "*",
        sides.getField("train").cast("double").alias("n_train"),
        sides.getField("rate").alias("churn_rate"),
    )


def compare_challenger(models: dict[str, PipelineModel], split: DataFrame) -> DataFrame:
    """Metrics of several models on the same test rows, one row each."""
    rows = [evaluate_churn(model, split, name) for name, model in models.items()]
    compared = rows[0]
    for row in rows[1:]:
        compared = compared.unionByName(row)
    return compared
