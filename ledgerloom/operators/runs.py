"""Model runs and the choice of the best one."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import RUNS

# Deciding metric per model and whether small or large is good.
CRITERIA = [
    ("forecasting", "mape", "min"),
    ("churn", "auc_roc", "max"),
    ("segmentation", "silhouette", "max"),
    ("inventory", "n_skus", "max"),
]


def log_run(
    spark: SparkSession,
    path: str,
    model: str,
    run_id: str,
    metrics: dict[str, float],
    params: dict[str, object] | None = None,
    tags: dict[str, str] | None = None,
) -> None:
    """Append one run; metrics without a value are left out."""
    row = (
        model,
        run_id,
        datetime.now(timezone.utc).replace(tzinfo=None),
        {k: float(v) for k, v in metrics.items() if v is not None},
        {k: str(v) for k, v in (params or {}).items()},
        {k: str(v) for k, v in (tags or {}).items()},
    )
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def promote_best(runs: DataFrame) -> DataFrame:
    """(model, run_id, metric, value) of the best run per model.

    Runs without the deciding metric do not take part; of equal runs the
    earliest wins. The minimum is taken over a struct, so the choice is a
    plain partial aggregation.
    """
    criteria = runs.sparkSession.createDataFrame(CRITERIA, "model string, metric string, direction string")
    valued = runs.join(criteria, "model").withColumn(
        "value", F.nanvl(F.try_element_at("metrics", F.col("metric")), F.lit(None).cast("double"))
    )
    worse = F.when(F.col("direction") == "min", F.col("value")).otherwise(-F.col("value"))
    rank = F.struct(worse, F.col("logged_at"), F.col("run_id"))
    ranked = valued.where(F.col("value").isNotNull()).groupBy("model", "metric")
    return ranked.agg(F.min_by("run_id", rank).alias("run_id"), F.min_by("value", rank).alias("value"))
