"""Classifier metrics from scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.prefix import running_totals


def _by_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    counts = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(counts, [F.desc("score")], ["pos", "neg"])


def roc_curve(scored: DataFrame, label: str = "churned", score: str = "churn_probability") -> DataFrame:
    """(threshold, fpr, tpr) for each distinct score, strictest first."""
    ranked = _by_score(scored, label, score)
    sizes = ranked.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    return ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("run_neg").cast("double"), sizes.getField("n").cast("double")).alias("fpr"),
        F.try_divide(F.col("run_pos").cast("double"), sizes.getField("p").cast("double")).alias("tpr"),
    )


def binary_metrics(
    scored: DataFrame,
    label: str = "churned",
    score: str = "churn_probability",
    cutoff: float = 0.5,
) -> DataFrame:
    """AUC, accuracy, precision, recall and F1 in one row; 0 where undefined.

    All of them follow from the counts per distinct score. For the area each
    positive is set against the negatives below it, equal scores counting
    half; it is null when a class is absent.
    """
    ranked = _by_score(scored, label, score)
    chosen = F.col("score") >= cutoff
    whole = "decimal(38,0)"
    # Positives times negatives at or above them, less half of those at the
    # same score, is what the area lacks. Doubled, it is a whole number.
    twice_lost = F.sum(F.col("pos").cast(whole) * (2 * F.col("run_neg") - F.col("neg")).cast(whole))
    counts = ranked.agg(
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
        F.coalesce(F.sum(F.when(chosen, F.col("pos"))), F.lit(0)).cast("double").alias("tp"),
        F.coalesce(F.sum(F.when(chosen, F.col("neg"))), F.lit(0)).cast("double").alias("fp"),
        twice_lost.cast("double").alias("lost"),
    )
    p, n, tp, fp = (F.col(c) for c in ("p", "n", "tp", "fp"))

    def ratio(part, among):
        return F.coalesce(F.try_divide(part, among), F.lit(0.0))

    return counts.select(
        (1.0 - F.try_divide(F.col("lost") / 2.0, p * n)).alias("auc_roc"),
        ratio(n - fp + tp, p + n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, p).alias("recall"),
        ratio(2 * tp, tp + fp + p).alias("f1"),
        (p + n).alias("n_test"),
    )
