"""Running totals and exact quantiles without a single-task window.

A window ordered over a whole table runs in one task. Here the rows are range
partitioned on the order, the layout is made permanent in a written table (a
partition id that was recomputed could differ), every partition is summed, and only the per-partition totals (at most one row per partition
and group) go through an ordered window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.numbers import as_column, nan_to_null
from ledgerloom.session import cut_lineage

PART = "_range_part"


def _plain(order: Sequence[Column | str]) -> list[Column]:
    return [as_column(column) for column in order]


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Sequence[str],
    group: Sequence[str] = (),
    previous: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``run_<c>``: the inclusive running total of each column in ``sums``.

    ``order`` must be total inside a group. ``previous`` names an ascending
    order column; ``prev_<c>`` then holds its value on the row before. The
    totals must be integers, so that they do not depend on the partitioning.
    """
    keys = [*[F.col(name) for name in group], *_plain(order)]
    # Without a number AQE joins neighbouring ranges that turn out small.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    placed = cut_lineage(ranged.withColumn(PART, F.spark_partition_id()))

    extra = [F.max(previous).alias(f"_last_{previous}")] if previous else []
    totals = placed.groupBy(*group, PART).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums], *extra)
    before = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        PART,
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums],
        *([F.max(f"_last_{previous}").over(before).alias("_carried")] if previous else []),
    )
    inside = Window.partitionBy(*group, PART).orderBy(*_plain(order))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    # One row for each range partition and group in it; the optimizer broadcasts them where they are few.
    joined = placed.join(offsets, [*group, PART])
    running = {f"run_{c}": F.sum(c).over(so_far) + F.col(f"_off_{c}") for c in sums}
    if previous:
        running[f"prev_{previous}"] = F.coalesce(F.lag(previous).over(inside), F.col("_carried"))
    helper = [PART, *[f"_off_{c}" for c in sums], *(["_carried"] if previous else [])]
    return joined.withColumns(running).drop(*helper)


def row_numbers(
    df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (), name: str = "row_no"
) -> DataFrame:
    """Number the rows of each group from 1 in a total order."""
    numbered = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], group)
    return numbered.withColumnRenamed("run__one", name).drop("_one")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of several numeric columns in one scan, nulls left out."""
    typed = df.select(*[nan_to_null(c).alias(c) for c in columns])
    long = typed.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def count_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, run_n): distinct values with their running counts."""
    return running_totals(value_counts(df, columns), ["value"], ["n"], ["column"])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column, p, value): linearly interpolated exact quantiles."""
    return quantiles_of(count_ranks(df, columns), probabilities)


def quantiles_of(counts: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Quantiles from running counts.

    Values are counted first, so repeated values cost one row; the ranks are
    then located in the running counts. Nothing is collected per column.
    """
    sizes = counts.groupBy("column").agg(F.max("run_n").alias("total"))
    points = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    place = F.col("p") * (F.col("total") - 1)
    targets = sizes.select("column", "total", points.alias("p")).select(
        "column",
        "p",
        F.floor(place).alias("low_rank"),
        F.ceil(place).alias("high_rank"),
        (place - F.floor(place)).alias("weight"),
    )
    # One target row per requested column and probability: bounded by the call.
    hits = counts.join(F.broadcast(targets), "column")
    first, last = F.col("run_n") - F.col("n"), F.col("run_n") - 1
    low = F.max(F.when(F.col("low_rank").between(first, last), F.col("value")))
    high = F.max(F.when(F.col("high_rank").between(first, last), F.col("value")))
    located = hits.groupBy("column", "p", "weight").agg(low.alias("low"), high.alias("high"))
    return located.select(
        "column", "p", (F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")).alias("value")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
