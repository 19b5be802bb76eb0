"""Expectations over the cleaned table and the write gate."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import off_units
from ledgerloom.sources.stages import publish, read_stage, remove, write_stage


class ValidationFailed(RuntimeError):
    """The cleaned data broke an expectation; nothing was published."""


@dataclass(frozen=True)
class Expectation:
    kind: str  # row_count, not_null, between or whole_units
    column: str | None = None
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return self.kind

    def row_breaks(self) -> Column:
        """Per-row offence; a null value only offends ``not_null``."""
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "whole_units":
            return F.coalesce(off_units(self.column), F.lit(False))
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (value < self.low)
        if self.high is not None:
            outside = outside | (value > self.high)
        return F.coalesce(outside, F.lit(False))


def default_suite(min_rows: int = 1, max_rows: int | None = None) -> list[Expectation]:
    # Checked columns and bounds of the cleaned table.
    required = ("CustomerID", "InvoiceNo", "InvoiceDate", "StockCode", "Quantity", "UnitPrice")
    return [
        Expectation("row_count", None, min_rows, max_rows),
        *[Expectation("not_null", column) for column in required],
        Expectation("between", "Quantity", 1),
        Expectation("between", "UnitPrice", 0.01),
        Expectation("between", "TotalPrice", 0.01),
    ]


def validate_expectations(df: DataFrame, suite: list[Expectation] | None = None) -> DataFrame:
    """One row per expectation from a single aggregate over the table."""
    suite = suite or default_suite()
    rows = F.count(F.lit(1))
    aggregates, entries = [], []
    for i, check in enumerate(suite):
        if check.kind == "row_count":
            evaluated = rows
            bad = rows < (check.low or 0)
            if check.high is not None:
                bad = bad | (rows > int(check.high))
            unexpected = F.when(bad, 1).otherwise(0).cast("bigint")
        else:
            evaluated = rows if check.kind == "not_null" else F.count(check.column)
            unexpected = F.count_if(check.row_breaks())
        aggregates += [evaluated.alias(f"e{i}"), unexpected.alias(f"u{i}")]
        entries.append(
            F.struct(
                F.lit(check.name).alias("expectation"),
                F.lit(check.column or "").alias("column"),
                F.col(f"e{i}").alias("evaluated"),
                F.col(f"u{i}").alias("unexpected"),
                (F.col(f"u{i}") == 0).alias("success"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def failed_expectations(df: DataFrame, suite: list[Expectation] | None = None) -> list[str]:
    """Names of broken expectations (the suite bounds the collected rows)."""
    broken = validate_expectations(df, suite).where(~F.col("success")).collect()
    return [f"{r['expectation']}({r['column']}): {r['unexpected']} of {r['evaluated']}" for r in broken]


def failing_rows(df: DataFrame, suite: list[Expectation] | None = None) -> DataFrame:
    """Rows that break a row-level expectation, with the reasons."""
    suite = suite or default_suite()
    reasons = [
        F.when(c.row_breaks(), F.lit(f"{c.kind}({c.column})")) for c in suite if c.kind != "row_count"
    ]
    return df.withColumn("reasons", F.array_compact(F.array(*reasons))).where(F.size("reasons") > 0)


def gate_and_write(
    df: DataFrame,
    path: str,
    quarantine_path: str | None = None,
    suite: list[Expectation] | None = None,
) -> None:
    """Write the table only if it meets the suite.

    The rows go to a staging folder first and the suite is evaluated on that
    columnar copy, so the upstream plan runs once and what was checked is what
    gets published.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex}"
    write_stage(df, staging, by_month=True)
    staged = read_stage(spark, staging)
    broken = failed_expectations(staged, suite)
    if broken:
        if quarantine_path:
            failing_rows(staged, suite).write.mode("append").parquet(quarantine_path)
        remove(spark, staging)
        raise ValidationFailed(f"{path} left unwritten, expectations broken: " + "; ".join(broken))
    publish(spark, staging, path)
