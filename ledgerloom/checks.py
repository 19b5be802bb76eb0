"""Argument and schema checks that run before any job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

ABC_CLASSES = ("A", "B", "C")
REORDER_SORTS = ("EOQ", "Revenue", "AnnualDemand", "DaysSinceLastSale")


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return sorted(set(required) - present)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def check_demand_args(horizon_days: int) -> None:
    if not 1 <= horizon_days <= 365:
        raise ValueError(f"horizon_days must be in [1, 365], got {horizon_days}")


def check_inventory_args(top_n: int, abc_filter: str) -> None:
    if not 1 <= top_n <= 500:
        raise ValueError(f"top_n must be in [1, 500], got {top_n}")
    if abc_filter not in (*ABC_CLASSES, "ALL"):
        raise ValueError(f"abc_filter must be A, B, C or ALL, got {abc_filter!r}")


def check_reorder_sort(sort_by: str) -> None:
    if sort_by not in REORDER_SORTS:
        raise ValueError(f"sort_by must be one of {REORDER_SORTS}, got {sort_by!r}")


def check_fraction(fraction: float) -> None:
    if not 0.0 < fraction < 1.0:
        raise ValueError(f"reference_fraction must be in (0, 1), got {fraction!r}")


def check_positive(name: str, values: Iterable[int]) -> None:
    if any(value <= 0 for value in values):
        raise ValueError(f"{name} must be positive integers")
