"""Scalar business rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import as_column, half_even


def eoq(
    annual_demand: Column | str,
    unit_cost: Column | str,
    ordering_cost: Column | float = 50.0,
    holding_pct: Column | float = 0.25,
) -> Column:
    """Wilson order quantity; 0 when any input is not positive."""
    demand, cost = as_column(annual_demand), as_column(unit_cost)
    order = ordering_cost if isinstance(ordering_cost, Column) else F.lit(float(ordering_cost))
    hold = holding_pct if isinstance(holding_pct, Column) else F.lit(float(holding_pct))
    usable = (demand > 0) & (cost > 0) & (order > 0) & (hold > 0)
    return F.when(usable, F.sqrt(2.0 * demand * order / (hold * cost))).otherwise(F.lit(0.0))


def annual_demand(units: Column | str, span_years: Column | str) -> Column:
    return half_even(as_column(units).cast("double") / as_column(span_years), 1)


def dead_stock_flag(days_since_last_sale: Column | str, limit_days: int = 60) -> Column:
    return F.when(as_column(days_since_last_sale) > limit_days, 1).otherwise(0)


def churn_label(recency: Column | str, inactivity_days: int = 90) -> Column:
    return F.when(as_column(recency) > inactivity_days, 1).otherwise(0)


def forecast_delta_pct(mean_forecast: Column | str, last_actual: Column | str) -> Column:
    """Change against the last actual in percent; 0 when that actual is 0."""
    forecast, actual = as_column(mean_forecast), as_column(last_actual)
    change = F.try_divide(forecast - actual, actual) * 100.0
    return F.when(actual == 0, F.lit(0.0)).otherwise(change)


def bucket(value: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Right-closed buckets between consecutive edges; null outside."""
    column = as_column(value)
    ladder = F.when(column <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        ladder = ladder.when(column <= upper, F.lit(label))
    return ladder
