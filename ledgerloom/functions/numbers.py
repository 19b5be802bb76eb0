"""Money sums and rounding.

Money is summed as whole ten-thousandths in a BIGINT. Integer sums do not
depend on row order, so a retried task gives the same total to the last bit,
and they stay in the primitive aggregation path where a wide DECIMAL would
not. An overflow raises, because ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

UNITS_PER_ONE = 10_000


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(value: Column | str) -> Column:
    return F.nanvl(as_column(value).cast("double"), F.lit(None).cast("double"))


def money_units(value: Column | str) -> Column:
    """A currency amount as whole ten-thousandths."""
    return F.rint(nan_to_null(value) * UNITS_PER_ONE).cast("bigint")


def off_units(value: Column | str) -> Column:
    """Whether an amount is not a whole number of ten-thousandths, beyond what arithmetic on doubles leaves."""
    scaled = nan_to_null(value) * UNITS_PER_ONE
    return F.abs(scaled - F.rint(scaled)) > 1e-3 + 1e-9 * F.abs(scaled)


def from_units(units: Column | str) -> Column:
    return as_column(units).cast("double") / F.lit(float(UNITS_PER_ONE))


def money_sum(value: Column | str) -> Column:
    """Aggregate: total amount, 0 for a group without values."""
    return from_units(F.coalesce(F.sum(money_units(value)), F.lit(0)))


def money_sum_over(value: Column | str, window: WindowSpec) -> Column:
    return from_units(F.sum(money_units(value)).over(window))


def money_mean(value: Column | str) -> Column:
    """Aggregate: mean amount, null for a group without values."""
    return from_units(F.sum(money_units(value))) / F.nullif(F.count(nan_to_null(value)), F.lit(0))


def half_even(value: Column | str, digits: int) -> Column:
    """Round the scaled double half to even."""
    factor = float(10**digits)
    return F.rint(as_column(value) * factor) / F.lit(factor)


def share_pct(part: Column | str, whole: Column | str) -> Column:
    """Percentage with two decimals; null when the whole is zero."""
    return half_even(F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double")) * 100.0, 2)
