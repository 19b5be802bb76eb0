"""Display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import as_column


def _scaled_whole(value: Column, digits: int) -> Column:
    """``value * 10**digits`` rounded on the exact binary value.

    Plain multiplication can turn 10.34999... into a tie at 103.5. The product's
    rounding error, found by splitting the factor into two halves (Dekker 1971),
    tells on which side of the tie the exact value lies.
    """
    factor = float(10**digits)
    product = value * factor
    spread = value * 134217729.0
    high = spread - (spread - value)
    error = (high * factor - product) + (value - high) * factor
    base = F.floor(product)
    rest = product - base
    tie_up = (error > 0) | ((error == 0) & (base % 2 != 0))
    up = (rest > 0.5) | ((rest == 0.5) & tie_up)
    return (base + F.when(up, 1).otherwise(0)).cast("bigint")


def _fixed(value: Column, digits: int) -> Column:
    whole = _scaled_whole(value, digits)
    size, factor = F.abs(whole), 10**digits
    sign = F.when(whole < 0, "-").otherwise("")
    left = F.floor(size / factor).cast("bigint")
    return F.format_string(f"%s%d.%0{digits}d", sign, left, size % factor)


def format_currency(value: Column | str) -> Column:
    """Compact amount: ``$1.83M``, ``$1.8k`` or ``$12`` by magnitude."""
    v = as_column(value).cast("double")
    size = F.abs(v)
    return (
        F.when(size >= 1e6, F.concat(F.lit("$"), _fixed(v / 1e6, 2), F.lit("M")))
        .when(size >= 1e3, F.concat(F.lit("$"), _fixed(v / 1e3, 1), F.lit("k")))
        .otherwise(F.concat(F.lit("$"), F.format_number(F.rint(v), 0)))
    )


def format_int(value: Column | str) -> Column:
    """Truncated integer with thousands separators."""
    return F.format_number(as_column(value).cast("bigint"), 0)
