"""Timestamps, day counts and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import as_column

# Text layouts accepted besides the ISO forms.
EXTRA_LAYOUTS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")


def parse_timestamp(value: Column | str, layouts: tuple[str, ...] = EXTRA_LAYOUTS) -> Column:
    """Text to TIMESTAMP_NTZ; null when no layout fits."""
    column = as_column(value)
    attempts = [column.try_cast("timestamp_ntz")]
    attempts += [F.try_to_timestamp(column, F.lit(layout)).cast("timestamp_ntz") for layout in layouts]
    return F.coalesce(*attempts)


def as_timestamp(df: DataFrame, name: str = "InvoiceDate") -> Column:
    """The column as TIMESTAMP_NTZ, whatever the table declares."""
    declared = dict(df.dtypes)[name]
    if declared == "timestamp_ntz":
        return F.col(name)
    if declared == "string":
        return parse_timestamp(name)
    return F.col(name).cast("timestamp_ntz")


def coerce_dates(df: DataFrame, name: str = "InvoiceDate") -> DataFrame:
    """Typed timestamps only: unparseable and null dates are dropped."""
    if dict(df.dtypes)[name] != "timestamp_ntz":
        df = df.withColumn(name, as_timestamp(df, name))
    return df.where(F.col(name).isNotNull())


def _time_of_day(ts: Column) -> Column:
    return ts - ts.cast("date").cast("timestamp_ntz")


def floor_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole elapsed days, rounded down (also below zero).

    Calendar-day difference, less one when the later clock time is the
    earlier one; no time zone takes part.
    """
    a = as_column(later).cast("timestamp_ntz")
    b = as_column(earlier).cast("timestamp_ntz")
    borrow = F.when(_time_of_day(a) < _time_of_day(b), 1).otherwise(0)
    return (F.datediff(a.cast("date"), b.cast("date")) - borrow).cast("int")


def plus_days(ts: Column | str, days: int) -> Column:
    return as_column(ts) + F.make_dt_interval(F.lit(days))


def month_start(ts: Column | str) -> Column:
    return F.trunc(as_column(ts).cast("date"), "MM")


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """Calendar features of a date: Monday is 0, weeks are ISO weeks."""
    column = as_column(day)
    weekday = F.weekday(column)
    return {
        "day_of_week": weekday.cast("tinyint"),
        "is_weekend": F.when(weekday >= 5, 1).otherwise(0).cast("tinyint"),
        "day_of_month": F.dayofmonth(column).cast("tinyint"),
        "month": F.month(column).cast("tinyint"),
        "iso_week": F.weekofyear(column).cast("smallint"),
        "year": F.year(column).cast("smallint"),
    }
