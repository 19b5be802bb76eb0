"""Public holidays by rule: fixed days, n-th weekdays and days counted from Easter."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONDAY, THURSDAY, SUNDAY = 0, 3, 6


@dataclass(frozen=True)
class Holiday:
    """A day of every year. ``day`` of ``month``, or its ``nth`` ``weekday``, or ``easter`` days after Easter Sunday."""

    name: str
    month: int = 3
    day: int | None = None
    weekday: int | None = None
    nth: int = 1
    easter: int | None = None
    monday_for_sunday: bool = False


# Holiday names per country.
RULES: dict[str, tuple[Holiday, ...]] = {
    "UK": (
        Holiday("NewYearsDay", 1, 1),
        Holiday("GoodFriday", easter=-2),
        Holiday("EasterMonday", easter=1),
        Holiday("ChristmasDay", 12, 25),
        Holiday("BoxingDay", 12, 26, monday_for_sunday=True),
    ),
    "US": (
        Holiday("NewYearsDay", 1, 1),
        Holiday("IndependenceDay", 7, 4),
        Holiday("Thanksgiving", 11, weekday=THURSDAY, nth=4),
        Holiday("ChristmasDay", 12, 25),
    ),
    "DE": (
        Holiday("NewYearsDay", 1, 1),
        Holiday("LabourDay", 5, 1),
        Holiday("GermanUnity", 10, 3),
        Holiday("ChristmasDay", 12, 25),
    ),
}


def rules_of(country: str | None) -> tuple[Holiday, ...]:
    """Holidays of a country, none for an unknown or missing one."""
    return RULES.get((country or "").strip().upper(), ())


def _after_march_22(year, floor: Callable):
    """Days from 22 March to Easter Sunday (Gregorian computus, in whole numbers; for columns as for ints)."""
    golden, century, rest = year % 19, floor(year / 100), year % 100
    leaps, correction = floor(century / 4), floor((century - floor((century + 8) / 25) + 1) / 3)
    moon = (19 * golden + century - leaps - correction + 15) % 30
    sunday = (32 + 2 * (century % 4) + 2 * floor(rest / 4) - moon - rest % 4) % 7
    late = floor((golden + 11 * moon + 22 * sunday) / 451)
    return moon + sunday - 7 * late


def holiday_column(rule: Holiday, year: Column) -> Column:
    """The date of a holiday in a year."""
    if rule.easter is not None:
        offset = _after_march_22(year, F.floor).cast("int") + rule.easter
        found = F.date_add(F.make_date(year, F.lit(3), F.lit(22)), offset)
    elif rule.weekday is not None:
        first = F.make_date(year, F.lit(rule.month), F.lit(1))
        found = F.date_add(first, F.pmod(F.lit(rule.weekday) - F.weekday(first), F.lit(7)) + 7 * (rule.nth - 1))
    else:
        found = F.make_date(year, F.lit(rule.month), F.lit(rule.day))
    return F.when(F.weekday(found) == SUNDAY, F.date_add(found, 1)).otherwise(found) if rule.monday_for_sunday else found


def holiday_date(rule: Holiday, year: int) -> date:
    """The same for plain numbers, for code that runs on small arrays."""
    if rule.easter is not None:
        found = date(year, 3, 22) + timedelta(_after_march_22(year, lambda x: int(x // 1)) + rule.easter)
    elif rule.weekday is not None:
        first = date(year, rule.month, 1)
        found = first + timedelta((rule.weekday - first.weekday()) % 7 + 7 * (rule.nth - 1))
    else:
        found = date(year, rule.month, rule.day)
    return found + timedelta(1) if rule.monday_for_sunday and found.weekday() == SUNDAY else found


def is_holiday(rule: Holiday, day: Column) -> Column:
    return day == holiday_column(rule, F.year(day))


def holiday_calendar(spark: SparkSession, country: str | None, start: date, end: date) -> DataFrame:
    """(country, ds, holiday) of every holiday between two dates; empty for an unknown or missing country."""
    key, rules = (country or "").strip().upper(), rules_of(country)
    years = spark.range(start.year, end.year + 1).select(F.col("id").cast("int").alias("year"))
    each = [F.struct(holiday_column(rule, F.col("year")).alias("ds"), F.lit(rule.name).alias("holiday")) for rule in rules]
    if not each:
        return spark.createDataFrame([], "country string, ds date, holiday string")
    days = years.select(F.lit(key).alias("country"), F.inline(F.array(*each)))
    return days.where(F.col("ds").between(F.lit(start), F.lit(end)))
