"""Country and date filters and the domain they choose from."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def filter_country_dates(
    df: DataFrame,
    countries: Sequence[str] | DataFrame = (),
    start: date | None = None,
    end: date | None = None,
    inclusive_midnight: bool = False,
) -> DataFrame:
    """Rows of the given countries (none given: all) between two dates.

    A long list may come as a table with a column Country; it is joined.

    The end date counts in full; ``inclusive_midnight`` also keeps the first
    instant of the following day. On a table laid out by year and month the
    bounds are repeated on those columns, which prunes its folders.
    """
    if isinstance(countries, DataFrame):
        df = df.join(countries.select("Country"), "Country", "left_semi").select(*df.columns)
    elif countries and "Country" in df.columns:
        df = df.where(F.col("Country").isin(*countries))
    ts = F.col("InvoiceDate")
    partitioned = {"year", "month"} <= set(df.columns)
    month_no = F.col("year") * 12 + F.col("month") if partitioned else None
    if start is not None:
        df = df.where(ts >= F.lit(start).cast("timestamp_ntz"))
        if partitioned:
            df = df.where(month_no >= start.year * 12 + start.month)
    if end is not None:
        stop = F.date_add(F.lit(end), 1).cast("timestamp_ntz")
        df = df.where(ts <= stop if inclusive_midnight else ts < stop)
        if partitioned:
            # The day after the last of a month may still count at midnight.
            slack = 1 if inclusive_midnight else 0
            df = df.where(month_no <= end.year * 12 + end.month + slack)
    return df


def table_domain(df: DataFrame) -> DataFrame:
    """Countries in order with their dates and the dates of the whole table."""
    day = F.col("InvoiceDate").cast("date")
    per_country = df.groupBy("Country").agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))
    # The rows are countries by now, so one task may look over all of them.
    everywhere = Window.partitionBy()
    bounds = {
        "min_date": F.min("first_date").over(everywhere),
        "max_date": F.max("last_date").over(everywhere),
    }
    return per_country.withColumns(bounds).where(F.col("Country").isNotNull())
