"""Daily series, calendar, lag and rolling features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ledgerloom.checks import check_positive, require_columns
from ledgerloom.functions.dates import calendar_columns, coerce_dates, month_start
from ledgerloom.functions.numbers import from_units, money_sum, money_units

DAILY_INPUT = ("InvoiceDate", "InvoiceNo", "TotalPrice", "Quantity", "CustomerID")
DAILY_VALUES = ("Revenue", "Orders", "ItemsSold", "Customers")


def _by_series(series: Sequence[str]) -> WindowSpec:
    """Days of a series in order. Without keys there is one series, whose
    length is a number of calendar days."""
    return Window.partitionBy(*series).orderBy("InvoiceDate")


def daily_revenue(
    transactions: DataFrame, fill_missing_days: bool = True, series: Sequence[str] = ()
) -> DataFrame:
    """Revenue, orders, items and customers per day (and series key).

    Lines are first added up per invoice and customer, on the map side as far
    as they meet there, so that the two distinct counts expand invoices and
    not lines, and a day with very many lines is spread over many tasks.
    """
    require_columns(transactions, [*DAILY_INPUT, *series], "transactions")
    lines = coerce_dates(transactions).select(
        *series,
        F.col("InvoiceDate").cast("date").alias("InvoiceDate"),
        "InvoiceNo",
        "CustomerID",
        money_units("TotalPrice").alias("units"),
        F.col("Quantity").cast("bigint").alias("items"),
    )
    if series:
        lines = lines.na.drop(subset=list(series))
    invoices = lines.groupBy(*series, "InvoiceDate", "InvoiceNo", "CustomerID").agg(
        F.sum("units").alias("units"), F.sum("items").alias("items")
    )
    return daily_from_invoices(invoices, series, fill_missing_days)


def daily_from_invoices(invoices: DataFrame, series: Sequence[str] = (), fill_missing_days: bool = True) -> DataFrame:
    """Daily totals from sums (units, items) per day, invoice and customer."""
    daily = invoices.groupBy(*series, "InvoiceDate").agg(
        from_units(F.coalesce(F.sum("units"), F.lit(0))).alias("Revenue"),
        F.count_distinct("InvoiceNo").alias("Orders"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("ItemsSold"),
        F.count_distinct("CustomerID").alias("Customers"),
    )
    return calendar_spine(daily, series) if fill_missing_days else daily


def calendar_spine(daily: DataFrame, series: Sequence[str] = (), values: Sequence[str] = DAILY_VALUES) -> DataFrame:
    """Add the missing days between first and last with zero values.

    Each day brings the empty days up to the next one, so the series is
    neither joined to a calendar nor aggregated a second time.
    """
    following = F.lead("InvoiceDate").over(_by_series(series))
    last_day = F.coalesce(F.date_sub(following, 1), F.col("InvoiceDate"))
    days = F.explode(F.sequence(F.col("InvoiceDate"), F.col("_last")))
    types = dict(daily.dtypes)
    spread = daily.withColumn("_last", last_day).select("*", days.alias("_day"))
    own = F.col("_day") == F.col("InvoiceDate")
    filled = [F.when(own, F.col(v)).otherwise(F.lit(0)).cast(types[v]).alias(v) for v in values]
    return spread.select(*series, F.col("_day").alias("InvoiceDate"), *filled)


def daily_resample(transactions: DataFrame) -> DataFrame:
    """Daily sum of quantity times price, empty days as 0."""
    dated = coerce_dates(transactions)
    daily = dated.groupBy(F.col("InvoiceDate").cast("date").alias("InvoiceDate")).agg(
        money_sum(F.col("Quantity") * F.col("UnitPrice")).alias("Revenue")
    )
    return calendar_spine(daily, values=("Revenue",))


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    month = month_start("InvoiceDate").alias("Month")
    return coerce_dates(transactions).groupBy(month).agg(money_sum("TotalPrice").alias("Revenue"))


def calendar_features(daily: DataFrame) -> DataFrame:
    return daily.withColumns(calendar_columns("InvoiceDate"))


def lag_features(
    daily: DataFrame, lags: Sequence[int] = (1, 7, 14), target: str = "Revenue", series: Sequence[str] = ()
) -> DataFrame:
    check_positive("lags", lags)
    require_columns(daily, [target], "daily series")
    window = _by_series(series)
    return daily.withColumns({f"lag_{n}": F.lag(target, n).over(window) for n in lags})


def rolling_features(
    daily: DataFrame,
    windows: Sequence[int] = (7, 14, 30),
    target: str = "Revenue",
    series: Sequence[str] = (),
) -> DataFrame:
    """Mean and deviation of the ``w`` days before each day.

    Half a window of history is required; otherwise the value is null.
    """
    check_positive("windows", windows)
    require_columns(daily, [target], "daily series")
    added: dict[str, Column] = {}
    for w in windows:
        past = _by_series(series).rowsBetween(-w, -1)
        enough = F.count(target).over(past) >= max(1, w // 2)
        added[f"rolling_mean_{w}"] = F.when(enough, F.avg(target).over(past))
        added[f"rolling_std_{w}"] = F.when(enough, F.stddev_samp(target).over(past))
    return daily.withColumns(added)


def timeseries_features(
    daily: DataFrame,
    lags: Sequence[int] = (1, 7, 14),
    windows: Sequence[int] = (7, 14, 30),
    target: str = "Revenue",
    series: Sequence[str] = (),
) -> DataFrame:
    """Calendar, lag and rolling columns on a gap-free daily series."""
    dated = calendar_features(daily)
    return rolling_features(lag_features(dated, lags, target, series), windows, target, series)


def rolling_band(daily: DataFrame, days: int = 7, series: Sequence[str] = ()) -> DataFrame:
    """Trailing mean and mean plus or minus one deviation, today included."""
    trailing = _by_series(series).rowsBetween(-(days - 1), 0)
    mean = F.avg("Revenue").over(trailing)
    std = F.stddev_samp("Revenue").over(trailing)
    return daily.withColumns({"band_mean": mean, "band_low": mean - std, "band_high": mean + std})


def daily_stability(daily: DataFrame, lag: int = 7) -> DataFrame:
    """Variation coefficient, autocorrelation and days without revenue."""
    before = F.lag("Revenue", lag).over(_by_series(()))
    return daily.withColumn("_before", before).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.try_divide(F.stddev_samp("Revenue"), F.avg("Revenue")).alias("variation"),
        F.corr("Revenue", "_before").alias(f"autocorr_{lag}"),
        F.count_if(F.col("Revenue") == 0).alias("zero_days"),
    )


def last_value(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return daily.groupBy(*series).agg(
        F.max("InvoiceDate").alias("last_date"), F.max_by("Revenue", "InvoiceDate").alias("last_actual")
    )


def history_tail(daily: DataFrame, days: int = 60) -> DataFrame:
    """The last days of a gap-free series."""
    newest = daily.agg(F.max("InvoiceDate")).scalar()
    return daily.where(F.col("InvoiceDate") > F.date_sub(newest, days))
