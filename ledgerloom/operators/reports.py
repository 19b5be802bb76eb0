"""Sales and distribution reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from ledgerloom.functions.numbers import money_sum, money_sum_over, share_pct
from ledgerloom.operators.prefix import count_ranks, numeric_columns, quantiles_of


def share_of_total(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Each value in percent of the column total, two decimals.

    For report tables (countries, months, a top list), whose rows are few
    enough to be totalled next to each other; the input is computed once.
    """
    return df.withColumn(name, share_pct(value, money_sum_over(value, Window.partitionBy())))


def revenue_by_country(transactions: DataFrame) -> DataFrame:
    known = transactions.where(F.col("Country").isNotNull())
    revenue = known.groupBy("Country").agg(money_sum("TotalPrice").alias("Revenue"))
    return share_of_total(revenue, "Revenue").orderBy(F.desc("Revenue"), "Country")


def kpi_summary(transactions: DataFrame) -> DataFrame:
    """Revenue, orders, customers and average order value in one row.

    Lines are added up per invoice and customer before the distinct counts, so
    the global aggregate receives invoices, already summed.
    """
    invoices = transactions.groupBy("InvoiceNo", "CustomerID").agg(money_sum("TotalPrice").alias("amount"))
    totals = invoices.agg(
        money_sum("amount").alias("total_revenue"),
        F.count_distinct("InvoiceNo").alias("n_orders"),
        F.count_distinct("CustomerID").alias("n_customers"),
    )
    value = F.coalesce(F.try_divide(F.col("total_revenue"), F.col("n_orders")), F.lit(0.0))
    return totals.withColumn("avg_order_value", value)


def top_products(transactions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best products and their share of the shown total."""
    known = transactions.where(F.col("StockCode").isNotNull() & F.col("Description").isNotNull())
    revenue = known.groupBy("StockCode", "Description").agg(money_sum("TotalPrice").alias("Revenue"))
    shown = revenue.orderBy(F.desc("Revenue"), "StockCode", "Description").limit(n)
    return share_of_total(shown, "Revenue")


def country_rows_topn(transactions: DataFrame, n: int = 10) -> DataFrame:
    known = transactions.where(F.col("Country").isNotNull())
    return known.groupBy("Country").count().orderBy(F.desc("count"), "Country").limit(n)


def country_revenue_topn(transactions: DataFrame, n: int = 8) -> DataFrame:
    known = transactions.where(F.col("Country").isNotNull())
    revenue = known.groupBy("Country").agg(money_sum("TotalPrice").alias("Revenue"))
    return revenue.orderBy(F.desc("Revenue"), "Country").limit(n)


def sku_filtered_revenue(transactions: DataFrame) -> DataFrame:
    known = transactions.where(F.col("StockCode").isNotNull())
    return known.groupBy("StockCode").agg(money_sum("TotalPrice").alias("CountryRevenue"))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column.

    Everything is read off the counted distinct values, so the input is
    scanned once.
    """
    names = list(columns or numeric_columns(df))
    counts = count_ranks(df, names)
    n, value = F.col("n"), F.col("value")
    means = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        (F.sum(n * value) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row per described column.
    off = value - F.col("mean")
    spread = counts.join(F.broadcast(means), "column").groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(n * off * off), F.sum("n") - 1)).alias("std")
    )
    quartiles = (
        quantiles_of(counts, (0.25, 0.5, 0.75))
        .groupBy("column")
        .pivot("p", [0.25, 0.5, 0.75])
        .agg(F.first("value"))
        .toDF("column", "p25", "p50", "p75")
    )
    return means.join(spread, "column").join(quartiles, "column").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def trimmed_histogram(df: DataFrame, column: str, bins: int = 40, trim: float | None = 0.99) -> DataFrame:
    """Counts in equal bins between minimum and (trimmed) maximum.

    Every bin is listed. The last one is closed on the right; a column with a
    single value gets bins of total width 1 around it.
    """
    counts = count_ranks(df, [column])
    if trim is not None:
        limit = quantiles_of(counts, [trim]).select("value").first()
        if limit is not None:
            counts = counts.where(F.col("value") <= limit["value"])
    ends = counts.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
    if ends["low"] is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, bin_high double, rows bigint")
    low, high = float(ends["low"]), float(ends["high"])
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    # A value on an edge may divide to the bin beside it; the edges as listed decide.
    guess = F.least(F.greatest(F.floor((F.col("value") - low) / width).cast("int"), F.lit(0)), F.lit(bins - 1))
    edge = lambda i: F.lit(low) + i * F.lit(width)
    place = F.when(F.col("value") < edge(guess), guess - 1).when(F.col("value") >= edge(guess + 1), guess + 1).otherwise(guess)
    counted = counts.groupBy(F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).alias("bin")).agg(F.sum("n").alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )
