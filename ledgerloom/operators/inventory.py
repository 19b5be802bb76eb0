"""SKU table: sales, ABC class, order quantity and dead stock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.checks import (
    ABC_CLASSES,
    check_inventory_args,
    check_reorder_sort,
    require_columns,
)
from ledgerloom.functions.dates import coerce_dates, floor_days, plus_days
from ledgerloom.functions.numbers import half_even, money_mean, money_sum, money_units
from ledgerloom.functions.retail import annual_demand, dead_stock_flag, eoq
from ledgerloom.operators.prefix import running_totals
from ledgerloom.operators.reports import sku_filtered_revenue
from ledgerloom.schemas import INVENTORY

INVENTORY_INPUT = ("StockCode", "Description", "Quantity", "UnitPrice", "InvoiceDate")


def _sku_order() -> list[Column]:
    return [F.desc("Revenue"), F.asc("StockCode"), F.asc("Description")]


def sku_sales(transactions: DataFrame) -> DataFrame:
    """Units, revenue, plain mean price and last sale per product."""
    require_columns(transactions, INVENTORY_INPUT, "transactions")
    known = coerce_dates(transactions).na.drop(subset=["StockCode", "Description"])
    return known.groupBy("StockCode", "Description").agg(
        F.coalesce(F.sum(F.col("Quantity").cast("bigint")), F.lit(0)).alias("UnitsSold"),
        money_sum(F.col("Quantity") * F.col("UnitPrice")).alias("Revenue"),
        money_mean("UnitPrice").alias("AvgUnitPrice"),
        F.max("InvoiceDate").alias("LastSale"),
    )


def _span_years(first: Column, last: Column) -> Column:
    days = floor_days(last, first) + 1
    return F.greatest(days.cast("double") / 365.25, F.lit(0.01))


def span_years(transactions: DataFrame) -> DataFrame:
    """One row: covered time in years, at least 0.01."""
    dated = coerce_dates(transactions)
    return dated.agg(_span_years(F.min("InvoiceDate"), F.max("InvoiceDate")).alias("span_years"))


def cumulative_share(skus: DataFrame) -> DataFrame:
    """Add ``cum_share`` of revenue in descending order and the ``sku_rank``."""
    counted = skus.withColumns({"_units": money_units("Revenue"), "_one": F.lit(1).cast("bigint")})
    ranked = running_totals(counted, _sku_order(), ["_units", "_one"])
    total = ranked.agg(F.sum("_units")).scalar()
    share = F.try_divide(F.col("run__units").cast("double"), total.cast("double"))
    return (
        ranked.withColumns({"_total": total, "cum_share": share})
        .withColumnRenamed("run__one", "sku_rank")
        .drop("_one", "_units")
    )


def abc_classify(skus: DataFrame) -> DataFrame:
    """Class by running revenue: A to 80 %, B to 95 %, C beyond.

    The best product is always A; without any revenue all are C.
    """
    ranked = cumulative_share(skus)
    run, total = F.col("run__units").cast("double"), F.col("_total").cast("double")
    label = (
        F.when(F.coalesce(total, F.lit(0.0)) <= 0, "C")
        .when(F.col("sku_rank") == 1, "A")
        .when(run <= F.lit(0.80) * total, "A")
        .when(run <= F.lit(0.95) * total, "B")
        .otherwise("C")
    )
    return ranked.withColumn("ABC", label).drop("run__units", "_total", "cum_share", "sku_rank")


def eoq_table(
    transactions: DataFrame,
    ordering_cost: float = 50.0,
    holding_pct: float = 0.25,
    dead_stock_days: int = 60,
    reference_date: datetime | str | None = None,
) -> DataFrame:
    """The inventory table, one row per product."""
    dated = coerce_dates(transactions)
    limits = dated.agg(F.struct(F.min("InvoiceDate").alias("first"), F.max("InvoiceDate").alias("last")))
    span = limits.scalar()
    first, last = span.getField("first"), span.getField("last")
    reference = plus_days(last, 1) if reference_date is None else F.lit(reference_date).cast("timestamp_ntz")
    demand = annual_demand("UnitsSold", _span_years(first, last))
    return (
        abc_classify(sku_sales(transactions))
        .withColumn("AnnualDemand", demand)
        .withColumn("EOQ", half_even(eoq("AnnualDemand", "AvgUnitPrice", ordering_cost, holding_pct), 1))
        .withColumn("DaysSinceLastSale", floor_days(reference, "LastSale"))
        .withColumn("IsDeadStock", dead_stock_flag("DaysSinceLastSale", dead_stock_days))
        .withColumn("OrderingCost", F.lit(float(ordering_cost)))
        .withColumn("HoldingPct", F.lit(float(holding_pct)))
        .select(*[field.name for field in INVENTORY.fields])
    )


def inventory_metrics(inventory: DataFrame, transactions: DataFrame) -> DataFrame:
    """Class counts, dead stock, revenue and covered years in one row."""
    n = F.count(F.lit(1)).cast("double")
    dead = F.coalesce(F.sum("IsDeadStock"), F.lit(0)).cast("double")
    counts = [
        F.count_if(F.col("ABC") == c).cast("double").alias(f"n_class_{c.lower()}") for c in ABC_CLASSES
    ]
    return inventory.agg(
        n.alias("n_skus"),
        *counts,
        dead.alias("n_dead_stock"),
        F.try_divide(dead, n).alias("dead_stock_pct"),
        money_sum("Revenue").alias("total_revenue"),
    ).withColumn("span_years", span_years(transactions).scalar())


def inventory_headline(inventory: DataFrame) -> DataFrame:
    n, dead = F.count(F.lit(1)), F.count_if(F.col("IsDeadStock") == 1)
    counts = [F.count_if(F.col("ABC") == c).alias(f"n_{c.lower()}") for c in ABC_CLASSES]
    share = F.coalesce(F.try_divide(dead.cast("double"), n.cast("double")) * 100.0, F.lit(0.0))
    return inventory.agg(
        n.alias("total_skus"),
        *counts,
        dead.alias("n_dead"),
        share.alias("dead_pct"),
        money_sum("Revenue").alias("total_revenue"),
        money_sum("EOQ").alias("total_eoq"),
    )


def abc_order_join(counts: DataFrame) -> DataFrame:
    """Counts for A, B and C in that order; an absent class stays null."""
    spark = counts.sparkSession
    classes = spark.createDataFrame([(c, i) for i, c in enumerate(ABC_CLASSES)], "ABC string, class_rank int")
    return classes.join(counts, "ABC", "left").orderBy("class_rank")


def abc_distribution(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("ABC").count()


def join_filtered_revenue(inventory: DataFrame, filtered: DataFrame | None) -> DataFrame:
    """Revenue under the current filter next to each product.

    Without a filter it is the product's own revenue. The key is the stock
    code alone, so several descriptions of one code carry the same amount.
    """
    if filtered is None:
        return inventory.withColumn("CountryRevenue", F.col("Revenue"))
    joined = inventory.join(sku_filtered_revenue(filtered), "StockCode", "left")
    return joined.withColumn("CountryRevenue", F.coalesce("CountryRevenue", F.lit(0.0)))


def reorder_list(
    inventory: DataFrame, top_n: int = 20, abc_filter: str = "A", dead_stock_only: bool = False
) -> DataFrame:
    check_inventory_args(top_n, abc_filter)
    if abc_filter != "ALL":
        inventory = inventory.where(F.col("ABC") == abc_filter)
    if dead_stock_only:
        inventory = inventory.where(F.col("IsDeadStock") == 1)
    return inventory.orderBy(*_sku_order()).limit(top_n)


def reorder_table(
    inventory: DataFrame,
    filtered: DataFrame | None = None,
    classes: Sequence[str] = ABC_CLASSES,
    dead_only: bool = False,
    end: date | None = None,
    sort_by: str = "EOQ",
) -> DataFrame:
    """Filtered reorder view; ``end`` keeps sales up to its first instant."""
    check_reorder_sort(sort_by)
    table = inventory.where(F.col("ABC").isin(*classes))
    if dead_only:
        table = table.where(F.col("IsDeadStock") == 1)
    if end is not None:
        table = table.where(F.col("LastSale") <= F.lit(end).cast("timestamp_ntz"))
    view = join_filtered_revenue(table, filtered).select(
        "StockCode",
        "Description",
        "ABC",
        "UnitsSold",
        "Revenue",
        "CountryRevenue",
        "AnnualDemand",
        "EOQ",
        "DaysSinceLastSale",
        "IsDeadStock",
    )
    return view.orderBy(F.desc(sort_by), "StockCode", "Description")


def top_reorder_candidates(inventory: DataFrame, n: int = 10) -> DataFrame:
    columns = ["StockCode", "Description", "ABC", "UnitsSold", "Revenue", "EOQ", "IsDeadStock"]
    return inventory.select(*columns).orderBy(*_sku_order()).limit(n)
