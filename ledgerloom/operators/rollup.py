"""A roll-up of the cleaned lines, and features made from it without reading lines again.

One row for each customer, invoice, product, country and day. Sums are whole
ten-thousandths, so features made from the roll-up equal those made from lines
to the last bit. Each aggregate over it has one distinct count at most: two of
them in one aggregate would multiply the rows before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.checks import require_columns
from ledgerloom.functions.dates import coerce_dates
from ledgerloom.functions.numbers import from_units, money_units, nan_to_null
from ledgerloom.operators.customers import recency_since
from ledgerloom.operators.daily import daily_from_invoices
from ledgerloom.schemas import RFM_COLUMNS

ROLLUP_KEYS = ("CustomerID", "InvoiceNo", "StockCode", "Description", "Country", "day")
ROLLUP_INPUT = ("CustomerID", "InvoiceNo", "StockCode", "Description", "Country", "InvoiceDate", "Quantity", "UnitPrice", "TotalPrice")


def line_rollup(lines: DataFrame) -> DataFrame:
    """Sums and dates of the lines of each key; lines without a readable date are left out."""
    require_columns(lines, ROLLUP_INPUT, "transactions")
    dated = coerce_dates(lines).withColumn("day", F.col("InvoiceDate").cast("date"))
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return dated.groupBy(*ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("InvoiceDate").alias("first"),
        F.max("InvoiceDate").alias("last"),
        whole(F.col("Quantity").cast("bigint")).alias("items"),
        whole(money_units("TotalPrice")).alias("units"),
        F.count(nan_to_null("TotalPrice")).alias("priced"),
        F.count("Country").alias("located"),
        whole(money_units(F.col("Quantity") * F.col("UnitPrice"))).alias("sales"),
        whole(money_units("UnitPrice")).alias("prices"),
        F.count(nan_to_null("UnitPrice")).alias("with_price"),
    )


def rfm_of(rollup: DataFrame, snapshot: datetime | str | None = None) -> DataFrame:
    grouped = rollup.where("CustomerID is not null").groupBy("CustomerID").agg(
        F.max("last").alias("LastPurchase"),
        F.min("first").alias("FirstPurchase"),
        F.count_distinct("InvoiceNo").alias("Frequency"),
        F.greatest(from_units(F.sum("units")), F.lit(0.0)).alias("Monetary"),
    )
    return recency_since(grouped.withColumn("CustomerID", F.col("CustomerID").cast("bigint")), snapshot).select(*RFM_COLUMNS)


def main_countries(rollup: DataFrame) -> DataFrame:
    """(CustomerID, main_country): the country of most lines, the first by name of equals."""
    counts = rollup.where("CustomerID is not null").groupBy("CustomerID", "Country").agg(F.sum("located").alias("n"))
    ranked = F.when(F.col("Country").isNotNull(), F.struct(-F.col("n"), F.col("Country").alias("name")))
    return counts.groupBy("CustomerID").agg(F.coalesce(F.min(ranked).getField("name"), F.lit("Unknown")).alias("main_country"))


def behaviour_of(rollup: DataFrame, home_country: str = "United Kingdom") -> DataFrame:
    """Basket size, product variety, purchase gap and home flag per customer; see ``customers.customer_behaviour``."""
    known = rollup.where("CustomerID is not null").groupBy("CustomerID")
    baskets = known.agg((from_units(F.sum("units")) / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_basket_size"), F.count_distinct("StockCode").alias("unique_products"))
    gaps = F.nullif(F.count_distinct("day") - 1, F.lit(0))
    spans = known.agg((F.datediff(F.max("day"), F.min("day")).cast("double") / gaps).alias("avg_days_between"))
    flags = main_countries(rollup).withColumn("is_uk", F.when(F.col("main_country") == home_country, 1).otherwise(0)).drop("main_country")
    # All three are grouped by customer already, so the joins move no rows.
    return baskets.join(spans, "CustomerID").join(flags, "CustomerID")


def daily_of(rollup: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Daily totals, see ``daily.daily_revenue``; ``series`` are columns of the roll-up."""
    known = rollup.na.drop(subset=list(series)) if series else rollup
    invoices = known.groupBy(*series, F.col("day").alias("InvoiceDate"), "InvoiceNo", "CustomerID").agg(F.sum("units").alias("units"), F.sum("items").alias("items"))
    return daily_from_invoices(invoices, series)


def sku_sales_of(rollup: DataFrame) -> DataFrame:
    """Units, revenue, plain mean price and last sale per product; see ``inventory.sku_sales``."""
    mean: Column = from_units(F.sum("prices")) / F.nullif(F.sum("with_price"), F.lit(0))
    return rollup.na.drop(subset=["StockCode", "Description"]).groupBy("StockCode", "Description").agg(
        F.sum("items").alias("UnitsSold"), from_units(F.sum("sales")).alias("Revenue"), mean.alias("AvgUnitPrice"), F.max("last").alias("LastSale")
    )


# States that merge


def customer_states(rollup: DataFrame, precision: int = 12) -> DataFrame:
    """One row per customer for the days of this roll-up, of a fixed size: sums, dates and sketches of the distinct counts.

    A sketch has ``2 ** precision`` registers; its relative error is about
    ``1.04 / 2 ** (precision / 2)`` (1.6 percent), and it is exact for few values.
    """
    return rollup.where("CustomerID is not null").groupBy("CustomerID").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("units").alias("units"),
        F.sum("priced").alias("priced"),
        F.count_distinct("day").alias("days"),
        F.hll_sketch_agg("InvoiceNo", precision).alias("invoices"),
        F.hll_sketch_agg("StockCode", precision).alias("products"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """States of several sets of days, which must not overlap, as one per customer."""
    return states.groupBy("CustomerID").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("units").alias("units"),
        F.sum("priced").alias("priced"),
        F.sum("days").alias("days"),
        F.hll_union_agg("invoices").alias("invoices"),
        F.hll_union_agg("products").alias("products"),
    )


def rfm_of_states(states: DataFrame, snapshot: datetime | str | None = None) -> DataFrame:
    """RFM from merged states; the frequency is an estimate, everything else exact."""
    named = states.select(
        F.col("CustomerID").cast("bigint").alias("CustomerID"),
        F.col("last").alias("LastPurchase"),
        F.col("first").alias("FirstPurchase"),
        F.hll_sketch_estimate("invoices").alias("Frequency"),
        F.greatest(from_units("units"), F.lit(0.0)).alias("Monetary"),
    )
    return recency_since(named, snapshot).select(*RFM_COLUMNS)


def behaviour_of_states(states: DataFrame) -> DataFrame:
    """Basket size, product variety (an estimate) and purchase gap from merged states."""
    gap = F.datediff(F.col("last").cast("date"), F.col("first").cast("date")).cast("double") / F.nullif(F.col("days") - 1, F.lit(0))
    return states.select(
        "CustomerID", (from_units("units") / F.nullif("priced", F.lit(0))).alias("avg_basket_size"), F.hll_sketch_estimate("products").alias("unique_products"), gap.alias("avg_days_between")
    )
