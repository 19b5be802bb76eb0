"""Cleaning rules for raw transaction lines.

Every rule is a column expression, so one projection labels each row with the
first rule it breaks and the whole step is a map-only scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.checks import require_columns
from ledgerloom.functions.dates import as_timestamp

CLEAN_INPUT = ("InvoiceNo", "CustomerID", "Quantity", "UnitPrice", "InvoiceDate")
RULES = ("cancelled", "null_customer", "nonpositive_quantity", "nonpositive_price", "bad_date")


def is_cancelled() -> Column:
    return F.coalesce(F.upper(F.col("InvoiceNo").cast("string")).startswith("C"), F.lit(False))


def is_null_customer() -> Column:
    return F.col("CustomerID").isNull() | F.isnan(F.col("CustomerID").cast("double"))


def is_nonpositive(name: str) -> Column:
    """A null value is not an offence here; the quality gate reports it."""
    return F.coalesce(F.col(name) <= 0, F.lit(False))


def drop_cancelled(df: DataFrame) -> DataFrame:
    return df.where(~is_cancelled())


def drop_null_customer(df: DataFrame) -> DataFrame:
    return df.where(F.col("CustomerID").isNotNull() & ~F.isnan(F.col("CustomerID").cast("double")))


def drop_nonpositive_quantity(df: DataFrame) -> DataFrame:
    return df.where(F.col("Quantity").isNull() | (F.col("Quantity") > 0))


def drop_nonpositive_price(df: DataFrame) -> DataFrame:
    return df.where(F.col("UnitPrice").isNull() | (F.col("UnitPrice") > 0))


def parse_invoice_date(df: DataFrame) -> DataFrame:
    return df.withColumn("InvoiceDate", as_timestamp(df)).where(F.col("InvoiceDate").isNotNull())


def add_total_price(df: DataFrame) -> DataFrame:
    return df.withColumn("TotalPrice", F.col("Quantity") * F.col("UnitPrice"))


def cast_customer_id(df: DataFrame) -> DataFrame:
    return df.withColumn("CustomerID", F.col("CustomerID").cast("bigint"))


def label_rows(df: DataFrame) -> DataFrame:
    """Add ``drop_reason``: the first rule a row breaks, null to keep it."""
    require_columns(df, CLEAN_INPUT, "raw data")
    reason = (
        F.when(is_cancelled(), "cancelled")
        .when(is_null_customer(), "null_customer")
        .when(is_nonpositive("Quantity"), "nonpositive_quantity")
        .when(is_nonpositive("UnitPrice"), "nonpositive_price")
        .when(F.col("InvoiceDate").isNull(), "bad_date")
    )
    return df.withColumn("InvoiceDate", as_timestamp(df)).withColumn("drop_reason", reason)


def clean(df: DataFrame) -> DataFrame:
    """Rows that break no rule, typed, with their total.

    The rules are separate filters, so those that the source understands
    (quantity, price, customer, date) reach its scan.
    """
    require_columns(df, CLEAN_INPUT, "raw data")
    kept = drop_nonpositive_price(drop_nonpositive_quantity(drop_null_customer(drop_cancelled(df))))
    return cast_customer_id(add_total_price(parse_invoice_date(kept)))


def clean_report(df: DataFrame) -> DataFrame:
    """One row: rows in, rows out and rows dropped per rule."""
    labelled = label_rows(df)
    counts = [F.count_if(F.col("drop_reason") == rule).alias(f"{rule}_dropped") for rule in RULES]
    return labelled.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("drop_reason").isNull()).alias("rows_out"),
        *counts,
    )


def quality_profile(df: DataFrame) -> DataFrame:
    """One row: share of raw lines with each defect."""
    require_columns(df, CLEAN_INPUT, "raw data")

    def share(condition: Column) -> Column:
        hits = F.count_if(condition).cast("double")
        return F.try_divide(hits, F.count(F.lit(1)).cast("double"))

    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        share(is_cancelled()).alias("cancelled_share"),
        share(is_null_customer()).alias("null_customer_share"),
        share(F.col("Quantity") < 0).alias("negative_quantity_share"),
        share(F.col("UnitPrice") <= 0).alias("nonpositive_price_share"),
    )
