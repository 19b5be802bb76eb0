"""Declared table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

RAW_COLUMNS = RAW.fieldNames()

RFM_COLUMNS = ["CustomerID", "Recency", "Frequency", "Monetary", "FirstPurchase", "LastPurchase"]

INVENTORY = T.StructType(
    [
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("UnitsSold", T.LongType()),
        T.StructField("Revenue", T.DoubleType()),
        T.StructField("AvgUnitPrice", T.DoubleType()),
        T.StructField("LastSale", T.TimestampNTZType()),
        T.StructField("ABC", T.StringType()),
        T.StructField("AnnualDemand", T.DoubleType()),
        T.StructField("EOQ", T.DoubleType()),
        T.StructField("DaysSinceLastSale", T.IntegerType()),
        T.StructField("IsDeadStock", T.IntegerType()),
        T.StructField("OrderingCost", T.DoubleType()),
        T.StructField("HoldingPct", T.DoubleType()),
    ]
)

CHURN_FEATURES = [
    "Recency",
    "Frequency",
    "Monetary",
    "avg_basket_size",
    "unique_products",
    "avg_days_between",
    "is_uk",
]

SEGMENT_FEATURES = ["Recency", "Frequency", "Monetary"]

RUNS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("logged_at", T.TimestampNTZType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)
