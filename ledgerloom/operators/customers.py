"""Customer features: recency, frequency, monetary value and behaviour."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.checks import require_columns
from ledgerloom.functions.dates import coerce_dates, floor_days, plus_days
from ledgerloom.functions.numbers import money_mean, money_sum
from ledgerloom.functions.retail import bucket, churn_label
from ledgerloom.schemas import CHURN_FEATURES, RFM_COLUMNS

RFM_INPUT = ("CustomerID", "InvoiceNo", "InvoiceDate", "TotalPrice")
BEHAVIOUR_INPUT = ("CustomerID", "InvoiceDate", "TotalPrice", "StockCode", "Country")


def recency_since(customers: DataFrame, snapshot: datetime | str | None) -> DataFrame:
    """Days from the last purchase to the snapshot.

    Without one it is the day after the last transaction, which is the largest
    last purchase: a maximum over customers, so lines are not read again.
    """
    if snapshot is not None:
        at = F.lit(snapshot).cast("timestamp_ntz")
        return customers.withColumn("Recency", floor_days(at, "LastPurchase"))
    at = customers.agg(plus_days(F.max("LastPurchase"), 1)).scalar()
    return customers.withColumn("Recency", floor_days(at, "LastPurchase"))


def _distinct(column: Column | str, approximate: float | None) -> Column:
    if approximate is None:
        return F.count_distinct(column)
    return F.approx_count_distinct(column, approximate)


def _rfm_aggregates(approximate: float | None = None) -> list[Column]:
    return [
        F.max("InvoiceDate").alias("LastPurchase"),
        F.min("InvoiceDate").alias("FirstPurchase"),
        _distinct("InvoiceNo", approximate).alias("Frequency"),
        F.greatest(money_sum("TotalPrice"), F.lit(0.0)).alias("Monetary"),
    ]


def rfm(
    transactions: DataFrame,
    snapshot: datetime | str | None = None,
    approximate: float | None = None,
) -> DataFrame:
    """One row per customer; unsorted, see ``sort_rfm``.

    ``approximate`` (a relative error) opts in to sketch-based distinct counts.
    """
    require_columns(transactions, RFM_INPUT, "transactions")
    dated = coerce_dates(transactions).where(F.col("CustomerID").isNotNull())
    grouped = dated.groupBy("CustomerID").agg(*_rfm_aggregates(approximate))
    named = grouped.withColumn("CustomerID", F.col("CustomerID").cast("bigint"))
    return recency_since(named, snapshot).select(*RFM_COLUMNS)


def sort_rfm(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("Monetary"), "CustomerID")


def rfm_means(table: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return table.agg(
        n.alias("n_customers"),
        F.try_divide(F.sum("Recency").cast("double"), n.cast("double")).alias("mean_recency"),
        F.try_divide(F.sum("Frequency").cast("double"), n.cast("double")).alias("mean_frequency"),
        money_mean("Monetary").alias("mean_monetary"),
    )


def distinct_customer_days(transactions: DataFrame) -> DataFrame:
    dated = coerce_dates(transactions)
    return dated.select("CustomerID", F.col("InvoiceDate").cast("date").alias("day")).distinct()


def _mean_gap(day: Column) -> Column:
    """Mean day gap between a group's distinct purchase days.

    The gaps of consecutive days add up to last minus first, so two extremes
    and a distinct count replace the sort per customer. Null for one day.
    """
    gaps = F.nullif(F.count_distinct(day) - 1, F.lit(0))
    return F.datediff(F.max(day), F.min(day)).cast("double") / gaps


def days_between_purchases(transactions: DataFrame) -> DataFrame:
    day = F.col("InvoiceDate").cast("date")
    dated = coerce_dates(transactions).where(F.col("CustomerID").isNotNull())
    return dated.groupBy("CustomerID").agg(_mean_gap(day).alias("avg_days_between"))


def home_country_flag(transactions: DataFrame, home_country: str = "United Kingdom") -> DataFrame:
    """1 for customers whose most frequent country (ties: smallest) is home.

    Lines are counted per customer and country first; the choice then runs
    over those counts.
    """
    known = transactions.where(F.col("CustomerID").isNotNull())
    counts = known.groupBy("CustomerID", "Country").agg(F.count("Country").alias("n"))
    ranked = F.when(F.col("Country").isNotNull(), F.struct(-F.col("n"), F.col("Country").alias("name")))
    main = F.coalesce(F.min(ranked).getField("name"), F.lit("Unknown"))
    chosen = counts.groupBy("CustomerID").agg(main.alias("main_country"))
    return chosen.withColumn("is_uk", F.when(F.col("main_country") == home_country, 1).otherwise(0))


def _behaviour_aggregates(basket: str) -> list[Column]:
    if basket == "line":
        size = money_mean("TotalPrice")
    elif basket == "invoice":
        size = money_sum("TotalPrice") / F.count_distinct("InvoiceNo")
    else:
        raise ValueError(f"basket must be 'line' or 'invoice', got {basket!r}")
    return [
        size.alias("avg_basket_size"),
        F.count_distinct("StockCode").alias("unique_products"),
        _mean_gap(F.col("InvoiceDate").cast("date")).alias("avg_days_between"),
    ]


def _with_home_flag(per_customer: DataFrame, dated: DataFrame, home_country: str) -> DataFrame:
    """Both sides are grouped by customer already, so the join moves no rows."""
    flags = home_country_flag(dated, home_country).drop("main_country")
    return per_customer.join(flags, "CustomerID", "left")


def customer_behaviour(
    transactions: DataFrame, home_country: str = "United Kingdom", basket: str = "line"
) -> DataFrame:
    """Basket size, product variety, purchase gap and home flag per customer."""
    require_columns(transactions, BEHAVIOUR_INPUT, "transactions")
    dated = coerce_dates(transactions).where(F.col("CustomerID").isNotNull())
    grouped = dated.groupBy("CustomerID").agg(*_behaviour_aggregates(basket))
    return _with_home_flag(grouped, dated, home_country)


def join_rfm_behaviour(rfm_table: DataFrame, behaviour: DataFrame) -> DataFrame:
    return rfm_table.join(behaviour, "CustomerID", "left")


def fill_churn_nulls(table: DataFrame) -> DataFrame:
    per_invoice = F.col("Monetary") / F.greatest(F.col("Frequency"), F.lit(1))
    return table.withColumns(
        {
            "avg_days_between": F.coalesce("avg_days_between", F.col("Recency").cast("double")),
            "avg_basket_size": F.coalesce("avg_basket_size", per_invoice),
            "unique_products": F.coalesce("unique_products", F.lit(0).cast("bigint")),
            "is_uk": F.coalesce("is_uk", F.lit(0)),
        }
    )


def fill_model_features(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return table.na.fill(0, columns or CHURN_FEATURES)


def churn_training_table(
    transactions: DataFrame,
    rfm_table: DataFrame | None = None,
    snapshot: datetime | str | None = None,
    inactivity_days: int = 90,
    home_country: str = "United Kingdom",
    basket: str = "line",
) -> DataFrame:
    """Features and label per customer.

    With a ready ``rfm_table`` the behaviour is joined to it; without one both
    come from a single aggregation over the transactions.
    """
    if rfm_table is not None:
        behaviour = customer_behaviour(transactions, home_country, basket)
        joined = join_rfm_behaviour(rfm_table, behaviour)
    else:
        require_columns(transactions, {*RFM_INPUT, *BEHAVIOUR_INPUT}, "transactions")
        dated = coerce_dates(transactions).where(F.col("CustomerID").isNotNull())
        grouped = dated.groupBy("CustomerID").agg(*_rfm_aggregates(), *_behaviour_aggregates(basket))
        joined = _with_home_flag(recency_since(grouped, snapshot), dated, home_country)
    return with_churn_label(joined, inactivity_days)


def with_churn_label(joined: DataFrame, inactivity_days: int = 90) -> DataFrame:
    """The churn table from customers with their behaviour: gaps filled, label added."""
    filled = fill_churn_nulls(joined)
    features = [c for c in CHURN_FEATURES if c not in RFM_COLUMNS]
    return filled.withColumn("churned", churn_label("Recency", inactivity_days)).select(
        *RFM_COLUMNS, *features, "churned"
    )


# Bucket edges and names of the customer cross table.
RECENCY_EDGES = [-1, 10, 30, 60, 120, 1000]
RECENCY_NAMES = ["<10", "10-30", "30-60", "60-120", "120+"]
FREQUENCY_EDGES = [0, 2, 5, 10, 20, 1000]
FREQUENCY_NAMES = ["1-2", "3-5", "6-10", "11-20", "20+"]
MONETARY_EDGES = [0, 300, 800, 1500, 3000, 1e6]
MONETARY_NAMES = ["<300", "300-800", "800-1500", "1500-3000", "3000+"]


def rfm_crosstab(table: DataFrame, open_end: bool = True) -> DataFrame:
    """Customers per recency and frequency bucket, split by monetary bucket.

    The margin row has ``All`` in both key columns. The last bucket of each
    measure has no upper end unless ``open_end`` is false. Customers outside
    the buckets of one of the measures have a row of their own, ``outside``.
    """
    def sort_in(name: str, edges: list[float], names: list[str]) -> Column:
        return bucket(name, [*edges[:-1], float("inf")] if open_end else edges, names)

    sorted_in = table.select(
        sort_in("Recency", RECENCY_EDGES, RECENCY_NAMES).alias("r"),
        sort_in("Frequency", FREQUENCY_EDGES, FREQUENCY_NAMES).alias("f"),
        sort_in("Monetary", MONETARY_EDGES, MONETARY_NAMES).alias("m"),
    )
    outside = F.col("r").isNull() | F.col("f").isNull() | F.col("m").isNull()
    placed = sorted_in.select(*[F.when(outside, F.lit("outside")).otherwise(F.col(c)).alias(c) for c in "rfm"])
    cells = [F.count_if(F.col("m") == name).alias(name) for name in MONETARY_NAMES]
    r, f = F.col("r"), F.col("f")
    grouped = placed.groupingSets([[r, f], []], r, f).agg(*cells, F.count(F.lit(1)).alias("All"))
    return grouped.select(
        F.coalesce("r", F.lit("All")).alias("recency_bucket"),
        F.coalesce("f", F.lit("All")).alias("frequency_bucket"),
        *MONETARY_NAMES,
        "All",
    )
