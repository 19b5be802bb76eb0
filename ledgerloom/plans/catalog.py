"""Named queries over the order tables, one per operator.

Each entry takes (spark, folder) and returns a DataFrame. Ratios of floating
point sums are rounded, because their last bits depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions import dates, holidays, numbers, retail, text
from ledgerloom.operators import (
    churn,
    cleaning,
    customers,
    daily,
    drift,
    evaluation,
    filters,
    forecast,
    inventory,
    prefix,
    quality,
    reports,
    rollup,
    runs,
    segments,
)
from ledgerloom.params import Params
from ledgerloom.plans import stages
from ledgerloom.plans.stages import Layout
from ledgerloom.schemas import RAW_COLUMNS, RFM_COLUMNS, SEGMENT_FEATURES
from ledgerloom.session import cut_lineage, scratch_path
from ledgerloom.sources import raw as raw_files
from ledgerloom.sources import stages as stage_files
from ledgerloom.sources.star import event_purchases, star_transactions, table

HOME = "NATION_9"
SNAPSHOT = "2001-09-01 11:30:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: numbers.half_even(c, digits) for c in columns})


def tx(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return star_transactions(spark, folder, list(columns) or None)


def cleaned(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Cleaned transactions with the rule columns and the named ones."""
    wanted = [c for c in RAW_COLUMNS if c in (*cleaning.CLEAN_INPUT, *columns)] if columns else RAW_COLUMNS
    return cleaning.clean(star_transactions(spark, folder, wanted))


def rfm_table(spark: SparkSession, folder: str) -> DataFrame:
    return customers.rfm(cleaned(spark, folder, "TotalPrice"))


def daily_table(spark: SparkSession, folder: str) -> DataFrame:
    return daily.daily_revenue(cleaned(spark, folder, "TotalPrice"))


def inventory_of(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.eoq_table(cleaned(spark, folder, "StockCode", "Description"))


def churn_table(spark: SparkSession, folder: str) -> DataFrame:
    lines = cleaned(spark, folder, "StockCode", "Country")
    return customers.churn_training_table(lines, home_country=HOME)


def numbered_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a cluster number that follows from their id."""
    return rfm_table(spark, folder).withColumn("cluster", (F.col("CustomerID") % 5).cast("int"))


def named_clusters(spark: SparkSession, folder: str) -> DataFrame:
    labelled = numbered_clusters(spark, folder)
    return segments.label_personas(labelled, segments.assign_personas(segments.cluster_centroids(labelled)))


def rule_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Churn labels with a score that follows from the customer id."""
    table_ = rfm_table(spark, folder).withColumn("churned", retail.churn_label("Recency"))
    score = ((F.col("CustomerID") * 37 + 11) % 101).cast("double") / 100.0
    return table_.select("CustomerID", "churned", score.alias("churn_probability"))


def naive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Holdout days forecast by the value one week earlier."""
    frame = forecast.prepare_series(daily_table(spark, folder))
    weekly = F.lag("y", 7).over(Window.partitionBy("series_key").orderBy("ds"))
    return forecast.holdout_tail(frame.withColumn("yhat", weekly)).where("is_test").select("series_key", "ds", "y", "yhat")


def text_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines whose dates are text in two layouts or unreadable."""
    lines = tx(spark, folder, "InvoiceNo", "StockCode", "Quantity", "InvoiceDate")
    kind = F.col("StockCode").cast("int") % 7
    shown = (
        F.when(kind == 0, "not a date")
        .when(kind == 1, F.date_format("InvoiceDate", "M/d/yyyy H:mm"))
        .otherwise(F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    )
    return lines.withColumn("InvoiceDate", shown)


def raw_text(spark: SparkSession, folder: str) -> DataFrame:
    return tx(spark, folder).withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**stage_files.STANDARD_CSV).option("encoding", "ISO-8859-1").csv(path)


# Sources and sinks


@query
def read_transactions_csv(spark, folder):
    path = scratch_path(spark, "csv")
    _write_csv(raw_text(spark, folder), path)
    return raw_files.read_transactions_csv(spark, path)


@query
def load_raw(spark, folder):
    base = scratch_path(spark, "raw")
    _write_csv(raw_text(spark, folder).limit(0), f"{base}/a_first_by_name.csv")
    _write_csv(raw_text(spark, folder), f"{base}/online_retail.csv")
    return raw_files.load_raw(spark, base)


@query
def read_stage(spark, folder):
    path = scratch_path(spark, "stage")
    stage_files.write_stage(cleaned(spark, folder), path, by_month=True)
    return stage_files.read_stage(spark, path).drop("year", "month")


@query
def write_stage(spark, folder):
    path = scratch_path(spark, "stage")
    stage_files.write_stage(cleaned(spark, folder), path, by_month=True)
    return stage_files.read_stage(spark, path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@query
def write_json_report(spark, folder):
    path = scratch_path(spark, "report")
    report = cleaning.clean_report(tx(spark, folder, *cleaning.CLEAN_INPUT))
    stage_files.write_json_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query
def read_inventory_csv(spark, folder):
    path = scratch_path(spark, "inventory")
    stage_files.write_inventory_csv(inventory_of(spark, folder), path)
    return stage_files.read_inventory_csv(spark, path)


@query
def write_inventory_csv(spark, folder):
    path = scratch_path(spark, "inventory")
    stage_files.write_inventory_csv(inventory_of(spark, folder), path)
    back = stage_files.read_inventory_csv(spark, path)
    return back.groupBy("ABC").agg(F.count(F.lit(1)).alias("skus"), numbers.money_sum("Revenue").alias("Revenue"))


@query
def table_domain(spark, folder):
    return filters.table_domain(cleaned(spark, folder, "Country"))


@query
def union_sources(spark, folder):
    lines = tx(spark, folder, "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "InvoiceDate")
    years = [lines.where(F.year("InvoiceDate") <= 1997), lines.where(F.year("InvoiceDate") > 1997)]
    return raw_files.union_sources(years)


# Cleaning and quality


@query
def drop_cancelled(spark, folder):
    return cleaning.drop_cancelled(tx(spark, folder, "InvoiceNo", "StockCode", "Quantity"))


@query
def drop_null_customer(spark, folder):
    return cleaning.drop_null_customer(tx(spark, folder, "InvoiceNo", "StockCode", "CustomerID"))


@query
def drop_nonpositive_quantity(spark, folder):
    return cleaning.drop_nonpositive_quantity(tx(spark, folder, "InvoiceNo", "StockCode", "Quantity"))


@query
def drop_nonpositive_price(spark, folder):
    return cleaning.drop_nonpositive_price(tx(spark, folder, "InvoiceNo", "StockCode", "UnitPrice"))


@query
def parse_invoice_date(spark, folder):
    return cleaning.parse_invoice_date(text_dates(spark, folder))


@query
def coerce_dates(spark, folder):
    return dates.coerce_dates(text_dates(spark, folder)).groupBy(
        F.col("InvoiceDate").cast("date").alias("day")
    ).agg(F.count(F.lit(1)).alias("lines"))


@query
def add_total_price(spark, folder):
    return cleaning.add_total_price(tx(spark, folder, "InvoiceNo", "StockCode", "Quantity", "UnitPrice"))


@query
def cast_customer_id(spark, folder):
    lines = cleaning.drop_null_customer(tx(spark, folder, "InvoiceNo", "StockCode", "CustomerID"))
    return cleaning.cast_customer_id(lines)


@query
def clean(spark, folder):
    return cleaned(spark, folder)


@query
def clean_report(spark, folder):
    return cleaning.clean_report(tx(spark, folder, *cleaning.CLEAN_INPUT))


@query
def quality_profile(spark, folder):
    return cleaning.quality_profile(tx(spark, folder, *cleaning.CLEAN_INPUT))


@query
def validate_expectations(spark, folder):
    """On uncleaned lines, so that some expectations fail."""
    return quality.validate_expectations(cleaning.add_total_price(tx(spark, folder, *cleaning.CLEAN_INPUT, "StockCode")))


@query
def gate_and_write(spark, folder):
    path = scratch_path(spark, "gated")
    quality.gate_and_write(cleaned(spark, folder), path)
    return stage_files.read_stage(spark, path).groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), numbers.money_sum("TotalPrice").alias("revenue")
    )


@query
def filter_country_dates(spark, folder):
    lines = cleaned(spark, folder, "Country", "StockCode")
    return filters.filter_country_dates(lines, [HOME, "NATION_3"], date(1998, 3, 1), date(1999, 3, 31))


@query
def drift_projection(spark, folder):
    return drift.drift_projection(cleaned(spark, folder, "Country"))


# Customers


@query
def rfm(spark, folder):
    return rfm_table(spark, folder)


@query
def rfm_at_snapshot(spark, folder):
    return customers.rfm(cleaned(spark, folder, "TotalPrice"), SNAPSHOT)


@query
def rfm_events(spark, folder):
    return customers.rfm(event_purchases(spark, folder))


@query
def sort_rfm(spark, folder):
    return customers.sort_rfm(rfm_table(spark, folder))


@query
def align_by_key(spark, folder):
    """Recency, value and behaviour of a customer from one aggregation."""
    return churn_table(spark, folder).select(
        *RFM_COLUMNS, "unique_products", numbers.half_even("avg_basket_size", 6).alias("avg_basket_size")
    )


@query
def rfm_means(spark, folder):
    return customers.rfm_means(rfm_table(spark, folder))


@query
def rfm_crosstab(spark, folder):
    return customers.rfm_crosstab(rfm_table(spark, folder))


@query
def distinct_customer_days(spark, folder):
    return customers.distinct_customer_days(cleaned(spark, folder, "TotalPrice"))


@query
def days_between_purchases(spark, folder):
    return customers.days_between_purchases(cleaned(spark, folder, "TotalPrice"))


@query
def customer_behaviour(spark, folder):
    return customers.customer_behaviour(cleaned(spark, folder, "StockCode", "Country"), HOME)


@query
def home_country_flag(spark, folder):
    return customers.home_country_flag(cleaned(spark, folder, "Country"), HOME)


@query
def join_rfm_behaviour(spark, folder):
    lines = cleaned(spark, folder, "StockCode", "Country")
    return customers.join_rfm_behaviour(customers.rfm(lines), customers.customer_behaviour(lines, HOME))


def _with_early_behaviour(spark: SparkSession, folder: str) -> DataFrame:
    """All customers with their behaviour up to 1996, missing for later ones."""
    lines = cleaned(spark, folder, "StockCode", "Country")
    early = filters.filter_country_dates(lines, end=date(1996, 12, 31))
    return customers.join_rfm_behaviour(customers.rfm(lines), customers.customer_behaviour(early, HOME))


@query
def join_stored_features(spark, folder):
    """RFM and behaviour stored by customer, joined where they lie."""
    lines = cut_lineage(rollup.line_rollup(cleaned(spark, folder)))
    paths = scratch_path(spark, "rfm"), scratch_path(spark, "behaviour")
    for made, path in zip((rollup.rfm_of(lines), rollup.behaviour_of(lines, HOME)), paths):
        stage_files.write_bucketed(made, path, ["CustomerID"], 8)
    return customers.join_rfm_behaviour(*[stage_files.read_bucketed(spark, path) for path in paths])


@query
def line_rollup(spark, folder):
    """Sums of the roll-up by country and month."""
    lines = rollup.line_rollup(cleaned(spark, folder))
    month = F.trunc("day", "MM").alias("month")
    return lines.groupBy("Country", month).agg(F.sum("lines").alias("lines"), F.sum("items").alias("items"), numbers.from_units(F.sum("units")).alias("revenue"), F.min("first").alias("first"), F.max("last").alias("last"))


@query
def rfm_of_rollup(spark, folder):
    return rollup.rfm_of(cut_lineage(rollup.line_rollup(cleaned(spark, folder))))


@query
def behaviour_of_rollup(spark, folder):
    return rollup.behaviour_of(cut_lineage(rollup.line_rollup(cleaned(spark, folder))), HOME)


@query
def daily_of_rollup(spark, folder):
    return rollup.daily_of(cut_lineage(rollup.line_rollup(cleaned(spark, folder))), ["Country"])


@query
def sku_sales_of_rollup(spark, folder):
    return rollup.sku_sales_of(cut_lineage(rollup.line_rollup(cleaned(spark, folder))))


@query
def merged_states(spark, folder):
    """States of the days before and after a date, merged; estimated counts against the exact ones."""
    lines = cut_lineage(rollup.line_rollup(cleaned(spark, folder)))
    parts = [rollup.customer_states(lines.where(f"day {op} date '2000-01-01'")) for op in ("<", ">=")]
    states = cut_lineage(rollup.merge_states(parts[0].unionByName(parts[1])))
    known = rollup.rfm_of_states(states).join(rollup.behaviour_of_states(states), "CustomerID")
    exact = rollup.rfm_of(lines).join(rollup.behaviour_of(lines), "CustomerID").select("CustomerID", F.col("Frequency").alias("f"), F.col("unique_products").alias("p"))
    near = [F.abs(F.col(a) - F.col(b)) <= 0.05 * F.col(b) for a, b in (("Frequency", "f"), ("unique_products", "p"))]
    both = known.join(exact, "CustomerID").withColumn("counts_near", near[0] & near[1])
    return both.select("CustomerID", "Recency", "Monetary", "FirstPurchase", "LastPurchase", "avg_basket_size", "avg_days_between", "counts_near")


@query
def amounts_off_units(spark, folder):
    """Event values that are finer than a ten-thousandth."""
    values = table(spark, folder, "events").select("event_type", "value")
    return values.groupBy("event_type").agg(F.count("value").alias("amounts"), F.count_if(numbers.off_units("value")).alias("off"))


@query
def fill_churn_nulls(spark, folder):
    return customers.fill_churn_nulls(_with_early_behaviour(spark, folder))


@query
def fill_model_features(spark, folder):
    return customers.fill_model_features(_with_early_behaviour(spark, folder))


@query
def churn_training_table(spark, folder):
    lines = cleaned(spark, folder, "StockCode", "Country")
    return customers.churn_training_table(lines, customers.rfm(lines), home_country=HOME)


@query
def churn_training_table_single_pass(spark, folder):
    return churn_table(spark, folder)


@query
def churn_label(spark, folder):
    return rfm_table(spark, folder).select("CustomerID", retail.churn_label("Recency", 120).alias("churned"))


# Daily series


@query
def daily_revenue(spark, folder):
    return daily_table(spark, folder)


@query
def daily_revenue_by_country(spark, folder):
    return daily.daily_revenue(cleaned(spark, folder, "Country"), series=["Country"])


@query
def calendar_spine(spark, folder):
    """Per country, where many days have no sale."""
    sparse = daily.daily_revenue(cleaned(spark, folder, "Country"), fill_missing_days=False, series=["Country"])
    return daily.calendar_spine(sparse, ["Country"])


@query
def daily_resample(spark, folder):
    return daily.daily_resample(cleaned(spark, folder, "TotalPrice"))


@query
def monthly_revenue(spark, folder):
    return daily.monthly_revenue(cleaned(spark, folder, "TotalPrice"))


@query
def calendar_features(spark, folder):
    return daily.calendar_features(daily_table(spark, folder).select("InvoiceDate", "Revenue"))


@query
def lag_features(spark, folder):
    return daily.lag_features(daily_table(spark, folder).select("InvoiceDate", "Revenue"))


@query
def rolling_features(spark, folder):
    rolled = daily.rolling_features(daily_table(spark, folder).select("InvoiceDate", "Revenue"))
    return rounded(rolled, 3, *[c for c in rolled.columns if c.startswith("rolling_")])


@query
def timeseries_features(spark, folder):
    full = daily.timeseries_features(daily_table(spark, folder))
    return rounded(full, 3, *[c for c in full.columns if c.startswith("rolling_")])


@query
def rolling_band(spark, folder):
    banded = daily.rolling_band(daily_table(spark, folder).select("InvoiceDate", "Revenue"))
    return rounded(banded, 3, "band_mean", "band_low", "band_high")


@query
def daily_stability(spark, folder):
    return rounded(daily.daily_stability(daily_table(spark, folder)), 6, "variation", "autocorr_7")


@query
def last_value(spark, folder):
    return daily.last_value(daily_table(spark, folder))


@query
def history_tail(spark, folder):
    return daily.history_tail(daily_table(spark, folder))


# Reports


@query
def kpi_summary(spark, folder):
    return reports.kpi_summary(cleaned(spark, folder, "TotalPrice"))


@query
def revenue_by_country(spark, folder):
    return reports.revenue_by_country(cleaned(spark, folder, "Country"))


@query
def share_of_total(spark, folder):
    return reports.share_of_total(daily.monthly_revenue(cleaned(spark, folder, "TotalPrice")), "Revenue")


@query
def top_products(spark, folder):
    return reports.top_products(cleaned(spark, folder, "StockCode", "Description"))


@query
def country_rows_topn(spark, folder):
    return reports.country_rows_topn(cleaned(spark, folder, "Country"))


@query
def country_revenue_topn(spark, folder):
    return reports.country_revenue_topn(cleaned(spark, folder, "Country"))


@query
def describe(spark, folder):
    return rounded(
        reports.describe(rfm_table(spark, folder), ["Recency", "Frequency", "Monetary"]), 4, "mean", "std", "p25", "p50", "p75"
    )


@query
def trimmed_histogram(spark, folder):
    return rounded(reports.trimmed_histogram(cleaned(spark, folder, "TotalPrice"), "TotalPrice"), 4, "bin_low", "bin_high")


@query
def exact_quantiles(spark, folder):
    lines = cleaned(spark, folder, "TotalPrice")
    found = prefix.exact_quantiles(lines, ["UnitPrice", "Quantity", "TotalPrice"], [0.01, 0.5, 0.9, 0.99])
    return rounded(found, 4, "value")


@query
def format_currency(spark, folder):
    orders = table(spark, folder, "orders")
    amount = F.floor(F.col("o_totalprice") * F.pow(F.lit(10.0), (F.col("o_orderkey") % 4).cast("double") - 2))
    signed = F.when(F.col("o_orderkey") % 5 == 0, -amount).otherwise(amount).cast("double")
    shown = orders.select("o_orderkey", signed.alias("amount"))
    return shown.withColumn("shown", text.format_currency("amount"))


@query
def format_int(spark, folder):
    orders = table(spark, folder, "orders")
    signed = F.when(F.col("o_orderkey") % 5 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return orders.select("o_orderkey", text.format_int(signed * 10).alias("shown"))


@query
def floor_days(spark, folder):
    lines = cleaned(spark, folder, "TotalPrice")
    return lines.select(
        "InvoiceNo", "InvoiceDate", dates.floor_days(F.lit(SNAPSHOT).cast("timestamp_ntz"), "InvoiceDate").alias("days"),
        dates.floor_days("InvoiceDate", F.lit(SNAPSHOT).cast("timestamp_ntz")).alias("days_back"),
    ).distinct()


# Inventory


@query
def sku_sales(spark, folder):
    return inventory.sku_sales(cleaned(spark, folder, "StockCode", "Description"))


@query
def span_years(spark, folder):
    return inventory.span_years(cleaned(spark, folder, "TotalPrice"))


@query
def cumulative_share(spark, folder):
    skus = inventory.sku_sales(cleaned(spark, folder, "StockCode", "Description"))
    return inventory.cumulative_share(skus).select("StockCode", "Description", "Revenue", "cum_share", "sku_rank")


@query
def abc_classify(spark, folder):
    skus = inventory.sku_sales(cleaned(spark, folder, "StockCode", "Description"))
    return inventory.abc_classify(skus).select("StockCode", "Description", "ABC")


@query
def eoq(spark, folder):
    parts = table(spark, folder, "part")
    demand = (F.col("p_size") - 5).cast("double") * 100.0
    return parts.select("p_partkey", numbers.half_even(retail.eoq(demand, "p_retailprice"), 6).alias("eoq"))


@query
def annual_demand(spark, folder):
    skus = inventory.sku_sales(cleaned(spark, folder, "StockCode", "Description"))
    return skus.select("StockCode", "Description", retail.annual_demand("UnitsSold", F.lit(2.5)).alias("AnnualDemand"))


@query
def dead_stock_flag(spark, folder):
    skus = inventory.sku_sales(cleaned(spark, folder, "StockCode", "Description"))
    age = dates.floor_days(F.lit(SNAPSHOT).cast("timestamp_ntz"), "LastSale")
    return skus.select("StockCode", "Description", retail.dead_stock_flag(age, 60).alias("IsDeadStock"))


@query
def eoq_table(spark, folder):
    return inventory_of(spark, folder)


@query
def inventory_metrics(spark, folder):
    return inventory.inventory_metrics(inventory_of(spark, folder), cleaned(spark, folder, "TotalPrice"))


@query
def inventory_headline(spark, folder):
    return inventory.inventory_headline(inventory_of(spark, folder))


@query
def abc_distribution(spark, folder):
    return inventory.abc_distribution(inventory_of(spark, folder))


@query
def abc_order_join(spark, folder):
    some = inventory_of(spark, folder).where("ABC <> 'B'")
    return inventory.abc_order_join(inventory.abc_distribution(some))


@query
def sku_filtered_revenue(spark, folder):
    lines = cleaned(spark, folder, "StockCode", "Country")
    return reports.sku_filtered_revenue(filters.filter_country_dates(lines, [HOME]))


@query
def join_filtered_revenue(spark, folder):
    lines = cleaned(spark, folder, "StockCode", "Country")
    filtered = filters.filter_country_dates(lines, ["NATION_4"])
    return inventory.join_filtered_revenue(inventory_of(spark, folder), filtered).select(
        "StockCode", "Description", "Revenue", "CountryRevenue"
    )


@query
def reorder_list(spark, folder):
    return inventory.reorder_list(inventory_of(spark, folder), 25, "B", dead_stock_only=True)


@query
def reorder_table(spark, folder):
    lines = cleaned(spark, folder, "StockCode", "Country")
    filtered = filters.filter_country_dates(lines, [HOME], end=date(2001, 6, 30))
    return inventory.reorder_table(inventory_of(spark, folder), filtered, ["A", "C"], end=date(2001, 6, 30))


@query
def top_reorder_candidates(spark, folder):
    return inventory.top_reorder_candidates(inventory_of(spark, folder))


# Drift


def _split(spark, folder):
    return drift.chronological_split(cleaned(spark, folder))


@query
def chronological_split(spark, folder):
    return _split(spark, folder).select("side", "InvoiceNo", "StockCode", "Quantity", "InvoiceDate")


@query
def drift_scores(spark, folder):
    return rounded(drift.drift_scores(drift.drift_projection(_split(spark, folder))), 6, "score")


@query
def drift_p_values(spark, folder):
    projected = drift.drift_projection(_split(spark, folder))
    return rounded(drift.drift_scores(projected, tests="p_value"), 6, "score")


@query
def split_sides(spark, folder):
    """Sides of the split from the cut alone."""
    return drift.cut_sides(spark, drift.split_cut(cleaned(spark, folder)))


@query
def drift_summary(spark, folder):
    lines = cleaned(spark, folder)
    cut = drift.split_cut(lines)
    return drift.drift_summary(drift.drift_scores(drift.drift_projection(cut.split(lines))), drift.cut_sides(spark, cut))


@query
def drift_display_score(spark, folder):
    """Distances of some columns beside p-values of others, with the rows and dates of both sides."""
    lines = cleaned(spark, folder)
    cut = drift.split_cut(lines)
    split = cut_lineage(drift.drift_projection(cut.split(lines)))
    distances = drift.drift_scores(split, ("UnitPrice", "TotalPrice"), ("DayOfWeek",))
    tested = drift.drift_scores(split, ("Quantity", "Hour"), ("Country",), tests="p_value")
    shown = rounded(drift.drift_display_score(distances.unionByName(tested)), 6, "score", "display_score")
    sides = drift.drift_summary(shown, drift.cut_sides(spark, cut))
    return shown.join(sides.select("n_reference", "n_current", "reference_start", "reference_end", "current_start", "current_end"), how="cross")


@query
def sketch_drift_scores(spark, folder):
    """Scores from one sketch a day against the exact ones of the same sides."""
    lines = cut_lineage(drift.drift_projection(cleaned(spark, folder)))
    newest = F.lit(date(2000, 1, 1))
    sketched = drift.sketch_drift_scores(drift.drift_sketches(lines), newest)
    sided = lines.withColumn("side", F.when(F.col("InvoiceDate").cast("date") < newest, "reference").otherwise("current"))
    exact = drift.drift_scores(sided, categorical=())
    both = sketched.withColumnRenamed("score", "sketched").join(exact.select("column", "score"), "column")
    return both.select("column", numbers.half_even("score", 6).alias("score"), (F.abs(F.col("sketched") - F.col("score")) <= F.col("error")).alias("within_error"))


@query
def drift_scores_events(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    split = drift.chronological_split(events, 0.6, "ts", ("event_id",))
    shown = split.withColumns({"hour": F.hour("ts"), "weekday": F.weekday("ts")})
    return rounded(drift.drift_scores(shown, ["value", "hour"], ["event_type", "weekday"]), 6, "score")


# Churn model


@query
def stratified_split(spark, folder):
    split = churn.stratified_split(churn_table(spark, folder))
    return split.groupBy("churned", "is_test").agg(F.count(F.lit(1)).alias("customers"))


def _churn_model(spark: SparkSession, folder: str):
    """Split table and fitted model."""
    split = churn.stratified_split(churn_table(spark, folder))
    return split, churn.fit_churn(split.where(~F.col("is_test")))


def _what_holds(compared: DataFrame) -> DataFrame:
    """Sizes of both sides and the churn rate, and whether every metric is a share."""
    shares = [F.col(c).between(0.0, 1.0) for c in ("auc_roc", "accuracy", "precision", "recall", "f1")]
    better = F.col("auc_roc") > 0.5
    return compared.select("model", "n_train", "n_test", numbers.half_even("churn_rate", 9).alias("churn_rate"), (shares[0] & shares[1] & shares[2] & shares[3] & shares[4]).alias("in_range"), better.alias("beats_chance"))


@query
def fit_churn(spark, folder):
    split, model = _churn_model(spark, folder)
    return _what_holds(churn.evaluate_churn(model, split))


@query
def score_churn(spark, folder):
    """Every customer has a probability, and is predicted to churn from one half on."""
    split, model = _churn_model(spark, folder)
    p = F.col("churn_probability")
    return churn.score_churn(model, split).select("CustomerID", "churned", p.between(0.0, 1.0).alias("in_range"), (F.col("predicted_churn") == (p >= 0.5)).alias("follows_cutoff"))


@query
def save_and_load_model(spark, folder):
    """Scores of the loaded model against those of the fitted one."""
    split, model = _churn_model(spark, folder)
    path = scratch_path(spark, "model")
    stage_files.save_model(model, path)
    kept, loaded = (churn.score_churn(m, split).select("CustomerID", F.col("churn_probability").alias(name)) for m, name in ((model, "kept"), (stage_files.load_model(path), "loaded")))
    return kept.join(loaded, "CustomerID").agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("kept") != F.col("loaded")).alias("differing"))


@query
def feature_importance(spark, folder):
    _, model = _churn_model(spark, folder)
    total = F.sum("importance").over(Window.partitionBy())
    return churn.feature_importance(model, spark).select("feature", F.col("importance").between(0.0, 1.0).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("adds_up"))


@query
def importance_sort(spark, folder):
    """Ranks of the sorted rows; the label follows from recency, so that feature leads."""
    _, model = _churn_model(spark, folder)
    ordered = churn.importance_sort(churn.feature_importance(model, spark))
    before = F.lag("importance").over(Window.orderBy("place"))
    placed = ordered.withColumn("place", F.monotonically_increasing_id())
    return placed.select("feature", F.coalesce(before >= F.col("importance"), F.col("feature") == "Recency").alias("in_order"))


@query
def compare_challenger(spark, folder):
    split, model = _churn_model(spark, folder)
    other = churn.fit_challenger(split.where(~F.col("is_test")))
    return _what_holds(churn.compare_challenger({"gbt": model, "forest": other}, split))


@query
def binary_metrics(spark, folder):
    scored = evaluation.binary_metrics(rule_scores(spark, folder))
    return rounded(scored, 9, "auc_roc", "accuracy", "precision", "recall", "f1")


@query
def roc_curve(spark, folder):
    return rounded(evaluation.roc_curve(rule_scores(spark, folder)), 9, "fpr", "tpr")


@query
def check_scoring_rows(spark, folder):
    """Scoring requests made from the customers, some with broken limits."""
    kind = F.col("CustomerID") % 9
    batch = churn_table(spark, folder).select(
        "CustomerID",
        F.when(kind == 1, -1.0).otherwise(F.col("Recency").cast("double")).alias("recency"),
        F.when(kind == 2, F.lit(-3)).otherwise(F.col("Frequency")).alias("frequency"),
        F.when(kind == 3, F.lit(None)).otherwise(F.col("Monetary")).alias("monetary"),
        F.when(kind == 4, F.lit(2)).when(kind == 5, F.lit(None)).otherwise(F.col("is_uk")).alias("is_uk"),
    )
    return churn.check_scoring_rows(batch)


# Segments


def _segmenter(spark: SparkSession, folder: str):
    return segments.fit_segmenter(rfm_table(spark, folder))


@query
def fit_segmenter(spark, folder):
    """What holds for any fit: every customer is in a cluster, and a settled centre is the mean of its members."""
    table_ = rfm_table(spark, folder)
    found = segments.fit_segmenter(table_)
    means = segments.cluster_centroids(segments.score_segments(found.model, table_)).withColumnsRenamed({c: f"mean_{c}" for c in SEGMENT_FEATURES})
    near = [F.abs(F.col(f"mean_{c}") - F.col(c)) <= 1e-4 * (1 + F.abs(F.col(c))) for c in SEGMENT_FEATURES]
    off = F.count_if(~(near[0] & near[1] & near[2]) | F.col("mean_Recency").isNull())
    judged = found.model.where("size > 0").join(means, "cluster", "left").agg(F.sum("size").alias("n_in_clusters"), off.alias("off_centre"))
    return judged.withColumn("settled", F.lit(found.converged)).join(table_.agg(F.count(F.lit(1)).alias("n_customers")))


@query
def select_k(spark, folder):
    tried = segments.select_k(spark, _segmenter(spark, folder))
    scored = F.col("silhouette").between(-1, 1) & (F.col("error") <= 0.01)
    first = F.max_by("k", F.struct("silhouette", -F.col("k"))).over(Window.partitionBy())
    return tried.select("k", scored.alias("scored"), (F.col("chosen") == (F.col("k") == first)).alias("best_is_chosen"))


@query
def score_segments(spark, folder):
    """Each customer's cluster against the centres, row by row."""
    model = _segmenter(spark, folder).model
    scored = segments.score_segments(model, rfm_table(spark, folder))
    # At most k_max rows.
    centres = F.broadcast(model.select(F.col("cluster").alias("other"), F.arrays_zip("centre", "mean", "spread").alias("axes")))
    point = F.array(*[F.col(c).cast("double") for c in SEGMENT_FEATURES])
    gaps = F.zip_with(point, "axes", lambda x, a: F.pow((x - a["mean"]) / a["spread"] - a["centre"], 2))
    apart = scored.join(centres, how="cross").withColumn("gap", F.aggregate(gaps, F.lit(0.0), lambda t, g: t + g))
    own = F.min(F.when(F.col("other") == F.col("cluster"), F.col("gap")))
    return apart.groupBy("CustomerID").agg((own <= F.min("gap") + 1e-9).alias("nearest"), F.count_distinct("persona").alias("personas"))


@query
def cluster_centroids(spark, folder):
    return segments.cluster_centroids(numbered_clusters(spark, folder))


@query
def assign_personas(spark, folder):
    return segments.assign_personas(segments.cluster_centroids(numbered_clusters(spark, folder)))


@query
def label_personas(spark, folder):
    labelled = numbered_clusters(spark, folder)
    known = segments.assign_personas(segments.cluster_centroids(labelled)).where("cluster < 3")
    return segments.label_personas(labelled, known, numbered_default=True).select("CustomerID", "cluster", "persona")


@query
def persona_order_join(spark, folder):
    return segments.persona_order_join(named_clusters(spark, folder).select("persona").distinct())


@query
def persona_summary(spark, folder):
    return segments.persona_summary(named_clusters(spark, folder))


@query
def persona_distribution(spark, folder):
    return segments.persona_distribution(named_clusters(spark, folder))


@query
def segment_headline(spark, folder):
    return segments.segment_headline(named_clusters(spark, folder))


@query
def centroid_distances(spark, folder):
    found = segments.centroid_distances(segments.cluster_centroids(numbered_clusters(spark, folder)))
    return rounded(found, 4, "min_distance", "mean_distance")


# Forecasts


def _country_series(spark: SparkSession, folder: str) -> DataFrame:
    lines = cleaned(spark, folder, "Country")
    return forecast.prepare_series(daily.daily_revenue(lines, series=["Country"]), ["Country"])


@query
def forecast_features(spark, folder):
    spec = forecast.ForecastSpec(yearly=True, extra_holidays=(("1998-12-25", "Christmas"), ("1999-12-25", "Christmas")))
    full = forecast.forecast_features(forecast.prepare_series(daily_table(spark, folder)), spec)
    trend, season = F.col("trend_x"), F.col("seasonal_x")
    # 6 weekly terms, 20 yearly terms, then the holiday flags by name.
    picked = {
        "t": trend[1],
        "hinge_1": trend[2],
        "hinge_25": trend[26],
        "week_sin_1": season[0],
        "week_cos_3": season[5],
        "year_sin_1": season[6],
        "year_cos_10": season[25],
    }
    out = full.select("series_key", "ds", *[numbers.half_even(v, 9).alias(k) for k, v in picked.items()], F.size(trend).alias("n_trend"), F.size(season).alias("n_seasonal"), season[27].alias("christmas"))
    return out


@query
def holdout_tail(spark, folder):
    return forecast.holdout_tail(_country_series(spark, folder)).groupBy("series_key", "is_test", "n_days").agg(
        F.min("ds").alias("first_day"), F.count(F.lit(1)).alias("days")
    )


@query
def holiday_calendar(spark, folder):
    """Holidays of three countries over the years of the orders."""
    first, last = table(spark, folder, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    found = [holidays.holiday_calendar(spark, country, date(first.year, 1, 1), date(last.year, 12, 31)) for country in ("UK", "US", "DE")]
    return found[0].union(found[1]).union(found[2])


@query
def series_sums(spark, folder):
    """Sums of the country series, the last 100 days added to stored sums of the days before."""
    frame = cut_lineage(_country_series(spark, folder))
    cut = frame.agg(F.date_sub(F.max("ds"), 100)).first()[0]
    spec = forecast.ForecastSpec(weekly_order=1, changepoints=2, holidays_country=None)
    stored = cut_lineage(forecast.series_sums(frame.where(F.col("ds") <= cut), [spec]))
    sums = forecast.add_days(stored, frame.where(F.col("ds") > cut), [spec])
    # Four trend terms (1, t, hinges at 0.4 and 0.8) by three seasonal ones (1, sine, cosine).
    picked = {"total": 0, "week_sine": 1, "with_time": 3, "with_hinge": 6, "hinge_week_cosine": 11}
    return sums.select("series_key", "first_day", "newest", "basis_days", "n_days", "largest", *[numbers.half_even(F.col("products")[at], 0).alias(name) for name, at in picked.items()])


@query
def fit_forecaster(spark, folder):
    """Fits by country, and the equation of the level: residuals, weighed by the season, add up to nothing."""
    frame = _country_series(spark, folder)
    spec = forecast.ForecastSpec()
    models = cut_lineage(forecast.fit_forecaster(frame, spec))
    known = forecast.predict_demand(models, 1, spec, include_history=True).where("is_history").select("series_key", "ds", "yhat")
    season = models.select("series_key", "gamma")
    rows = frame.join(known, ["series_key", "ds"]).join(season, "series_key")
    lift = 1.0 + F.aggregate(F.zip_with(F.array(*forecast.seasonal_terms(F.col("ds"), spec)), "gamma", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
    checked = rows.groupBy("series_key").agg((F.abs(F.sum((F.col("y") - F.col("yhat")) * lift)) < 1e-4 * F.sum(F.abs("y"))).alias("level_balanced"))
    return models.join(checked, "series_key").select("series_key", "setting", "mode", "fit", "reason", "first_day", "last_day", "n_days", "level_balanced")


def _banded(forecasts: DataFrame) -> DataFrame:
    """Keys, whether the forecast lies in its band, and whether the band is as wide as on the first day."""
    width = F.col("yhat_upper") - F.col("yhat_lower")
    first = F.first(width).over(Window.partitionBy("series_key").orderBy("ds"))
    return forecasts.select("series_key", "ds", F.col("yhat").between(F.col("yhat_lower"), F.col("yhat_upper")).alias("in_band"), (width >= first * (1 - 1e-6)).alias("no_narrower"))


@query
def predict_demand(spark, folder):
    models = forecast.fit_forecaster(_country_series(spark, folder))
    return _banded(forecast.predict_demand(models, 30))


@query
def forecast_tail(spark, folder):
    frame = _country_series(spark, folder)
    models = forecast.fit_forecaster(frame)
    full = forecast.predict_demand(models, 45, include_history=True)
    return _banded(forecast.forecast_tail(full, frame, 14))


def _judged(evaluated: DataFrame) -> DataFrame:
    """Keys, days and reasons, and whether an evaluated series has metrics."""
    return evaluated.withColumn("scored", F.coalesce((F.col("mape") > 0) & (F.col("rmse") > 0), F.lit(False))).drop("mape", "rmse")


@query
def evaluate_forecaster(spark, folder):
    return _judged(forecast.evaluate_forecaster(_country_series(spark, folder)))


@query
def forecast_grid(spark, folder):
    return _judged(forecast.forecast_grid(_country_series(spark, folder)))


@query
def forecast_metrics(spark, folder):
    return rounded(forecast.forecast_metrics(naive_forecast(spark, folder)), 6, "mape", "rmse")


@query
def forecast_headline(spark, folder):
    history = forecast.prepare_series(daily_table(spark, folder))
    shown = forecast.forecast_headline(history, naive_forecast(spark, folder), end=date(2001, 6, 30))
    return rounded(shown, 4, "mean_forecast", "delta_pct")


@query
def forecast_delta_pct(spark, folder):
    series = daily_table(spark, folder)
    before = F.lag("Revenue", 1).over(Window.orderBy("InvoiceDate"))
    both = series.select("InvoiceDate", "Revenue", before.alias("last_actual")).where("last_actual is not null")
    return rounded(both.withColumn("delta_pct", retail.forecast_delta_pct("Revenue", "last_actual")), 6, "delta_pct")


# Runs and stages


def _order_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Model runs made from the orders: one per month and model."""
    orders = table(spark, folder, "orders")
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    name = F.element_at(F.array(*[F.lit(m) for m, _, _ in runs.CRITERIA]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    metric = F.element_at(F.array(*[F.lit(m) for _, m, _ in runs.CRITERIA]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    per_month = orders.groupBy(month.alias("month"), name.alias("model"), metric.alias("metric")).agg(
        F.count(F.lit(1)).alias("n")
    )
    odd = F.month("month") % 3 == 0
    return per_month.select(
        "model",
        F.concat("model", F.lit("-"), F.col("month").cast("string")).alias("run_id"),
        F.col("month").cast("timestamp_ntz").alias("logged_at"),
        F.create_map(F.when(odd, "other").otherwise(F.col("metric")), F.col("n").cast("double")).alias("metrics"),
    )


@query
def promote_best(spark, folder):
    return runs.promote_best(_order_runs(spark, folder))


@query
def log_run(spark, folder):
    path = scratch_path(spark, "runs")
    metrics = inventory.inventory_metrics(inventory_of(spark, folder), cleaned(spark, folder, "TotalPrice")).first()
    runs.log_run(spark, path, "inventory", "run-1", metrics.asDict(), {"dead_stock_days": 60})
    return runs.read_runs(spark, path).select("model", "run_id", F.explode("metrics").alias("metric", "value"))


def _staged(spark: SparkSession, folder: str, features: bool = False) -> Layout:
    """Stage folders of this query alone."""
    layout = Layout(scratch_path(spark, "stages"))
    stages.run_data(spark, tx(spark, folder), layout)
    if features:
        stages.run_features(spark, layout)
    return layout


@query
def run_data(spark, folder):
    layout = Layout(scratch_path(spark, "stages"))
    return stages.run_data(spark, tx(spark, folder), layout)


@query
def run_features(spark, folder):
    layout = _staged(spark, folder, features=True)
    full = stage_files.read_stage(spark, layout.at("timeseries_features"))
    return rounded(full, 3, *[c for c in full.columns if c.startswith("rolling_")])


@query
def run_monitor(spark, folder):
    return stages.run_monitor(spark, _staged(spark, folder)).select(
        "n_columns", "n_drifted_columns", "drift_share", "n_reference", "n_current"
    )


def _trained(spark: SparkSession, folder: str) -> Layout:
    layout = _staged(spark, folder, features=True)
    stages.run_train(spark, layout, Params(home_country=HOME, enable_challenger=True))
    return layout


@query
def run_train(spark, folder):
    """Metrics of the logged runs that follow from the tables, and the names of the others."""
    layout = _trained(spark, folder)
    logged = runs.read_runs(spark, layout.at("runs")).select("model", F.explode("metrics").alias("metric", "value"))
    given = (F.col("model") == "inventory") | F.col("metric").isin("n_train", "n_test", "churn_rate", "holdout_days", "n_days")
    return logged.select("model", "metric", F.when(given, numbers.half_even("value", 6)).alias("value"))


@query
def run_promote(spark, folder):
    promoted = stages.run_promote(spark, _trained(spark, folder))
    return promoted.select("model", "metric", F.when(F.col("model") == "inventory", F.col("value")).alias("value"))
