"""Chronological split and two-sample drift scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.checks import check_fraction, require_columns
from ledgerloom.functions.tails import chi_square_tail, kolmogorov_tail
from ledgerloom.operators.prefix import running_totals
from ledgerloom.operators.selection import Cut, chronological_cut

NUMERIC_METHOD = "Wasserstein distance (normed)"
CATEGORICAL_METHOD = "Jensen-Shannon distance"
NUMERIC_TEST = "K-S p_value"
CATEGORICAL_TEST = "chi-square p_value"
NUMERIC_COLUMNS = ("Quantity", "UnitPrice", "TotalPrice", "Hour")
CATEGORICAL_COLUMNS = ("Country", "DayOfWeek")


def split_cut(
    df: DataFrame, fraction: float = 0.7, date_column: str = "InvoiceDate", tie_break: Sequence[str] = ("InvoiceNo", "StockCode")
) -> Cut:
    """Where the reference side ends, with the size and dates of both sides."""
    check_fraction(fraction)
    if date_column not in df.columns:
        raise KeyError(f"no {date_column!r} column to split on")
    return chronological_cut(df, fraction, date_column, tie_break)


def chronological_split(
    df: DataFrame,
    fraction: float = 0.7,
    date_column: str = "InvoiceDate",
    tie_break: Sequence[str] = ("InvoiceNo", "StockCode"),
) -> DataFrame:
    """Add ``side``: the oldest ``int(n * fraction)`` rows are ``reference``.

    The cut is found by counting (see ``selection``), so the result reads the
    rows once and compares each with the cut.
    """
    return split_cut(df, fraction, date_column, tie_break).split(df)


def drift_projection(df: DataFrame) -> DataFrame:
    """The compared columns, with hour and weekday taken from the date."""
    require_columns(df, ["Quantity", "UnitPrice", "TotalPrice", "Country"], "transactions")
    kept = ["Quantity", "UnitPrice", "TotalPrice", "Country"]
    extra = []
    if "InvoiceDate" in df.columns:
        extra = [F.hour("InvoiceDate").alias("Hour"), F.weekday("InvoiceDate").alias("DayOfWeek")]
    return df.select(*[c for c in ("side", "InvoiceDate") if c in df.columns], *kept, *extra)


def drift_scores(
    split: DataFrame,
    numeric: Sequence[str] = NUMERIC_COLUMNS,
    categorical: Sequence[str] = CATEGORICAL_COLUMNS,
    threshold: float = 0.1,
    tests: str = "distance",
    level: float = 0.05,
) -> DataFrame:
    """One row per column: method, score, threshold, drift_detected.

    All columns are counted by value and side in one scan; everything after
    that works on distinct values.

    ``tests="distance"``. Numeric: area between the two distribution functions
    over the reference deviation. Categorical: Jensen-Shannon distance with
    natural logarithms. Both are set against ``threshold``.

    ``tests="p_value"``. Numeric: two-sample Kolmogorov-Smirnov test, by its
    limit distribution. Categorical: chi-square of the current counts against
    the reference shares; a value the reference never has gives 0. Both are set
    against ``level``.
    """
    if tests not in ("distance", "p_value"):
        raise ValueError(f"tests must be distance or p_value, got {tests!r}")
    none = F.lit(None)
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.nanvl(F.col(c).cast("double"), none.cast("double")).alias("value"),
            none.cast("string").alias("text"),
        )
        for c in numeric
    ]
    cells += [
        F.struct(
            F.lit(c).alias("column"), none.cast("double").alias("value"), F.col(c).cast("string").alias("text")
        )
        for c in categorical
    ]
    seen = split.select("side", F.inline(F.array(*cells)))
    counts = (
        seen.where(F.col("value").isNotNull() | F.col("text").isNotNull())
        .groupBy("column", "value", "text")
        .agg(
            F.count_if(F.col("side") == "reference").alias("n_ref"),
            F.count_if(F.col("side") == "current").alias("n_cur"),
        )
    )
    run = running_totals(counts, ["value", "text"], ["n_ref", "n_cur"], ["column"], previous="value")
    sizes = run.groupBy("column").agg(
        F.sum("n_ref").alias("all_ref"),
        F.sum("n_cur").alias("all_cur"),
        F.try_divide(F.sum(F.col("n_ref") * F.col("value")), F.sum("n_ref")).alias("ref_mean"),
    )
    # One row per compared column.
    rows = run.join(F.broadcast(sizes), "column")
    is_numeric = F.col("column").isin(*numeric)
    scored = _distances(rows, is_numeric) if tests == "distance" else _p_values(rows, is_numeric)
    return scored.withColumn("threshold", F.lit(float(threshold if tests == "distance" else level))).withColumn("drift_detected", drifted())


def _distances(rows: DataFrame, is_numeric: Column) -> DataFrame:
    p = F.try_divide(F.col("n_ref"), F.col("all_ref"))
    q = F.try_divide(F.col("n_cur"), F.col("all_cur"))
    mid = (p + q) / 2

    def pulled(x):
        return F.when(x > 0, x * F.ln(x / mid)).otherwise(F.lit(0.0))

    below = F.try_divide(F.col("run_n_ref") - F.col("n_ref"), F.col("all_ref")) - F.try_divide(
        F.col("run_n_cur") - F.col("n_cur"), F.col("all_cur")
    )
    area = F.sum(F.abs(below) * (F.col("value") - F.col("prev_value")))
    spread = F.sqrt(F.sum(F.col("n_ref") * F.pow(F.col("value") - F.col("ref_mean"), 2)) / F.max("all_ref"))
    divergence = 0.5 * F.sum(pulled(p)) + 0.5 * F.sum(pulled(q))
    return (
        rows.groupBy("column")
        .agg(
            F.coalesce(area, F.lit(0.0)).alias("area"),
            F.greatest(spread, F.lit(0.001)).alias("spread"),
            F.greatest(divergence, F.lit(0.0)).alias("divergence"),
        )
        .select(
            "column",
            F.when(is_numeric, NUMERIC_METHOD).otherwise(CATEGORICAL_METHOD).alias("method"),
            F.when(is_numeric, F.col("area") / F.col("spread")).otherwise(F.sqrt("divergence")).alias("score"),
        )
    )


def _p_values(rows: DataFrame, is_numeric: Column) -> DataFrame:
    gap = F.abs(F.try_divide(F.col("run_n_ref"), F.col("all_ref")) - F.try_divide(F.col("run_n_cur"), F.col("all_cur")))
    expected = F.col("n_ref").cast("double") * F.col("all_cur") / F.col("all_ref")
    off = F.when(expected > 0, F.pow(F.col("n_cur") - expected, 2) / expected).otherwise(float("inf"))
    found = rows.groupBy("column").agg(
        F.max(gap).alias("gap"),
        F.sum(off).alias("off"),
        (F.count(F.lit(1)) - 1).alias("freedom"),
        F.max("all_ref").cast("double").alias("n"),
        F.max("all_cur").cast("double").alias("m"),
    )
    scaled = F.sqrt(F.col("n") * F.col("m") / (F.col("n") + F.col("m"))) * F.col("gap")
    usable = (F.col("n") > 0) & (F.col("m") > 0)
    p = F.when(is_numeric, kolmogorov_tail(scaled)).otherwise(chi_square_tail(F.col("off"), F.col("freedom")))
    return found.select(
        "column", F.when(is_numeric, NUMERIC_TEST).otherwise(CATEGORICAL_TEST).alias("method"), F.when(usable, p).alias("score")
    )


# Sketches


def drift_sketches(
    df: DataFrame, numeric: Sequence[str] = NUMERIC_COLUMNS, date_column: str = "InvoiceDate", k: int = 4096
) -> DataFrame:
    """(day, column, sketch, n, total, squares): a quantile sketch per day and numeric column.

    Of a fixed size however many values a day has; later days are appended,
    earlier ones are not read again. ``k`` sets the error, see ``rank_error``.
    """
    values = [F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("value")) for c in numeric]
    long = df.select(F.col(date_column).cast("date").alias("day"), F.inline(F.array(*values))).where("value is not null and day is not null")
    return long.groupBy("day", "column").agg(
        F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("total"),
        F.sum(F.col("value") * F.col("value")).alias("squares"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def rank_error(k: int) -> float:
    """Rank error of one sketch for all ranks at once, with 99 % confidence (published fit for this kind of sketch)."""
    return 2.446 / k**0.9433


def sketch_drift_scores(
    sketches: DataFrame, first_current: Column, points: int = 10_000, k: int = 4096, threshold: float = 0.1
) -> DataFrame:
    """Wasserstein scores from merged sketches, with a bound of their error.

    Days from ``first_current`` on are the current side. The area between two
    distribution functions is also the area between their quantile functions,
    which is read off at ``points`` ranks. A sketch's quantiles are true ones
    of ranks at most the rank error away, which moves such an area by no more
    than twice that error times the range of the values.
    """
    side = F.when(F.col("day") < first_current, "ref").otherwise("cur")
    merged = sketches.groupBy("column", side.alias("side")).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    # The function wants a constant array.
    ranks = F.split(F.lit(",".join(str((i + 0.5) / points) for i in range(points))), ",").cast("array<double>")
    read = merged.withColumn("at", F.kll_sketch_get_quantile_double("sketch", ranks))
    ref, cur = read.where("side = 'ref'"), read.where("side = 'cur'").select("column", *[F.col(c).alias(f"cur_{c}") for c in ("at", "low", "high")])
    gaps = F.zip_with("at", "cur_at", lambda a, b: F.abs(a - b))
    area = F.aggregate(gaps, F.lit(0.0), lambda t, x: t + x) / points
    mean = F.col("total") / F.col("n")
    spread = F.greatest(F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))), F.lit(0.001))
    ranges = F.col("high") - F.col("low") + F.col("cur_high") - F.col("cur_low")
    return ref.join(cur, "column").select(
        "column",
        F.lit(NUMERIC_METHOD).alias("method"),
        (area / spread).alias("score"),
        ((2 * rank_error(k) + 1.0 / points) * ranges / spread).alias("error"),
        F.lit(float(threshold)).alias("threshold"),
        (area / spread > threshold).alias("drift_detected"),
    )


def _is_p_value():
    return F.col("method").contains("p_value")


def drifted():
    """A distance drifts above its threshold, a p-value below it."""
    score, limit = F.col("score"), F.col("threshold")
    return F.when(_is_p_value(), score < limit).otherwise(score > limit)


def drift_display_score(scores: DataFrame) -> DataFrame:
    """Scores for display, where higher always means more drift."""
    shown = F.when(_is_p_value(), 1 - F.col("score")).otherwise(F.col("score"))
    return scores.withColumn("display_score", shown)


def split_sides(split: DataFrame, date_column: str = "InvoiceDate") -> DataFrame:
    return split.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date_column).alias("start"), F.max(date_column).alias("end")
    )


def cut_sides(spark: SparkSession, cut: Cut) -> DataFrame:
    """``split_sides`` of the rows the cut was found in, without reading them again."""
    rows = [("reference", cut.n_reference, cut.reference_start, cut.reference_end), ("current", cut.n_current, cut.current_start, cut.current_end)]
    return spark.createDataFrame(rows, "side string, n_rows bigint, start timestamp_ntz, end timestamp_ntz")


def drift_summary(scores: DataFrame, sides: DataFrame) -> DataFrame:
    """One row: drifted columns and the size and dates of both ``sides`` (from ``cut_sides`` or ``split_sides``)."""
    hits = F.count_if("drift_detected")
    names = F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("column"))))
    totals = scores.agg(
        F.count(F.lit(1)).alias("n_columns"),
        hits.alias("n_drifted_columns"),
        F.coalesce(F.try_divide(hits.cast("double"), F.count(F.lit(1)).cast("double")), F.lit(0.0)).alias(
            "drift_share"
        ),
        F.array_join(names, ",").alias("drifted_columns"),
    )
    of = lambda side, column: F.max(F.when(F.col("side") == side, F.col(column)))
    both = sides.agg(
        of("reference", "n_rows").alias("n_reference"),
        of("current", "n_rows").alias("n_current"),
        of("reference", "start").alias("reference_start"),
        of("reference", "end").alias("reference_end"),
        of("current", "start").alias("current_start"),
        of("current", "end").alias("current_end"),
    )
    # Both are global aggregates of exactly one row.
    return totals.withColumn("_one", F.lit(1)).join(both.withColumn("_one", F.lit(1)), "_one").drop("_one")
