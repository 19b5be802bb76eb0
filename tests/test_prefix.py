import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions import tails
from ledgerloom.operators import drift, prefix, reports, selection


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, and one group holds most rows."""
    rows = spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("v"),
        F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("g"),
    )
    return rows


@pytest.mark.parametrize("group", [[], ["g"]])
def test_equals_the_plain_window(skewed, group):
    got = prefix.running_totals(skewed, [F.desc("v"), F.asc("id")], ["v"], group, partitions=7)
    plain = Window.partitionBy(*group).orderBy(F.desc("v"), F.asc("id")).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("run_v", F.sum("v").over(plain)).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_previous_value_crosses_partitions(skewed):
    values = skewed.select("g", "v").distinct().withColumn("one", F.lit(1).cast("bigint"))
    got = prefix.running_totals(values, ["v"], ["one"], ["g"], previous="v", partitions=5)
    want = values.withColumn("prev_v", F.lag("v").over(Window.partitionBy("g").orderBy("v")))
    assert got.select("g", "v", "prev_v").exceptAll(want.select("g", "v", "prev_v")).count() == 0


def test_row_numbers(skewed):
    got = prefix.row_numbers(skewed, ["v", "id"], ["g"])
    per_group = got.groupBy("g").agg(F.count("*").alias("n"), F.max("row_no").alias("m"), F.count_distinct("row_no").alias("d"))
    assert all(r["n"] == r["m"] == r["d"] for r in per_group.collect())


def test_quantiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.exponential(5, 997).round(2), rng.integers(0, 4, 997)
    df = spark.createDataFrame([(float(x), int(y)) for x, y in zip(a, b)] + [(None, None)], "a double, b int")
    got = {(r["column"], r["p"]): r["value"] for r in prefix.exact_quantiles(df, ["a", "b"], [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
    for name, values in (("a", a), ("b", b)):
        for p in (0.0, 0.1, 0.5, 0.99, 1.0):
            assert got[(name, p)] == pytest.approx(np.quantile(values, p))


def test_describe_and_histogram_against_numpy(spark):
    rng = np.random.default_rng(4)
    v = np.append(rng.gamma(2.0, 10.0, 800).round(1), [900.0] * 3)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    row = reports.describe(df, ["v"]).first()
    assert row["count"] == len(v) and row["std"] == pytest.approx(v.std(ddof=1)) and row["p75"] == pytest.approx(np.quantile(v, 0.75))
    kept = v[v <= np.quantile(v, 0.99)]
    want, edges = np.histogram(kept, bins=40)
    got = reports.trimmed_histogram(df, "v").orderBy("bin").collect()
    assert sum(r["rows"] for r in got) == len(kept) and len(got) == 40
    assert got[0]["bin_low"] == pytest.approx(edges[0]) and got[-1]["bin_high"] == pytest.approx(edges[-1])
    assert [r["rows"] for r in got] == list(want)


def test_histogram_values_on_edges(spark):
    values = [i / 10 for i in range(41)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = reports.trimmed_histogram(frame, "v", 40, None).orderBy("bin").collect()
    edges = [r["bin_low"] for r in got] + [4.0]
    want = [sum(a <= v < b for v in values) for a, b in zip(edges, edges[1:])]
    want[-1] += 1  # the last bin is closed
    assert [r["rows"] for r in got] == want
    single = reports.trimmed_histogram(spark.createDataFrame([(2.0,)] * 5, "v double"), "v").where("rows > 0").first()
    assert single["rows"] == 5 and single["bin_low"] == pytest.approx(2.0)


# Drift


def hourly(spark, n=1000):
    return spark.range(n).select(
        (F.lit("2011-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("InvoiceDate"),
        F.col("id").cast("string").alias("InvoiceNo"),
        (F.col("id") % 5 + 1).cast("int").alias("Quantity"),
        F.lit(2.0).alias("UnitPrice"),
        ((F.col("id") % 5 + 1) * 2.0).alias("TotalPrice"),
        F.when(F.col("id") % 3 == 0, "France").otherwise("United Kingdom").alias("Country"),
    )


def test_split_counts_and_order(spark):
    split = drift.chronological_split(hourly(spark), 0.7)
    sides = {r["side"]: r for r in drift.split_sides(split).collect()}
    assert (sides["reference"]["n_rows"], sides["current"]["n_rows"]) == (700, 300)
    assert sides["reference"]["end"] <= sides["current"]["start"]


def test_split_inside_one_hot_instant(spark):
    """All rows share a timestamp, half of them are exact copies."""
    same = hourly(spark).withColumn("InvoiceDate", F.lit("2011-01-01 05:00:00").cast("timestamp_ntz"))
    same = same.withColumn("InvoiceNo", F.when(F.col("InvoiceNo") % 2 == 0, "x").otherwise(F.col("InvoiceNo")))
    split = drift.chronological_split(same.drop("Quantity", "TotalPrice", "Country"), 0.37)
    assert split.where("side = 'reference'").count() == 370 and split.count() == 1000


@pytest.mark.parametrize("few", [0, 10_000])
def test_kth_row_against_a_sort(spark, few):
    """Ties, copies and nulls; with ``few`` 0 only pivots find the row."""
    rng = np.random.default_rng(3)
    rows = [(None if rng.random() < 0.1 else int(rng.integers(0, 5)), None if rng.random() < 0.1 else str(rng.integers(0, 40)), float(rng.integers(0, 3))) for _ in range(600)]
    rows += [(2, "7", 1.0)] * 300
    frame = spark.createDataFrame(rows, "a int, b string, c double").repartition(3)
    ranked = sorted(rows, key=lambda r: tuple((v is not None, v or type(v)()) if v is not None else (False,) for v in r))
    for k in (1, 17, 450, 611, 900):
        row, kept, copies = selection.kth_row(frame, ["a", "b", "c"], k, few)
        assert tuple(row[:3]) == ranked[k - 1] and copies == rows.count(ranked[k - 1])
        assert kept == k - ranked.index(ranked[k - 1])
    with pytest.raises(ValueError):
        selection.kth_row(frame, ["a", "b", "c"], 901, few)


def test_split_reads_once_and_knows_its_sides(spark):
    rows = hourly(spark, 1000).unionByName(hourly(spark, 3).withColumn("InvoiceDate", F.lit(None).cast("timestamp_ntz")))
    cut = drift.split_cut(rows, 0.37)
    split = cut.split(rows)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    sides = {r["side"]: tuple(r) for r in drift.cut_sides(spark, cut).collect()}
    assert sides == {r["side"]: tuple(r) for r in drift.split_sides(split).collect()}
    assert sides["reference"][1] == 371


# Tail probabilities from published tables.
CHI_SQUARE = [(3.841459, 1, 0.05), (6.634897, 1, 0.01), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (24.724970, 11, 0.01), (124.342113, 100, 0.05), (1.145476, 5, 0.95), (0.0, 4, 1.0), (2000.0, 7, 0.0)]
KOLMOGOROV = [(0.5, 0.963945), (0.8, 0.544142), (1.0, 0.27), (1.2238, 0.1), (1.3581, 0.05), (1.6276, 0.01), (1.9495, 0.001), (0.04, 1.0)]


def test_tails_against_tables(spark):
    rows = spark.createDataFrame(CHI_SQUARE, "x double, f int, p double").withColumn("got", tails.chi_square_tail(F.col("x"), F.col("f")))
    assert all(r["got"] == pytest.approx(r["p"], abs=2e-6) for r in rows.collect())
    rows = spark.createDataFrame(KOLMOGOROV, "x double, p double").withColumn("got", tails.kolmogorov_tail(F.col("x")))
    assert all(r["got"] == pytest.approx(r["p"], abs=1e-4) for r in rows.collect())
    # Many degrees of freedom: near a half at their median, where the single terms would vanish.
    wide = spark.createDataFrame([(3999.333, 4000), (4000.333, 4001)], "x double, f int").withColumn("got", tails.chi_square_tail(F.col("x"), F.col("f")))
    assert all(r["got"] == pytest.approx(0.5, abs=1e-3) for r in wide.collect())


def test_p_values_of_two_samples(spark):
    rng = np.random.default_rng(4)
    rows = [(side, float(v), str(k)) for side, n, shift in (("reference", 3000, 0.0), ("current", 2000, 0.03)) for v, k in zip(rng.normal(shift, 1, n).round(2), rng.integers(0, 4, n))]
    rows += [("reference", 0.0, "x"), ("current", 0.0, "new")]
    got = {r["column"]: r for r in drift.drift_scores(spark.createDataFrame(rows, "side string, v double, k string"), ["v"], ["k"], tests="p_value").collect()}
    a, b = (np.sort([v for s, v, _ in rows if s == side]) for side in ("reference", "current"))
    grid = np.unique(np.concatenate([a, b]))
    d = np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)).max()
    x = d * np.sqrt(len(a) * len(b) / (len(a) + len(b)))
    assert got["v"]["score"] == pytest.approx(2 * sum((-1) ** (j - 1) * np.exp(-2 * j * j * x * x) for j in range(1, 200)), abs=1e-9)
    assert got["v"]["method"] == "K-S p_value" and got["v"]["threshold"] == 0.05
    assert got["k"]["score"] == 0.0 and got["k"]["drift_detected"]
    with pytest.raises(ValueError):
        drift.drift_scores(spark.createDataFrame(rows, "side string, v double, k string"), ["v"], ["k"], tests="other")


def test_sketches_merge_within_their_error(spark):
    rng = np.random.default_rng(5)
    rows = [(f"2011-01-{1 + i % 28:02d}", float(v), float(v * v)) for i, v in enumerate(rng.gamma(2, 3, 20_000) + np.repeat([0.0, 0.4], 10_000))]
    frame = spark.createDataFrame(rows, "day string, v double, w double").withColumn("InvoiceDate", F.col("day").cast("timestamp_ntz"))
    first = F.lit("2011-01-15").cast("date")
    early, late = (drift.drift_sketches(frame.where(f"day {op} '2011-01-20'"), ["v", "w"], k=200) for op in ("<", ">="))
    got = {r["column"]: r for r in drift.sketch_drift_scores(early.unionByName(late), first, k=200).collect()}
    sided = frame.withColumn("side", F.when(F.col("InvoiceDate") < first, "reference").otherwise("current"))
    for r in drift.drift_scores(sided, ["v", "w"], []).collect():
        assert abs(got[r["column"]]["score"] - r["score"]) <= got[r["column"]]["error"] < 5


@pytest.mark.parametrize("fraction", [0.0, 1.0, -0.1, 1.5])
def test_bad_fractions(spark, fraction):
    with pytest.raises(ValueError):
        drift.chronological_split(hourly(spark, 10), fraction)


def test_split_needs_dates_and_two_sides(spark):
    with pytest.raises(KeyError):
        drift.chronological_split(hourly(spark, 10).drop("InvoiceDate"))
    with pytest.raises(ValueError):
        drift.chronological_split(hourly(spark, 1), 0.5)


def test_scores_against_brute_force(spark):
    rng = np.random.default_rng(9)
    ref, cur = rng.normal(0, 1, 400).round(2), rng.normal(0.5, 1.4, 300).round(2)
    kinds = ["a", "b", "c", "d"]
    rc, cc = rng.choice(kinds[:3], 400), rng.choice(kinds, 300, p=[0.1, 0.2, 0.3, 0.4])
    rows = [("reference", float(v), str(k)) for v, k in zip(ref, rc)] + [("current", float(v), str(k)) for v, k in zip(cur, cc)]
    got = {r["column"]: r for r in drift.drift_scores(spark.createDataFrame(rows, "side string, v double, k string"), ["v"], ["k"]).collect()}
    grid = np.sort(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), grid, "right") / len(ref) - np.searchsorted(np.sort(cur), grid, "right") / len(cur)
    assert got["v"]["score"] == pytest.approx((np.abs(f[:-1]) * np.diff(grid)).sum() / ref.std())
    p, q = (np.array([(x == k).mean() for k in kinds]) for x in (rc, cc))
    m = (p + q) / 2
    kl = lambda x: sum(a * np.log(a / b) for a, b in zip(x, m) if a > 0)
    assert got["k"]["score"] == pytest.approx(np.sqrt(kl(p) / 2 + kl(q) / 2))
    assert got["v"]["drift_detected"] and got["k"]["drift_detected"]


def test_identical_sides_do_not_drift(spark):
    rows = [(s, 1.0, "a") for s in ("reference", "current") for _ in range(5)]
    got = drift.drift_scores(spark.createDataFrame(rows, "side string, v double, k string"), ["v"], ["k"]).collect()
    assert [r["score"] for r in got] == [0.0, 0.0] and not any(r["drift_detected"] for r in got)


def test_p_value_direction(spark):
    scores = spark.createDataFrame([("a", "K-S p_value", 0.03, 0.05), ("b", "K-S p_value", 0.2, 0.05)], "column string, method string, score double, threshold double")
    got = drift.drift_display_score(scores.withColumn("drift_detected", drift.drifted())).orderBy("column").collect()
    assert [(r["drift_detected"], round(r["display_score"], 6)) for r in got] == [(True, 0.97), (False, 0.8)]
