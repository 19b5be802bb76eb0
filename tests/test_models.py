from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import holidays
from ledgerloom.operators import churn, evaluation, forecast, runs, segments

# Segments


def test_single_centroid_is_champion(spark):
    one = spark.createDataFrame([(0, 3.0, 25.0, 6000.0)], "cluster int, Recency double, Frequency double, Monetary double")
    assert [tuple(r) for r in segments.assign_personas(one).collect()] == [(0, "Champions")]


PERSONA_TABLES = [
    # One cluster for each rule. Quartiles: recency 20 and 100, frequency 10 (median) and 30, value 4500.
    (
        [(0, 5.0, 40.0, 5000.0), (1, 50.0, 30.0, 4500.0), (2, 100.0, 10.0, 4500.0), (3, 200.0, 2.0, 100.0), (4, 20.0, 5.0, 200.0)],
        ["Champions", "Loyal Customers", "At Risk", "Hibernating", "Regular"],
    ),
    # Two clusters, the best and the worst.
    ([(0, 10.0, 20.0, 5000.0), (1, 100.0, 3.0, 300.0)], ["Champions", "Hibernating"]),
    # Equal clusters meet the first rule; each takes the next free name, and then the first rule's again.
    ([(i, 50.0, 5.0, 100.0) for i in range(7)], ["Champions", "Loyal Customers", "Regular", "At Risk", "Hibernating", "Champions", "Champions"]),
]


@pytest.mark.parametrize("rows, names", PERSONA_TABLES)
def test_personas_in_id_order(spark, rows, names):
    frame = spark.createDataFrame(rows, "cluster int, Recency double, Frequency double, Monetary double")
    got = {r["cluster"]: r["persona"] for r in segments.assign_personas(frame).collect()}
    assert got == dict(enumerate(names))


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    centres = [(10, 20, 5000), (100, 3, 300), (250, 1, 50)]
    rows = []
    for n, (r, f, m) in enumerate(centres):
        for i in range(50):
            rows.append((n * 50 + i, float(r + rng.normal(0, 2)), float(f + rng.normal(0, 0.3)), float(m + rng.normal(0, 10))))
    return spark.createDataFrame(rows, "CustomerID bigint, Recency double, Frequency double, Monetary double")


def test_three_blobs_and_scoring(spark, blobs, tmp_path):
    from ledgerloom.sources.stages import read_stage, write_stage

    found = segments.fit_segmenter(blobs, 3, 5, n_init=2)
    assert found.k == 3 and found.silhouette > 0.3 and found.converged
    chosen = segments.select_k(spark, found).where("chosen").collect()
    assert [r["k"] for r in chosen] == [3]
    again = segments.fit_segmenter(blobs.repartition(7), 3, 5, n_init=2)
    assert again.silhouettes == found.silhouettes and again.model.collect() == found.model.collect()
    write_stage(found.model, str(tmp_path / "m"))
    scored = segments.score_segments(read_stage(spark, str(tmp_path / "m")), blobs)
    sizes = {r["cluster"]: r["count"] for r in scored.groupBy("cluster").count().collect()}
    assert sizes == {0: 50, 1: 50, 2: 50}
    top = scored.where("CustomerID = 0").first()
    assert (top["cluster"], top["persona"]) == (0, "Champions")
    summary = segments.persona_summary(scored).collect()
    assert sum(r["n_customers"] for r in summary) == 150
    assert tuple(segments.segment_headline(scored).first()) == (150, 3, 3)


def test_customers_that_are_all_alike(spark):
    rows = spark.createDataFrame([(i, 1.0, 1.0, 1.0) for i in range(9)], "CustomerID bigint, Recency double, Frequency double, Monetary double")
    with pytest.raises(RuntimeError, match="two clusters"):
        segments.fit_segmenter(rows, 2, 3, n_init=2)
    with pytest.raises(RuntimeError, match="no customers"):
        segments.fit_segmenter(rows.limit(0), 2, 3)


def test_unmapped_cluster_defaults(spark):
    rows = spark.createDataFrame([(7, 1)], "cluster int, CustomerID bigint")
    nobody = spark.createDataFrame([], "cluster int, persona string")
    assert segments.label_personas(rows, nobody).first()["persona"] == "Regular"
    assert segments.label_personas(rows, nobody, numbered_default=True).first()["persona"] == "cluster_7"


# Churn


@pytest.fixture(scope="module")
def customers(spark):
    return spark.range(400).select(
        F.col("id").alias("CustomerID"),
        (F.col("id") * 7 % 180).cast("int").alias("Recency"),
        (F.col("id") % 9 + 1).alias("Frequency"),
        (F.col("id") % 50 * 10.0).alias("Monetary"),
        F.lit(5.0).alias("avg_basket_size"),
        (F.col("id") % 4).alias("unique_products"),
        F.when(F.col("id") % 5 > 0, 3.0).alias("avg_days_between"),
        F.lit(1).alias("is_uk"),
        F.when(F.col("id") * 7 % 180 > 90, 1).otherwise(0).alias("churned"),
    )


def test_stratified_split_is_exact_and_stable(customers):
    split = churn.stratified_split(customers)
    sizes = {(r["churned"], r["is_test"]): r["count"] for r in split.groupBy("churned", "is_test").count().collect()}
    labels = {r["churned"]: r["count"] for r in customers.groupBy("churned").count().collect()}
    assert sizes[(0, True)] + sizes[(1, True)] == 80
    for label, n in labels.items():
        assert abs(sizes[(label, True)] - n * 0.2) < 1
    other = churn.stratified_split(customers.repartition(13))
    assert split.where("is_test").select("CustomerID").exceptAll(other.where("is_test").select("CustomerID")).count() == 0


def test_churn_model(spark, customers):
    split = churn.stratified_split(customers)
    train = split.where("not is_test")
    model = churn.fit_churn(train, trees=5)
    row = churn.evaluate_churn(model, split).first()
    assert row["auc_roc"] > 0.9 and row["n_test"] == 80 and row["n_train"] == 320
    scored = churn.score_churn(model, split)
    assert scored.where("churn_probability < 0 or churn_probability > 1").count() == 0
    best = churn.importance_sort(churn.feature_importance(model, spark)).first()
    assert best["feature"] == "Recency"
    honest = churn.fit_churn(train, trees=3, drop_recency=True)
    assert "Recency" not in honest.stages[0].getInputCols()
    both = churn.compare_challenger({"gbt": model, "forest": churn.fit_challenger(train, 5)}, split)
    assert {r["model"] for r in both.collect()} == {"gbt", "forest"}


def test_metrics_against_brute_force(spark):
    rng = np.random.default_rng(8)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20.0
    row = evaluation.binary_metrics(spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "churned int, churn_probability double")).first()
    pos, neg = s[y == 1], s[y == 0]
    assert row["auc_roc"] == pytest.approx(((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2))
    p = s >= 0.5
    assert row["accuracy"] == pytest.approx((p == y).mean())
    assert row["precision"] == pytest.approx(y[p].mean()) and row["recall"] == pytest.approx(p[y == 1].mean())
    assert row["f1"] == pytest.approx(2 * row["precision"] * row["recall"] / (row["precision"] + row["recall"]))


def test_metrics_with_one_class(spark):
    row = evaluation.binary_metrics(spark.createDataFrame([(0, 0.1), (0, 0.2)], "churned int, churn_probability double")).first()
    assert row["auc_roc"] is None and row["precision"] == row["recall"] == row["f1"] == 0.0 and row["accuracy"] == 1.0


def test_roc_is_monotone(spark):
    rows = [(i % 2, (i * 37 % 11) / 11) for i in range(100)]
    curve = evaluation.roc_curve(spark.createDataFrame(rows, "churned int, churn_probability double")).orderBy(F.desc("threshold")).collect()
    assert all(a["fpr"] <= b["fpr"] and a["tpr"] <= b["tpr"] for a, b in zip(curve, curve[1:]))
    assert (curve[-1]["fpr"], curve[-1]["tpr"]) == (1.0, 1.0)


def test_scoring_limits(spark):
    batch = spark.createDataFrame(
        [(1.0, 1, 1.0, 1), (-1.0, 1, 1.0, 1), (1.0, -1, 1.0, 1), (1.0, 1, None, 1), (1.0, 1, 1.0, 2), (1.0, 1, 1.0, None)],
        "recency double, frequency int, monetary double, is_uk int",
    )
    got = [r["violation"] for r in churn.check_scoring_rows(batch).collect()]
    assert got == [None, "recency", "frequency", "monetary", "is_uk", None]
    assert churn.scoring_features(batch).count() == 2
    with pytest.raises(ValueError):
        churn.check_scoring_rows(batch.drop("monetary"))


# Forecasts


def series(spark, days=374, noise=0.05, key="a", seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(days)
    ds = pd.date_range("2010-12-01", periods=days)
    y = (1000 + 3 * t) * (1 + 0.25 * np.sin(2 * np.pi * ds.dayofweek / 7)) * (1 + rng.normal(0, noise, days))
    return spark.createDataFrame([(key, d.date(), float(v)) for d, v in zip(ds, y)], "series_key string, ds date, y double")


@pytest.mark.parametrize("mode", ["multiplicative", "additive"])
def test_holdout_error_is_small(spark, mode):
    spec = forecast.ForecastSpec(mode=mode)
    row = forecast.evaluate_forecaster(series(spark), spec).first()
    assert row["mape"] < 0.10 and row["holdout_days"] == 30 and row["rmse"] > 0


def test_many_series_horizon_and_band(spark):
    frame = series(spark).unionByName(series(spark, 100, key="b", seed=2)).unionByName(series(spark, 10, key="short"))
    models = forecast.fit_forecaster(frame)
    assert {r["series_key"]: (r["n_days"], r["fit"], r["reason"]) for r in models.collect()} == {
        "a": (374, "full", None), "b": (100, "full", None), "short": (10, "mean", "fewer than 14 days"),
    }
    ahead = forecast.predict_demand(models, 30)
    assert ahead.count() == 90 and ahead.where("yhat_lower > yhat_upper").count() == 0
    first = ahead.where("series_key = 'a'").agg(F.min("ds"), F.max("ds")).first()
    assert tuple(first) == (date(2011, 12, 10), date(2012, 1, 8))
    full = forecast.predict_demand(models, 5, include_history=True)
    assert full.where("is_history").count() == 484
    assert forecast.forecast_tail(full, frame, 3).count() == 9
    inside = frame.join(full.where("is_history"), ["series_key", "ds"]).where("series_key = 'a'")
    covered = inside.where("y between yhat_lower and yhat_upper").count() / 374
    assert 0.7 < covered < 0.9
    wide = forecast.predict_demand(forecast.fit_forecaster(frame, forecast.ForecastSpec(interval_width=0.95)), 30)
    width = F.avg(F.col("yhat_upper") - F.col("yhat_lower"))
    assert wide.agg(width).first()[0] > 1.4 * ahead.agg(width).first()[0]
    mean = frame.where("series_key = 'short'").agg(F.avg("y")).first()[0]
    assert ahead.where("series_key = 'short'").first()["yhat"] == pytest.approx(mean)


def test_series_with_missing_days_has_a_reason(spark):
    frame = series(spark, 60).where("ds <> '2010-12-20'")
    row = forecast.fit_forecaster(frame).first()
    assert (row["fit"], row["reason"]) == ("mean", "1 days are missing")


def test_short_history_has_a_reason(spark):
    with pytest.raises(ValueError, match="44 days"):
        forecast.require_history(series(spark, 44))
    assert forecast.require_history(series(spark, 45)).count() == 45
    both = series(spark, 44, key="short").unionByName(series(spark, 45, key="long"))
    got = {r["series_key"]: r for r in forecast.evaluate_forecaster(both).collect()}
    assert got["short"]["reason"] == "44 days, more than 44 are needed" and got["short"]["mape"] is None
    assert got["long"]["reason"] is None and got["long"]["rmse"] > 0 and got["long"]["holdout_days"] == 30
    grid = forecast.forecast_grid(both).collect()
    assert len(grid) == 8 and sum(r["reason"] is None for r in grid) == 4
    with pytest.raises(ValueError):
        forecast.predict_demand(forecast.fit_forecaster(series(spark, 60)), 0)


def test_fit_moves_rows_once_and_groups_none_in_python(spark):
    plan = forecast.fit_forecaster(series(spark, 60))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan
    # The rows by series, and one small row of sums for each part of a series.
    assert plan.count("Exchange hashpartitioning") == 2


def test_grid_fits_all_settings_in_one_plan(spark):
    grid = forecast.forecast_grid(series(spark, 120))
    assert grid.count() == len(forecast.GRID) and grid.select("setting").distinct().count() == 4
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2  # sums, fits


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_fit_from_sums_against_rows(spark, mode):
    """The penalised equations hold on the rows, and no other coefficients near them are better."""
    spec = forecast.ForecastSpec(mode=mode, yearly=True, yearly_order=2, extra_holidays=(("2011-03-01", "Sale"),))
    bent = series(spark, 300).withColumn("y", F.col("y") + 12.0 * F.greatest(F.datediff("ds", F.lit(date(2011, 4, 1))), F.lit(0)))
    rows = sorted(bent.collect(), key=lambda r: r["ds"])
    row = forecast.fit_forecaster(bent, spec).first()
    y = np.array([r["y"] for r in rows])
    scale, t = np.abs(y).max(), np.arange(300) / 299
    days = np.array([(r["ds"] - date(1970, 1, 1)).days for r in rows], float)
    trend, season = forecast.trend_matrix(t, spec), forecast.seasonal_matrix(days, spec)
    beta, sigma = np.array(row["beta"]) / scale, row["sigma"] / scale
    gamma = np.array(row["gamma"]) / (scale if mode == "additive" else 1.0)
    assert (beta[2:] == 0).any() and (beta[2:] != 0).any()  # sparse

    def cost(b, g):
        fitted = trend @ b + season @ g if mode == "additive" else (trend @ b) * (1 + season @ g)
        prior = (b[:2] ** 2).sum() / 50 + (g**2).sum() / 200 + np.abs(b[2:]).sum() / spec.changepoint_prior_scale
        return ((y / scale - fitted) ** 2).sum() / (2 * sigma**2) + prior

    least, draw = cost(beta, gamma), np.random.default_rng(0)
    for _ in range(300):
        step = draw.choice([1e-2, 1e-3, 1e-4])
        b, g = beta + step * draw.standard_normal(len(beta)) * (draw.random(len(beta)) < 0.2), gamma + step * draw.standard_normal(len(gamma)) * (draw.random(len(gamma)) < 0.2)
        assert cost(b, g) >= least - 1e-3 * abs(least)
    errors = ((y / scale - (trend @ beta + season @ gamma if mode == "additive" else (trend @ beta) * (1 + season @ gamma))) ** 2).sum()
    assert sigma == pytest.approx(np.sqrt(errors / 300), rel=0.05)


def test_later_days_add_to_stored_sums(spark):
    spec = forecast.ForecastSpec()
    frame = series(spark, 200).unionByName(series(spark, 150, key="b", seed=3))
    stored = forecast.series_sums(frame.where("ds < '2011-03-01'"), [spec])
    added = forecast.add_days(stored, frame.where("ds >= '2011-03-01'"), [spec])
    basis = stored.select("series_key", "first_day", "basis_days")
    whole = forecast.day_sums(frame.join(basis, "series_key"), spec)
    for a, b in zip(added.orderBy("series_key").collect(), whole.orderBy("series_key").collect()):
        assert a[:7] == b[:7] and np.allclose(a["products"], b["products"])
    fits = {r["series_key"]: r for r in forecast.fit_from_sums(added, [spec]).collect()}
    assert fits["a"]["n_days"] == 200 and fits["a"]["last_day"] == date(2011, 6, 18) and fits["a"]["basis_days"] == 90


def test_bands_widen_and_cover_held_out_days(spark):
    """Random walks of the trend: the band grows with the horizon and holds about as many days as it says."""
    draw, rows = np.random.default_rng(11), []
    for key in range(40):
        slope = 2.0 + np.cumsum((draw.random(430) < 0.06) * draw.laplace(0, 1.5, 430))
        y = 3000 + np.cumsum(slope) + draw.normal(0, 25, 430)
        rows += [(str(key), d.date(), float(v)) for d, v in zip(pd.date_range("2010-01-01", periods=430), y)]
    frame = spark.createDataFrame(rows, "series_key string, ds date, y double")
    spec = forecast.ForecastSpec(mode="additive", holidays_country=None, changepoint_range=0.95, changepoint_prior_scale=0.5)
    models = forecast.fit_forecaster(frame.where("ds < '2011-01-05'"), spec)
    ahead = forecast.predict_demand(models, 60, spec)
    width = ahead.groupBy(F.datediff("ds", F.lit(date(2011, 1, 4))).alias("h")).agg(F.avg(F.col("yhat_upper") - F.col("yhat_lower")).alias("w")).orderBy("h").collect()
    assert all(a["w"] < b["w"] for a, b in zip(width, width[1:])) and width[-1]["w"] > 1.5 * width[0]["w"]
    covered = ahead.join(frame, ["series_key", "ds"]).agg(F.avg((F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))).cast("int"))).first()[0]
    assert 0.55 < covered < 0.95  # the slope at the end of the history counts as known


def test_metrics_skip_zero_actuals(spark):
    rows = [("a", 0.0, 5.0), ("a", 10.0, 9.0), ("b", 0.0, 1.0)]
    got = {r["series_key"]: r for r in forecast.forecast_metrics(spark.createDataFrame(rows, "series_key string, y double, yhat double")).collect()}
    assert got["a"]["mape"] == pytest.approx(0.1) and got["a"]["rmse"] == pytest.approx(np.sqrt(13))
    assert np.isnan(got["b"]["mape"])


# Holidays of the application's data.
KNOWN_HOLIDAYS = {
    "UK": ["2010-12-25 ChristmasDay", "2010-12-27 BoxingDay", "2011-01-01 NewYearsDay", "2011-04-22 GoodFriday",
           "2011-04-25 EasterMonday", "2011-12-25 ChristmasDay", "2011-12-26 BoxingDay"],
    "US": ["2010-11-25 Thanksgiving", "2010-12-25 ChristmasDay", "2011-01-01 NewYearsDay", "2011-07-04 IndependenceDay",
           "2011-11-24 Thanksgiving", "2011-12-25 ChristmasDay"],
    "DE": ["2010-10-03 GermanUnity", "2010-12-25 ChristmasDay", "2011-01-01 NewYearsDay", "2011-05-01 LabourDay",
           "2011-10-03 GermanUnity", "2011-12-25 ChristmasDay"],
}
KNOWN_EASTERS = ["1954-04-18", "1981-04-19", "1999-04-04", "2000-04-23", "2008-03-23", "2011-04-24", "2024-03-31", "2038-04-25", "2049-04-18", "2285-03-22"]


def test_holidays(spark):
    for country, known in KNOWN_HOLIDAYS.items():
        got = holidays.holiday_calendar(spark, f" {country.lower()} ", date(2010, 10, 1), date(2011, 12, 31)).collect()
        assert sorted(f"{r['ds']} {r['holiday']}" for r in got) == known
    for missing in ("XX", None):
        assert holidays.holiday_calendar(spark, missing, date(2010, 1, 1), date(2011, 1, 1)).count() == 0
    sunday = holidays.Holiday("Easter", easter=0)
    years = spark.createDataFrame([(int(d[:4]), d) for d in KNOWN_EASTERS], "y int, d string")
    assert years.where(holidays.holiday_column(sunday, F.col("y")).cast("string") != F.col("d")).count() == 0
    row = forecast.forecast_features(series(spark, 60)).where("ds = '2010-12-25'").first()
    assert sum(row["seasonal_x"][6:]) == 1.0


def test_terms_of_rows_and_of_arrays_agree(spark):
    spec = forecast.ForecastSpec(yearly=True, yearly_order=3, extra_holidays=(("1997-05-05", "Sale"), ("1998-12-26", "BoxingDay")))
    days = spark.range(3000).select(F.lit("a").alias("series_key"), F.date_add(F.lit(date(1995, 1, 1)), F.col("id").cast("int")).alias("ds"))
    rows = forecast.forecast_features(days, spec).orderBy("ds").collect()
    number = np.arange(3000) + (date(1995, 1, 1) - date(1970, 1, 1)).days
    assert np.allclose(forecast.seasonal_matrix(number.astype(float), spec), [r["seasonal_x"] for r in rows])
    assert np.allclose(forecast.trend_matrix(np.arange(3000) / 2999, spec), [r["trend_x"] for r in rows])


def test_headline(spark):
    history = series(spark, 10)
    ahead = spark.createDataFrame([("a", date(2011, 1, 1), 2.0), ("a", date(2011, 1, 2), 4.0)], "series_key string, ds date, yhat double")
    row = forecast.forecast_headline(history, ahead, end=date(2010, 12, 3)).first()
    actual = history.where("ds = '2010-12-03'").first()["y"]
    assert row["last_actual"] == actual and row["delta_pct"] == pytest.approx((3.0 - actual) / actual * 100)


# Runs


def test_best_run_rules(spark, tmp_path):
    path = str(tmp_path / "runs")
    for model, run, metrics in [
        ("forecasting", "f1", {"mape": 0.3}),
        ("forecasting", "f2", {"mape": 0.1, "rmse": None}),
        ("forecasting", "f3", {"mape": 0.1}),
        ("churn", "c1", {"auc_roc": 0.7}),
        ("churn", "c2", {"auc_roc": 0.9}),
        ("churn", "c3", {"f1": 1.0}),
        ("segmentation", "s1", {"best_k": 4}),
        ("unknown", "u1", {"mape": 0.0}),
    ]:
        runs.log_run(spark, path, model, run, metrics, {"p": 1}, {"t": "x"})
    got = {r["model"]: r["run_id"] for r in runs.promote_best(runs.read_runs(spark, path)).collect()}
    assert got == {"forecasting": "f2", "churn": "c2"}


def test_forecast_fits_each_series_once(spark):
    models = forecast.fit_forecaster(series(spark), forecast.ForecastSpec())
    plan = forecast.predict_demand(models, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2  # sums, fits
