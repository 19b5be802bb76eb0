"""The five stages: data, features, train, promote, monitor."""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import churn, drift, forecast, inventory, segments
from ledgerloom.operators.cleaning import clean, clean_report
from ledgerloom.operators.customers import join_rfm_behaviour, with_churn_label
from ledgerloom.operators.daily import timeseries_features
from ledgerloom.operators.forecast import ForecastSpec
from ledgerloom.operators.quality import Expectation, default_suite, gate_and_write
from ledgerloom.operators.rollup import behaviour_of, customer_states, daily_of, line_rollup, merge_states, rfm_of, rfm_of_states
from ledgerloom.operators.runs import log_run, promote_best, read_runs
from ledgerloom.params import Params
from ledgerloom.session import cut_lineage
from ledgerloom.sources.raw import load_raw
from ledgerloom.sources.stages import (
    exists,
    read_stage,
    save_model,
    write_inventory_csv,
    write_json_report,
    write_stage,
)


class StageMissing(RuntimeError):
    """An earlier stage has not been run."""


@dataclass(frozen=True)
class Layout:
    """Where the stages keep their tables."""

    base: str

    def at(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def need(self, spark: SparkSession, name: str, stage: str) -> DataFrame:
        if not exists(spark, self.at(name)):
            raise StageMissing(f"{self.at(name)} not found, run the {stage} stage first")
        return read_stage(spark, self.at(name))


def run_data(
    spark: SparkSession, raw: DataFrame | str, layout: Layout, params: Params = Params()
) -> DataFrame:
    """Clean, check and publish ``cleaned``; returns the clean report.

    The report counts come from their own aggregate over five columns: counted
    while writing, a retried task could count its rows twice.
    """
    source = load_raw(spark, raw) if isinstance(raw, str) else raw
    # Amounts are summed as whole ten-thousandths; finer ones would be rounded line by line, so they are refused.
    suite = [*default_suite(params.min_rows, params.max_rows), Expectation("whole_units", "TotalPrice")]
    gate_and_write(clean(source), layout.at("cleaned"), layout.at("quarantine"), suite)
    write_json_report(clean_report(source), layout.at("clean_report"))
    return spark.read.json(layout.at("clean_report"))


def run_features(spark: SparkSession, layout: Layout, params: Params = Params()) -> dict[str, DataFrame]:
    """Customer and daily features. The lines are read once, for the roll-up that everything else is made from."""
    write_stage(line_rollup(layout.need(spark, "cleaned", "data")), layout.at("rollup"))
    rollup = read_stage(spark, layout.at("rollup"))
    write_stage(rfm_of(rollup), layout.at("rfm"))
    write_stage(behaviour_of(rollup, params.home_country), layout.at("behaviour"))
    write_stage(daily_of(rollup), layout.at("daily_revenue"))
    if params.series_keys:
        write_stage(daily_of(rollup, params.series_keys.split(",")), layout.at("daily_series"))
    daily = read_stage(spark, layout.at("daily_revenue"))
    write_stage(timeseries_features(daily, params.lags, params.windows), layout.at("timeseries_features"))
    return {name: read_stage(spark, layout.at(name)) for name in ("rfm", "daily_revenue", "timeseries_features")}


def update_features(spark: SparkSession, layout: Layout, params: Params = Params()) -> DataFrame:
    """RFM kept up by days: only days after the last known one are read, and their states merged with the stored ones.

    The frequency is an estimate here (see ``customer_states``); ``run_features`` is exact.
    """
    cleaned, path = layout.need(spark, "cleaned", "data"), layout.at("customer_states")
    if exists(spark, path):
        through = read_stage(spark, path).agg(F.max("through")).first()[0]
        cleaned = cleaned.where(F.col("InvoiceDate") >= F.date_add(F.lit(through), 1).cast("timestamp_ntz"))
    rollup = cut_lineage(line_rollup(cleaned))
    newest = rollup.agg(F.max("day")).first()[0]
    if newest is not None:
        write_stage(customer_states(rollup).withColumn("through", F.lit(newest)), path, mode="append")
    merged = merge_states(read_stage(spark, path).drop("through"))
    write_stage(rfm_of_states(merged), layout.at("rfm_estimated"))
    return read_stage(spark, layout.at("rfm_estimated"))


def spec_from(params: Params) -> ForecastSpec:
    return ForecastSpec(
        weekly_order=params.weekly_order,
        yearly=params.yearly_seasonality,
        yearly_order=params.yearly_order,
        mode=params.seasonality_mode,
        changepoint_prior_scale=params.changepoint_prior_scale,
        holidays_country=params.holidays_country,
        interval_width=params.interval_width,
    )


def _first_row(df: DataFrame, *drop: str) -> dict:
    return {k: v for k, v in df.first().asDict().items() if k not in drop}


def train_forecasting(spark: SparkSession, layout: Layout, params: Params) -> dict:
    spec = spec_from(params)
    frame = forecast.prepare_series(layout.need(spark, "daily_revenue", "features"))
    forecast.require_history(frame, params.holdout_days)
    metrics = _first_row(forecast.evaluate_forecaster(frame, spec, params.holdout_days), "series_key", "reason")
    write_stage(forecast.fit_forecaster(frame, spec), layout.at("models/forecaster"))
    models = read_stage(spark, layout.at("models/forecaster"))
    write_stage(forecast.predict_demand(models, params.horizon_days, spec), layout.at("forecast"))
    if params.series_keys:
        _train_series(spark, layout, params, spec)
    return metrics


def _train_series(spark: SparkSession, layout: Layout, params: Params, spec: ForecastSpec) -> None:
    """Models, forecasts and holdout metrics of every series; short ones are listed with the reason."""
    frame = forecast.prepare_series(layout.need(spark, "daily_series", "features"), params.series_keys.split(","))
    write_stage(forecast.evaluate_forecaster(frame, spec, params.holdout_days), layout.at("series_evaluation"))
    write_stage(forecast.fit_forecaster(frame, spec), layout.at("models/series_forecaster"))
    models = read_stage(spark, layout.at("models/series_forecaster"))
    write_stage(forecast.predict_demand(models, params.horizon_days, spec), layout.at("series_forecast"))


def train_churn(spark: SparkSession, layout: Layout, params: Params) -> dict:
    joined = join_rfm_behaviour(layout.need(spark, "rfm", "features"), layout.need(spark, "behaviour", "features"))
    table = with_churn_label(joined, params.inactivity_days)
    split = cut_lineage(churn.stratified_split(table, seed=params.seed))
    train = split.where(~F.col("is_test"))
    models = {"gbt": churn.fit_churn(train, params.churn_trees, seed=params.seed)}
    if params.enable_challenger:
        models["forest"] = churn.fit_challenger(train, params.churn_trees, seed=params.seed)
    compared = cut_lineage(churn.compare_challenger(models, split))
    write_stage(compared, layout.at("churn_comparison"))
    save_model(models["gbt"], layout.at("models/churn"))
    importance = churn.importance_sort(churn.feature_importance(models["gbt"], spark))
    write_stage(importance, layout.at("feature_importance"))
    return _first_row(compared.where("model = 'gbt'"), "model")


def train_segmentation(spark: SparkSession, layout: Layout, params: Params) -> dict:
    table = layout.need(spark, "rfm", "features")
    found = segments.fit_segmenter(table, params.k_min, params.k_max, params.n_init, params.seed)
    write_stage(found.model, layout.at("models/segmenter"))
    model = read_stage(spark, layout.at("models/segmenter"))
    write_stage(segments.score_segments(model, table), layout.at("segments"))
    labelled = read_stage(spark, layout.at("segments"))
    write_stage(segments.persona_summary(labelled), layout.at("persona_summary"))
    scores = {f"silhouette_k{k}": s for k, s in found.silhouettes.items()}
    return {"best_k": found.k, "silhouette": found.silhouette, "silhouette_error": found.errors[found.k], **scores}


def train_inventory(spark: SparkSession, layout: Layout, params: Params) -> dict:
    cleaned = layout.need(spark, "cleaned", "data")
    table = inventory.eoq_table(cleaned, params.ordering_cost, params.holding_pct, params.dead_stock_days)
    write_stage(table, layout.at("inventory"))
    stored = read_stage(spark, layout.at("inventory"))
    write_inventory_csv(stored, layout.at("inventory_csv"))
    metrics = inventory.inventory_metrics(stored, cleaned)
    write_json_report(metrics, layout.at("inventory_metrics"))
    return _first_row(spark.read.json(layout.at("inventory_metrics")))


TRAINERS = {
    "forecasting": train_forecasting,
    "churn": train_churn,
    "segmentation": train_segmentation,
    "inventory": train_inventory,
}


def run_train(spark: SparkSession, layout: Layout, params: Params = Params()) -> DataFrame:
    """Fit every model in order, log a run for each and return the runs."""
    for name, stage in (("cleaned", "data"), ("rfm", "features"), ("daily_revenue", "features")):
        layout.need(spark, name, stage)
    settings = {k: v for k, v in asdict(params).items() if v is not None}
    for name, train in TRAINERS.items():
        metrics = train(spark, layout, params)
        log_run(spark, layout.at("runs"), name, uuid.uuid4().hex, metrics, settings, {"model": name})
    return read_runs(spark, layout.at("runs"))


def run_promote(spark: SparkSession, layout: Layout) -> DataFrame:
    """Best run per model, written as ``production``; empty without runs."""
    if not exists(spark, layout.at("runs")):
        return spark.createDataFrame([], "model string, metric string, run_id string, value double")
    write_stage(promote_best(read_runs(spark, layout.at("runs"))), layout.at("production"))
    return read_stage(spark, layout.at("production"))


def run_monitor(spark: SparkSession, layout: Layout, params: Params = Params()) -> DataFrame:
    """Drift scores and summary of the cleaned table, also as JSON."""
    cleaned = layout.need(spark, "cleaned", "data")
    cut = drift.split_cut(cleaned, params.drift_reference_fraction)
    projected = drift.drift_projection(cut.split(cleaned))
    write_stage(drift.drift_scores(projected, threshold=params.drift_threshold), layout.at("drift_scores"))
    scores = read_stage(spark, layout.at("drift_scores"))
    write_json_report(scores, layout.at("drift_scores_json"))
    write_json_report(drift.drift_summary(scores, drift.cut_sides(spark, cut)), layout.at("drift_summary"))
    return spark.read.json(layout.at("drift_summary"))
