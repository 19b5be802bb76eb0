"""Demand forecasts for many daily series.

The model is additive regression in the form published by Taylor and Letham,
"Forecasting at Scale" (2018): a trend with changepoint hinges and, on top of
or multiplied with it, Fourier seasonality and holiday effects. Its priors are
theirs too: normal for level, slope and seasons, and Laplace for the hinges,
which makes most of them zero.

A fit needs the rows only for sums: of y, its square, and its products with the
terms of the model. These sums are distributive. Tasks add them up over the
rows they hold, Spark adds up the parts, and later days add to stored sums
(``merge_sums``). The terms themselves depend on the calendar alone, so each
series is then solved from its sums, for any number of settings at once.
Forecasts are dot products on the JVM side.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.checks import check_demand_args, check_positive, require_columns
from ledgerloom.functions import holidays as holiday_rules
from ledgerloom.functions.holidays import Holiday, holiday_date, is_holiday, rules_of
from ledgerloom.functions.retail import forecast_delta_pct
from ledgerloom.session import cut_lineage

# The solver travels to the executors by value; the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(holiday_rules)

SPARE_DAYS = 14  # days a fit needs; a series needs more than holdout + SPARE_DAYS days to be evaluated


@dataclass(frozen=True)
class ForecastSpec:
    name: str = "default"
    weekly_order: int = 3
    yearly: bool = False
    yearly_order: int = 10
    mode: str = "multiplicative"
    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior_scale: float = 0.05
    holidays_country: str | None = "UK"
    extra_holidays: tuple[tuple[str, str], ...] = ()
    interval_width: float = 0.80

    def __post_init__(self) -> None:
        if self.mode not in ("additive", "multiplicative"):
            raise ValueError(f"mode must be additive or multiplicative, got {self.mode!r}")

    @property
    def years(self) -> int:
        return self.yearly_order if self.yearly else 0

    def holidays(self) -> dict[str, tuple[list[Holiday], list[date]]]:
        """Rules and single days of every holiday, by name."""
        found: dict[str, tuple[list[Holiday], list[date]]] = {}
        for rule in rules_of(self.holidays_country):
            found.setdefault(rule.name, ([], []))[0].append(rule)
        for day, name in self.extra_holidays:
            found.setdefault(name, ([], []))[1].append(date.fromisoformat(day))
        return dict(sorted(found.items()))


def prepare_series(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """(series_key, ds, y) from a gap-free daily table."""
    require_columns(daily, ["InvoiceDate", "Revenue", *series], "daily series")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in series]) if series else F.lit("ALL")
    return daily.select(key.alias("series_key"), F.col("InvoiceDate").alias("ds"), F.col("Revenue").alias("y"))


def holdout_tail(frame: DataFrame, holdout_days: int = 30) -> DataFrame:
    """Add ``is_test`` for the last days of each series and its ``n_days``."""
    check_positive("holdout_days", [holdout_days])
    whole = Window.partitionBy("series_key")
    return frame.withColumns(
        {
            "is_test": F.col("ds") > F.date_sub(F.max("ds").over(whole), holdout_days),
            "n_days": F.count(F.lit(1)).over(whole),
        }
    )


def _fourier(day_number: Column, period: float, order: int) -> list[Column]:
    terms = []
    for n in range(1, order + 1):
        angle = day_number * (2.0 * math.pi * n / period)
        terms += [F.sin(angle), F.cos(angle)]
    return terms


def _places(spec: ForecastSpec) -> list[float]:
    """Scaled times of the changepoints."""
    return [spec.changepoint_range * (j + 1) / spec.changepoints for j in range(spec.changepoints)]


def trend_terms(t: Column, spec: ForecastSpec) -> list[Column]:
    """Level, slope and one hinge per changepoint on scaled time."""
    return [F.lit(1.0), t, *[F.greatest(t - place, F.lit(0.0)) for place in _places(spec)]]


def seasonal_terms(ds: Column, spec: ForecastSpec) -> list[Column]:
    """Weekly and yearly Fourier terms and one flag per holiday name."""
    day_number = F.unix_date(ds).cast("double")
    terms = _fourier(day_number, 7.0, spec.weekly_order) + _fourier(day_number, 365.25, spec.years)
    for rules, days in spec.holidays().values():
        hit = F.lit(False)
        for rule in rules:
            hit = hit | is_holiday(rule, ds)
        if days:
            hit = hit | ds.isin(*[F.lit(day) for day in days])
        terms.append(F.when(hit, 1.0).otherwise(0.0))
    return terms or [F.lit(0.0)]


def trend_matrix(t: np.ndarray, spec: ForecastSpec) -> np.ndarray:
    """``trend_terms`` of an array of scaled times."""
    return np.column_stack([np.ones(len(t)), t, *[np.maximum(t - place, 0.0) for place in _places(spec)]])


def seasonal_matrix(days: np.ndarray, spec: ForecastSpec) -> np.ndarray:
    """``seasonal_terms`` of an array of days since 1970."""
    columns = []
    for period, order in ((7.0, spec.weekly_order), (365.25, spec.years)):
        for n in range(1, order + 1):
            angle = days * (2.0 * math.pi * n / period)
            columns += [np.sin(angle), np.cos(angle)]
    epoch = date(1970, 1, 1)
    years = range((epoch + timedelta(int(days.min()))).year, (epoch + timedelta(int(days.max()))).year + 1) if len(days) else ()
    for rules, single in spec.holidays().values():
        hits = [holiday_date(rule, year) for rule in rules for year in years] + single
        columns.append(np.isin(days, [(hit - epoch).days for hit in hits]).astype(float))
    return np.column_stack(columns) if columns else np.zeros((len(days), 1))


def scaled_time(ds: Column, first_day: Column, basis_days: Column) -> Column:
    """0 on the first day and 1 on the last one the model's time scale was made for."""
    return F.datediff(ds, first_day).cast("double") / F.greatest(basis_days - 1, F.lit(1))


def with_basis(frame: DataFrame) -> DataFrame:
    """Add ``first_day`` and ``basis_days`` (days from the first to the last) of each row's series."""
    whole = Window.partitionBy("series_key")
    spans = frame.withColumns({"first_day": F.min("ds").over(whole), "_last": F.max("ds").over(whole)})
    return spans.withColumn("basis_days", F.datediff("_last", "first_day") + 1).drop("_last")


def forecast_features(frame: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Add ``trend_x`` and ``seasonal_x`` arrays to (series_key, ds, ...)."""
    t = scaled_time(F.col("ds"), F.col("first_day"), F.col("basis_days"))
    return with_basis(frame).withColumns(
        {
            "trend_x": F.array(*trend_terms(t, spec)),
            "seasonal_x": F.array(*seasonal_terms(F.col("ds"), spec)),
        }
    )


# Sums


def union_spec(specs: Sequence[ForecastSpec]) -> ForecastSpec:
    """A setting whose terms include those of all given ones, which must agree on changepoints and holidays."""
    alike = {(s.changepoints, s.changepoint_range, s.holidays_country, s.extra_holidays) for s in specs}
    if len(alike) != 1:
        raise ValueError("settings that are fitted together need the same changepoints and holidays")
    years = max(s.years for s in specs)
    return replace(specs[0], weekly_order=max(s.weekly_order for s in specs), yearly=years > 0, yearly_order=years)


def _used(spec: ForecastSpec, union: ForecastSpec) -> list[int]:
    """Places of a setting's seasonal terms among those of the union."""
    start = 2 * union.weekly_order
    flags = start + 2 * union.years
    found = [*range(2 * spec.weekly_order), *range(start, start + 2 * spec.years), *range(flags, flags + len(spec.holidays()))]
    return found or [0]


def day_sums(rows: DataFrame, union: ForecastSpec) -> DataFrame:
    """Sums over rows (series_key, ds, y, first_day, basis_days), one row per series.

    ``products``: y times each trend term times each seasonal term (the first
    of which is 1), row by row of that matrix. Rows in any order; a task emits
    one part for each series and batch.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("series_key").dictionary_encode()
            day = batch.column("ds").cast(pa.int32()).to_numpy().astype(float)
            first = batch.column("first_day").cast(pa.int32()).to_numpy().astype(float)
            y, basis = batch.column("y").to_numpy(zero_copy_only=False), batch.column("basis_days").to_numpy()
            code = keys.indices.to_numpy(zero_copy_only=False)
            trend = trend_matrix((day - first) / np.maximum(basis - 1, 1), union)
            season = np.column_stack([np.ones(len(day)), seasonal_matrix(day, union)])
            order = np.argsort(code, kind="stable")
            edges = np.flatnonzero(np.append(True, np.diff(code[order]) != 0)) if len(code) else np.zeros(0, int)
            parts = np.split(order, edges[1:]) if len(code) else []
            heads = [p[0] for p in parts]
            yield pa.record_batch(
                {
                    "series_key": pa.array([keys.dictionary[int(code[i])].as_py() for i in heads], pa.string()),
                    "first_day": batch.column("first_day").take(pa.array(heads, pa.int64())),
                    "basis_days": pa.array([int(basis[i]) for i in heads], pa.int32()),
                    "oldest": pa.array([int(day[p].min()) for p in parts], pa.int32()).cast(pa.date32()),
                    "newest": pa.array([int(day[p].max()) for p in parts], pa.int32()).cast(pa.date32()),
                    "n_days": pa.array([len(p) for p in parts], pa.int64()),
                    "largest": pa.array([float(np.abs(y[p]).max()) for p in parts], pa.float64()),
                    "squares": pa.array([float((y[p] ** 2).sum()) for p in parts], pa.float64()),
                    "products": pa.array([((trend[p] * y[p, None]).T @ season[p]).ravel() for p in parts], pa.list_(pa.float64())),
                }
            )

    typed = rows.select("series_key", "ds", F.col("y").cast("double").alias("y"), "first_day", F.col("basis_days").cast("int").alias("basis_days"))
    return _added(typed.where("y is not null").mapInArrow(partial, SUMS_SCHEMA))


SUMS_SCHEMA = (
    "series_key string, first_day date, basis_days int, oldest date, newest date, n_days bigint, "
    "largest double, squares double, products array<double>"
)


def _added(parts: DataFrame) -> DataFrame:
    return (
        parts.groupBy("series_key", "first_day", "basis_days")
        .agg(
            F.min("oldest").alias("oldest"),
            F.max("newest").alias("newest"),
            F.sum("n_days").alias("n_days"),
            F.max("largest").alias("largest"),
            F.sum("squares").alias("squares"),
            Summarizer.sum(array_to_vector("products")).alias("products"),
        )
        .withColumn("products", vector_to_array("products"))
    )


def series_sums(frame: DataFrame, specs: Sequence[ForecastSpec] = (ForecastSpec(),), tasks: int | None = None) -> DataFrame:
    """Sums of every series, on a time scale that spans its days.

    Rows move once, by series; ``tasks`` says into how many partitions (the
    adaptive planner decides where it is not given).
    """
    spread = frame.repartition(tasks, "series_key") if tasks else frame.repartition("series_key")
    return day_sums(with_basis(spread.select("series_key", "ds", "y")), union_spec(specs))


def add_days(sums: DataFrame, days: DataFrame, specs: Sequence[ForecastSpec] = (ForecastSpec(),)) -> DataFrame:
    """Stored sums with later days of known series added; earlier days are not read again.

    The time scale stays as it was, so its changepoints do too. Days of series
    without sums are left out; they need ``series_sums``.
    """
    known = sums.select("series_key", "first_day", "basis_days")
    return merge_sums(sums, day_sums(days.join(known, "series_key"), union_spec(specs)))


def merge_sums(*sums: DataFrame) -> DataFrame:
    """Sums over the days of all of them, which must not overlap."""
    whole = sums[0]
    for part in sums[1:]:
        whole = whole.unionByName(part)
    return _added(whole)


# Fits

MODEL_SCHEMA = (
    "series_key string, setting string, mode string, fit string, reason string, first_day date, last_day date, "
    "basis_days int, n_days bigint, beta array<double>, gamma array<double>, sigma double, trend_rate double, band double"
)
LEVEL_SCALE, SEASON_SCALE, SIGMA_SCALE = 5.0, 10.0, 0.5  # of the published priors, y being scaled to 1
ROUNDS, SWEEPS, SETTLED = 8, 200, 1e-9


def _sparse(gram: np.ndarray, target: np.ndarray, ridge: np.ndarray, hinges: slice, weight: float, start: np.ndarray) -> np.ndarray:
    """Least squares from sums, with a ridge on all but the hinges and an absolute penalty on these.

    The other coefficients are eliminated; the hinges are found by coordinate
    descent on what is left of the matrix.
    """
    chosen = np.zeros(len(target), bool)
    chosen[hinges] = True
    inner = gram[~chosen][:, ~chosen] + np.diag(ridge[~chosen])
    cross = gram[~chosen][:, chosen]
    solved = np.linalg.solve(inner, np.column_stack([cross, target[~chosen]]))
    left = gram[chosen][:, chosen] - cross.T @ solved[:, :-1]
    rest = target[chosen] - cross.T @ solved[:, -1]
    delta, scale = start.copy(), np.maximum(np.diag(left), 1e-12)
    slope = rest - left @ delta
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(delta)):
            free = slope[j] + scale[j] * delta[j]
            new = math.copysign(max(abs(free) - weight, 0.0), free) / scale[j]
            if new != delta[j]:
                slope -= left[:, j] * (new - delta[j])
                moved = max(moved, abs(new - delta[j]))
                delta[j] = new
        if moved < SETTLED * (1.0 + np.abs(delta).max(initial=0.0)):
            break
    out = np.zeros(len(target))
    out[chosen] = delta
    out[~chosen] = solved[:, -1] - solved[:, :-1] @ delta
    return out


def _solved(row: dict, spec: ForecastSpec, union: ForecastSpec) -> tuple[np.ndarray, np.ndarray, float]:
    """beta, gamma (in the places of the union) and the residual deviation of one series, all for y scaled to 1."""
    used, n = _used(spec, union), int(row["n_days"])
    day = (row["first_day"] - date(1970, 1, 1)).days + np.arange(n)
    trend = trend_matrix(np.arange(n) / max(row["basis_days"] - 1, 1), union)
    season = seasonal_matrix(day.astype(float), union)[:, used]
    products = np.array(row["products"]).reshape(trend.shape[1], -1) / row["largest"]
    with_trend, with_both, squares = products[:, 0], products[:, 1:][:, used], row["squares"] / row["largest"] ** 2
    hinges, width = slice(2, trend.shape[1]), trend.shape[1]
    beta, gamma = np.zeros(width), np.zeros(len(used))
    beta[0] = with_trend[0] / n
    variance = max(squares / n - beta[0] ** 2, 1e-12)
    additive = spec.mode == "additive"
    gram = np.column_stack([trend, season]).T @ np.column_stack([trend, season]) if additive else None
    for _ in range(ROUNDS):
        ridge = variance / np.concatenate([np.full(2, LEVEL_SCALE**2), np.ones(width - 2), np.full(len(used), SEASON_SCALE**2)])
        weight = variance / spec.changepoint_prior_scale
        if additive:
            both = _sparse(gram, np.concatenate([with_trend, with_both[0]]), ridge, hinges, weight, beta[hinges])
            beta, gamma = both[:width], both[width:]
            fitted, matched = trend @ beta + season @ gamma, with_trend @ beta + with_both[0] @ gamma
        else:
            # Bilinear in trend and season: each is a linear problem given the other.
            lift = 1.0 + season @ gamma
            lifted = trend * lift[:, None]
            beta = _sparse(lifted.T @ lifted, with_trend + with_both @ gamma, ridge[:width], hinges, weight, beta[hinges])
            level = trend @ beta
            weighted = season * level[:, None]
            gamma = np.linalg.solve(weighted.T @ weighted + np.diag(ridge[width:]), beta @ with_both - weighted.T @ level)
            fitted, matched = level * (1.0 + season @ gamma), with_trend @ beta + beta @ with_both @ gamma
        before, errors = variance, max(squares - 2 * matched + (fitted * fitted).sum(), 0.0)
        # The published half-normal prior keeps the deviation from running off; this is its largest point given the errors.
        variance = max(_deviation(errors, n) ** 2, 1e-12)
        if abs(variance - before) <= 1e-9 * before:
            break
    if not additive:
        # The trend once more, so that its equations hold for the seasons that are returned.
        lifted = trend * (1.0 + season @ gamma)[:, None]
        beta = _sparse(lifted.T @ lifted, with_trend + with_both @ gamma, ridge[:width], hinges, weight, beta[hinges])
    whole = np.zeros(len(seasonal_matrix(np.zeros(1), union)[0]))
    whole[used] = gamma
    return beta, whole, math.sqrt(variance)


def _deviation(errors: float, n: int) -> float:
    """Largest point of -n log s - errors / (2 s^2) - s^2 / (2 SIGMA_SCALE^2)."""
    prior = 1.0 / SIGMA_SCALE**2
    return math.sqrt((-n + math.sqrt(n * n + 4 * prior * errors)) / (2 * prior))


def fit_from_sums(sums: DataFrame, specs: Sequence[ForecastSpec] = (ForecastSpec(),), min_days: int = SPARE_DAYS) -> DataFrame:
    """One coefficient row per series and setting.

    ``fit`` is ``full``; or ``mean`` for a series of fewer than ``min_days``
    days or with missing days, whose coefficients are its mean, for the given
    ``reason``.
    """
    union, specs = union_spec(specs), list(specs)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "date": pa.date32(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
        fields = [f.strip().split(" ") for f in MODEL_SCHEMA.split(",")]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                span = (row["newest"] - row["first_day"]).days + 1
                reason = None
                if row["n_days"] < min_days:
                    reason = f"fewer than {min_days} days"
                elif span != row["n_days"]:
                    reason = f"{span - row['n_days']} days are missing"
                for spec in specs:
                    mean = row["products"][0] / row["n_days"]
                    if reason or not row["largest"]:
                        beta, gamma = np.zeros(2 + union.changepoints), np.zeros(len(seasonal_matrix(np.zeros(1), union)[0]))
                        beta[0], rate = mean, 0.0
                        sigma = math.sqrt(max(row["squares"] / row["n_days"] - mean**2, 0.0))
                    else:
                        beta, gamma, sigma = _solved(row, spec, union)
                        # Later changepoints: as many and as large as in the past, at any time.
                        rate = 2 * float(np.abs(beta[2:]).mean() if spec.changepoints else 0.0) ** 2 * spec.changepoints / 3 * row["largest"] ** 2
                        beta, sigma = beta * row["largest"], sigma * row["largest"]
                        gamma = gamma * (row["largest"] if spec.mode == "additive" else 1.0)
                    band = NormalDist().inv_cdf(0.5 + spec.interval_width / 2)
                    out.append((row["series_key"], spec.name, spec.mode, "mean" if reason else "full", reason, row["first_day"], row["newest"], row["basis_days"], row["n_days"], beta, gamma, sigma, rate, band))
            columns = zip(*out) if out else ([],) * len(fields)
            yield pa.record_batch([pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])

    return sums.mapInArrow(solve, MODEL_SCHEMA)


def fit_forecaster(frame: DataFrame, spec: ForecastSpec = ForecastSpec(), min_days: int = SPARE_DAYS, tasks: int | None = None) -> DataFrame:
    """One coefficient row per series; see ``fit_from_sums``."""
    return fit_from_sums(series_sums(frame, [spec], tasks), [spec], min_days)


def _dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _with_forecast(known: DataFrame, spec: ForecastSpec, kept: Sequence[str]) -> DataFrame:
    """Forecast rows that have a day next to the coefficients of their series.

    The band holds the residuals and, after the last known day, the trend's own
    changes: their variance grows with the cube of the time since then.
    """
    t = scaled_time(F.col("ds"), F.col("first_day"), F.col("basis_days"))
    ahead = F.greatest(t - scaled_time(F.col("last_day"), F.col("first_day"), F.col("basis_days")), F.lit(0.0))
    level = _dot(F.array(*trend_terms(t, spec)), F.col("beta"))
    season = _dot(F.array(*seasonal_terms(F.col("ds"), spec)), F.col("gamma"))
    multiplied = F.col("mode") == "multiplicative"
    lift = F.when(multiplied, 1.0 + season).otherwise(F.lit(1.0))
    yhat = F.when(multiplied, level * (1.0 + season)).otherwise(level + season)
    wide = F.col("band") * F.sqrt(F.col("sigma") * F.col("sigma") + F.col("trend_rate") * F.pow(ahead, 3) * lift * lift)
    return (
        known.withColumn("yhat", yhat)
        .withColumn("_wide", wide)
        .withColumn("yhat_lower", F.col("yhat") - F.col("_wide"))
        .withColumn("yhat_upper", F.col("yhat") + F.col("_wide"))
        .select(*kept, "yhat", "yhat_lower", "yhat_upper")
    )


def forecast_days(days: DataFrame, models: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Forecast the given (series_key, ds) rows, by every setting the models have."""
    return _with_forecast(days.join(models, "series_key"), spec, [*days.columns, "setting"])


def future_days(models: DataFrame, horizon_days: int) -> DataFrame:
    following = F.sequence(F.date_add("last_day", 1), F.date_add("last_day", horizon_days))
    return models.select("series_key", F.explode(following).alias("ds"))


def predict_demand(
    models: DataFrame,
    horizon_days: int = 30,
    spec: ForecastSpec = ForecastSpec(),
    include_history: bool = False,
) -> DataFrame:
    """The next days of every series; history days come flagged on request."""
    check_demand_args(horizon_days)
    first = F.col("first_day") if include_history else F.date_add("last_day", 1)
    span = F.sequence(first, F.date_add("last_day", horizon_days))
    # The coefficients go with each day, so that a series is fitted once.
    days = models.withColumn("ds", F.explode(span)).withColumn("is_history", F.col("ds") <= F.col("last_day"))
    return _with_forecast(days, spec, ["series_key", "ds", *(["is_history"] if include_history else [])])


def forecast_tail(forecast: DataFrame, history: DataFrame, horizon_days: int = 30) -> DataFrame:
    """Forecast rows after the last known day of their series."""
    newest = history.groupBy("series_key").agg(F.max("ds").alias("_last"))
    after = F.col("ds") > F.col("_last")
    within = F.col("ds") <= F.date_add("_last", horizon_days)
    return forecast.join(newest, "series_key").where(after & within).drop("_last")


def forecast_metrics(scored: DataFrame, keys: Sequence[str] = ("series_key",)) -> DataFrame:
    """MAPE without zero actuals (NaN if none remain) and RMSE per series."""
    error = F.col("y") - F.col("yhat")
    usable = F.col("y") != 0
    return scored.groupBy(*keys).agg(
        F.coalesce(F.avg(F.when(usable, F.abs(error / F.nullif("y", F.lit(0.0))))), F.lit(float("nan"))).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(F.lit(1)).alias("holdout_days"),
    )


def evaluate_forecaster(
    frame: DataFrame, spec: ForecastSpec = ForecastSpec(), holdout_days: int = 30, min_days: int = SPARE_DAYS
) -> DataFrame:
    """Fit on all but the tail of each series, score the tail.

    A series of ``holdout_days + min_days`` days or fewer is in the result too,
    without metrics and with the reason.
    """
    return evaluate_settings(frame, [spec], holdout_days, min_days).drop("setting")


def evaluate_settings(frame: DataFrame, specs: Sequence[ForecastSpec], holdout_days: int = 30, min_days: int = SPARE_DAYS) -> DataFrame:
    """Holdout metrics of every series under every setting, from one set of sums."""
    union = union_spec(specs)
    # Written once: the sums, the scored days and the list of series read it.
    marked = cut_lineage(holdout_tail(frame, holdout_days))
    long_enough = F.col("n_days") > holdout_days + min_days
    usable = marked.where(long_enough)
    models = fit_from_sums(series_sums(usable.where(~F.col("is_test")), specs), specs, min_days)
    scored = forecast_days(usable.where("is_test").select("series_key", "ds", "y"), models, union)
    metrics = forecast_metrics(scored, ("series_key", "setting"))
    short = F.format_string(f"%d days, more than {holdout_days + min_days} are needed", "n_days")
    every = marked.groupBy("series_key").agg(F.max("n_days").alias("n_days"))
    named = every.withColumn("setting", F.explode(F.array(*[F.lit(s.name) for s in specs])))
    return named.join(metrics, ["series_key", "setting"], "left").select(
        "series_key", "setting", "mape", "rmse", "holdout_days", "n_days", F.when(~long_enough, short).alias("reason")
    )


def require_history(frame: DataFrame, holdout_days: int = 30) -> DataFrame:
    """Refuse input in which a series is too short to hold out a tail."""
    need = holdout_days + SPARE_DAYS
    short = frame.groupBy("series_key").count().where(F.col("count") <= need).limit(1).collect()
    if short:
        raise ValueError(f"need more than {need} days of history; {short[0]['series_key']} has {short[0]['count']}")
    return frame


# The compared settings (yearly terms, their order, mode).
GRID = [
    (False, 10, "multiplicative"),
    (True, 10, "additive"),
    (True, 5, "multiplicative"),
    (False, 0, "additive"),
]


def grid_specs(base: ForecastSpec = ForecastSpec()) -> list[ForecastSpec]:
    return [
        replace(base, name=f"yearly={yearly} order={order} mode={mode}".lower(), yearly=yearly, yearly_order=order, mode=mode, holidays_country=None)
        for yearly, order, mode in GRID
    ]


def forecast_grid(frame: DataFrame, base: ForecastSpec = ForecastSpec(), holdout_days: int = 30, min_days: int = SPARE_DAYS) -> DataFrame:
    """Holdout metrics of every grid setting and series; see ``evaluate_settings``."""
    return evaluate_settings(frame, grid_specs(base), holdout_days, min_days)


def forecast_headline(
    history: DataFrame, forecast: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Last actual in the chosen dates, mean forecast and change per series."""
    if start is not None:
        history = history.where(F.col("ds") >= F.lit(start))
    if end is not None:
        history = history.where(F.col("ds") <= F.lit(end))
    last = history.groupBy("series_key").agg(F.max_by("y", "ds").alias("last_actual"))
    mean = forecast.groupBy("series_key").agg(
        F.avg("yhat").alias("mean_forecast"), F.count(F.lit(1)).alias("horizon_days")
    )
    return mean.join(last, "series_key", "left").withColumn(
        "delta_pct", forecast_delta_pct("mean_forecast", "last_actual")
    )
