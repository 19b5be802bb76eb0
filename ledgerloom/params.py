"""Operator parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

CONF_PREFIX = "spark.ledgerloom."


@dataclass(frozen=True)
class Params:
    # The defaults users of the retail application rely on.
    inactivity_days: int = 90
    home_country: str = "United Kingdom"
    ordering_cost: float = 50.0
    holding_pct: float = 0.25
    dead_stock_days: int = 60
    lags: tuple[int, ...] = (1, 7, 14)
    windows: tuple[int, ...] = (7, 14, 30)
    k_min: int = 4
    k_max: int = 8
    n_init: int = 10
    horizon_days: int = 30
    holdout_days: int = 30
    weekly_order: int = 3
    yearly_seasonality: bool = False
    yearly_order: int = 10
    seasonality_mode: str = "multiplicative"
    changepoint_prior_scale: float = 0.05
    holidays_country: str = "UK"
    series_keys: str = ""  # comma-separated columns of the roll-up; forecasts by series besides the total
    interval_width: float = 0.80
    drift_reference_fraction: float = 0.7
    drift_threshold: float = 0.1
    min_rows: int = 1
    max_rows: int | None = None
    churn_trees: int = 200
    enable_challenger: bool = False
    seed: int = 42

    @classmethod
    def from_spark(cls, spark: SparkSession) -> "Params":
        """Defaults overridden by ``spark.ledgerloom.<name>`` settings."""
        found = {}
        for field in fields(cls):
            text = spark.conf.get(CONF_PREFIX + field.name, None)
            if text is not None:
                found[field.name] = _convert(text, field.default)
        return cls(**found)


def _convert(text: str, default: object) -> object:
    if isinstance(default, bool):
        return text.strip().lower() in ("1", "true", "yes")
    if isinstance(default, tuple):
        return tuple(int(part) for part in text.split(","))
    if isinstance(default, str):
        return text
    if text.strip().lower() in ("", "none"):
        return None
    return type(default)(text)
