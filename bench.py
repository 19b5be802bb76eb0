"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``: one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from ledgerloom.plans.catalog import QUERIES
from ledgerloom.session import build_session, ensure_local_shared_dir

HEADLINE = (
    "clean_report validate_expectations rfm churn_training_table_single_pass daily_revenue_by_country "
    "timeseries_features kpi_summary revenue_by_country top_products describe trimmed_histogram eoq_table "
    "reorder_table chronological_split drift_scores drift_scores_events binary_metrics assign_personas "
    "forecast_grid predict_demand promote_best"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    ensure_local_shared_dir(spark)
    # Start the JVM, warm the code generator and a Python worker outside the timing.
    for name in ("clean_report", "rfm", "exact_quantiles", "evaluate_forecaster"):
        QUERIES[name](spark, folder).collect()
    taken = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "retail_headline_total",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
