"""Features from the roll-up, states that merge, stored layouts."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import customers, daily, inventory, rollup
from ledgerloom.plans import stages
from ledgerloom.plans.stages import Layout
from ledgerloom.params import Params
from ledgerloom.operators.quality import ValidationFailed
from ledgerloom.sources import stages as files

LINES = [(f"I{i % 40}", f"S{i % 7}", i % 5 + 1, f"2011-0{1 + i % 3}-{1 + i % 27:02d}T{i % 24:02d}:00:00", 0.25 * (i % 9 + 1), i % 11 or None, ["France", "Spain", None][i % 3]) for i in range(300)]


def rows(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=str)


@pytest.fixture
def lines(make_tx):
    return make_tx(LINES)


def test_features_of_the_rollup_equal_those_of_the_lines(lines):
    made = rollup.line_rollup(lines)
    known = lines.where("CustomerID is not null")
    assert rows(rollup.rfm_of(made)) == rows(customers.rfm(lines))
    assert rows(rollup.behaviour_of(made, "France")) == rows(customers.customer_behaviour(lines, "France"))
    assert rows(rollup.daily_of(made, ["Country"])) == rows(daily.daily_revenue(lines, series=["Country"]))
    assert rows(rollup.sku_sales_of(made)) == rows(inventory.sku_sales(lines))
    assert made.agg(F.sum("lines")).first()[0] == lines.count() and known.count() < lines.count()


def test_no_aggregate_multiplies_rows(lines):
    made = rollup.line_rollup(lines)
    for frame in (rollup.rfm_of(made), rollup.behaviour_of(made)):
        assert "Expand" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_states_merge(lines):
    made = rollup.line_rollup(lines)
    parts = [rollup.customer_states(made.where(f"month(day) {c}")) for c in ("= 1", "= 2", "= 3")]
    states = rollup.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    # Few values, so the sketches are exact.
    assert rows(rollup.rfm_of_states(states)) == rows(rollup.rfm_of(made))
    wanted = rollup.behaviour_of(made).drop("is_uk")
    assert rows(rollup.behaviour_of_states(states)) == rows(wanted)


def test_new_days_alone_are_read(spark, lines, tmp_path):
    layout = Layout(str(tmp_path))
    cut = F.lit("2011-03-10").cast("timestamp_ntz")
    files.write_stage(lines.where(F.col("InvoiceDate") < cut), layout.at("cleaned"), by_month=True)
    stages.update_features(spark, layout)
    # Known days are gone from the table now; what is stored must do.
    files.write_stage(lines.where(F.col("InvoiceDate") >= cut), layout.at("cleaned"), by_month=True)
    for _ in range(2):  # the second time there is nothing new
        assert rows(stages.update_features(spark, layout)) == rows(customers.rfm(lines))


def test_stored_by_customer_joins_without_moving_rows(spark, lines, tmp_path):
    made = rollup.line_rollup(lines)
    a, b = str(tmp_path / "rfm"), str(tmp_path / "behaviour")
    files.write_bucketed(rollup.rfm_of(made), a, ["CustomerID"], 4)
    files.write_bucketed(rollup.behaviour_of(made).repartition(3), b, ["CustomerID"], 4)
    spark.sql(f"DROP TABLE {files._bucket_table(b)}")  # as in a session that has not seen it
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = customers.join_rfm_behaviour(files.read_bucketed(spark, a), files.read_bucketed(spark, b))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined) == rows(customers.join_rfm_behaviour(rollup.rfm_of(made), rollup.behaviour_of(made)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_amounts_finer_than_the_unit_are_refused(spark, make_raw, tmp_path):
    def raw(price):
        return make_raw([("1", "S", "D", 3, "2011-01-01 10:00:00", price, 1.0, "France")])

    stages.run_data(spark, raw(2.55), Layout(str(tmp_path / "good")))
    with pytest.raises(ValidationFailed, match="whole_units"):
        stages.run_data(spark, raw(0.01234), Layout(str(tmp_path / "bad")))


def test_train_by_series(spark, make_tx, tmp_path):
    lines = make_tx([(f"I{c}{i}", "S", 1 + i % 7, f"2011-{1 + i // 28:02d}-{1 + i % 28:02d}T10:00:00", 2.0, 1 + i % 5, c) for c, n in (("France", 80), ("Spain", 20)) for i in range(n)])
    layout, params = Layout(str(tmp_path)), Params(series_keys="Country", holdout_days=10, horizon_days=5)
    files.write_stage(lines, layout.at("cleaned"), by_month=True)
    stages.run_features(spark, layout, params)
    stages.train_forecasting(spark, layout, params)
    judged = {r["series_key"]: r for r in files.read_stage(spark, layout.at("series_evaluation")).collect()}
    assert judged["France"]["reason"] is None and judged["Spain"]["reason"] and judged["Spain"]["mape"] is None
    assert files.read_stage(spark, layout.at("series_forecast")).groupBy("series_key").count().count() == 2
