from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.dates import floor_days
from ledgerloom.operators import customers

UK, FR = "United Kingdom", "France"


def rows_by(df, key="CustomerID"):
    return {r[key]: r for r in df.collect()}


def test_known_rfm(make_tx):
    tx = make_tx(
        [
            ("i1", "A", 1, "2011-01-01", 1.0, 1, UK),
            ("i2", "A", 1, "2011-01-05", 2.0, 1, UK),
            ("i3", "A", 1, "2011-01-10", 3.0, 1, UK),
            ("i4", "A", 1, "2011-01-15", 5.0, 2, UK),
            ("i5", "A", 1, "2011-01-05", 2.0, 3, UK),
        ]
    )
    got = rows_by(customers.rfm(tx, "2011-01-20"))
    assert {c: (r["Recency"], r["Frequency"], r["Monetary"]) for c, r in got.items()} == {
        1: (10, 3, 6.0),
        2: (5, 1, 5.0),
        3: (15, 1, 2.0),
    }
    assert got[1]["FirstPurchase"] == datetime(2011, 1, 1) and got[1]["LastPurchase"] == datetime(2011, 1, 10)
    assert [r["CustomerID"] for r in customers.sort_rfm(customers.rfm(tx)).collect()] == [1, 2, 3]


def test_distinct_invoices_refunds_and_floor(make_tx):
    tx = make_tx(
        [
            ("i1", "A", 1, "2011-05-01", 10.0, 1, UK),
            ("i1", "B", -1, "2011-05-01", 5.0, 1, UK),
            ("i2", "B", -1, "2011-05-10", 5.0, 2, UK),
        ]
    )
    got = rows_by(customers.rfm(tx))
    assert (got[1]["Frequency"], got[1]["Monetary"], got[1]["Recency"]) == (1, 5.0, 10)
    assert (got[2]["Monetary"], got[2]["Recency"]) == (0.0, 1)
    late = make_tx([("i", "A", 1, "2011-01-10T20:00:00", 1.0, 1, UK)])
    assert customers.rfm(late, "2011-01-20 08:00:00").first()["Recency"] == 9


def test_floor_days_below_zero(spark):
    pair = spark.sql("select timestamp_ntz'2011-01-10 20:00:00' a, timestamp_ntz'2011-01-20 08:00:00' b")
    assert pair.select(floor_days("a", "b")).first()[0] == -10
    assert pair.select(floor_days("b", "a")).first()[0] == 9


def test_approximate_distinct_is_opt_in(make_tx):
    tx = make_tx([(f"i{n}", "A", 1, "2011-01-01", 1.0, 1, UK) for n in range(200)])
    assert abs(customers.rfm(tx, approximate=0.05).first()["Frequency"] - 200) <= 30


def test_behaviour(make_tx):
    tx = make_tx(
        [
            ("i1", "S1", 1, "2011-01-01", 2.0, 1, UK),
            ("i2", "S1", 1, "2011-01-05T09:00:00", 3.0, 1, UK),
            ("i3", "S2", 1, "2011-01-10", 1.0, 1, UK),
            ("i4", "S2", 1, "2011-01-10", 1.0, 2, FR),
            ("i5", "S2", 1, "2011-01-10", 1.0, 3, FR),
            ("i5", "S2", 1, "2011-01-10", 1.0, 3, UK),
        ]
    )
    got = rows_by(customers.customer_behaviour(tx))
    assert (got[1]["avg_basket_size"], got[1]["unique_products"], got[1]["avg_days_between"], got[1]["is_uk"]) == (2.0, 2, 4.5, 1)
    assert got[2]["avg_days_between"] is None and got[2]["is_uk"] == 0
    assert got[3]["is_uk"] == 0  # tie goes to the smaller name
    assert rows_by(customers.customer_behaviour(tx, basket="invoice"))[3]["avg_basket_size"] == 2.0


def test_home_flag_without_country(make_tx):
    tx = make_tx([("i", "S", 1, "2011-01-01", 1.0, 1, None), ("i", "S", 1, "2011-01-01", 1.0, 2, None), ("j", "S", 1, "2011-01-01", 1.0, 2, UK)])
    got = rows_by(customers.home_country_flag(tx))
    assert got[1]["main_country"] == "Unknown" and got[2]["is_uk"] == 1


@pytest.mark.parametrize("with_rfm", [True, False])
def test_training_table(make_tx, with_rfm):
    tx = make_tx([("i1", "S1", 1, "2011-01-10", 4.0, 1, UK), ("i2", "S1", 1, "2010-10-12", 4.0, 2, UK)])
    table = customers.rfm(tx, "2011-01-20") if with_rfm else None
    got = rows_by(customers.churn_training_table(tx, table, snapshot="2011-01-20"))
    assert got[1]["avg_days_between"] == 10.0 and got[1]["churned"] == 0
    assert got[2]["Recency"] == 100 and got[2]["churned"] == 1


def test_fill_churn_nulls_without_behaviour(spark):
    table = spark.createDataFrame(
        [(1, 10, 0, 6.0)], "CustomerID bigint, Recency int, Frequency bigint, Monetary double"
    ).withColumns({c: F.lit(None).cast(t) for c, t in (("avg_basket_size", "double"), ("unique_products", "bigint"), ("avg_days_between", "double"), ("is_uk", "int"))})
    row = customers.fill_churn_nulls(table).first()
    assert (row["avg_days_between"], row["avg_basket_size"], row["unique_products"], row["is_uk"]) == (10.0, 6.0, 0, 0)


def test_crosstab_edges(spark):
    table = spark.createDataFrame(
        [(10, 2, 300.0), (11, 3, 300.01), (10, 1, 0.0), (2000, 1, 5.0)], "Recency int, Frequency bigint, Monetary double"
    )
    got = {(r["recency_bucket"], r["frequency_bucket"]): r for r in customers.rfm_crosstab(table).collect()}
    assert set(got) == {("<10", "1-2"), ("10-30", "3-5"), ("120+", "1-2"), ("outside", "outside"), ("All", "All")}
    assert got[("All", "All")]["All"] == 4 and got[("10-30", "3-5")]["300-800"] == 1
    assert got[("outside", "outside")]["All"] == 1 and got[("120+", "1-2")]["<300"] == 1
    closed = {(r["recency_bucket"], r["frequency_bucket"]): r["All"] for r in customers.rfm_crosstab(table, open_end=False).collect()}
    assert closed == {("<10", "1-2"): 1, ("10-30", "3-5"): 1, ("outside", "outside"): 2, ("All", "All"): 4}
