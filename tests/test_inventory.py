from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.checks import check_demand_args, check_inventory_args
from ledgerloom.functions import text
from ledgerloom.functions.numbers import half_even
from ledgerloom.functions.retail import eoq, forecast_delta_pct
from ledgerloom.operators import inventory, reports
from ledgerloom.operators.filters import filter_country_dates
from ledgerloom.sources.stages import read_inventory_csv, write_inventory_csv

UK = "United Kingdom"


@pytest.mark.parametrize(
    "revenues, classes",
    [
        ([100, 20, 5], "ACC"),
        ([100, 30, 20, 10, 5], "AABCC"),
        ([1000, 1, 1], "ACC"),
        ([0, 0], "CC"),
        ([5], "A"),
    ],
)
def test_abc(spark, revenues, classes):
    skus = spark.createDataFrame([(f"S{i}", "d", float(r)) for i, r in enumerate(revenues)], "StockCode string, Description string, Revenue double")
    got = inventory.abc_classify(skus).orderBy("StockCode").collect()
    assert "".join(r["ABC"] for r in got) == classes


def test_abc_with_a_third_of_equal_revenues(spark):
    skus = spark.range(300).select(F.format_string("%04d", "id").alias("StockCode"), F.lit("d").alias("Description"), F.when(F.col("id") < 100, 50.0).otherwise(F.col("id") / 10.0).alias("Revenue"))
    rows = sorted(skus.collect(), key=lambda r: (-r["Revenue"], r["StockCode"]))
    total, run, want = sum(r["Revenue"] for r in rows), 0.0, {}
    for i, r in enumerate(rows):
        run += r["Revenue"]
        want[r["StockCode"]] = "A" if i == 0 or run <= 0.8 * total + 1e-9 else "B" if run <= 0.95 * total + 1e-9 else "C"
    got = {r["StockCode"]: r["ABC"] for r in inventory.abc_classify(skus).collect()}
    assert got == want


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_eoq_and_rounding(spark):
    assert one(spark, eoq(F.lit(1000.0), F.lit(4.0))) == pytest.approx(316.23, rel=1e-3)
    for args in [(0.0, 4.0), (10.0, 0.0)]:
        assert one(spark, eoq(*map(F.lit, args))) == 0.0
    assert one(spark, eoq(F.lit(1.0), F.lit(1.0), 0.0)) == 0.0 and one(spark, eoq(F.lit(1.0), F.lit(1.0), 50.0, 0.0)) == 0.0
    assert one(spark, half_even(F.lit(0.25), 1)) == 0.2 and one(spark, half_even(F.lit(0.35), 1)) == round(0.35 * 10) / 10
    assert one(spark, forecast_delta_pct(F.lit(5.0), F.lit(0.0))) == 0.0
    assert one(spark, forecast_delta_pct(F.lit(5.0), F.lit(4.0))) == 25.0


@pytest.mark.parametrize("value", [1834355.0, 1800.0, 12.0, -10350.0, 10350.0, 999.5, 999.7, 1.005e6, 2.675e6, -1234567.0, 0.5, 1.5, 1050.0, 123456789012.0])
def test_currency_like_printf(spark, value):
    size = abs(value)
    want = f"${value / 1e6:.2f}M" if size >= 1e6 else f"${value / 1e3:.1f}k" if size >= 1e3 else f"${value:,.0f}"
    assert one(spark, text.format_currency(F.lit(value))) == want
    assert one(spark, text.format_int(F.lit(value))) == f"{int(value):,}"


@pytest.fixture(scope="module")
def tx(make_tx):
    return make_tx(
        [
            ("i1", "S1", 10, "2011-06-01", 4.0, 1, UK),
            ("i2", "S1", 5, "2011-06-01", 2.0, 1, "France"),
            ("i3", "S2", 1, "2010-01-01", 3.0, 2, UK),
            ("i4", "00123", 2, "2011-05-01", 1.0, 2, UK),
        ]
    )


def test_inventory_table(tx):
    table = inventory.eoq_table(tx, reference_date="2011-07-01")
    got = {r["StockCode"]: r for r in table.collect()}
    assert got["S1"]["UnitsSold"] == 15 and got["S1"]["Revenue"] == 50.0 and got["S1"]["AvgUnitPrice"] == 3.0
    assert got["S1"]["IsDeadStock"] == 0 and got["S2"]["IsDeadStock"] == 1
    assert got["S1"]["LastSale"] == datetime(2011, 6, 1) and got["S1"]["OrderingCost"] == 50.0
    years = 517 / 365.25
    assert got["S1"]["AnnualDemand"] == round(15 / years, 1)
    metrics = inventory.inventory_metrics(table, tx).first().asDict()
    assert set(metrics) == {"n_skus", "n_class_a", "n_class_b", "n_class_c", "n_dead_stock", "dead_stock_pct", "total_revenue", "span_years"}
    assert metrics["n_skus"] == 3.0 and metrics["total_revenue"] == 55.0 and metrics["span_years"] == pytest.approx(years)


def test_null_description_leaves_the_table(spark, tx):
    holes = tx.withColumn("Description", F.when(F.col("StockCode") == "S2", None).otherwise(F.col("Description")))
    assert inventory.eoq_table(holes).where("StockCode = 'S2'").count() == 0


def test_csv_keeps_digit_codes(spark, tx, tmp_path):
    table = inventory.eoq_table(tx)
    write_inventory_csv(table, str(tmp_path / "inv"))
    back = read_inventory_csv(spark, str(tmp_path / "inv"))
    assert back.schema.simpleString() == table.schema.simpleString()
    assert back.exceptAll(table).count() == 0 and back.where("StockCode = '00123'").count() == 1


def test_reorder_views(tx):
    table = inventory.eoq_table(tx, reference_date="2011-07-01")
    assert [r["StockCode"] for r in inventory.reorder_list(table, 2, "ALL").collect()] == ["S1", "S2"]
    assert [r["StockCode"] for r in inventory.reorder_list(table, 5, "ALL", dead_stock_only=True).collect()] == ["S2", "00123"]
    view = inventory.reorder_table(table, filter_country_dates(tx, ["France"]), sort_by="Revenue").collect()
    assert [(r["StockCode"], r["CountryRevenue"]) for r in view] == [("S1", 10.0), ("S2", 0.0), ("00123", 0.0)]
    none = inventory.reorder_table(table, filter_country_dates(tx, ["Nowhere"])).collect()
    assert {r["CountryRevenue"] for r in none} == {0.0}
    assert {r["CountryRevenue"] for r in inventory.reorder_table(table).collect()} == {50.0, 3.0, 2.0}
    with pytest.raises(ValueError):
        inventory.reorder_table(table, sort_by="Description")


def test_argument_checks():
    for bad in [(0, "A"), (501, "A"), (1, "D")]:
        with pytest.raises(ValueError):
            check_inventory_args(*bad)
    for bad in (0, 366):
        with pytest.raises(ValueError):
            check_demand_args(bad)


def test_date_filter_ends(make_tx):
    tx = make_tx([("a", "S", 1, "2011-01-31T23:59:00", 1.0, 1, UK), ("b", "S", 1, "2011-02-01T00:00:00", 1.0, 1, UK)])
    end = date(2011, 1, 31)
    months = tx.withColumns({"year": F.year("InvoiceDate"), "month": F.month("InvoiceDate")})
    for table in (tx, months):
        assert filter_country_dates(table, end=end).count() == 1
        assert filter_country_dates(table, end=end, inclusive_midnight=True).count() == 2
        assert filter_country_dates(table, start=date(2011, 2, 1)).count() == 1


def test_kpis(make_tx, spark):
    tx = make_tx([("a", "S", 2, "2011-01-01", 1.5, 1, UK), ("a", "T", 1, "2011-01-01", 1.0, 1, UK), ("b", "T", 1, "2011-01-01", 2.0, 2, UK)])
    row = reports.kpi_summary(tx).first()
    assert tuple(row) == (6.0, 2, 2, 3.0)
    assert tuple(reports.kpi_summary(tx.limit(0)).first()) == (0.0, 0, 0, 0.0)
