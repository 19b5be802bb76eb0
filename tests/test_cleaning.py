import pytest

from ledgerloom.checks import missing_columns, require_columns
from ledgerloom.operators import cleaning, quality

GOOD = ("536365", "A", "x", 4, "2010-12-01 08:26:00", 2.5, 17850.0, "United Kingdom")


def change(**new):
    names = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    return tuple(new.get(n, v) for n, v in zip(names, GOOD))


@pytest.mark.parametrize(
    "bad, counter",
    [
        ([change(InvoiceNo="C536365")], "cancelled_dropped"),
        ([change(InvoiceNo="c1")], "cancelled_dropped"),
        ([change(CustomerID=None)], "null_customer_dropped"),
        ([change(CustomerID=float("nan"))], "null_customer_dropped"),
        ([change(Quantity=0), change(Quantity=-6)], "nonpositive_quantity_dropped"),
        ([change(UnitPrice=0.0), change(UnitPrice=-1.0)], "nonpositive_price_dropped"),
        ([change(InvoiceDate="garbage")], "bad_date_dropped"),
    ],
)
def test_each_rule_drops_and_counts(make_raw, bad, counter):
    raw = make_raw([GOOD, *bad])
    assert cleaning.clean(raw).count() == 1
    report = cleaning.clean_report(raw).first().asDict()
    assert report.pop(counter) == len(bad)
    assert report.pop("rows_in") == 1 + len(bad) and report.pop("rows_out") == 1
    assert set(report.values()) == {0}


def test_first_broken_rule_is_charged(make_raw):
    raw = make_raw([change(InvoiceNo="C1", CustomerID=None, Quantity=-1, UnitPrice=0.0, InvoiceDate="?")])
    report = cleaning.clean_report(raw).first()
    assert report["cancelled_dropped"] == 1 and report["null_customer_dropped"] == 0


def test_types_total_and_null_survivors(make_raw):
    cleaned = cleaning.clean(make_raw([GOOD, change(Quantity=None), change(InvoiceNo=None)]))
    types = dict(cleaned.dtypes)
    assert types["InvoiceDate"] == "timestamp_ntz" and types["CustomerID"] == "bigint"
    rows = cleaned.orderBy("Quantity").collect()
    assert len(rows) == 3
    assert rows[0]["TotalPrice"] is None and rows[1]["TotalPrice"] == 10.0


def test_clean_and_labels_agree(make_raw):
    rows = [
        change(InvoiceNo=i, CustomerID=c, Quantity=q, UnitPrice=p, InvoiceDate=d)
        for i in ("1", "C1", None)
        for c in (1.0, None)
        for q in (1, 0, None)
        for p in (1.0, 0.0, None)
        for d in ("2010-12-01", "12/1/2010 8:26", "no", None)
    ]
    raw = make_raw(rows)
    kept = cleaning.label_rows(raw).where("drop_reason is null").count()
    assert cleaning.clean(raw).count() == kept > 0


def test_date_layouts(make_raw):
    dates = ["2010-12-01 08:26:00", "2010-12-01", "12/1/2010 8:26"]
    got = cleaning.clean(make_raw([change(InvoiceDate=d) for d in dates])).select("InvoiceDate").collect()
    assert sorted(str(r[0]) for r in got) == ["2010-12-01 00:00:00", "2010-12-01 08:26:00", "2010-12-01 08:26:00"]


def test_cleaning_filters_reach_the_scan(spark, make_raw, tmp_path):
    make_raw([GOOD]).write.parquet(str(tmp_path / "raw"))
    plan = cleaning.clean(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThan(Quantity,0)" in pushed and "IsNotNull(CustomerID)" in pushed
    assert "Exchange" not in plan


def test_required_columns(make_raw):
    raw = make_raw([GOOD])
    assert missing_columns(raw.drop("Country", "Quantity"), ["Quantity", "Country", "UnitPrice"]) == ["Country", "Quantity"]
    with pytest.raises(ValueError, match="Quantity"):
        cleaning.clean(raw.drop("Quantity"))
    assert require_columns(raw, ["Country"]) is raw


def test_expectations(make_raw):
    good = cleaning.clean(make_raw([GOOD, GOOD]))
    assert all(r["success"] for r in quality.validate_expectations(good).collect())
    bad = cleaning.clean(make_raw([GOOD, change(Quantity=None), change(StockCode=None), change(UnitPrice=0.001)]))
    failed = {(r["expectation"], r["column"]): r["unexpected"] for r in quality.validate_expectations(bad).where("not success").collect()}
    assert failed == {
        ("not_null", "Quantity"): 1,
        ("not_null", "StockCode"): 1,
        ("between", "UnitPrice"): 1,
        ("between", "TotalPrice"): 1,
    }
    empty = quality.validate_expectations(good.limit(0)).where("not success").collect()
    assert [r["expectation"] for r in empty] == ["row_count"]
    assert quality.failed_expectations(good, quality.default_suite(max_rows=1)) == ["row_count(): 1 of 2"]


def test_gate_writes_only_good_data(spark, make_raw, tmp_path):
    path, quarantine = str(tmp_path / "out"), str(tmp_path / "bad")
    bad = cleaning.clean(make_raw([GOOD, change(StockCode=None)]))
    with pytest.raises(quality.ValidationFailed, match="StockCode"):
        quality.gate_and_write(bad, path, quarantine)
    assert not (tmp_path / "out").exists()
    assert [p.name for p in tmp_path.iterdir()] == ["bad"]
    assert spark.read.parquet(quarantine).count() == 1
    for _ in range(2):
        quality.gate_and_write(cleaning.clean(make_raw([GOOD, GOOD])), path, quarantine)
        assert spark.read.parquet(path).count() == 2
