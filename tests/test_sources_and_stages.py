import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from ledgerloom.params import Params
from ledgerloom.plans import cli, stages
from ledgerloom.plans.stages import Layout, StageMissing
from ledgerloom.schemas import RAW_COLUMNS
from ledgerloom.sources import raw, star
from ledgerloom.sources.stages import read_stage, write_stage
from ledgerloom.sources.workbooks import read_transactions_workbooks
from ledgerloom.streaming import transactions as stream

HEADER = ",".join(RAW_COLUMNS)
LINE = '536365,85123A,"CAF\xc9, WHITE",6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom'
DATA = "/root/testdata/sf0.001"


def write_text(path, *lines):
    path.write_bytes("\n".join(lines).encode("latin-1"))


def test_csv_by_name_latin1_and_corrupt(spark, tmp_path):
    write_text(tmp_path / "a.csv", HEADER, LINE, "1,2")
    got = raw.read_transactions_csv(spark, str(tmp_path / "a.csv"), keep_corrupt=True).cache()
    first = got.where("InvoiceNo = '536365'").first()
    assert first["Description"] == "CAF\xc9, WHITE" and first["Quantity"] == 6 and first["CustomerID"] == 17850.0
    assert got.where("_corrupt_record is not null").count() == 1
    names = list(reversed(RAW_COLUMNS)) + ["Extra"]
    write_text(tmp_path / "b.csv", ",".join(names), "France,1.0,2.0,2010-12-01,3,x,007,9,more")
    row = raw.read_transactions_csv(spark, str(tmp_path / "b.csv")).first()
    assert (row["StockCode"], row["Quantity"], row["UnitPrice"], row["Extra"]) == ("007", 3, 2.0, "more")


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    write_text(tmp_path / "q.csv", HEADER, '1,A,"TEA ""ROSE"", SET\nOF 3",6,2010-12-01,2.5,7.0,France', "2,B,plain,1,2010-12-02,1.0,8.0,France")
    got = {r.InvoiceNo: r for r in raw.read_transactions_csv(spark, str(tmp_path / "q.csv")).collect()}
    assert set(got) == {"1", "2"} and got["1"].Description == 'TEA "ROSE", SET\nOF 3' and got["1"].Quantity == 6
    write_text(tmp_path / "bad.csv", HEADER, "1,2")
    with pytest.raises(Exception, match="MALFORMED"):
        raw.read_transactions_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_inventory_csv_keeps_texts(spark, tmp_path):
    from ledgerloom.schemas import INVENTORY
    from ledgerloom.sources.stages import read_inventory_csv, write_inventory_csv

    def row(code, text):
        given = {"StockCode": code, "Description": text}
        return tuple(given.get(f.name) for f in INVENTORY.fields)

    rows = [row("1", 'a "b", c'), row("2", "two\nlines"), row("3", "")]
    write_inventory_csv(spark.createDataFrame(rows, INVENTORY), str(tmp_path / "inv"))
    back = {r.StockCode: r.Description for r in read_inventory_csv(spark, str(tmp_path / "inv")).collect()}
    assert back == {"1": 'a "b", c', "2": "two\nlines", "3": ""}


def test_failed_publish_keeps_the_old_table(spark, tmp_path):
    from ledgerloom.sources.stages import publish

    old = str(tmp_path / "table")
    write_stage(spark.range(3), old)
    with pytest.raises(Exception):
        publish(spark, str(tmp_path / "never_written"), old)
    assert read_stage(spark, old).count() == 3
    write_stage(spark.range(5), str(tmp_path / "staged"))
    publish(spark, str(tmp_path / "staged"), old)
    assert read_stage(spark, old).count() == 5 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["table"]


def test_shared_folder_and_scopes(spark, tmp_path):
    from ledgerloom.session import cut_lineage, scratch_scope

    with scratch_scope(spark):
        with scratch_scope(spark):
            inner, kept = cut_lineage(spark.range(2)), cut_lineage(spark.range(3), outlive=True)
            gone = inner.inputFiles()[0]
        assert kept.count() == 3
        with pytest.raises(Exception):
            spark.read.parquet(gone).count()


def test_discovery_order(spark, tmp_path):
    for name in ("zz.csv", "aa.csv", "b.xls", "c.xlsx", "online_retail_ii.csv", "online_retail_II.xlsx", "notes.txt"):
        (tmp_path / name).write_text("")
    names = [s.name for s in raw.discover_raw_files(spark, str(tmp_path))]
    assert names == ["online_retail_II.xlsx", "online_retail_ii.csv", "c.xlsx", "aa.csv", "zz.csv"]
    assert raw.discover_raw_files(spark, str(tmp_path / "nowhere")) == []
    assert raw.detect_format("/x/A.CSV") == "csv"
    for name in ("a.parquet", "a.xls"):
        with pytest.raises(ValueError):
            raw.detect_format(name)


def test_load_raw_checks(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        raw.load_raw(spark, str(tmp_path))
    write_text(tmp_path / "x.csv", "InvoiceNo,StockCode", "1,2")
    with pytest.raises(ValueError, match="Country"):
        raw.load_raw(spark, str(tmp_path))
    write_text(tmp_path / "online_retail.csv", HEADER, LINE)
    assert raw.load_raw(spark, str(tmp_path)).count() == 1


def write_book(path, sheets, shared=()):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
        for n, rows in enumerate(sheets, 1):
            body = ""
            for r, row in enumerate(rows, 1):
                cells = ""
                for c, value in enumerate(row):
                    ref = f"{chr(65 + c)}{r}"
                    if value is None:
                        continue
                    if value in shared:
                        cells += f'<c r="{ref}" t="s"><v>{list(shared).index(value)}</v></c>'
                    elif isinstance(value, str):
                        cells += f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
                    else:
                        cells += f'<c r="{ref}"><v>{value}</v></c>'
                body += f'<row r="{r}">{cells}</row>'
            book.writestr(f"xl/worksheets/sheet{n}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks_concatenate_sheets(spark, tmp_path):
    one = [536365.0, "85123A", "A & B", 6, 40513.3513888889, 2.55, 17850, "United Kingdom"]
    two = ["C9", 22423, None, -2, "2010-12-02 10:00:00", 1.5, None, "France"]
    write_book(tmp_path / "online_retail_II.xlsx", [[RAW_COLUMNS, one], [RAW_COLUMNS, two, one]], ("United Kingdom", "InvoiceNo"))
    got = read_transactions_workbooks(spark, str(tmp_path)).orderBy("InvoiceNo").collect()
    assert len(got) == 3
    assert got[0][:6] == ("536365", "85123A", "A & B", 6, "2010-12-01 08:26:00", 2.55)
    assert got[2]["StockCode"] == "22423" and got[2]["CustomerID"] is None and got[2]["Quantity"] == -2
    assert raw.load_raw(spark, str(tmp_path)).count() == 3


def test_workbook_without_columns(spark, tmp_path):
    write_book(tmp_path / "a.xlsx", [[["InvoiceNo"], ["1"]]])
    with pytest.raises(Exception, match="lacks required columns"):
        read_transactions_workbooks(spark, str(tmp_path)).count()


def test_union_needs_the_same_columns(spark):
    with pytest.raises(Exception):
        raw.union_sources([spark.range(1), spark.range(1).toDF("other")]).count()


def test_monthly_layout_prunes(spark, tmp_path):
    from datetime import date

    from ledgerloom.operators.cleaning import clean
    from ledgerloom.operators.filters import filter_country_dates

    path = str(tmp_path / "cleaned")
    write_stage(clean(star.star_transactions(spark, DATA)), path, by_month=True)
    some = filter_country_dates(read_stage(spark, path), start=date(1999, 3, 5), end=date(1999, 4, 20))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThanOrEqual(InvoiceDate" in plan
    assert {(r["year"], r["month"]) for r in some.select("year", "month").distinct().collect()} == {(1999, 3), (1999, 4)}


def test_unused_dimensions_are_not_read(spark):
    plan = star.star_transactions(spark, DATA, ["InvoiceNo", "Quantity"])._jdf.queryExecution().executedPlan().toString()
    assert "part.parquet" not in plan and "supplier.parquet" not in plan and "l_shipdate" not in plan


# Stages


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    home = Layout(str(tmp_path_factory.mktemp("stages")))
    stages.run_data(spark, star.star_transactions(spark, DATA), home)
    return home


def test_stages_end_to_end(spark, layout):
    report = spark.read.json(layout.at("clean_report")).first()
    assert report["rows_out"] == read_stage(spark, layout.at("cleaned")).count() > 5000
    features = stages.run_features(spark, layout)
    assert len(features["timeseries_features"].columns) == 20  # the date and 19 features
    params = Params(home_country="NATION_9", n_init=1, k_max=5, churn_trees=3, enable_challenger=True)
    logged = stages.run_train(spark, layout, params)
    assert {r["model"] for r in logged.collect()} == set(stages.TRAINERS)
    assert {r["model"] for r in stages.run_promote(spark, layout).collect()} == set(stages.TRAINERS)
    assert read_stage(spark, layout.at("forecast")).count() == 30
    assert read_stage(spark, layout.at("churn_comparison")).count() == 2
    summary = stages.run_monitor(spark, layout).first()
    assert summary["n_columns"] == 6 and summary["n_reference"] + summary["n_current"] == report["rows_out"]


def test_missing_stages(spark, tmp_path):
    nothing = Layout(str(tmp_path))
    for stage in (stages.run_features, stages.run_train, stages.run_monitor):
        with pytest.raises(StageMissing):
            stage(spark, nothing)
    assert stages.run_promote(spark, nothing).count() == 0


def test_command_line(spark, tmp_path, capsys):
    base, folder = str(tmp_path / "base"), tmp_path / "raw"
    folder.mkdir()
    write_text(folder / "online_retail.csv", HEADER, LINE, LINE.replace("536365", "C1"))
    assert cli.main(["data", "--raw", str(folder), "--base", base]) == 0
    assert "cancelled_dropped=1" in capsys.readouterr().out
    assert cli.main(["features", "--base", base]) == 0
    assert cli.main(["promote", "--base", base]) == 0
    write_text(folder / "online_retail.csv", HEADER, LINE.replace("85123A", ""))
    assert cli.main(["data", "--raw", str(folder), "--base", str(tmp_path / "other")]) == 1
    assert "StockCode" in capsys.readouterr().err
    assert not (tmp_path / "other" / "cleaned").exists()
    assert cli.main(["monitor", "--base", str(tmp_path / "none")]) == 1


def test_params_from_settings(spark):
    spark.conf.set("spark.ledgerloom.lags", "1,2")
    spark.conf.set("spark.ledgerloom.max_rows", "none")
    spark.conf.set("spark.ledgerloom.holding_pct", "0.3")
    spark.conf.set("spark.ledgerloom.enable_challenger", "true")
    try:
        got = Params.from_spark(spark)
    finally:
        for name in ("lags", "max_rows", "holding_pct", "enable_challenger"):
            spark.conf.unset(f"spark.ledgerloom.{name}")
    assert (got.lags, got.max_rows, got.holding_pct, got.enable_challenger) == ((1, 2), None, 0.3, True)
    assert Params.from_spark(spark) == Params()


# Streams


def test_stream_agrees_with_batch(spark, tmp_path):
    from ledgerloom.operators.cleaning import clean
    from ledgerloom.operators.daily import daily_revenue

    shown = star.star_transactions(spark, DATA).withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    shown.coalesce(1).write.option("header", True).csv(str(tmp_path / "in"))
    raw_stream = stream.read_transactions_stream(spark, str(tmp_path / "in"))
    cleaned = stream.clean_stream(raw_stream)
    stream.write_stream(cleaned, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    batch = clean(shown)
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(batch).count() == 0
    days = stream.daily_revenue_stream(cleaned)
    stream.write_stream(days, str(tmp_path / "days"), str(tmp_path / "c2")).awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "days"))
    want = daily_revenue(batch, fill_missing_days=False)
    both = closed.alias("s").join(want.alias("b"), "InvoiceDate")
    assert closed.count() == both.count() > 1000
    assert both.where("s.Revenue <> b.Revenue or s.ItemsSold <> b.ItemsSold").count() == 0
