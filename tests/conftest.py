import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import build_session  # noqa: E402

TX_SCHEMA = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
    "UnitPrice double, CustomerID bigint, Country string, TotalPrice double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_tx(spark):
    """Cleaned lines from (invoice, stock, qty, date, price, customer, country)."""

    def make(rows):
        full = [
            (i, s, f"item {s}", q, datetime.fromisoformat(d), p, c, k, q * p) for i, s, q, d, p, c, k in rows
        ]
        return spark.createDataFrame(full, TX_SCHEMA)

    return make


@pytest.fixture(scope="session")
def make_raw(spark):
    def make(rows):
        from ledgerloom.schemas import RAW

        return spark.createDataFrame(rows, RAW)

    return make
