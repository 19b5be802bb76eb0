"""XLSX transaction workbooks.

A workbook is a zip of XML sheets and cannot be split, and its format allows at
most 1,048,576 rows per sheet. Spark spreads the workbooks over tasks; a task
streams the rows of its sheets into Arrow batches.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.checks import require_columns
from ledgerloom.schemas import RAW, RAW_COLUMNS

# Fixed values of the OOXML spreadsheet format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
SHEET_FILE = re.compile(r"xl/worksheets/[^/]+\.xml")
DAY_ZERO = datetime(1899, 12, 30)

BATCH_ROWS = 10_000

# The reader travels to the executors by value; the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _texts(node: ElementTree.Element) -> str:
    return "".join(part.text or "" for part in node.iter(f"{MAIN}t"))


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag == f"{MAIN}si":
                found.append(_texts(node))
                node.clear()
    return found


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - ord("A") + 1
    return index - 1


def _cell_value(cell: ElementTree.Element, shared: list[str]) -> str | None:
    if cell.get("t") == "inlineStr":
        return _texts(cell)
    value = cell.findtext(f"{MAIN}v")
    if value is not None and cell.get("t") == "s":
        return shared[int(value)]
    return value


def _sheet_rows(book: zipfile.ZipFile, sheet: str, shared: list[str]) -> Iterator[dict[int, str | None]]:
    with book.open(sheet) as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag != f"{MAIN}row":
                continue
            cells = {}
            for position, cell in enumerate(node.iter(f"{MAIN}c")):
                reference = cell.get("r")
                cells[_column_index(reference) if reference else position] = _cell_value(cell, shared)
            yield cells
            node.clear()


def _excel_date(text: str | None) -> str | None:
    """A serial day number as ISO text; other text stays as it is."""
    try:
        serial = float(text)
    except (TypeError, ValueError):
        return text
    moment = DAY_ZERO + timedelta(seconds=round(serial * 86400))
    return moment.strftime("%Y-%m-%d %H:%M:%S")


def _plain_code(text: str | None) -> str | None:
    """A numeric identifier cell without its decimal part."""
    return text[:-2] if text and text.endswith(".0") and text[:-2].isdigit() else text


def _to_frame(rows: list[list[str | None]]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=RAW_COLUMNS, dtype=object)
    for name in ("InvoiceNo", "StockCode"):
        frame[name] = frame[name].map(_plain_code)
    frame["InvoiceDate"] = frame["InvoiceDate"].map(_excel_date)
    frame["Quantity"] = pd.to_numeric(frame["Quantity"], errors="coerce").astype("Int32")
    for name in ("UnitPrice", "CustomerID"):
        frame[name] = pd.to_numeric(frame[name], errors="coerce")
    return frame


def _read_books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as book:
                shared = _shared_strings(book)
                for sheet in sorted(n for n in book.namelist() if SHEET_FILE.fullmatch(n)):
                    yield from _read_sheet(book, sheet, shared)


def _read_sheet(book: zipfile.ZipFile, sheet: str, shared: list[str]) -> Iterator[pd.DataFrame]:
    rows = _sheet_rows(book, sheet, shared)
    header = {name: i for i, name in next(rows, {}).items()}
    absent = [c for c in RAW_COLUMNS if c not in header]
    if absent:
        raise ValueError(f"sheet {sheet} lacks required columns: {absent}")
    places = [header[c] for c in RAW_COLUMNS]
    pending = []
    for cells in rows:
        pending.append([cells.get(i) for i in places])
        if len(pending) >= BATCH_ROWS:
            yield _to_frame(pending)
            pending = []
    if pending:
        yield _to_frame(pending)


def read_transactions_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """All sheets of all workbooks below ``path``, concatenated."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{xlsx,XLSX}").load(path)
    raw = files.select("content").mapInPandas(_read_books, RAW)
    return require_columns(raw, RAW_COLUMNS, "workbooks")
