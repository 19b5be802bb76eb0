"""Raw transaction files: discovery, CSV and workbook readers."""

from __future__ import annotations

import warnings
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.checks import require_columns
from ledgerloom.schemas import RAW, RAW_COLUMNS
from ledgerloom.sources.stages import STANDARD_CSV
from ledgerloom.sources.workbooks import read_transactions_workbooks

# File names looked for first, best first.
PREFERRED_NAMES = (
    "online_retail_II.xlsx",
    "online_retail_ii.xlsx",
    "online_retail.xlsx",
    "online_retail.csv",
    "online_retail_II.csv",
    "online_retail_ii.csv",
)
SUFFIX_FORMATS = {".xlsx": "workbook", ".csv": "csv"}
SUFFIX_ORDER = (".xlsx", ".csv")
UNREADABLE = (".xls",)


def detect_format(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    suffix = "." + name.rsplit(".", 1)[-1] if "." in name else ""
    if suffix not in SUFFIX_FORMATS:
        raise ValueError(f"unknown raw file type {suffix!r}: {path}")
    return SUFFIX_FORMATS[suffix]


class RawSource(NamedTuple):
    rank: int
    name: str
    format: str
    path: str


def discover_raw_files(spark: SparkSession, folder: str) -> list[RawSource]:
    """Candidate sources of a folder, best first.

    Named candidates come in list order; others follow by suffix, then by name.
    A source may be one file or a folder of part files that carries the suffix.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        suffix = "." + name.rsplit(".", 1)[-1].lower()
        if suffix in UNREADABLE:
            warnings.warn(f"{name} is skipped: binary workbooks cannot be read", stacklevel=2)
        if suffix not in SUFFIX_FORMATS or name.startswith((".", "_")):
            continue
        if name in PREFERRED_NAMES:
            rank = PREFERRED_NAMES.index(name)
        else:
            rank = len(PREFERRED_NAMES) + SUFFIX_ORDER.index(suffix)
        found.append(RawSource(rank, name, SUFFIX_FORMATS[suffix], status.getPath().toString()))
    return sorted(found)


def read_transactions_csv(spark: SparkSession, path: str, keep_corrupt: bool = False, multi_line: bool = True) -> DataFrame:
    """Header CSV in latin-1; columns are found by name and typed as declared.

    Values may hold commas, doubled quotes and, with ``multi_line``, line
    breaks; a file is then read by one task, so a large table should come as
    many files, or without ``multi_line`` if no value has a line break. Only the
    header is looked at beforehand; a column without a declared type stays
    text. A malformed record raises, or is kept in ``_corrupt_record`` next to
    nulls with ``keep_corrupt``.
    """
    reader = spark.read.options(**STANDARD_CSV).option("encoding", "ISO-8859-1").option("multiLine", multi_line)
    header = reader.csv(path).columns
    types = {field.name: field.dataType for field in RAW.fields}
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    if keep_corrupt:
        fields.append(T.StructField("_corrupt_record", T.StringType()))
    typed = reader.schema(T.StructType(fields)).option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST").option("enforceSchema", False)
    return require_columns(typed.csv(path), RAW_COLUMNS, "raw data")


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """Concatenate sheets or files with the same columns."""
    return reduce(lambda left, right: left.unionByName(right), parts)


def load_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The best raw file of a folder, with its required columns checked."""
    candidates = discover_raw_files(spark, folder)
    if not candidates:
        raise FileNotFoundError(f"no raw transaction file in {folder}")
    best = candidates[0]
    reader = read_transactions_csv if best.format == "csv" else read_transactions_workbooks
    raw = reader(spark, best.path)
    return require_columns(raw, RAW_COLUMNS, "raw data")
