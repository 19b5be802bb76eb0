"""Stage tables, report sidecars and model folders."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import INVENTORY

# Quotes inside a quoted value are doubled.
STANDARD_CSV = {"header": True, "quote": '"', "escape": '"'}


def write_stage(df: DataFrame, path: str, by_month: bool = False, mode: str = "overwrite") -> None:
    """Parquet table; ``by_month`` lays it out by year and month.

    The rebalance hint gathers each month into few files and lets AQE split a
    month that holds far more rows than the others; sorting inside a task gives
    row groups with narrow date ranges.
    """
    if not by_month:
        df.write.mode(mode).parquet(path)
        return
    dated = df.withColumns({"year": F.year("InvoiceDate"), "month": F.month("InvoiceDate")})
    (
        dated.hint("rebalance", "year", "month")
        .sortWithinPartitions("year", "month", "InvoiceDate")
        .write.mode(mode)
        .partitionBy("year", "month")
        .parquet(path)
    )


def _bucket_table(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.rstrip('/').encode()).hexdigest()[:16]}"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A table whose rows are dealt to ``buckets`` by ``keys`` and sorted within, so that joins and groups on them move no rows.

    The layout is kept beside the files, for sessions that do not know the table.
    """
    spark, name = df.sparkSession, _bucket_table(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    placed = df.repartition(buckets, *keys)
    placed.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    spark.createDataFrame([(list(keys), buckets)], "keys array<string>, buckets int").coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}__buckets")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed`` with its layout, whichever session wrote it."""
    name = _bucket_table(path)
    if not spark.catalog.tableExists(name):
        layout = spark.read.schema("keys array<string>, buckets int").json(f"{path.rstrip('/')}__buckets").first()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        keys = ", ".join(f"`{key}`" for key in layout["keys"])
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def publish(spark: SparkSession, staging: str, path: str) -> None:
    """Put a finished staging folder in the place of the published table.

    The old table is moved aside first and removed at the end; if the new one
    cannot take its place, it is moved back.
    """
    fs, source = _file_system(spark, staging)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old_{uuid.uuid4().hex}")
    replaces = fs.exists(target)
    if replaces:
        if not fs.rename(target, aside):
            raise OSError(f"could not move {path} aside")
    elif target.getParent() is not None:
        fs.mkdirs(target.getParent())
    moved = False
    try:
        moved = fs.rename(source, target)
    finally:
        if replaces and not moved:
            fs.rename(aside, target)
    if not moved:
        raise OSError(f"could not publish {staging} as {path}")
    if replaces:
        fs.delete(aside, True)


def write_json_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as JSON lines."""
    report.write.mode("overwrite").json(path)


def write_inventory_csv(table: DataFrame, path: str) -> None:
    columns = [field.name for field in INVENTORY.fields]
    table.select(*columns).write.mode("overwrite").options(**STANDARD_CSV, emptyValue='""').csv(path)


def read_inventory_csv(spark: SparkSession, path: str) -> DataFrame:
    """Declared types: an all-digit stock code stays text. An empty text is quoted, a null is not (so no text reads as null)."""
    return spark.read.schema(INVENTORY).options(**STANDARD_CSV, multiLine=True, nullValue="\x01", emptyValue="", mode="FAILFAST").csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
