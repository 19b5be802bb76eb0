"""Retail transactions derived from a star schema of order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.schemas import RAW_COLUMNS


_schemas: dict[tuple[str, int], StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; its schema is read again only after the path has changed."""
    path = f"{folder}/{name}.parquet"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    changed = target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getModificationTime()
    if (path, changed) not in _schemas:
        _schemas[path, changed] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path, changed]).parquet(path)


def spread_if_narrow(df: DataFrame, key: str) -> DataFrame:
    """Spread a table by key when it offers fewer scan tasks than there are cores.

    A small table in one file would keep a single core busy with all the work
    that follows. A table of many files or row groups is left as it is.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, key) if df.rdd.getNumPartitions() < tasks else df


def star_transactions(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """Raw transaction lines from lineitem and its dimensions.

    Dimensions hang on left joins over their unique keys, so a dimension that
    no requested column needs is left out of the plan altogether. Defects
    (cancelled invoices, missing customers, bad quantities and prices) follow
    from the keys.
    """
    wanted = list(columns or RAW_COLUMNS)
    lines = spread_if_narrow(table(spark, folder, "lineitem"), "l_orderkey")
    lines = lines.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "Description" in wanted:
        parts = table(spark, folder, "part").select("p_partkey", "p_name")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "Country" in wanted:
        # One after the other, so that each keeps its own size estimate and a
        # small supplier table is broadcast instead of shuffling the lines.
        suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
        nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
        lines = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        lines = lines.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    odd_part = F.col("l_partkey") % 50 == 0
    number = F.col("l_orderkey").cast("string")
    derived = {
        "InvoiceNo": F.when(returned, F.concat(F.lit("C"), number)).otherwise(number),
        "StockCode": F.col("l_partkey").cast("string"),
        "Description": F.col("p_name"),
        "Quantity": F.when(returned, -F.col("l_quantity"))
        .when((F.col("l_linenumber") == 2) & odd_part, F.lit(0.0))
        .otherwise(F.col("l_quantity"))
        .cast("int"),
        "InvoiceDate": F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(8) + F.col("l_linenumber")),
        "UnitPrice": F.when((F.col("l_linenumber") == 3) & odd_part, F.lit(0.0)).otherwise(
            F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("double") / 100.0
        ),
        "CustomerID": F.when(F.col("o_orderkey") % 50 == 0, None).otherwise(F.col("o_custkey").cast("double")),
        "Country": F.col("n_name"),
    }
    return lines.select(*[derived[name].alias(name) for name in wanted])


def event_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events as cleaned transactions of one line each."""
    events = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    return events.select(
        F.col("event_id").cast("string").alias("InvoiceNo"),
        F.col("user_id").cast("bigint").alias("CustomerID"),
        F.col("ts").cast("timestamp_ntz").alias("InvoiceDate"),
        F.col("value").alias("TotalPrice"),
    )
