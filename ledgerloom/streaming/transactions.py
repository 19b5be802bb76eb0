"""Cleaning and daily totals on a stream of raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.checks import require_columns
from ledgerloom.functions.numbers import money_sum
from ledgerloom.operators.cleaning import clean
from ledgerloom.schemas import RAW, RAW_COLUMNS
from ledgerloom.sources.stages import STANDARD_CSV


def read_transactions_stream(spark: SparkSession, folder: str, header: list[str] | None = None) -> DataFrame:
    """New CSV files of a folder as raw transaction lines, columns by name.

    ``header`` gives the columns in file order; without it the files already in
    the folder tell it. A later file with another header raises.
    """
    reader = spark.read.options(**STANDARD_CSV).option("encoding", "ISO-8859-1")
    names = header or reader.csv(folder).columns
    types = {field.name: field.dataType for field in RAW.fields}
    schema = T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in names])
    stream = spark.readStream.schema(schema).options(**STANDARD_CSV, enforceSchema=False).option("encoding", "ISO-8859-1")
    return require_columns(stream.csv(folder), RAW_COLUMNS, "raw data").select(*RAW_COLUMNS)


def clean_stream(raw: DataFrame) -> DataFrame:
    """The batch cleaning rules; they are row-wise and keep no state."""
    return clean(raw)


def daily_revenue_stream(cleaned: DataFrame, lateness: str = "1 day", error: float = 0.02) -> DataFrame:
    """Daily totals with a watermark.

    Distinct orders and customers are sketches here, so the state of a day has
    a fixed size however many lines it receives.
    """
    timed = cleaned.withColumn("event_time", F.col("InvoiceDate").cast("timestamp"))
    return (
        timed.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", "1 day"))
        .agg(
            money_sum("TotalPrice").alias("Revenue"),
            F.approx_count_distinct("InvoiceNo", error).alias("Orders"),
            F.sum("Quantity").alias("ItemsSold"),
            F.approx_count_distinct("CustomerID", error).alias("Customers"),
        )
        .select(F.col("window.start").cast("date").alias("InvoiceDate"), "Revenue", "Orders", "ItemsSold", "Customers")
    )


def write_stream(
    df: DataFrame, path: str, checkpoint: str, output_mode: str = "append"
) -> StreamingQuery:
    """Exactly-once parquet output of everything available, then stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode(output_mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
