"""CSV to Parquet conversion with a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import list_files

_MB = 1024 * 1024


def _size(spark: SparkSession, path: str, pattern: str):
    return list_files(spark, path, pattern).agg(F.coalesce(F.sum("size"), F.lit(0))).scalar()


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, date_column: str = "InvoiceDate") -> DataFrame:
    """Write snappy Parquet with inferred types and return a one-row report.

    The date column becomes a timestamp when every value parses, and stays text otherwise.
    """
    source = (
        spark.read.option("header", "true").option("inferSchema", "true").option("escape", '"')
        .option("recursiveFileLookup", "true").csv(csv_path)
    )
    if dict(source.dtypes)[date_column] == "string":
        parsed = F.col(date_column).try_cast("timestamp_ntz")
        unparsed = source.where(F.col(date_column).isNotNull() & parsed.isNull()).limit(1)
        if unparsed.isEmpty():
            source = source.withColumn(date_column, parsed)
    source.write.mode("errorifexists").option("compression", "snappy").parquet(parquet_path)

    written = spark.read.parquet(parquet_path)
    report = written.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(written.columns)).alias("column_count"),
        F.min(date_column).cast("string").alias("first_date"),
        F.max(date_column).cast("string").alias("last_date"),
        F.count_distinct("Invoice").alias("unique_invoices"),
        F.count_distinct("StockCode").alias("unique_products"),
        F.count_distinct("`Customer ID`").alias("unique_customers"),
    )
    before, after = _size(spark, csv_path, ".*"), _size(spark, parquet_path, r".*\.parquet$")
    return (
        report.withColumn("csv_bytes", before)
        .withColumn("parquet_bytes", after)
        .withColumn("csv_mb", F.round(F.col("csv_bytes") / _MB, 2))
        .withColumn("parquet_mb", F.round(F.col("parquet_bytes") / _MB, 2))
        .withColumn("compression_pct", F.round((1 - F.col("parquet_bytes") / F.col("csv_bytes")) * 100, 1))
        .drop("csv_bytes", "parquet_bytes")
    )
