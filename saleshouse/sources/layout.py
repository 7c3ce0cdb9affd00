"""Physical layout of the written tables: clustering, file pruning reports, point lookups, slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import monthly
from ..operators.monthly import MONTH
from ..operators.ordering import with_running_total
from ..operators.storage import CODEC


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH, F.expr("date_key div 100").cast("int"))


def clustered(fact: DataFrame, keys: tuple[str, ...] = ("date_key", "country_key"), spread: str = "sales_key") -> DataFrame:
    """Rows with their month, ordered by ``keys`` over all tasks, so that range filters skip folders and files.

    ``spread`` ends the range key: a day or country with much of the data still fills many files,
    and each task writes one month, or a few small ones.
    """
    return with_month(fact.repartitionByRange(*keys, spread).sortWithinPartitions(*keys, spread))


def write_clustered(fact: DataFrame, path: str, keys: tuple[str, ...] = ("date_key", "country_key"), spread: str = "sales_key") -> None:
    """Write ordered files to a new path, in one folder per month. For a table that is changed later, see `publish_clustered`."""
    clustered(fact, keys, spread).write.mode("overwrite").option("compression", CODEC).partitionBy(MONTH).parquet(path)


def publish_clustered(fact: DataFrame, base: str) -> monthly.Pointer:
    """Make ``fact`` the content of the table at ``base``, whose months can be replaced while it is read."""
    return monthly.publish(clustered(fact), base, surrogate="sales_key")


def month_filter(first: int, last: int) -> Column:
    """Day-key range that also prunes month folders."""
    return F.col("date_key").between(first, last) & F.col(MONTH).between(first // 100, last // 100)


def read_slice(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    return spark.read.parquet(path).where(month_filter(first, last)).drop(MONTH)


def reload_slice(spark: SparkSession, base: str, rows: DataFrame, first: int, last: int) -> DataFrame:
    """Replace the days ``first``..``last`` of a published fact; run twice, the result is the same.

    The months touched are read once and written beside the old ones; one pointer then switches readers. A reader that began before ends with the old rows; a job
    that dies leaves the old table, or, after the pointer, the new one.
    """
    now = monthly.pointer(spark, base)
    months = range(first // 100, last // 100 + 1)
    stored = monthly.read(spark, base, months[0], months[-1], now)
    in_range = F.col("date_key").between(first, last)
    content = stored.where(~in_range).drop(MONTH).unionByName(rows.where(in_range).select(*[c for c in stored.columns if c != MONTH]))
    new = monthly.publish(clustered(content), base, months, "sales_key", now)
    return monthly.read(spark, base, at=new).drop(MONTH)


def file_ranges(table: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key of each file of a table that is read from files."""
    return (
        table.groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(key).alias("low"), F.max(key).alias("high"))
        .where("low is not null")
    )


def depth(ranges: DataFrame) -> DataFrame:
    """How far files overlap on a key: 1.0 means every key value is in one file; aim below 5.

    ``average_overlaps``: other files that share part of a file's range, per file.
    ``average_depth``: files to read for a key value, over the values at which ranges start or end.
    A sweep over range starts and ends: two rows per file, never a pair of files.
    """
    starts = ranges.groupBy(F.col("low").alias("at")).agg(F.count(F.lit(1)).alias("opened"))
    ends = ranges.groupBy(F.col("high").alias("at")).agg(F.count(F.lit(1)).alias("closed"))
    points = starts.join(ends, "at", "full").select(
        "at", F.coalesce("opened", F.lit(0)).alias("opened"), F.coalesce("closed", F.lit(0)).alias("closed")
    )
    swept = points
    for column in ("opened", "closed"):
        swept = with_running_total(swept, [F.col("at")], column, f"{column}_upto")
    swept = swept.withColumns(
        {"opened_before": F.col("opened_upto") - F.col("opened"), "closed_before": F.col("closed_upto") - F.col("closed")}
    )
    # Each file overlaps those that opened earlier and are still open, and those opening with it;
    # every overlapping pair is met once, at the later of the two starts.
    open_now = F.col("opened_upto") - F.col("closed_before")
    still_open = F.col("opened_before") - F.col("closed_before")
    pairs = F.sum(F.col("opened") * still_open + F.expr("opened * (opened - 1) div 2"))
    files = F.sum("opened")
    return swept.agg(
        files.alias("files"),
        C.ratio(pairs * 2, files, 4).alias("average_overlaps"),
        C.ratio(F.sum(open_now), F.count(F.lit(1)), 4).alias("average_depth"),
    )


def write_point_lookup(dim: DataFrame, path: str, column: str) -> None:
    """Order by the column and add a Parquet Bloom filter, so an equality filter reads few row groups."""
    (
        dim.repartitionByRange(column)
        .sortWithinPartitions(column)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{column}", "true")
        .option("parquet.bloom.filter.max.bytes", str(1 << 20))
        .parquet(path)
    )


def point_lookup(spark: SparkSession, path: str, column: str, value: object) -> DataFrame:
    return spark.read.parquet(path).where(F.col(column) == value)


def substring_search(dim: DataFrame, column: str, text: str) -> DataFrame:
    return dim.where(F.col(column).contains(text))
