"""Reports over a query log: one row per query that ran."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

_GB = 1024 * 1024 * 1024


def _recent(log: DataFrame, now: Column, hours: int, database: str | None) -> DataFrame:
    """Queries that ended in the last ``hours``."""
    ended = F.expr("timestampadd(MILLISECOND, total_elapsed_time, start_time)")
    since = now - F.make_dt_interval(F.lit(0), F.lit(hours))
    recent = log.where((ended >= since) & (F.col("start_time") <= now))
    return recent.where(F.col("database_name") == database) if database else recent


def _seconds(milliseconds: Column) -> Column:
    return C.ratio(milliseconds, F.lit(1000), 6)


def _gigabytes(size: Column) -> Column:
    return C.ratio(size, F.lit(_GB), 6)


def _succeeded(log: DataFrame) -> DataFrame:
    return log.where(F.col("execution_status") == "SUCCESS")


def slowest(log: DataFrame, now: Column, database: str | None = None, hours: int = 24, k: int = 20) -> DataFrame:
    top = _succeeded(_recent(log, now, hours, database)).orderBy(F.col("total_elapsed_time").desc(), "query_id").limit(k)
    return top.select(
        "query_id", "query_text", "database_name", "schema_name", "execution_status",
        _seconds(F.col("total_elapsed_time")).alias("execution_time_seconds"), "bytes_scanned", "rows_produced", "start_time",
    )


def most_scanned(log: DataFrame, now: Column, database: str | None = None, hours: int = 24, k: int = 10) -> DataFrame:
    top = _recent(log, now, hours, database).where("bytes_scanned > 0").orderBy(F.col("bytes_scanned").desc(), "query_id").limit(k)
    return top.select(
        "query_id", F.left("query_text", F.lit(100)).alias("query_snippet"),
        _seconds(F.col("total_elapsed_time")).alias("execution_time_seconds"),
        _gigabytes(F.col("bytes_scanned")).alias("gb_scanned"), "rows_produced",
    )


def by_user(log: DataFrame, now: Column, database: str | None = None, hours: int = 24) -> DataFrame:
    elapsed = F.col("total_elapsed_time")
    return (
        _succeeded(_recent(log, now, hours, database)).groupBy("user_name")
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            _seconds(F.sum(elapsed)).alias("total_execution_seconds"),
            C.ratio(F.sum(elapsed), F.count(elapsed) * 1000, 6).alias("avg_execution_seconds"),
            _gigabytes(F.sum("bytes_scanned")).alias("total_gb_scanned"),
        )
        .orderBy(F.col("total_execution_seconds").desc(), "user_name")
    )


def failed(log: DataFrame, now: Column, database: str | None = None, hours: int = 24, k: int = 20) -> DataFrame:
    rows = _recent(log, now, hours, database).where(F.col("execution_status") == "FAILED")
    return rows.orderBy(F.col("start_time").desc(), "query_id").limit(k).select(
        "query_id", "query_text", "error_code", "error_message", "start_time"
    )


def daily(log: DataFrame, now: Column, database: str | None = None, days: int = 30) -> DataFrame:
    recent = log.where((F.col("start_time") >= now - F.make_dt_interval(F.lit(days))) & (F.col("start_time") <= now))
    if database:
        recent = recent.where(F.col("database_name") == database)
    return (
        recent.groupBy(F.to_date("start_time").alias("query_date"))
        .agg(F.count(F.lit(1)).alias("daily_query_count"), _seconds(F.sum("total_elapsed_time")).alias("daily_execution_seconds"))
        .orderBy("query_date")
    )


def search(log: DataFrame, text: str, k: int = 5) -> DataFrame:
    found = log.where(F.col("query_text").contains(text)).orderBy(F.col("start_time").desc(), "query_id").limit(k)
    return found.select("query_id", "query_text", "total_elapsed_time", "bytes_scanned")


def compare(log: DataFrame, baseline: str, optimized: str) -> DataFrame:
    version = F.when(F.col("query_id") == baseline, "Baseline").otherwise("Optimized").alias("version")
    return log.where(F.col("query_id").isin(baseline, optimized)).select(version, "total_elapsed_time", "bytes_scanned")
