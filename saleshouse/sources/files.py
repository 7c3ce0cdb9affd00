"""Loading CSV and Parquet files into raw_transactions, with error policies and load history."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions.fixed_values import NULL_TOKENS, SOURCE_COLUMNS
from ..operators import storage
from ..operators.storage import fixed_now, materialize

RAW_COLUMNS = list(SOURCE_COLUMNS.values())
_BAD = "corrupt_text"
_CSV_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in [*RAW_COLUMNS, _BAD]])
# A doubled quote inside a quoted field stands for one quote.
_CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}

CSV_FILES = r".*\.csv(\.gz|\.bz2)?$"
PARQUET_FILES = r".*\.parquet$"

HISTORY_SCHEMA = (
    "file_name string, status string, row_count bigint, row_parsed bigint, error_count bigint, "
    "first_error_message string, first_error_line_number bigint, last_load_time timestamp_ntz"
)


@dataclass(frozen=True)
class Load:
    """Result of one load: rows for raw_transactions, rejected rows, and one history row per file."""

    rows: DataFrame
    rejected: DataFrame
    history: DataFrame


def _listing(spark: SparkSession, paths: str | list[str], pattern: str) -> DataFrame:
    """Files by path, and by the spelling their rows carry (``_metadata.file_path`` is URL-encoded)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select(
            "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
            F.col("_metadata.file_path").alias("file_name"),
        )
        .where(F.col("path").rlike(pattern))
    )


def list_files(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """Files below ``path`` whose path matches the regular expression; contents are not read."""
    return _listing(spark, path, pattern).drop("file_name")


def _null_tokens(column: str) -> Column:
    value = F.col(column)
    return F.when(~value.isin(NULL_TOKENS), value).alias(column)


def csv_reader(reader, multi_line: bool = False):
    """A batch or stream reader set up for the feed's CSV files.

    ``multi_line`` allows line breaks inside quoted fields; such files cannot be split, so leave it
    off unless the feed needs it.
    """
    return (
        reader.schema(_CSV_SCHEMA)
        .options(**_CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("multiLine", str(multi_line).lower())
    )


def with_origin(scanned: DataFrame) -> DataFrame:
    """Columns by position, null tokens removed, with the file and the split each row came from."""
    return scanned.select(
        *map(_null_tokens, RAW_COLUMNS),
        _BAD,
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def scan_csv(spark: SparkSession, paths: str | list[str], pattern: str = CSV_FILES, multi_line: bool = False) -> DataFrame:
    """All rows, good and bad. Files that do not match the pattern are not opened."""
    scanned = csv_reader(spark.read, multi_line).csv(paths)
    return with_origin(scanned.where(F.col("_metadata.file_path").rlike(pattern)))


def scan_parquet(spark: SparkSession, paths: str | list[str], pattern: str = PARQUET_FILES) -> DataFrame:
    """Columns by name, all as text."""
    paths = [paths] if isinstance(paths, str) else paths
    return (
        spark.read.option("recursiveFileLookup", "true").parquet(*paths)
        .where(F.col("_metadata.file_path").rlike(pattern))
        .select(
            *(F.col(f"`{source}`").cast("string").alias(name) for source, name in SOURCE_COLUMNS.items()),
            F.col("_metadata.file_path").alias("file_name"),
            (F.col("_metadata.row_index") + 1).alias("file_row_number"),
        )
    )


def _first(rows: DataFrame, n: int, ordered: bool) -> DataFrame:
    """Any n rows, or the first by all columns."""
    return (rows.orderBy(*RAW_COLUMNS) if ordered else rows).limit(n)


def preview_csv(spark: SparkSession, path: str, rows: int = 10, ordered: bool = False) -> DataFrame:
    return _first(scan_csv(spark, path).select(*RAW_COLUMNS, _BAD), rows, ordered).select(*RAW_COLUMNS)


def preview_parquet(spark: SparkSession, path: str, rows: int = 10, ordered: bool = False) -> DataFrame:
    return _first(scan_parquet(spark, path).select(*RAW_COLUMNS), rows, ordered)


def number_rows(scanned: DataFrame) -> DataFrame:
    """CSV rows with their row number in the file; the first row after the header is 1.

    Spark does not number CSV rows. A scan reads each file split in order, so ids taken during the
    scan give the position within the split; counting rows per split and summing the counts of the
    earlier splits of the same file gives the rest. The rows are written once, because both steps
    must see the same ids.
    """
    stored = materialize(scanned.withColumn("scan_id", F.monotonically_increasing_id()), "csv-scan")
    splits = stored.groupBy("file_name", "block").agg(F.min("scan_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    # One row per split of one file.
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file_name", "block", "first_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    starts = materialize(starts, "csv-splits")
    return (
        stored.join(starts, ["file_name", "block"])
        .withColumn("file_row_number", F.col("before") + F.col("scan_id") - F.col("first_id") + 1)
        .drop("block", "scan_id", "first_id", "before")
    )


def _skip_rule(policy: str) -> Column:
    """Condition on (error_count, row_parsed) under which a whole file is left out."""
    errors, parsed = F.col("error_count"), F.col("row_parsed")
    if policy == "CONTINUE":
        return F.lit(False)
    if policy in ("SKIP_FILE", "ABORT_STATEMENT"):
        return errors > 0
    match = re.fullmatch(r"SKIP_FILE_(\d+)(%?)", policy)
    if not match:
        raise ValueError(f"unknown error policy {policy!r}")
    limit = int(match[1])
    return errors * 100 > parsed * limit if match[2] else errors > limit


def apply_error_policy(parsed: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """Rows kept under the policy, and per-file counts with the decision taken.

    ``parsed`` has ``file_name``, ``file_row_number`` and the corrupt text of bad rows.
    """
    bad = F.col(_BAD).isNotNull()
    files = (
        parsed.groupBy("file_name")
        .agg(
            F.count(F.lit(1)).alias("row_parsed"),
            F.count_if(bad).alias("error_count"),
            F.min(F.when(bad, F.col("file_row_number"))).alias("first_error_line_number"),
        )
        .withColumn("skipped", _skip_rule(policy))
    )
    files = materialize(files, "file-counts")
    if policy == "ABORT_STATEMENT":
        first = files.where("skipped").orderBy("file_name").limit(1).collect()
        if first:
            raise ValueError(f"bad row {first[0].first_error_line_number} in {first[0].file_name}")
    good = parsed.where(~bad)
    if policy == "CONTINUE":
        return good, files
    skipped = files.where("skipped").select("file_name")
    return good.join(skipped, "file_name", "left_anti"), files


def _history(listed: DataFrame, files: DataFrame, at: Column) -> DataFrame:
    """Files without a single row (empty, or only a header) count as loaded with zero rows."""
    loaded = F.when(F.col("skipped"), 0).otherwise(F.col("row_parsed") - F.col("error_count"))
    status = (
        F.when(F.col("skipped") | ((F.col("error_count") > 0) & (loaded == 0)), "LOAD_FAILED")
        .when(F.col("error_count") > 0, "PARTIALLY_LOADED")
        .otherwise("LOADED")
    )
    zero = F.lit(0).cast("bigint")
    return listed.join(files, "file_name", "left").select(
        "file_name",
        status.alias("status"),
        F.coalesce(loaded, zero).alias("row_count"),
        F.coalesce("row_parsed", zero).alias("row_parsed"),
        F.coalesce("error_count", zero).alias("error_count"),
        F.when(F.col("error_count") > 0, F.lit("number of fields does not match")).alias("first_error_message"),
        "first_error_line_number",
        at.alias("last_load_time"),
    )


def as_raw(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows of raw_transactions, all with one load time that does not change between reads."""
    at = fixed_now(rows.sparkSession) if at is None else at
    return rows.select(*RAW_COLUMNS, at.alias("load_timestamp"), "file_name", "file_row_number")


def copy_csv(
    spark: SparkSession, paths: str | list[str], pattern: str = CSV_FILES, on_error: str = "CONTINUE", multi_line: bool = False
) -> Load:
    """Load CSV files into raw_transactions rows under an error policy."""
    at = fixed_now(spark)
    parsed = number_rows(scan_csv(spark, paths, pattern, multi_line))
    kept, files = apply_error_policy(parsed, on_error)
    return Load(as_raw(kept, at), failed_rows(parsed), _history(_listing(spark, paths, pattern), files, at))


def failed_rows(parsed: DataFrame) -> DataFrame:
    """Bad rows only; nothing is loaded."""
    return parsed.where(F.col(_BAD).isNotNull()).select(
        F.col("file_name").alias("file"),
        F.col("file_row_number").alias("row"),
        F.lit("number of fields does not match").alias("error"),
        F.col(_BAD).alias("raw_text"),
    )


def validate_csv(spark: SparkSession, paths: str | list[str], pattern: str = CSV_FILES, multi_line: bool = False) -> DataFrame:
    return failed_rows(number_rows(scan_csv(spark, paths, pattern, multi_line)))


def copy_parquet(spark: SparkSession, paths: str | list[str], pattern: str = PARQUET_FILES) -> Load:
    """Row numbers come with the files and are the same at every read, so the rows need no copy."""
    at = fixed_now(spark)
    rows = scan_parquet(spark, paths, pattern).withColumn(_BAD, F.lit(None).cast("string"))
    kept, files = apply_error_policy(rows, "CONTINUE")
    return Load(as_raw(kept, at), failed_rows(rows), _history(_listing(spark, paths, pattern), files, at))


def failed_loads(history: DataFrame, now: Column, days: int = 7) -> DataFrame:
    recent = F.col("last_load_time") >= now - F.make_dt_interval(F.lit(days))
    return history.where((F.col("status") == "LOAD_FAILED") & recent).orderBy(F.col("last_load_time").desc(), "file_name")


def new_files(spark: SparkSession, path: str, history: DataFrame, pattern: str = CSV_FILES) -> DataFrame:
    """Files below ``path`` that no earlier load has taken: unseen ones, failed ones, and those changed since their load."""
    loaded = history.where("status <> 'LOAD_FAILED'").groupBy("file_name").agg(F.max("last_load_time").alias("loaded_at"))
    changed = F.col("modified").cast("timestamp_ntz") > F.col("loaded_at")
    listed = _listing(spark, path, pattern).join(loaded, "file_name", "left")
    return listed.where(F.col("loaded_at").isNull() | changed).select("path")


def literal_path(path: str) -> str:
    """A path as a reader's pattern that fits this path alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def copy_new_csv(spark: SparkSession, path: str, history: DataFrame, pattern: str = CSV_FILES, on_error: str = "CONTINUE") -> Load | None:
    """Load only new files. The driver holds the new files' names, as any Spark reader's does."""
    names = [literal_path(row.path) for row in new_files(spark, path, history, pattern).toLocalIterator()]
    return copy_csv(spark, names, pattern, on_error) if names else None


def record_history(load: Load, path: str) -> None:
    """Append a load's history to the table that later loads ask."""
    load.history.write.mode("append").parquet(path)


def stored_history(spark: SparkSession, path: str) -> DataFrame:
    """All recorded loads; no rows before the first."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


# --- reports over raw_transactions


def trace_invoice(raw: DataFrame, invoice_no: str) -> DataFrame:
    return raw.where(F.col("invoice_no") == invoice_no).select("file_name", "file_row_number", "invoice_no")


def trace_rows(raw: DataFrame, file_name: str, first: int, last: int) -> DataFrame:
    return raw.where((F.col("file_name") == file_name) & F.col("file_row_number").between(first, last))


def load_batches(raw: DataFrame) -> DataFrame:
    return raw.groupBy(C.hour_start(F.col("load_timestamp")).alias("load_hour")).agg(F.count(F.lit(1)).alias("rows_loaded")).orderBy("load_hour")


def row_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct("file_name").alias("distinct_files"))


def null_counts(raw: DataFrame) -> DataFrame:
    checked = [c for c in RAW_COLUMNS if c != "description"]
    return raw.agg(F.count(F.lit(1)).alias("total_rows"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked))


def audit(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.min("load_timestamp").alias("earliest_load"),
        F.max("load_timestamp").alias("latest_load"),
        F.count_distinct("file_name").alias("file_count"),
        F.min("file_row_number").alias("min_row_number"),
        F.max("file_row_number").alias("max_row_number"),
    )


def sample(raw: DataFrame, rows: int = 10, ordered: bool = False) -> DataFrame:
    return _first(raw, rows, ordered)


def country_distribution(raw: DataFrame, k: int = 10) -> DataFrame:
    counts = raw.groupBy("country").agg(F.count(F.lit(1)).alias("transaction_count"))
    # Countries are not validated in raw, so their number has no bound: the total is a scalar, not a window.
    every = raw.agg(F.count(F.lit(1))).scalar()
    return (
        counts.withColumn("percentage", C.percent(F.col("transaction_count"), every))
        .orderBy(F.col("transaction_count").desc(), "country")
        .limit(k)
    )
