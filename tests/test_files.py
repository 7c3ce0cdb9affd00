import gzip
from datetime import datetime

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from saleshouse.sources import convert, files
from saleshouse.streaming import ingest

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
GOOD = "1,A,thing,1,2010-01-05 10:00:00,2.00,7,France\n"


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(HEADER + "".join(lines), encoding="utf-8")


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "my feed"
    write(folder, "a.csv", GOOD, '2,B,"red, big ""box""",NULL,null,,8,"Spain"\n', GOOD)
    write(folder, "b.csv", GOOD, "3,C,x,1,2010-01-05,1.00,7,France,extra\n", GOOD, "4,too,short\n", GOOD, GOOD)
    write(folder / "deep", "only-header.csv")
    (folder / "empty.csv").write_text("")
    (folder / "notes.txt").write_text("no data")
    return folder


def by_name(history):
    return {r.file_name.rsplit("/", 1)[1]: r for r in history.collect()}


def test_listing(spark, feed):
    assert {r.path.rsplit("/", 1)[1] for r in files.list_files(spark, str(feed), r".*\.csv").collect()} == {
        "a.csv", "b.csv", "only-header.csv",
    }


def test_copy(spark, feed):
    load = files.copy_csv(spark, str(feed))
    assert load.rows.count() == 7
    quoted = load.rows.where("invoice_no = '2'").first()
    assert (quoted.description, quoted.quantity, quoted.invoice_date, quoted.unit_price, quoted.country) == ('red, big "box"', None, None, None, "Spain")
    assert quoted.file_row_number == 2
    assert sorted(tuples(load.rejected, "row", "raw_text")) == [(2, "3,C,x,1,2010-01-05,1.00,7,France,extra"), (4, "4,too,short")]
    history = by_name(load.history)
    assert (history["a.csv"].status, history["a.csv"].row_count) == ("LOADED", 3)
    b = history["b.csv"]
    assert (b.status, b.row_count, b.row_parsed, b.error_count, b.first_error_line_number) == ("PARTIALLY_LOADED", 4, 6, 2, 2)
    assert (history["only-header.csv"].status, history["only-header.csv"].row_parsed) == ("LOADED", 0)
    # Spark's file sources pass over files without a single byte.
    assert "empty.csv" not in history


@pytest.mark.parametrize("policy,rows,status", [
    ("CONTINUE", 7, "PARTIALLY_LOADED"), ("SKIP_FILE", 3, "LOAD_FAILED"), ("SKIP_FILE_1", 3, "LOAD_FAILED"),
    ("SKIP_FILE_2", 7, "PARTIALLY_LOADED"), ("SKIP_FILE_33%", 3, "LOAD_FAILED"), ("SKIP_FILE_34%", 7, "PARTIALLY_LOADED"),
])
def test_policies(spark, feed, policy, rows, status):
    load = files.copy_csv(spark, str(feed), on_error=policy)
    assert load.rows.count() == rows and by_name(load.history)["b.csv"].status == status


def test_abort_and_unknown_policy(spark, feed):
    with pytest.raises(ValueError, match="bad row 2"):
        files.copy_csv(spark, str(feed), on_error="ABORT_STATEMENT")
    with pytest.raises(ValueError, match="unknown"):
        files.copy_csv(spark, str(feed), on_error="IGNORE")


def test_row_numbers_over_many_splits(spark, tmp_path):
    write(tmp_path / "big", "x.csv", *(f"{i},A,thing number {i},1,2010-01-05,2.00,7,France\n" for i in range(1, 3001)))
    write(tmp_path / "big", "y.csv", *(f"{i},A,other,1,2010-01-05,2.00,7,France\n" for i in range(1, 51)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        load = files.copy_csv(spark, str(tmp_path / "big"))
        scanned = files.scan_csv(spark, str(tmp_path / "big"))
        assert scanned.select("block").distinct().count() > 3
        assert load.rows.where(F.col("file_row_number") != F.col("invoice_no").cast("bigint")).count() == 0
        assert load.rows.count() == 3050
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_compressed(spark, tmp_path):
    with gzip.open(tmp_path / "z.csv.gz", "wt") as out:
        out.write(HEADER + GOOD)
    assert files.copy_csv(spark, str(tmp_path)).rows.count() == 1


def test_only_new_files(spark, feed):
    first = files.copy_csv(spark, str(feed)).history
    assert files.copy_new_csv(spark, str(feed), first) is None
    write(feed, "c d.csv", GOOD, GOOD)
    load = files.copy_new_csv(spark, str(feed), first)
    assert load.rows.count() == 2 and len(by_name(load.history)) == 1


def test_stream_reads_each_file_once(spark, feed, tmp_path):
    target, checkpoint = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    assert ingest.ingest_available(spark, str(feed), target, checkpoint, files_per_batch=1).count() == 7
    write(feed, "late.csv", GOOD)
    rows = ingest.ingest_available(spark, str(feed), target, checkpoint)
    assert rows.count() == 8
    assert sorted(r.file_row_number for r in rows.where("file_name like '%/b.csv'").collect()) == [1, 3, 5, 6]


def test_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame(
        [("1", "A", "x", 2, datetime(2010, 1, 5, 10), 1.5, 17850.0, "France"), ("2", "A", None, 1, None, 1.0, None, None)],
        ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"],
    ).coalesce(1).write.parquet(path)
    load = files.copy_parquet(spark, path)
    assert tuples(load.rows.orderBy("file_row_number"), "invoice_no", "quantity", "invoice_date", "customer_id", "file_row_number") == [
        ("1", "2", "2010-01-05 10:00:00", "17850.0", 1), ("2", "1", None, None, 2),
    ]
    assert load.history.first().row_count == 2
    assert files.preview_parquet(spark, path).count() == 2


def test_failed_loads(spark):
    rows = [("a", "LOAD_FAILED", 0, 1, 1, "m", 1, datetime(2020, 1, 9)), ("b", "LOAD_FAILED", 0, 1, 1, "m", 1, datetime(2020, 1, 1)),
            ("c", "LOADED", 1, 1, 0, None, None, datetime(2020, 1, 9))]
    history = spark.createDataFrame(rows, files.HISTORY_SCHEMA)
    now = F.lit("2020-01-10").cast("timestamp_ntz")
    assert [r.file_name for r in files.failed_loads(history, now).collect()] == ["a"]


def test_convert(spark, tmp_path):
    write(tmp_path / "in", "a.csv", *[GOOD] * 500, "2,B,x,3,2011-02-03 04:05:06,1.00,,Spain\n")
    report = convert.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    assert (report.row_count, report.column_count, report.unique_invoices, report.unique_products, report.unique_customers) == (501, 8, 2, 2, 1)
    assert (report.first_date, report.last_date) == ("2010-01-05 10:00:00", "2011-02-03 04:05:06")
    assert report.parquet_mb is not None and report.compression_pct > 0
    assert dict(spark.read.parquet(str(tmp_path / "out")).dtypes)["InvoiceDate"].startswith("timestamp")


def test_convert_keeps_dates_that_do_not_parse(spark, tmp_path):
    write(tmp_path / "in", "a.csv", GOOD, GOOD.replace("2010-01-05 10:00:00", "soon"))
    convert.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert dict(spark.read.parquet(str(tmp_path / "out")).dtypes)["InvoiceDate"] == "string"


def test_trace_range(spark, feed):
    rows = files.copy_csv(spark, str(feed)).rows
    name = rows.where("file_name like '%/b.csv'").first().file_name
    assert files.trace_rows(rows, name, 2, 5).count() == 2
