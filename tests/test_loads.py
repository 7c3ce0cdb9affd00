"""Load times that stay, a stored history, and files that are loaded again."""

import os
import time

from saleshouse.operators import storage
from saleshouse.plans import reports, staging
from saleshouse.sources import files

HEAD = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
GOOD = "1,A,thing,2,2010-01-05 10:00:00,3.00,7,France\n"
BAD = "1,A,thing,2,2010-01-05 10:00:00,3.00,7,France,extra\n"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEAD + "".join(lines))


def test_times_do_not_move(spark, tmp_path):
    write(tmp_path / "feed", "a.csv", GOOD)
    load = files.copy_csv(spark, str(tmp_path / "feed"))
    staged = staging.stg_orders(load.rows)
    read = lambda: (load.rows.first().load_timestamp, load.history.first().last_load_time, staged.first()._processed_at)
    first = read()
    time.sleep(1.2)
    assert read() == first and first[0] == first[1]


def test_failed_and_changed_files_are_loaded_again(spark, tmp_path):
    feed, table = tmp_path / "feed", str(tmp_path / "history")
    write(feed, "good.csv", GOOD)
    write(feed, "spoiled.csv", GOOD, BAD)
    assert files.stored_history(spark, table).count() == 0
    load = files.copy_new_csv(spark, str(feed), files.stored_history(spark, table), on_error="SKIP_FILE")
    assert load.rows.count() == 1
    files.record_history(load, table)

    write(feed, "spoiled.csv", GOOD, GOOD)  # repaired
    again = files.copy_new_csv(spark, str(feed), files.stored_history(spark, table), on_error="SKIP_FILE")
    assert again.rows.count() == 2 and {os.path.basename(r.file_name) for r in again.rows.collect()} == {"spoiled.csv"}
    files.record_history(again, table)
    assert files.copy_new_csv(spark, str(feed), files.stored_history(spark, table)) is None

    time.sleep(1.1)
    write(feed, "good.csv", GOOD, GOOD, GOOD)  # changed since its load
    assert files.copy_new_csv(spark, str(feed), files.stored_history(spark, table)).rows.count() == 3


def test_names_with_pattern_signs(spark, tmp_path):
    write(tmp_path / "feed", "c[1].csv", GOOD)
    write(tmp_path / "feed", "c{2}.csv", GOOD)
    write(tmp_path / "feed", "c1.csv", GOOD)
    history = files.copy_csv(spark, str(tmp_path / "feed" / "c1.csv")).history
    assert files.copy_new_csv(spark, str(tmp_path / "feed"), history).rows.count() == 2


def test_several_distinct_counts_without_expanding_rows(spark):
    fact = spark.createDataFrame(
        [("1", 1, 5, 9, 2, "3.00"), ("1", None, 6, 9, 1, "1.00")],
        "invoice_no string, customer_key bigint, product_key bigint, country_key bigint, quantity int, total string",
    ).selectExpr("*", "cast(total as decimal(12,2)) total_amount", "cast(total as decimal(10,2)) unit_price")
    report = reports.kpis(fact)
    row = report.first()
    assert (row.total_orders, row.active_customers, row.products_sold, row.countries_served) == (1, 1, 2, 1)
    assert "Expand" not in report._jdf.queryExecution().optimizedPlan().toString()


def test_work_folder_is_not_a_temporary_one(spark):
    assert storage.work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir"))
