"""What goes through shuffles and into files: as few and as narrow rows as the results need."""

import re
from bisect import bisect_right
from datetime import datetime

import pytest
from helpers import Shop, line, tuples

from saleshouse import catalog
from saleshouse.operators import monthly, pairs, storage
from saleshouse.plans import fact, summaries
from saleshouse.sources import colocated, layout, tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Order tables of a few rows: a price beyond its type on a line without an order and on one of a product without price, no order date, no buyer."""
    base = str(tmp_path_factory.mktemp("orders"))
    day = datetime(1996, 5, 4)
    lines = [(1, 1, 1, 3.0, 10.5), (1, 2, 2, 1.0, 2.0), (2, 1, 1, 4.0, 7.25), (3, 97, 1, 1.0, 1e9), (9, 1, 1, 1.0, 1e9), (4, 2, 1, 2.0, None), (5, 1, 1, 6.0, 1.0), (None, 1, 1, 1.0, 1.0)]
    made = {
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"),
        "orders": ([(1, 1, day), (2, 2, datetime(1999, 1, 2)), (3, 1, day), (4, 4, None), (5, 7, day)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
        "part": ([(1, "blue ring"), (2, "old bolt"), (97, "cold plate")], "p_partkey bigint, p_name string"),
        "customer": ([(1, 3), (2, 24), (4, 5)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(3, "NATION_3", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "REGION_0")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def below(lines, pattern):
    """The lines of a plan below the first that fits."""
    at = next(n for n, text in enumerate(lines) if re.search(pattern, text))
    depth = re.search(r"[A-Za-z]", lines[at]).start()
    found = []
    for text in lines[at + 1:]:
        start = re.search(r"[A-Za-z]", text)
        if start and start.start() <= depth:
            break
        found.append(text)
    return "\n".join(found)


def test_customers_meet_orders_not_lines(spark, folder, no_broadcast):
    text = below(plan(tables.raw_transactions(spark, folder)), r"SortMergeJoin \[o_custkey")
    assert "c_custkey" in text and "l_partkey" not in text


def test_raw_rows_of_odd_tables(spark, folder):
    got = tables.raw_transactions(spark, folder).select("file_row_number", "quantity", "unit_price", "description", "country", "file_name")
    assert sorted(tuples(got)) == [
        (11, "3", "10.50", "blue ring", "NATION_3", "sales-1996.csv"),
        (12, "1", "2.00", "old bolt", "NATION_3", "sales-1996.csv"),
        (21, "4", "7.25", "blue ring", "NATION_24", "sales-1999.csv"),
        (31, "1", "n/a", "cold plate", "NATION_3", "sales-1996.csv"),
        (41, "2", None, "old bolt", "NATION_5", None),
    ]


def test_a_feed_of_one_kind_writes_that_kind_only(spark, folder):
    path = catalog.csv_feed(spark, folder)
    kinds = [key[2] for key in catalog._FEEDS if key[1] == folder]
    assert kinds == ["csv"] and path == catalog.csv_feed(spark, folder)
    rows = spark.read.option("header", "true").csv(path)
    assert sorted((r.Invoice, r.years) for r in rows.collect()) == [("1", "early"), ("1", "early"), ("2", "late"), ("3", "early")]
    assert [r.invoice_no for r in catalog._incremental(spark, folder).collect()] == ["2"]


def test_work_tables_are_compressed(spark, tmp_path):
    kept = storage.materialize(spark.range(5), "small")
    published = storage.publish(spark.range(5), str(tmp_path / "t"))
    assert all(".zstd." in name for df in (kept, published) for name in df.inputFiles())


def test_the_numbering_by_country_writes_only_the_facts_columns(spark, monkeypatch):
    seen = []
    number = fact.with_row_number
    monkeypatch.setattr(fact, "with_row_number", lambda df, *a: seen.append(df.columns) or number(df, *a))
    shop = Shop(spark, [line("1", customer="7", country="France"), line("2", customer="7", country="Spain"), line("3", customer=None)], "by_country")
    got = shop.fact.select("sales_key", "invoice_no").orderBy("sales_key").collect()
    assert [tuple(r) for r in got] == [(1, "1"), (2, "1"), (3, "2"), (4, "2"), (5, "3")]
    assert set(seen[-1]) == {"_source_row_id", "invoice_date_key", *fact.FACT_COLUMNS} - {"sales_key", "date_key"}


def test_part_numbers_are_compiled(spark):
    cuts = [3, 5, 9]
    rows = spark.createDataFrame([(k,) for k in (None, 1, 3, 4, 5, 8, 9, 20)], "k int").select("k", colocated.part_number("k", cuts).alias("p"))
    assert {r.k: r.p for r in rows.collect()} == {k: (0 if k is None else bisect_right(cuts, k) * 64 // 4) for k in (None, 1, 3, 4, 5, 8, 9, 20)}
    assert "lambda" not in "".join(plan(rows))


def test_the_interleaved_order_is_a_column(spark, tmp_path, monkeypatch):
    seen = []
    kind = type(spark.range(0))
    plain = kind.sortWithinPartitions
    monkeypatch.setattr(kind, "sortWithinPartitions", lambda df, *cols: seen.append(cols) or plain(df, *cols))
    rows = spark.range(50).selectExpr("id AS sales_key", "cast(id % 7 AS int) AS date_key", "id % 5 AS country_key")
    colocated.write_interleaved(rows, str(tmp_path / "t"))
    assert all(isinstance(c, str) for cols in seen for c in cols)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.columns == rows.columns and sorted(tuples(back)) == sorted(tuples(rows))


def test_baskets_of_one_block_meet_without_another_shuffle(spark, no_broadcast):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (None, 1), (3, None)], "b int, i int")
    found = pairs.frequent_pairs(rows, "b", "i", 1, None)
    text = "\n".join(plan(found))
    assert re.search(r"SortMergeJoin \[basket#\d+\w*\], \[basket#\d+\w*\], Inner, \(a#", text)
    assert sorted(tuples(found)) == [(1, 2, 2), (1, 3, 1), (2, 3, 1)]


def test_a_product_summary_does_not_multiply_its_rows(spark):
    shop = Shop(spark, [line("1"), line("1"), line("2", customer=None), line("3", code="B", customer="8"), line("4", code="B", customer=None)])
    summary = summaries.product_summary(shop.fact, shop.products, shop.categories, shop.dates)
    assert "Expand" not in "\n".join(plan(summary))
    got = summary.select("stock_code", "times_ordered", "unique_customers", "total_quantity_sold")
    assert sorted(tuples(got)) == [("A", 2, 1, 3), ("B", 2, 1, 2)]


def test_shuffle_files_of_written_tables_go_at_once(spark, tmp_path):
    """A table that is read from here on needs none of the shuffles that made it: they go as the write ends, before the driver collects garbage."""
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return sum(held.getAllBlocks().apply(k).toString().startswith("shuffle_") for k in range(held.getAllBlocks().size()))

    rows = spark.range(3000).selectExpr("id AS sales_key", "cast(19960101 + id % 28 + 100 * (id % 3) AS int) AS date_key", "cast(id % 5 AS int) AS country_key")
    before = shuffles()
    stored = storage.materialize(rows.groupBy("date_key").count(), "gone")
    published = storage.publish(rows.repartition(7, "country_key"), str(tmp_path / "table"))
    layout.publish_clustered(rows, str(tmp_path / "fact"))
    assert shuffles() <= before
    assert stored.count() == 84 and published.count() == monthly.read(spark, str(tmp_path / "fact")).count() == 3000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
