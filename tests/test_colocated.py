"""Interleaved order and bucketed tables."""

import random

import pytest
from helpers import tuples

from saleshouse.sources import colocated as co
from saleshouse.sources import layout

FACT = "sales_key bigint, date_key int, country_key int, product_key int, quantity int, total_amount decimal(12,2)"


@pytest.fixture(scope="module")
def fact(spark):
    """A year of sales; a third of the rows is of one country, a third of one product, some rows have no product."""
    rnd = random.Random(5)
    days = [20100100 + 100 * m + d for m in range(12) for d in range(1, 29)]
    rows = []
    for k in range(30_000):
        country = 7 if rnd.random() < 0.33 else rnd.randrange(1, 41)
        product = rnd.choices([3, None, rnd.randrange(1, 500)], [33, 10, 57])[0]
        rows.append((k, rnd.choice(days), country, product, rnd.randrange(1, 9), None))
    return spark.createDataFrame(rows, FACT).selectExpr("* EXCEPT (total_amount)", "CAST(quantity * 2.5 AS decimal(12,2)) AS total_amount")


def files_met(table, low, high, country):
    """Files whose ranges of both keys meet the filter, and all files: what a reader that knows each file's extremes opens."""
    ranges = {r.file: [r.low, r.high] for r in layout.file_ranges(table, "date_key").collect()}
    for r in layout.file_ranges(table, "country_key").collect():
        ranges[r.file] += [r.low, r.high]
    return sum(a <= high and low <= b and c <= country <= d for a, b, c, d in ranges.values()), len(ranges)


def test_a_country_over_a_year_skips_files(spark, fact, tmp_path):
    co.write_interleaved(fact, str(tmp_path / "both"), files=64)
    by_day = fact.repartitionByRange(64, "date_key", "country_key", "sales_key").sortWithinPartitions("date_key", "country_key", "sales_key")
    by_day.write.parquet(str(tmp_path / "day"))
    both, day = (spark.read.parquet(str(tmp_path / x)) for x in ("both", "day"))
    assert sorted(tuples(both)) == sorted(tuples(fact))
    for country in (2, 20, 39):
        met, every = files_met(both, 20100101, 20101231, country)
        assert every > 50 and met <= every / 4
        assert files_met(day, 20100101, 20101231, country)[0] >= every / 2
    assert files_met(both, 20100301, 20100305, 7)[0] <= every / 4  # the country of a third of the rows, within days
    got = {r.key: r for r in co.depths(both).collect()}
    single = {r.key: r for r in co.depths(day).collect()}
    assert set(got) == {"date_key", "country_key"} and got["country_key"].average_depth < single["country_key"].average_depth / 2


def test_interleaved_bits(spark):
    rows = [(a, b) for a in (0, 1, 2, 33, 63) for b in (0, 1, 5, 63)]
    df = spark.createDataFrame(rows, "a int, b int")
    for r in df.select("a", "b", co.interleaved(df.a, df.b).alias("z")).collect():
        assert r.z == sum((r.a >> k & 1) << 2 * k + 1 | (r.b >> k & 1) << 2 * k for k in range(co.BITS))


def test_interleaved_order_of_odd_tables(spark, fact, tmp_path):
    for n, df in enumerate([fact.limit(0), fact.selectExpr("* EXCEPT (country_key)", "CAST(null AS int) AS country_key"), fact.where("sales_key = 5")]):
        co.write_interleaved(df, str(tmp_path / str(n)))
        back = spark.read.schema(df.schema).parquet(str(tmp_path / str(n)))
        assert sorted(tuples(back), key=str) == sorted(tuples(df), key=str)


def test_bucketed_tables_join_without_a_shuffle(spark, fact, tmp_path):
    products = spark.createDataFrame([(k, f"c{k % 400}") for k in range(1, 500)], "product_key int, stock_code string")
    expected = co.sales_by(fact, products, "product_key", "stock_code")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = co.write_bucketed(fact, str(tmp_path / "fact"), "product_key", 8, "sales_key")
        dealt = co.write_bucketed(products, str(tmp_path / "products"), "product_key", 8)
        got = co.sales_by(sales, dealt, "product_key", "stock_code")
        plan = got._jdf.queryExecution().executedPlan().toString()
        # The one exchange is that of the reduced rows by stock code.
        assert "hashpartitioning(product_key" not in plan and plan.count("Exchange hashpartitioning") == 1, plan
        lines = sales.join(dealt, "product_key")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in lines, lines
        assert sorted(tuples(got)) == sorted(tuples(expected))
        assert sales.count() == fact.count() and sales.where("product_key is null").count() == fact.where("product_key is null").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    files = [p.name for p in (tmp_path / "fact").glob("*.parquet")]
    assert len(files) > 16  # a bucket is written by several tasks


def test_bucketed_empty_table(spark, fact, tmp_path):
    empty = co.write_bucketed(fact.limit(0), str(tmp_path / "none"), "product_key", 4)
    assert empty.count() == 0 and empty.columns == fact.columns
