"""Months are replaced beside the old ones, by one pointer; merge and reload touch only their months."""

import pytest
from helpers import Shop, line, tuples
from pyspark.sql import functions as F

from saleshouse.operators import monthly
from saleshouse.plans import fact, summaries
from saleshouse.sources import layout

DAYS = ["2010-01-05", "2010-01-20", "2010-02-05", "2010-03-05"]


@pytest.fixture
def table(spark, tmp_path):
    shop = Shop(spark, [line(invoice=str(i), day=f"{d} 00:00:00") for i, d in enumerate(DAYS)])
    base = str(tmp_path / "fact")
    layout.publish_clustered(shop.fact.drop("_loaded_at"), base)
    return shop, base


def days(df):
    return sorted(tuples(df, "date_key", "quantity"))


def files(spark, base):
    return {f.split("/sales_month=")[1] for f in monthly.read(spark, base).inputFiles()}


def test_a_reader_that_began_before_ends_with_the_old_rows(spark, table):
    shop, base = table
    before, old = monthly.read(spark, base), files(spark, base)
    layout.reload_slice(spark, base, shop.fact.where("date_key = 20100120").withColumn("quantity", F.lit(4)), 20100101, 20100131)
    assert days(before) == [(20100105, 1), (20100120, 1), (20100205, 1), (20100305, 1)]
    assert days(monthly.read(spark, base)) == [(20100120, 4), (20100205, 1), (20100305, 1)]
    assert {f for f in files(spark, base) if not f.startswith("201001")} == {f for f in old if not f.startswith("201001")}


def test_a_job_that_dies_leaves_the_old_table(spark, table, monkeypatch):
    shop, base = table
    new = shop.fact.where("date_key = 20100120").withColumn("quantity", F.lit(4))
    with monkeypatch.context() as patch:  # before its pointer

        def die(*_):
            raise KeyboardInterrupt

        patch.setattr(monthly, "_point", die)
        with pytest.raises(KeyboardInterrupt):
            layout.reload_slice(spark, base, new, 20100101, 20100131)
    assert days(monthly.read(spark, base)) == [(20100105, 1), (20100120, 1), (20100205, 1), (20100305, 1)]
    # Half way through its pointer.
    fs, path = monthly._filesystem(spark, monthly._name(base, 2))
    stream = fs.create(path)
    stream.write(bytearray(b'{"months": {"201'))
    stream.close()
    assert monthly.pointer(spark, base).number == 1
    assert days(layout.reload_slice(spark, base, new, 20100101, 20100131)) == [(20100120, 4), (20100205, 1), (20100305, 1)]
    assert monthly.pointer(spark, base).number == 3
    monthly.vacuum(spark, base)
    assert days(monthly.read(spark, base)) == [(20100120, 4), (20100205, 1), (20100305, 1)]
    assert monthly._pointers(spark, base) == [3]


def test_two_writers(spark, table):
    shop, base = table
    begun = monthly.pointer(spark, base)
    rows = monthly.read(spark, base, 201002, 201002, begun).withColumn("quantity", F.lit(7))
    layout.reload_slice(spark, base, shop.fact.where("date_key = 20100205"), 20100201, 20100228)
    with pytest.raises(monthly.ChangedMeanwhile):
        monthly.publish(rows, base, [201002], based_on=begun)
    with pytest.raises(monthly.ChangedMeanwhile):
        monthly._point(spark, base, monthly.pointer(spark, base))
    assert days(monthly.read(spark, base, 201002, 201002)) == [(20100205, 1)]


def test_rows_of_other_months_are_refused(spark, table):
    _, base = table
    with pytest.raises(ValueError):
        monthly.publish(monthly.read(spark, base), base, [201001])


def test_a_table_without_rows(spark, table, tmp_path):
    shop, base = table
    out = layout.reload_slice(spark, base, shop.fact.limit(0), 20100101, 20101231)
    assert out.count() == 0 and out.columns == shop.fact.drop("_loaded_at").columns
    assert days(layout.reload_slice(spark, base, shop.fact, 20100101, 20101231)) == [(20100105, 1), (20100120, 1), (20100205, 1), (20100305, 1)]
    with pytest.raises(FileNotFoundError):
        monthly.read(spark, str(tmp_path / "nothing"))


def test_merge_touches_its_months_only(spark, table):
    shop, base = table
    old = files(spark, base)
    held = shop.fact.drop("_loaded_at")
    source = held.where("date_key = 20100205").drop("sales_key").withColumn("quantity", F.lit(9))
    more = source.withColumn("invoice_no", F.lit("N")).withColumn("date_key", F.lit(20100207))
    merged = fact.merge_months(spark, base, source.unionByName(more))
    want = fact.merge(held, source.unionByName(more))
    shown = [c for c in held.columns if c != "sales_key"]
    assert sorted(tuples(merged, *shown)) == sorted(tuples(want, *shown))
    assert merged.select("sales_key").distinct().count() == 5
    assert merged.where("invoice_no = 'N'").first().sales_key > 4  # after the greatest key ever given out
    assert {f for f in files(spark, base) if not f.startswith("201002")} == {f for f in old if not f.startswith("201002")}
    # Keys of rows that are gone are not given out again.
    layout.reload_slice(spark, base, shop.fact.limit(0), 20100201, 20100228)
    high = monthly.pointer(spark, base).high
    again = fact.merge_months(spark, base, more)
    assert again.where("invoice_no = 'N'").first().sales_key > high >= 5
    with pytest.raises(ValueError):
        fact.merge_months(spark, base, source.union(source))
    assert fact.merge_months(spark, base, source.limit(0)).count() == 4


def test_merge_of_several_rows_of_a_key_and_a_new_month(spark, tmp_path):
    shop = Shop(spark, [line(invoice="1", code="A"), line(invoice="1", code="A"), line(invoice="2", code="A")])
    base, target = str(tmp_path / "fact"), shop.fact.drop("_loaded_at")
    layout.publish_clustered(target, base)
    both = target.where("invoice_no = '1'").drop("sales_key").limit(1).withColumn("quantity", F.lit(5))
    late = both.withColumn("invoice_no", F.lit("9")).withColumn("date_key", F.lit(20110301))
    merged = fact.merge_months(spark, base, both.unionByName(late))
    assert sorted(tuples(merged, "invoice_no", "date_key", "quantity")) == [("1", 20100105, 5), ("1", 20100105, 5), ("2", 20100105, 1), ("9", 20110301, 5)]


def test_daily_months_are_replaced_at_once(spark, table, tmp_path):
    shop, base = table
    daily = str(tmp_path / "daily")
    summaries.publish_daily(summaries.daily_sales(shop.fact, shop.dates), daily)
    before = summaries.read_daily(spark, daily)
    layout.reload_slice(spark, base, shop.fact.where("date_key = 20100205").withColumn("quantity", F.lit(4)), 20100120, 20100228)
    after = summaries.refresh_daily(spark, daily, monthly.read(spark, base), shop.dates, 20100120, 20100228)
    full = summaries.daily_sales(monthly.read(spark, base).drop(monthly.MONTH), shop.dates)
    assert sorted(tuples(after, *full.columns)) == sorted(tuples(full)) and after.count() == 3
    assert before.count() == 4
