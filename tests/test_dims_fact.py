from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import Shop, line, tuples
from pyspark.sql import functions as F

from saleshouse.operators import scd2
from saleshouse.plans import dims, fact, staging
from saleshouse.sources import layout


def test_calendar(spark):
    days = dims.dim_date(spark, date(2009, 1, 1), date(2012, 12, 31))
    assert days.count() == 1461
    assert tuples(dims.date_span(days)) == [(date(2009, 1, 1), date(2012, 12, 31), 1461)]
    row = days.where("date_key = 20111225").first()
    assert (row.quarter, row.month_name, row.day_name, row.day_of_week, row.is_weekend) == (4, "Dec", "Sun", 0, True)
    assert [r.days_in_year for r in dims.date_years(days).collect()] == [365, 365, 365, 366]
    full = dims.dim_date(spark, date(2010, 6, 15), date(2010, 6, 15), names="full").first()
    assert (full.month_name, full.day_name) == ("June", "Tuesday")


def test_regions(spark):
    shop = Shop(spark, [line(country=c) for c in ("USA", "Japan", "Germany", "Australia", "Narnia")])
    assert tuples(shop.countries.orderBy("country_key"), "country_key", "country_name", "region") == [
        (1, "Australia", "Oceania"), (2, "Germany", "Europe"), (3, "Japan", "Asia"), (4, "Narnia", "Other"), (5, "USA", "Americas"),
    ]


def test_categories(spark):
    kinds = dims.dim_category(spark)
    assert dims.category_count(kinds).first()[0] == 8
    assert dims.category_listing(kinds).first() == (1, "General Merchandise")
    assert tuples(dims.default_category(kinds)) == [(1, "General Merchandise")]


def test_categorise_first_rule_wins(spark):
    shop = Shop(spark, [line(code=c, text=t) for c, t in [("1", "garden gift"), ("2", "Paper bag"), ("3", "pen"), ("4", "toy"), ("5", "rock")]])
    found = dict(tuples(dims.categorise(shop.products), "stock_code", "category_key"))
    assert found == {"1": 2, "2": 3, "3": 4, "4": 6, "5": 1}


def test_price_bands(spark):
    shop = Shop(spark, [line(code=p, price=p) for p in ("0.99", "1.00", "5.00", "5.01", "10.00", "20.00", "20.01")])
    assert dict(tuples(dims.product_price_bands(shop.products))) == {"Under £1": 1, "£1-£5": 2, "£5-£10": 2, "£10-£20": 1, "Over £20": 1}


MOVER = [
    line(invoice="1", day="2010-01-05 10:00:00", country="France"),
    line(invoice="2", day="2010-02-05 10:00:00", country="France"),
    line(invoice="3", day="2010-03-05 10:00:00", country="Germany"),
    line(invoice="4", day="2010-04-05 10:00:00", country="France"),
    line(invoice="5", day="2010-04-06 10:00:00", customer=None, country="Germany"),
]


def test_one_current_keeps_fact_rows(spark):
    shop = Shop(spark, MOVER)
    assert tuples(shop.customers.orderBy("customer_key"), "customer_id", scd2.FROM, scd2.TO, scd2.CURRENT) == [
        (7, datetime(2010, 1, 5), datetime(2010, 3, 5), False),
        (7, datetime(2010, 3, 5), datetime(2010, 4, 5), False),
        (7, datetime(2010, 4, 5), None, True),
    ]
    assert [r.row_count for r in fact.row_count_check(shop.fact, shop.stg).collect()] == [5, 5]
    assert shop.fact.select("sales_key").distinct().count() == 5


def test_by_country_fans_out(spark):
    shop = Shop(spark, MOVER, mode="by_country")
    assert sorted(tuples(shop.customers, "customer_key", "total_lifetime_orders", scd2.CURRENT)) == [(1, 3, True), (2, 1, True)]
    assert [r.row_count for r in fact.row_count_check(shop.fact, shop.stg).collect()] == [9, 5]
    assert sorted(r.sales_key for r in shop.fact.collect()) == list(range(1, 10))


def test_as_of_load_takes_the_version_of_the_day(spark):
    shop = Shop(spark, MOVER)
    loaded = fact.fact_sales_as_of(shop.stg, shop.customers, shop.products, shop.countries)
    assert sorted(tuples(loaded, "invoice_no", "customer_key"), key=str) == [("1", 1), ("2", 1), ("3", 2), ("4", 3), ("5", None)]


def test_interval_is_half_open(spark):
    shop = Shop(spark, MOVER)
    on_change_day = scd2.as_of(shop.customers, F.lit(datetime(2010, 3, 5)).cast("timestamp_ntz"))
    assert tuples(on_change_day, "customer_key") == [(2,)]


def test_latest_state_of_a_day_counts(spark):
    rows = [line(invoice="1", day="2010-01-05 10:00:00", country="France"), line(invoice="2", day="2010-01-05 11:00:00", country="Germany")]
    assert Shop(spark, rows).customers.count() == 1


def test_guests_do_not_share_a_join_key(spark):
    shop = Shop(spark, [line(invoice=str(i), customer=None) for i in range(50)])
    keys = shop.stg.select(fact._buyer_key(F.col("customer_id")).alias("k"))
    assert keys.distinct().count() > 40
    assert keys.agg(F.max("k")).first()[0] < -(1 << 31)
    assert shop.fact.where("customer_key is null").count() == 50


def test_lookup_failures_and_unknown_member(spark):
    shop = Shop(spark, [line(code="A"), line(code="B"), line(code=None), line(country=None)])
    products = shop.products.where("stock_code = 'A'")
    lost = fact.lookup_failures(shop.stg, products, shop.countries)
    assert sorted(r.reason for r in lost.collect()) == ["country not found", "product not found", "product not found"]
    kept = fact.fact_unknown_member(shop.stg, shop.customers, products, shop.countries)
    assert sorted(tuples(kept, "product_key", "country_key")) == [(-1, 1), (-1, 1), (1, -1), (1, 1)]
    assert fact.fact_sales(shop.stg, shop.customers, products, shop.countries).count() == 1


def test_orphans(spark):
    shop = Shop(spark, [line(code="A"), line(code="A"), line(code="B", customer=None)])
    assert fact.orphans(shop.fact, shop.products.where("stock_code = 'B'"), "product_key", "n").first().n == 2
    assert fact.orphans(shop.fact, shop.products, "product_key", "n").first().n == 0
    nobody = shop.customers.where("false")
    assert fact.orphans(shop.fact, nobody, "customer_key", "n", skip_null=True).first().n == 2


def test_date_outside_the_calendar_is_an_orphan(spark):
    shop = Shop(spark, [line(), line(day="2020-01-01 00:00:00")])
    assert shop.fact.count() == 2
    assert fact.orphans(shop.fact, shop.dates, "date_key", "n").first().n == 1
    wide = fact.newest_sales(shop.fact, shop.dates, shop.customers, shop.products, shop.categories, shop.countries)
    assert [r.year for r in wide.collect()] == [2010]


def test_newest_sales_equal_the_full_join(spark):
    shop = Shop(spark, [line(invoice=str(i), code=str(i % 4), customer=None if i % 3 else "7") for i in range(40)])
    products = shop.products.where("stock_code <> '3'")
    args = (shop.dates, shop.customers, products, shop.categories, shop.countries)
    top = tuples(fact.newest_sales(shop.fact, *args, k=7))
    assert top == tuples(fact.newest_sales(shop.fact, *args, k=None).orderBy(F.col("sales_key").desc()).limit(7))


# --- changes


def test_price_move_threshold_is_exclusive(spark):
    shop = Shop(spark, [line(code=c, price="100.00") for c in "ABCD"])
    new = spark.createDataFrame(
        [("A", Decimal("110.00")), ("B", Decimal("110.01")), ("C", Decimal("89.99")), ("X", Decimal("1.00"))], "stock_code string, unit_price decimal(10,2)"
    )
    assert sorted(r.stock_code for r in scd2.detect_price_moves(new, shop.products, "stock_code").collect()) == ["B", "C"]


def test_detect_is_null_safe(spark):
    dim = spark.createDataFrame([(1, "a", True), (2, None, True), (3, "c", False)], f"id int, country string, {scd2.CURRENT} boolean")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d"), (1, "b")], "id int, country string")
    assert sorted(tuples(scd2.detect_changes(new, dim, "id", ["country"])), key=str) == [(1, "b"), (3, "c"), (4, "d")]


def test_apply_closes_and_adds(spark):
    shop = Shop(spark, [line(customer="7"), line(customer="8")])
    changes = spark.createDataFrame([(7, 99), (50, 1)], "customer_id int, country_key bigint")
    out = scd2.apply(shop.customers, changes, "customer_id", "customer_key", F.lit("2011-01-01"))
    at = datetime(2011, 1, 1)
    assert sorted(tuples(out, "customer_key", "customer_id", "country_key", scd2.FROM, scd2.TO, scd2.CURRENT, "total_lifetime_orders")) == [
        (1, 7, 1, datetime(2010, 1, 5), at, False, 1),
        (2, 8, 1, datetime(2010, 1, 5), None, True, 1),
        (3, 7, 99, at, None, True, 1),
        (4, 50, 1, at, None, True, None),
    ]
    with pytest.raises(ValueError):
        scd2.apply(shop.customers, changes.union(changes), "customer_id", "customer_key", F.lit("2011-01-01"))


def test_merge(spark):
    shop = Shop(spark, [line(invoice="1", code="A"), line(invoice="1", code="A"), line(invoice="2", code="A")])
    target = shop.fact.drop("_loaded_at")
    source = target.where("invoice_no = '2'").drop("sales_key").withColumn("quantity", F.lit(9))
    new = source.withColumn("invoice_no", F.lit("3"))
    both = target.where("invoice_no = '1'").drop("sales_key").limit(1).withColumn("quantity", F.lit(5))
    merged = fact.merge(target, source.union(new).union(both))
    assert sorted(tuples(merged, "sales_key", "invoice_no", "quantity")) == [(1, "1", 5), (2, "1", 5), (3, "2", 9), (4, "3", 9)]
    with pytest.raises(ValueError):
        fact.merge(target, source.union(source))


def test_slice_reload(spark, tmp_path):
    days = ["2010-01-05", "2010-01-20", "2010-02-05", "2010-03-05"]
    shop = Shop(spark, [line(invoice=str(i), day=f"{d} 00:00:00") for i, d in enumerate(days)])
    path = str(tmp_path / "fact")
    layout.publish_clustered(shop.fact, path)
    new = shop.fact.where("date_key = 20100120").withColumn("quantity", F.lit(4))
    for _ in range(2):
        out = layout.reload_slice(spark, path, new, 20100110, 20100228)
        assert sorted(tuples(out, "date_key", "quantity")) == [(20100105, 1), (20100120, 4), (20100305, 1)]


def test_clustered_read_prunes_months(spark, tmp_path):
    shop = Shop(spark, [line(invoice=str(m), day=f"2010-0{m}-05 00:00:00") for m in range(1, 7)])
    path = str(tmp_path / "fact")
    layout.write_clustered(shop.fact, path)
    part = layout.read_slice(spark, path, 20100201, 20100331)
    assert part.count() == 2 and len(part.inputFiles()) <= 6
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan and "PushedFilters: [IsNotNull(date_key)" in plan


def test_doc_variant(spark):
    shop = Shop(spark, [line(invoice="2"), line(invoice="1"), line(customer=None), line(invoice="3", day="bad"), line(code="Z", quantity="-1")])
    out = fact.fact_doc_variant(staging.clean_only(shop.raw), shop.customers, shop.products, shop.dates)
    assert tuples(out.orderBy("sales_key"), "sales_key", "invoice_no", "date_key") == [(1, "3", None), (2, "1", 20100105), (3, "2", 20100105)]


def test_depth(spark):
    ranges = spark.createDataFrame([("a", 1, 5), ("b", 5, 9), ("c", 2, 7), ("d", 20, 30)], "file string, low int, high int")
    row = layout.depth(ranges).first()
    # a-b, a-c and b-c overlap: 6 ends over 4 files. Files open at 1, 2, 5, 7, 9, 20, 30: 1, 2, 3, 2, 1, 1, 1.
    assert (row.files, float(row.average_overlaps), float(row.average_depth)) == (4, 1.5, round(11 / 7, 4))


def test_load_message(spark):
    shop = Shop(spark, [line()])
    assert fact.load_message(shop.fact, "fact_sales").first().status == "fact_sales populated successfully with 1 rows"
    assert tuples(fact.load_counts({"a": shop.fact, "b": shop.dates})) == [("a", 1), ("b", 1826)]
