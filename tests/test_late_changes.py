"""Changes that come late: back-dated versions, moves to new countries, members the fact knows first."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import Shop, line, tuples
from pyspark.sql import functions as F

from saleshouse.operators import scd2
from saleshouse.plans import dims, fact

TRACKED = ["country"]
SHOWN = ["id", "country", scd2.FROM, scd2.TO, scd2.CURRENT]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "id int, country string, at timestamp_ntz")


def start(spark, rows):
    held = scd2.observations(rows_of(spark, rows), "id", "at", TRACKED)
    return scd2.versions(held, "id", TRACKED).withColumn("key", F.monotonically_increasing_id() + 1).select("key", *SHOWN)


def day(n):
    return datetime(2010, 1, 1) + timedelta(days=n)


def fixed(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("seed", [1, 2])
def test_deliveries_in_any_order_equal_one_build(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(5), rnd.choice(["A", "B", None]), day(rnd.randrange(12)) + timedelta(hours=rnd.randrange(3))) for _ in range(60)]
    rnd.shuffle(rows)
    pieces = [rows[:15], rows[15:20], rows[20:50], rows[50:]]
    rnd.shuffle(pieces)
    dim = fixed(spark, start(spark, pieces[0]))
    held = fixed(spark, scd2.observations(rows_of(spark, pieces[0]), "id", "at", TRACKED))
    for piece in pieces[1:]:
        dim, held = (fixed(spark, df) for df in scd2.deliver(dim, held, rows_of(spark, piece), "id", "key", "at", TRACKED))
        assert dim.select("key").distinct().count() == dim.count()
    want = scd2.build(rows_of(spark, rows), "id", "at", TRACKED)
    assert sorted(tuples(dim, *SHOWN), key=str) == sorted(tuples(want, *SHOWN), key=str)


def test_back_dated_rows(spark):
    rows = [(1, "A", day(1)), (1, "A", day(3)), (1, "B", day(6)), (2, "A", day(1))]
    observed = scd2.observations(rows_of(spark, rows), "id", "at", TRACKED)
    dim = spark.createDataFrame(
        [(1, 1, "A", day(1), day(6), False, "x"), (2, 1, "B", day(6), None, True, "y"), (3, 2, "A", day(1), None, True, "z")],
        f"key bigint, id int, country string, {scd2.FROM} timestamp_ntz, {scd2.TO} timestamp_ntz, {scd2.CURRENT} boolean, note string",
    )
    # A stay in C between two sightings in A splits the interval; A again on the day of B joins; a third key is new; no key, no time.
    late = [(1, "C", day(2)), (1, "A", day(6) + timedelta(hours=5)), (3, "C", day(4)), (None, "C", day(4)), (2, "C", None)]
    after, _ = scd2.deliver(dim, observed, rows_of(spark, late), "id", "key", "at", TRACKED)
    assert sorted(tuples(after)) == [
        (1, 1, "A", day(1), day(2), False, "x"),
        (3, 2, "A", day(1), None, True, "z"),
        (4, 1, "C", day(2), day(3), False, "y"),  # columns beyond the tracked ones from the key's last version
        (5, 1, "A", day(3), None, True, "y"),
        (6, 3, "C", day(4), None, True, None),
    ]
    assert tuples(scd2.dropped(dim, after, "key"), "key") == [(2,)]  # B was corrected within its day


def test_apply_with_several_current_rows(spark):
    shop = Shop(spark, [line(customer="7", country="France"), line(customer="7", country="Japan"), line(customer="8")], mode="by_country")
    before = shop.customers
    assert before.where("customer_id = 7").count() == 2
    changes = spark.createDataFrame([(7, 1, 99)], "customer_id int, country_key bigint, total_lifetime_orders int")
    out = scd2.apply(before, changes, ["customer_id", "country_key"], "customer_key", F.lit("2011-01-01"))
    assert sorted(tuples(scd2.current(out), "customer_id", "country_key", "total_lifetime_orders")) == [(7, 1, 99), (7, 2, 1), (8, 1, 1)]
    by_customer = changes.drop("country_key")  # the customer alone: both versions end, one new one begins
    out = scd2.apply(before, by_customer, "customer_id", "customer_key", F.lit("2011-01-01"))
    assert sorted(tuples(scd2.current(out), "customer_id", "total_lifetime_orders")) == [(7, 99), (8, 1)]


def test_new_countries_get_the_next_keys(spark):
    shop = Shop(spark, [line(country="France"), line(country="Japan")])
    names = spark.createDataFrame([("Peru",), ("Japan",), ("Chad",), ("Peru",), (None,)], "country_name string")
    got = dims.add_countries(shop.countries, names)
    assert sorted(tuples(got, "country_key", "country_name")) == [(1, "France"), (2, "Japan"), (3, "Chad"), (4, "Peru")]
    assert got.schema["country_key"].dataType == shop.countries.schema["country_key"].dataType
    assert dims.add_countries(shop.countries.limit(0), names).count() == 3


def test_reports_keep_unknown_rows(spark):
    shop = Shop(spark, [line(code="A"), line(code="B"), line(country="Japan")])
    products, countries = shop.products.where("stock_code = 'A'"), shop.countries.where("country_name = 'France'")
    sales = fact.fact_unknown_member(shop.stg, shop.customers, products, countries)
    assert sales.join(products, "product_key").count() == 2  # without the unknown row, lines are lost
    wide = sales.join(dims.products_with_unknown(products), "product_key").join(dims.countries_with_unknown(countries), "country_key")
    assert sorted(tuples(wide, "stock_code", "country_name")) == [("A", "France"), ("A", "Unknown"), ("Unknown", "France")]
    twice = dims.products_with_unknown(dims.products_with_unknown(products))
    assert twice.where("product_key = -1").count() == 1 and scd2.current(twice).count() == 2


def test_late_members_equal_a_full_load(spark):
    shop = Shop(spark, [line(code="A"), line(code="B"), line(code="C", country="Japan"), line(code="A", country="Peru"), line(code="D", customer=None)])
    products, countries = shop.products.where("stock_code = 'A'"), shop.countries.where("country_name = 'France'")
    before = fact.fact_unknown_member(shop.stg, shop.customers, products, countries)
    # Some members arrive, then all.
    some = dims.infer_products(products, shop.stg.where("stock_code <> 'D'"))
    partly = fact.repair_unknown(before, shop.stg, some, countries)
    assert fact.unknown_rows(partly).count() == 3 and partly.count() == 5
    every = dims.infer_products(some, shop.stg)
    places = dims.add_countries(countries, shop.stg.select(F.col("country").alias("country_name")))
    after = fact.repair_unknown(partly, shop.stg, every, places)
    full = fact.fact_sales(shop.stg, shop.customers, every, places)
    columns = [c for c in fact.FACT_COLUMNS]
    assert sorted(tuples(after, *columns), key=str) == sorted(tuples(full, *columns), key=str)
    assert fact.unknown_rows(after).count() == 0
    assert tuples(fact.repaired_rows(fact.unknown_rows(after), shop.stg, every, places)) == []


def test_inferred_products_are_filled_in_place(spark):
    shop = Shop(spark, [line(code="A", text="lamp"), line(code="B"), line(code="C")])
    known = shop.products.where("stock_code = 'A'")
    bare = dims.infer_products(known, shop.stg)
    assert sorted(tuples(bare, "product_key", "stock_code", "description"), key=str) == [(1, "A", "lamp"), (2, "B", None), (3, "C", None)]
    arrived = spark.createDataFrame([("B", "box"), ("A", "other")], "stock_code string, description string")
    done = dims.complete_products(bare, arrived)
    assert sorted(tuples(done, "product_key", "stock_code", "description"), key=str) == [(1, "A", "lamp"), (2, "B", "box"), (3, "C", None)]
    assert done.schema == bare.schema and done.where(scd2.CURRENT).count() == 3
    with pytest.raises(ValueError):
        dims.complete_products(bare, arrived.union(arrived))
