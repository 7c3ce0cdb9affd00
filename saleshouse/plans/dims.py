"""Calendar, country, category, customer and product dimensions, and the checks run on them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..operators import scd2
from ..operators.ordering import with_row_number


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _everything():
    """Window over a result of a few rows (regions, years, bands)."""
    return Window.partitionBy()


# --- calendar


def dim_date(spark: SparkSession, first: date, last: date, names: str = "short") -> DataFrame:
    """One row per day; at most a few tens of thousands of rows for any real range."""
    days = (last - first).days + 1
    if days < 1:
        raise ValueError("the calendar ends before it starts")
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    weekday = C.weekday_number(F.col("date"))
    return spark.range(days).select(day.alias("date")).select(
        C.date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        C.month_label(F.col("date"), names).alias("month_name"),
        F.dayofmonth("date").alias("day"),
        weekday.alias("day_of_week"),
        C.weekday_label(F.col("date"), names).alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def date_row_count(dates: DataFrame) -> DataFrame:
    return dates.agg(_n("total_rows"))


def date_span(dates: DataFrame) -> DataFrame:
    span = F.datediff(F.max("date"), F.min("date")) + 1
    return dates.agg(F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"), span.alias("total_days"))


def date_samples(dates: DataFrame, days: list[date]) -> DataFrame:
    wanted = dates.where(F.col("date").isin(days))
    return wanted.select("date_key", "date", "year", "quarter", "month_name", "day_name", "is_weekend").orderBy("date")


def date_weekend_split(dates: DataFrame) -> DataFrame:
    counts = dates.groupBy("is_weekend").agg(_n("day_count"))
    share = C.percent(F.col("day_count"), F.sum("day_count").over(_everything()))
    return counts.withColumn("percentage", share).orderBy("is_weekend")


def date_years(dates: DataFrame) -> DataFrame:
    return (
        dates.groupBy("year")
        .agg(_n("days_in_year"), F.min("date").alias("year_start"), F.max("date").alias("year_end"))
        .orderBy("year")
    )


# --- country


def literal_region(country: Column) -> Column:
    return C.first_match([(country.isin(names), region) for region, names in V.REGIONS.items()], V.OTHER_REGION)


def _placed(names: DataFrame, regions: DataFrame | None) -> DataFrame:
    if regions is None:
        return names.withColumn("region", literal_region(F.col("country_name")))
    return names.join(regions, "country_name", "left").withColumn("region", F.coalesce("region", F.lit(V.OTHER_REGION)))


def dim_country(stg: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Countries of valid rows, keyed by name order. ``regions`` replaces the built-in region rule."""
    names = stg.where(F.col("is_valid") & F.col("country").isNotNull()).select(F.col("country").alias("country_name")).distinct()
    keyed = with_row_number(_placed(names, regions), [F.col("country_name")], "country_key")
    return keyed.select("country_key", "country_name", F.lit(None).cast("string").alias("country_code"), "region")


def add_countries(countries: DataFrame, names: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """The dimension with the countries of ``names`` (country_name) that it lacks, under the next keys in name order."""
    unseen = names.select("country_name").where("country_name is not null").distinct().join(countries, "country_name", "left_anti")
    keyed = with_row_number(_placed(unseen, regions), [F.col("country_name")], "__n")
    last_key = countries.agg(F.coalesce(F.max("country_key"), F.lit(0))).scalar()
    kind = countries.schema["country_key"].dataType
    new = keyed.select((last_key + F.col("__n")).cast(kind).alias("country_key"), "country_name", F.lit(None).cast("string").alias("country_code"), "region")
    return countries.unionByName(new)


# --- members that the facts know before the dimension does


UNKNOWN = -1
UNKNOWN_NAME = "Unknown"


def with_unknown(dim: DataFrame, surrogate: str, **values: object) -> DataFrame:
    """The dimension with a row for the key -1, so that joins keep the facts whose lookup failed. ``values`` fill its columns; others are null."""
    given = {surrogate: UNKNOWN, scd2.CURRENT: True, **values}
    row = [F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    return dim.where(F.col(surrogate) != UNKNOWN).unionByName(dim.sparkSession.range(1).select(*row))


def products_with_unknown(products: DataFrame) -> DataFrame:
    return with_unknown(products, "product_key", stock_code=UNKNOWN_NAME, description=UNKNOWN_NAME, category_key=V.DEFAULT_CATEGORY)


def countries_with_unknown(countries: DataFrame) -> DataFrame:
    return with_unknown(countries, "country_key", country_name=UNKNOWN_NAME, region=V.OTHER_REGION)


def infer_products(products: DataFrame, stg: DataFrame) -> DataFrame:
    """The dimension with a bare row for each stock code of valid rows that no current product has: key, code and first day only.

    `complete_products` fills it when the product itself arrives; the key stays, so facts need no second repair.
    """
    unseen = (
        stg.where("is_valid and stock_code is not null").groupBy("stock_code").agg(F.to_date(F.min("invoice_date")).alias("first_sold_date"))
        .join(scd2.current(products).select("stock_code"), "stock_code", "left_anti")
    )
    numbered = with_row_number(unseen, [F.col("stock_code")], "__n")
    last_key = products.agg(F.coalesce(F.max("product_key"), F.lit(0).cast("bigint"))).scalar()
    known = {
        "product_key": last_key + F.col("__n"), "category_key": F.lit(V.DEFAULT_CATEGORY), scd2.FROM: F.col("first_sold_date").cast("timestamp_ntz"),
        scd2.CURRENT: F.lit(True), "stock_code": F.col("stock_code"), "first_sold_date": F.col("first_sold_date"),
    }
    return products.unionByName(numbered.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in products.schema.fields]))


def complete_products(products: DataFrame, arrived: DataFrame) -> DataFrame:
    """Bare rows filled from ``arrived`` (stock_code and any columns, one row a code): what is null takes the arrived value, nothing else changes."""
    scd2.reject_duplicates(arrived, ["stock_code"])
    given = [c for c in arrived.columns if c != "stock_code"]
    late = arrived.select("stock_code", F.struct(*given).alias("__late"))
    bare = F.col(scd2.CURRENT) & F.col("description").isNull() & F.col("unit_price").isNull() & F.col("__late").isNotNull()
    filled = {c: F.when(bare, F.coalesce(F.col(c), F.col(f"__late.{c}"))).otherwise(F.col(c)).cast(products.schema[c].dataType) for c in given}
    return products.join(late, "stock_code", "left").withColumns(filled).select(*products.columns)


def country_listing(countries: DataFrame) -> DataFrame:
    return countries.select("country_key", "country_name", "country_code", "region").orderBy("region", "country_name")


def countries_per_region(countries: DataFrame) -> DataFrame:
    return countries.groupBy("region").agg(_n("country_count")).orderBy(F.col("country_count").desc(), "region")


def find_country(countries: DataFrame, name: str) -> DataFrame:
    return countries.where(F.col("country_name") == name)


def unnamed_countries(countries: DataFrame) -> DataFrame:
    return countries.where(F.col("country_name").isNull()).agg(_n("null_countries"))


# --- category


def dim_category(spark: SparkSession) -> DataFrame:
    """The fixed categories. Built from literals, so Spark knows the table is tiny and broadcasts it."""
    rows = [
        F.struct(F.lit(key).cast("bigint").alias("category_key"), F.lit(name).alias("category_name"))
        for key, name in enumerate(V.CATEGORIES, start=1)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def category_listing(categories: DataFrame) -> DataFrame:
    return categories.orderBy("category_key")


def default_category(categories: DataFrame) -> DataFrame:
    return categories.where(F.col("category_key") == V.DEFAULT_CATEGORY)


def category_count(categories: DataFrame) -> DataFrame:
    return categories.agg(_n("total_categories"))


# --- customer

_CUSTOMER = [
    "customer_key", "customer_id", "country_key", "first_order_date", "last_order_date",
    "total_lifetime_orders", scd2.FROM, scd2.TO, scd2.CURRENT,
]


def dim_customer(stg: DataFrame, countries: DataFrame, mode: str = "one_current") -> DataFrame:
    """Customers of valid rows.

    ``one_current``: one version per stretch in one country and exactly one current version per
    customer, so the fact keeps one row per staging row; order dates and counts are the customer's.
    ``by_country``: one row per customer and country, all current. A customer with two countries
    then doubles their fact rows.
    """
    known = stg.where(F.col("is_valid") & F.col("customer_id").isNotNull())
    keys = ["customer_id", "country"] if mode == "by_country" else ["customer_id"]
    life = known.groupBy(*keys).agg(
        F.to_date(F.min("invoice_date")).alias("first_order_date"),
        F.to_date(F.max("invoice_date")).alias("last_order_date"),
        F.count_distinct("invoice_no").cast("int").alias("total_lifetime_orders"),
    )
    if mode == "by_country":
        versions = (
            life.withColumn(scd2.FROM, F.col("first_order_date").cast("timestamp_ntz"))
            .withColumn(scd2.TO, F.lit(None).cast("timestamp_ntz"))
            .withColumn(scd2.CURRENT, F.lit(True))
        )
    elif mode == "one_current":
        versions = scd2.build(known, "customer_id", "invoice_date", ["country"]).join(life, "customer_id")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    located = versions.join(countries.select("country_key", F.col("country_name").alias("country")), "country", "left")
    order = [F.col("customer_id"), F.col("country").asc_nulls_first()] if mode == "by_country" else [F.col("customer_id"), F.col(scd2.FROM)]
    return with_row_number(located, order, "customer_key").select(*_CUSTOMER)


def order_segment(orders: Column, label: int) -> Column:
    """``label`` 2 = segment name, 3 = report bucket."""
    rules = [(orders.between(low, high), row[label]) for row in V.ORDER_SEGMENTS if (low := row[0]) and (high := row[1])]
    return C.first_match(rules, V.ORDER_SEGMENTS[-1][label])


def customer_sample(customers: DataFrame, rows: int = 10) -> DataFrame:
    return customers.orderBy("customer_key").limit(rows)


def customers_by_currency(customers: DataFrame) -> DataFrame:
    return customers.groupBy(scd2.CURRENT).agg(_n("customer_count"))


def customer_segments(customers: DataFrame) -> DataFrame:
    segment = order_segment(F.col("total_lifetime_orders"), 2).alias("customer_segment")
    counts = customers.groupBy(segment).agg(_n("customer_count"), F.min("total_lifetime_orders").alias("least"))
    return counts.orderBy("least").drop("least")


def customers_by_country(customers: DataFrame, countries: DataFrame, k: int = 10) -> DataFrame:
    counts = scd2.current(customers).groupBy("country_key").agg(_n("customer_count"))
    named = counts.join(countries, "country_key").select("country_name", "region", "customer_count")
    return named.orderBy(F.col("customer_count").desc(), "country_name").limit(k)


def customers_without_country(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("country_key").isNull()).agg(_n("customers_without_country"))


def longest_customers(customers: DataFrame, k: int = 10) -> DataFrame:
    tenure = F.datediff("last_order_date", "first_order_date").alias("customer_tenure_days")
    return (
        scd2.current(customers)
        .select("customer_id", "total_lifetime_orders", "first_order_date", "last_order_date", tenure)
        .orderBy(F.col("total_lifetime_orders").desc(), "customer_id")
        .limit(k)
    )


# --- product


def dim_product(stg: DataFrame) -> DataFrame:
    """Products of valid rows: greatest description, mean price, first sale; default category."""
    first_day = F.to_date(F.min("invoice_date"))
    products = stg.where("is_valid and stock_code is not null").groupBy("stock_code").agg(
        F.max("description").alias("description"),
        C.mean(F.col("unit_price")).cast("decimal(10,2)").alias("unit_price"),
        first_day.alias("first_sold_date"),
    )
    return with_row_number(products, [F.col("stock_code")], "product_key").select(
        "product_key",
        "stock_code",
        "description",
        F.lit(V.DEFAULT_CATEGORY).cast("bigint").alias("category_key"),
        "unit_price",
        "first_sold_date",
        F.col("first_sold_date").cast("timestamp_ntz").alias(scd2.FROM),
        F.lit(None).cast("timestamp_ntz").alias(scd2.TO),
        F.lit(True).alias(scd2.CURRENT),
    )


def categorise(products: DataFrame, rules: list[tuple[list[str], int]] | None = None) -> DataFrame:
    """Category by keyword for current versions; the first matching rule wins."""
    text = F.upper("description")
    tests = []
    for words, key in rules or V.CATEGORY_KEYWORDS:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        tests.append((hit, key))
    chosen = C.first_match(tests, V.DEFAULT_CATEGORY).cast("bigint")
    return products.withColumn("category_key", F.when(F.col(scd2.CURRENT), chosen).otherwise(F.col("category_key")))


def price_band(price: Column) -> Column:
    under, to5, to10, to20, over = V.PRICE_BANDS
    return C.first_match(
        [(price < 1, under), (price.between(1, 5), to5), (price.between(5, 10), to10), (price.between(10, 20), to20)], over
    )


def product_sample(products: DataFrame, rows: int = 10) -> DataFrame:
    return products.orderBy("product_key").limit(rows)


def products_by_currency(products: DataFrame) -> DataFrame:
    return products.groupBy(scd2.CURRENT).agg(_n("product_count"))


def product_price_bands(products: DataFrame) -> DataFrame:
    band = price_band(F.col("unit_price")).alias("price_range")
    counts = scd2.current(products).groupBy(band).agg(_n("product_count"), F.min("unit_price").alias("least"))
    return counts.orderBy("least").drop("least")


def products_by_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    counts = scd2.current(products).groupBy("category_key").agg(_n("product_count"))
    named = counts.join(categories, "category_key").select("category_name", "product_count")
    return named.orderBy(F.col("product_count").desc(), "category_name")


def _top_products(products: DataFrame, by: str, k: int) -> DataFrame:
    shown = scd2.current(products).select("stock_code", "description", "unit_price", "first_sold_date")
    return shown.orderBy(F.col(by).desc(), "stock_code").limit(k)


def dearest_products(products: DataFrame, k: int = 10) -> DataFrame:
    return _top_products(products, "unit_price", k)


def newest_products(products: DataFrame, k: int = 10) -> DataFrame:
    return _top_products(products, "first_sold_date", k)


def products_without_description(products: DataFrame) -> DataFrame:
    empty = F.col("description").isNull() | (F.trim("description") == "")
    return products.where(empty).agg(_n("products_without_description"))
