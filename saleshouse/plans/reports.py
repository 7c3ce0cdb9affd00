"""Business reports and query patterns over the fact.

Each report reduces the fact by key first and joins the large dimensions (customer, product) to the
reduced rows. The calendar is joined to the fact directly: a few thousand rows are far below the
size up to which Spark broadcasts by itself, so that join costs no shuffle. No join is forced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import scd2
from ..operators.ordering import exact_percentiles
from ..sources.layout import month_filter
from . import dims


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _orders(name: str) -> Column:
    return F.count_distinct("invoice_no").alias(name)


def _revenue(name: str = "total_revenue") -> Column:
    return F.sum("total_amount").alias(name)


def _mean_line(name: str = "avg_line_item_value") -> Column:
    return C.mean(F.col("total_amount")).alias(name)


def dated(fact: DataFrame, dates: DataFrame, *attributes: str) -> DataFrame:
    """Fact rows with calendar attributes; days outside the calendar drop out."""
    return fact.join(dates.select("date_key", *attributes), "date_key")


def _whole(value: str):
    """Total over a result of a few rows (types, buckets)."""
    return F.sum(value).over(Window.partitionBy())


# --- by country, time, product, customer


def by_country(fact: DataFrame, countries: DataFrame, k: int = 10) -> DataFrame:
    sums = fact.groupBy("country_key").agg(
        _n("order_lines"), F.sum("quantity").alias("total_units_sold"), _revenue(), _mean_line(), _orders("distinct_orders")
    )
    named = sums.join(countries.select("country_key", "country_name"), "country_key").drop("country_key")
    return named.select("country_name", *[c for c in named.columns if c != "country_name"]).orderBy(
        F.col("total_revenue").desc(), "country_name"
    ).limit(k)


def by_region(fact: DataFrame, countries: DataFrame) -> DataFrame:
    sums = fact.groupBy("country_key").agg(_n("lines"), _revenue("revenue"), F.count("total_amount").alias("amounts"))
    return (
        sums.join(countries, "country_key").groupBy("region")
        .agg(
            F.count_distinct("country_name").alias("countries_in_region"),
            F.sum("lines").alias("order_lines"),
            F.sum("revenue").alias("total_revenue"),
            C.ratio(F.sum("revenue"), F.sum("amounts"), 2).alias("avg_line_item_value"),
        )
        .orderBy(F.col("total_revenue").desc(), "region")
    )


def by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        dated(fact, dates, "year", "quarter", "month", "month_name").groupBy("year", "quarter", "month", "month_name")
        .agg(_revenue("monthly_revenue"), _orders("order_count"), _n("line_item_count"), _mean_line())
        .orderBy("year", "month")
    )


def by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        dated(fact, dates, "year").groupBy("year")
        .agg(_revenue("annual_revenue"), _orders("total_orders"), F.count_distinct("customer_key").alias("active_customers"))
        .withColumn("avg_order_value", C.ratio(F.col("annual_revenue"), F.col("total_orders"), 2))
        .orderBy("year")
    )


def day_type(weekend: Column) -> Column:
    return F.when(weekend, "Weekend").otherwise("Weekday")


def by_weekend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    sums = dated(fact, dates, "is_weekend").groupBy("is_weekend").agg(
        _n("order_lines"), _revenue(), _mean_line(), _orders("order_count")
    )
    shown = [c for c in sums.columns if c != "is_weekend"]
    return sums.select("is_weekend", day_type(F.col("is_weekend")).alias("day_type"), *shown).orderBy("is_weekend")


def _products(fact: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per current product: a stock code has one current version."""
    sums = fact.groupBy("product_key").agg(
        F.sum("quantity").alias("total_units_sold"),
        C.mean(F.col("unit_price")).alias("avg_selling_price"),
        _revenue(),
        _orders("orders_containing_product"),
    )
    named = scd2.current(products).join(categories, "category_key").select("product_key", "stock_code", "description", "category_name")
    return named.join(sums, "product_key").drop("product_key")


def products_by_revenue(fact: DataFrame, products: DataFrame, categories: DataFrame, k: int = 10) -> DataFrame:
    return _products(fact, products, categories).orderBy(F.col("total_revenue").desc(), "stock_code").limit(k)


def products_by_units(fact: DataFrame, products: DataFrame, categories: DataFrame, k: int = 10) -> DataFrame:
    return _products(fact, products, categories).orderBy(F.col("total_units_sold").desc(), "stock_code").limit(k)


def by_category(fact: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    # Orders per category must be counted once, so the category joins before the count.
    filed = fact.join(scd2.current(products).select("product_key", "category_key"), "product_key")
    sums = filed.groupBy("category_key").agg(
        F.count_distinct("product_key").alias("product_count"),
        F.sum("quantity").alias("total_units_sold"),
        _revenue(),
        _mean_line(),
        _orders("orders_containing_category"),
    )
    named = categories.join(sums, "category_key").drop("category_key")
    return named.orderBy(F.col("total_revenue").desc(), "category_name")


def top_customers(fact: DataFrame, customers: DataFrame, countries: DataFrame, k: int = 10) -> DataFrame:
    sums = fact.where("customer_key is not null").groupBy("customer_key").agg(
        F.sum("quantity").alias("total_units_purchased"), _revenue("total_lifetime_value"), _mean_line(), _orders("orders_in_period")
    )
    named = (
        scd2.current(customers).select("customer_key", "customer_id", "country_key", "total_lifetime_orders")
        .join(countries.select("country_key", "country_name"), "country_key")
        .select("customer_key", "customer_id", "country_name", "total_lifetime_orders")
    )
    return named.join(sums, "customer_key").drop("customer_key").orderBy(F.col("total_lifetime_value").desc(), "customer_id").limit(k)


def order_buckets(customers: DataFrame) -> DataFrame:
    bucket = dims.order_segment(F.col("total_lifetime_orders"), 3).alias("order_count_bucket")
    counts = scd2.current(customers).groupBy(bucket).agg(
        F.count_distinct("customer_id").alias("customer_count"), F.min("total_lifetime_orders").alias("least")
    )
    share = C.percent(F.col("customer_count"), _whole("customer_count"))
    return counts.withColumn("percent_of_customers", share).orderBy("least").drop("least")


def guests_against_registered(fact: DataFrame) -> DataFrame:
    kind = F.when(F.col("customer_key").isNull(), "Guest Transaction").otherwise("Registered Customer")
    sums = fact.groupBy(kind.alias("customer_type")).agg(_n("order_lines"), _orders("order_count"), _revenue(), _mean_line())
    share = C.percent(F.col("total_revenue"), _whole("total_revenue"))
    return sums.withColumn("percent_of_revenue", share).orderBy(F.col("total_revenue").desc())


def by_sign(fact: DataFrame) -> DataFrame:
    kind = F.when(F.col("quantity") < 0, "Returns/Refunds").when(F.col("quantity") == 0, "Zero Quantity (Data Issue)")
    sums = fact.groupBy(kind.otherwise("Normal Sales").alias("transaction_type")).agg(_n("row_count"), _revenue("total_amount"))
    return sums.withColumn("percent_of_rows", C.percent(F.col("row_count"), _whole("row_count"))).orderBy(F.col("row_count").desc())


def price_stats(fact: DataFrame) -> DataFrame:
    """Lowest and highest price with their row counts, mean and median, from one count per price."""
    prices = fact.groupBy("unit_price").agg(F.count(F.lit(1)).alias("n"))
    median = exact_percentiles(fact, "unit_price", {"median": "0.5"}).scalar()
    known = F.col("unit_price").isNotNull()
    lowest = F.min(F.when(known, F.struct("unit_price", "n")))
    highest = F.max(F.when(known, F.struct("unit_price", "n")))
    total = F.sum(F.col("unit_price") * F.col("n"))
    stats = prices.agg(
        lowest.alias("low"), highest.alias("high"), C.ratio(total, F.sum(F.when(known, F.col("n"))), 2).alias("mean")
    ).select("*", F.round(median, 2).alias("median"))
    none = F.lit(None).cast("bigint")
    rows = [
        ("Minimum Price", F.col("low.unit_price"), F.col("low.n")),
        ("Maximum Price", F.col("high.unit_price"), F.col("high.n")),
        ("Average Price", F.col("mean"), none),
        ("Median Price", F.col("median"), none),
    ]
    structs = [
        F.struct(F.lit(text).alias("metric"), value.cast("decimal(22,2)").alias("value"), n.alias("row_count")) for text, value, n in rows
    ]
    return stats.select(F.inline(F.array(*structs)))


def key_nulls(fact: DataFrame) -> DataFrame:
    keys = {"Date Key": "date_key", "Customer Key": "customer_key", "Product Key": "product_key", "Country Key": "country_key"}
    counts = fact.agg(_n("n"), *(F.count(key).alias(key) for key in keys.values()))
    rows = [
        F.struct(
            F.lit(name).alias("dimension"), F.col("n").alias("total_rows"), F.col(key).alias("non_null_count"),
            (F.col("n") - F.col(key)).alias("null_count"),
        )
        for name, key in keys.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def kpis(fact: DataFrame) -> DataFrame:
    return (
        fact.agg(
            _revenue(),
            _mean_line(),
            _n("total_line_items"),
            F.sum("quantity").alias("total_units_sold"),
            F.count_if(F.col("customer_key").isNull()).alias("guest_transactions"),
        )
        .select(
            "*",
            C.number_of(fact, "invoice_no").alias("total_orders"),
            C.number_of(fact, "customer_key").alias("active_customers"),
            C.number_of(fact, "product_key").alias("products_sold"),
            C.number_of(fact, "country_key").alias("countries_served"),
        )
        .withColumn("avg_order_value", C.ratio(F.col("total_revenue"), F.col("total_orders"), 2))
        .withColumn("avg_items_per_order", C.ratio(F.col("total_line_items"), F.col("total_orders"), 2))
        .withColumn("revenue_per_customer", C.ratio(F.col("total_revenue"), F.col("active_customers"), 2))
    )


# --- query patterns


def customer_or_guest(fact: DataFrame, customers: DataFrame) -> DataFrame:
    sums = fact.groupBy("customer_key").agg(_revenue("revenue"))
    named = sums.join(customers.select("customer_key", "customer_id"), "customer_key", "left")
    # The id is cast first: an int and a text have no common type.
    who = F.coalesce(F.col("customer_id").cast("string"), F.lit("GUEST")).alias("customer")
    return named.groupBy(who).agg(F.sum("revenue").alias("revenue"))


def order_count(fact: DataFrame) -> DataFrame:
    return fact.agg(_orders("order_count"))


def order_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("invoice_no").agg(_revenue("order_total"))


def by_quarter(fact: DataFrame, dates: DataFrame) -> DataFrame:
    sums = dated(fact, dates, "year", "quarter").groupBy("year", "quarter").agg(_revenue("quarterly_revenue"))
    return sums.orderBy("year", "quarter")


def by_geography(fact: DataFrame, countries: DataFrame) -> DataFrame:
    sums = fact.groupBy("country_key").agg(_revenue("revenue"))
    named = sums.join(countries, "country_key").groupBy("region", "country_name").agg(F.sum("revenue").alias("revenue"))
    return named.orderBy(F.col("revenue").desc(), "country_name")


def _per_current_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    sums = fact.where("customer_key is not null").groupBy("customer_key").agg(_revenue("revenue"))
    return scd2.current(customers).join(sums, "customer_key")


def customers_by_region(fact: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Through the customer's country, not the country of the sale."""
    return (
        _per_current_customer(fact, customers).join(countries, "country_key").groupBy("region", "country_name")
        .agg(F.count_distinct("customer_key").alias("customer_count"), F.sum("revenue").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), "country_name")
    )


def customers_per_region(customers: DataFrame, countries: DataFrame) -> DataFrame:
    placed = customers.join(countries.select("country_key", "region"), "country_key")
    return placed.groupBy("region").agg(F.count_distinct("customer_id").alias("customer_count")).orderBy("region")


def products_per_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    counts = scd2.current(products).groupBy("category_key").agg(F.count_distinct("product_key").alias("product_count"))
    return counts.join(categories, "category_key").select("category_name", "product_count")


def product_listing(products: DataFrame, categories: DataFrame) -> DataFrame:
    return scd2.current(products).join(categories, "category_key").select("stock_code", "description", "category_name", "unit_price")


def monthly_active(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        dated(fact, dates, "year", "month", "month_name").groupBy("year", "month_name", "month")
        .agg(_revenue("monthly_revenue"), F.count_distinct("customer_key").alias("active_customers"))
        .orderBy("year", "month")
        .drop("month")
    )


def rfm_raw(fact: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """Customers without sales keep a NULL amount."""
    sums = fact.where("customer_key is not null").groupBy("customer_key").agg(_revenue("monetary_value"))
    joined = scd2.current(customers).join(sums, "customer_key", "left")
    return joined.groupBy(
        "customer_id",
        F.datediff(as_of, "last_order_date").alias("recency_days"),
        F.col("total_lifetime_orders").alias("frequency"),
    ).agg(F.sum("monetary_value").alias("monetary_value"))


def customers_with_country(customers: DataFrame, countries: DataFrame) -> DataFrame:
    return scd2.current(customers).join(countries, "country_key", "left").select("customer_id", "country_name")


def simple_lifetime_value(fact: DataFrame, customers: DataFrame) -> DataFrame:
    sums = fact.where("customer_key is not null").groupBy("customer_key").agg(
        _orders("order_count"), _revenue("lifetime_value"), C.mean(F.col("total_amount"), 6).alias("avg_line_item")
    )
    named = scd2.current(customers).select("customer_key", "customer_id").join(sums, "customer_key").drop("customer_key")
    return named.orderBy(F.col("lifetime_value").desc(), "customer_id")


def simple_products(fact: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    sums = fact.groupBy("product_key").agg(F.sum("quantity").alias("units_sold"), _revenue("revenue"))
    named = scd2.current(products).join(categories, "category_key").join(sums, "product_key")
    shown = named.select("stock_code", "description", "category_name", "units_sold", "revenue")
    return shown.orderBy(F.col("revenue").desc(), "stock_code")


def by_description(fact: DataFrame, products: DataFrame) -> DataFrame:
    sums = fact.groupBy("product_key").agg(_revenue("revenue"))
    return sums.join(products, "product_key").groupBy("description").agg(F.sum("revenue").alias("revenue"))


def price_against_list(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Mean price paid against the mean price of the product row."""
    paid = fact.groupBy("product_key").agg(C.mean(F.col("unit_price")).alias("avg_paid"))
    named = products.select("product_key", "stock_code", F.col("unit_price").alias("list_price")).join(paid, "product_key")
    return named.select("stock_code", "avg_paid", "list_price", (F.col("avg_paid") - F.col("list_price")).alias("diff"))


def order_lines(fact: DataFrame, invoice_no: str) -> DataFrame:
    return fact.where(F.col("invoice_no") == invoice_no)


def point_lookup(dim: DataFrame, column: str, value: object) -> DataFrame:
    return dim.where(F.col(column) == value)


def range_sum(clustered_fact: DataFrame, first: int, last: int) -> DataFrame:
    """Revenue of a day-key range; on the clustered table, other months' folders are not read."""
    return clustered_fact.where(month_filter(first, last)).agg(_revenue())
