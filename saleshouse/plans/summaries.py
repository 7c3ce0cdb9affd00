"""Saved summary tables, keeping them current, and the dashboard queries that read them."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import monthly as months_table
from ..operators.monthly import MONTH
from ..operators.storage import materialize
from ..sources.layout import with_month
from . import deltas
from .reports import dated, day_type


def _orders(name: str) -> Column:
    return F.count_distinct("invoice_no").alias(name)


def customer_summary(fact: DataFrame, customers: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    """Per customer. Days since the last order depend on today, so they are added when read."""
    sums = dated(fact.where("customer_key is not null"), dates, "date").groupBy("customer_key").agg(
        _orders("total_orders"),
        F.sum("quantity").alias("total_items_purchased"),
        F.sum("total_amount").alias("lifetime_revenue"),
        C.mean(F.col("total_amount"), 6).alias("avg_order_value"),
        F.max("date").alias("most_recent_order_date"),
    )
    return _named_customers(sums, customers, countries)


def _named_customers(sums: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    known = customers.select("customer_key", "customer_id", "country_key", "first_order_date", "last_order_date").join(
        countries.select("country_key", "country_name"), "country_key"
    )
    return known.join(sums, "customer_key").select(
        "customer_key", "customer_id", "country_name", "first_order_date", "last_order_date", "total_orders",
        "total_items_purchased", "lifetime_revenue", "avg_order_value", "most_recent_order_date",
    )


def with_days_since(summary: DataFrame, as_of: Column) -> DataFrame:
    return summary.withColumn("days_since_last_order", F.datediff(as_of, "most_recent_order_date"))


def product_summary(fact: DataFrame, products: DataFrame, categories: DataFrame, dates: DataFrame) -> DataFrame:
    """Per product. Each distinct count reads its two columns alone: counted beside the sums, every row would go through the shuffle once for each."""
    rows = dated(fact, dates, "date")
    sums = rows.groupBy("product_key").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("total_amount").alias("total_revenue"),
        C.mean(F.col("unit_price"), 6).alias("avg_selling_price"),
        F.min("date").alias("first_sale_date"),
        F.max("date").alias("last_sale_date"),
    )
    for column, name in (("invoice_no", "times_ordered"), ("customer_key", "unique_customers")):
        held = rows.where(F.col(column).isNotNull()).select("product_key", column).distinct()
        counted = held.groupBy("product_key").agg(F.count(F.lit(1)).alias(name))
        sums = sums.join(counted, "product_key", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return _named_products(sums, products, categories)


def _named_products(sums: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    named = products.join(categories, "category_key").select("product_key", "stock_code", "description", "category_name")
    return named.join(sums, "product_key").select(
        "product_key", "stock_code", "description", "category_name", "times_ordered", "total_quantity_sold", "total_revenue",
        "avg_selling_price", "unique_customers", "first_sale_date", "last_sale_date",
    )


def daily_sales(fact: DataFrame, dates: DataFrame) -> DataFrame:
    day = ["date_key", "date", "year", "quarter", "month", "month_name", "day_name", "is_weekend"]
    return dated(fact, dates, *day[1:]).groupBy(*day).agg(
        _orders("order_count"),
        F.count_distinct("customer_key").alias("unique_customers"),
        F.sum("quantity").alias("total_items_sold"),
        F.sum("total_amount").alias("daily_revenue"),
        C.mean(F.col("total_amount"), 6).alias("avg_transaction_value"),
    )


def publish_daily(summary: DataFrame, base: str, months: Sequence[int] | None = None, based_on: months_table.Pointer | None = None) -> months_table.Pointer:
    """Publish day rows in one folder per month; with ``months`` replace only those, beside the old ones."""
    # A month is at most 31 rows, so a task may hold whole months.
    return months_table.publish(with_month(summary).repartition(MONTH), base, months, based_on=based_on)


def read_daily(spark: SparkSession, base: str) -> DataFrame:
    return months_table.read(spark, base).drop(MONTH)


def refresh_daily(spark: SparkSession, base: str, clustered_fact: DataFrame, dates: DataFrame, first: int, last: int) -> DataFrame:
    """Recompute the months of the changed days ``first``..``last`` and replace them at once.

    ``clustered_fact`` still has its month column, so only those months are read. The days follow from
    the fact alone, so a refresh that died is done again; readers see the old months until then.
    """
    now = months_table.pointer(spark, base)
    months = range(first // 100, last // 100 + 1)
    changed = clustered_fact.where(F.col(MONTH).between(months[0], months[-1])).drop(MONTH)
    publish_daily(daily_sales(changed, dates), base, months, now)
    return read_daily(spark, base)


def refresh_keyed(summary: DataFrame, key: str, touched: DataFrame, recompute) -> DataFrame:
    """A customer or product summary after a change.

    Distinct counts do not add up, so touched keys are recomputed from all their sales.
    ``touched`` holds the keys of every row that was added, changed or removed; ``recompute`` turns
    a condition-free function of those keys into summary rows. Publish the result as a new version.
    """
    keys = materialize(touched.select(key).where(F.col(key).isNotNull()).distinct(), "touched")
    untouched = summary.join(keys, key, "left_anti")
    return untouched.unionByName(recompute(keys).select(*summary.columns))


# --- summaries kept by what was added and removed (see `deltas`)

CUSTOMER_STATE = deltas.Kept("customer_key", ("quantity", "total_amount"), ("invoice_no", "date"))
PRODUCT_STATE = deltas.Kept("product_key", ("quantity", "total_amount", "unit_price"), ("invoice_no", "customer_key", "date"))


def customer_state(fact: DataFrame, dates: DataFrame) -> deltas.State:
    """The state of fact rows, or of a change of them (`deltas.signed`)."""
    return deltas.state_of(dated(fact, dates, "date"), CUSTOMER_STATE)


def product_state(fact: DataFrame, dates: DataFrame) -> deltas.State:
    return deltas.state_of(dated(fact, dates, "date"), PRODUCT_STATE)


def customer_figures(figures: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    """`customer_summary` from the figures of a state."""
    sums = figures.select(
        "customer_key", F.col("invoice_no__values").alias("total_orders"), F.col("quantity").cast("bigint").alias("total_items_purchased"),
        F.col("total_amount").alias("lifetime_revenue"), deltas.mean_of("total_amount", 6).alias("avg_order_value"),
        F.to_date("date__last").alias("most_recent_order_date"),
    )
    return _named_customers(sums, customers, countries)


def product_figures(figures: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """`product_summary` from the figures of a state."""
    sums = figures.select(
        "product_key", F.col("invoice_no__values").alias("times_ordered"), F.col("quantity").cast("bigint").alias("total_quantity_sold"),
        F.col("total_amount").alias("total_revenue"), deltas.mean_of("unit_price", 6).alias("avg_selling_price"),
        F.col("customer_key__values").alias("unique_customers"), F.to_date("date__first").alias("first_sale_date"),
        F.to_date("date__last").alias("last_sale_date"),
    )
    return _named_products(sums, products, categories)


# --- dashboard queries


def top_customers(summary: DataFrame, as_of: Column, more_than: int = 1000, k: int = 50) -> DataFrame:
    rows = with_days_since(summary.where(F.col("lifetime_revenue") > more_than), as_of)
    return rows.orderBy(F.col("lifetime_revenue").desc(), "customer_id").limit(k).select(
        "customer_id", "country_name", "total_orders", "lifetime_revenue", "avg_order_value", "days_since_last_order"
    )


def top_products(summary: DataFrame, k: int = 20) -> DataFrame:
    return summary.orderBy(F.col("total_revenue").desc(), "stock_code").limit(k).select(
        "stock_code", "description", "category_name", "total_revenue", "total_quantity_sold", "unique_customers"
    )


def monthly(daily: DataFrame) -> DataFrame:
    """Orders of a month are the sum of its days' orders; the mean is per day."""
    return daily.groupBy("year", "month", "month_name").agg(
        F.sum("daily_revenue").alias("monthly_revenue"),
        F.sum("order_count").alias("monthly_orders"),
        C.mean(F.col("daily_revenue"), 6).alias("avg_daily_revenue"),
    ).orderBy("year", "month").drop("month")


def weekend(daily: DataFrame) -> DataFrame:
    return daily.groupBy(day_type(F.col("is_weekend")).alias("day_type")).agg(
        F.count(F.lit(1)).alias("days_count"),
        F.sum("daily_revenue").alias("total_revenue"),
        C.mean(F.col("daily_revenue"), 6).alias("avg_daily_revenue"),
        F.sum("order_count").alias("total_orders"),
    )


def compare(base: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows of each answer, and rows the other answer does not have. Equal answers differ in none."""

    def row(version: str, mine: DataFrame, other: DataFrame) -> DataFrame:
        missing = mine.exceptAll(other).agg(F.count(F.lit(1))).scalar()
        counted = mine.agg(F.count(F.lit(1)).alias("row_count"))
        return counted.select(F.lit(version).alias("version"), "row_count", missing.alias("differing_rows"))

    return row("base", base, summary).unionByName(row("summary", summary, base))


def timed_compare(base: DataFrame, summary: DataFrame) -> dict[str, float]:
    """Seconds to compute each answer in full."""
    seconds = {}
    for version, answer in (("base", base), ("summary", summary)):
        start = time.perf_counter()
        answer.write.format("noop").mode("overwrite").save()
        seconds[version] = time.perf_counter() - start
    return seconds


def customer_revenue_base(fact: DataFrame, customers: DataFrame) -> DataFrame:
    sums = fact.where("customer_key is not null").groupBy("customer_key").agg(F.sum("total_amount").alias("lifetime_revenue"))
    return customers.select("customer_key", "customer_id").join(sums, "customer_key").groupBy("customer_id").agg(
        F.sum("lifetime_revenue").cast(C.SUM_TYPE).alias("lifetime_revenue")
    )


def customer_revenue_summary(summary: DataFrame) -> DataFrame:
    return summary.groupBy("customer_id").agg(F.sum("lifetime_revenue").cast(C.SUM_TYPE).alias("lifetime_revenue"))
