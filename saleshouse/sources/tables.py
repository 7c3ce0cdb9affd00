"""Order-line tables (lineitem, orders, part, customer, events) seen as the warehouse's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def raw_transactions(spark: SparkSession, folder: str, moving_customers: bool = False) -> DataFrame:
    """One untyped row per order line, with the defects a real feed has.

    ``moving_customers`` lets a customer's country change with the year of the order.
    """
    # Lines are shuffled for parts and for orders; customers meet the orders, which are fewer. A price goes as a short decimal,
    # and as it stands only where it is none, so that its cast fails on the row that is used and not before.
    price = F.col("l_extendedprice").try_cast("decimal(10,2)")
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", price.alias("price"), F.when(price.isNull(), F.col("l_extendedprice")).alias("odd_price")
    )
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = read(spark, folder, "part").select("p_partkey", "p_name")
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey")

    order, part, buyer = F.col("o_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    ordered = F.col("o_orderdate").cast("timestamp_ntz")
    units = F.col("l_quantity").cast("int")
    nation = F.col("c_nationkey") + F.year(ordered) if moving_customers else F.col("c_nationkey")
    placed = orders.join(customers, buyer == F.col("c_custkey")).drop("c_custkey")
    return (
        lines.join(parts, part == F.col("p_partkey"))
        .join(placed, F.col("l_orderkey") == order)
        .select(
            F.concat(F.when(order % 11 == 0, "C").otherwise(""), order.cast("string")).alias("invoice_no"),
            part.cast("string").alias("stock_code"),
            F.col("p_name").alias("description"),
            F.when(part % 89 == 0, "0")
            .when((order % 11 == 0) & (order % 22 != 0), (-units).cast("string"))
            .otherwise(units.cast("string"))
            .alias("quantity"),
            F.when(order % 101 == 0, "not a date")
            .otherwise(ordered.cast("string"))
            .alias("invoice_date"),
            F.when(part % 97 == 0, "n/a")
            .otherwise(F.coalesce("price", F.col("odd_price").cast("decimal(10,2)")).cast("string"))
            .alias("unit_price"),
            F.when(buyer % 4 != 0, buyer.cast("string")).alias("customer_id"),
            F.concat(F.lit("NATION_"), (nation % 25).cast("string")).alias("country"),
            # The nightly batch that loaded the line, and its place in that feed.
            F.expr("timestampadd(HOUR, cast(24 + o_orderkey % 24 as int), cast(o_orderdate as timestamp_ntz))").alias("load_timestamp"),
            F.concat(F.lit("sales-"), F.year(ordered).cast("string"), F.lit(".csv")).alias("file_name"),
            (order * 10 + F.col("l_linenumber")).alias("file_row_number"),
        )
    )


def region_rules(spark: SparkSession, folder: str) -> DataFrame:
    """country_name → region, from the nation and region tables."""
    nations = read(spark, folder, "nation")
    regions = read(spark, folder, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_name").alias("country_name"), F.col("r_name").alias("region")
    )


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    """A query log with one entry per event."""
    events = read(spark, folder, "events")
    key = F.get_json_object("props", "$.k").cast("bigint")
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").cast("string").alias("query_id"),
        F.concat(
            F.lit("SELECT "), F.col("event_type"), F.lit(" FROM fact_sales WHERE k = "), key.cast("string"),
            F.repeat(F.lit(" AND true"), 12),
        ).alias("query_text"),
        F.when(F.col("user_id") % 3 == 0, "sandbox").otherwise("sales").alias("database_name"),
        F.lit("production").alias("schema_name"),
        F.col("user_id").cast("string").alias("user_name"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("execution_status"),
        F.round(F.col("value") * 1000).cast("bigint").alias("total_elapsed_time"),
        (key * 1048576).alias("bytes_scanned"),
        key.alias("rows_produced"),
        F.when(failed, F.concat(F.lit("E"), key.cast("string"))).alias("error_code"),
        F.when(failed, F.lit("event reported an error")).alias("error_message"),
        F.col("ts").cast("timestamp_ntz").alias("start_time"),
    )


def customer_update(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table as a later delivery: every tenth customer has moved."""
    nation = F.col("c_nationkey") + F.when(F.col("c_custkey") % 10 == 0, 1).otherwise(0)
    return read(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.concat(F.lit("NATION_"), (nation % 25).cast("string")).alias("country"),
    )


def price_update(spark: SparkSession, folder: str) -> DataFrame:
    """The part table as a later price list: every seventh part has a new description."""
    renamed = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit(" (new)"))).otherwise(F.col("p_name"))
    return read(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("stock_code"),
        renamed.alias("description"),
        (F.col("p_retailprice").cast("decimal(10,2)") * 50).cast("decimal(10,2)").alias("unit_price"),
    )
