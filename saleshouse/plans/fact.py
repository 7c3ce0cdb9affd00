"""Loading the line-item sales fact, and checking it against its sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import monthly, scd2
from ..operators.ordering import with_row_number
from ..operators.storage import fixed_now, materialize
from ..sources import layout

UNKNOWN = -1
FACT_COLUMNS = [
    "sales_key", "date_key", "customer_key", "product_key", "country_key", "invoice_no",
    "quantity", "unit_price", "total_amount",
]

# Join keys of guest rows: below any int, so they match no customer.
_GUEST_BASE = 1 << 40
_GUEST_BITS = (1 << 62) - 1


def _buyer_key(customer_id: Column) -> Column:
    """Join key for a nullable customer id.

    A left join sends every NULL key to the same task, and guests are a large share of all rows.
    Here each guest row gets a key of its own that no customer has, so guests spread over all tasks.
    """
    spread = F.xxhash64("invoice_no", "stock_code", "_source_row_id").bitwiseAND(F.lit(_GUEST_BITS))
    return F.coalesce(customer_id.cast("bigint"), -spread - _GUEST_BASE)


def _with_customer(rows: DataFrame, customers: DataFrame, condition: Column | None = None) -> DataFrame:
    lookup = customers.select(
        F.col("customer_id").cast("bigint").alias("__buyer"), "customer_key",
        F.col(scd2.FROM).alias("__cf"), F.col(scd2.TO).alias("__ct"),
    )
    keyed = rows.withColumn("__b", _buyer_key(F.col("customer_id")))
    on = F.col("__b") == F.col("__buyer")
    if condition is not None:
        on = on & condition
    return keyed.join(lookup, on, "left").drop("__b", "__buyer", "__cf", "__ct")


def _product_lookup(products: DataFrame) -> DataFrame:
    return products.select("stock_code", "product_key")


def _country_lookup(countries: DataFrame) -> DataFrame:
    return countries.select(F.col("country_name").alias("country"), "country_key")


def _shape(rows: DataFrame, sales_key: Column | str = "_source_row_id") -> DataFrame:
    key = F.col(sales_key) if isinstance(sales_key, str) else sales_key
    return rows.select(
        key.alias("sales_key"),
        F.col("invoice_date_key").alias("date_key"),
        "customer_key", "product_key", "country_key", "invoice_no", "quantity", "unit_price", "total_amount",
        fixed_now(rows.sparkSession).alias("_loaded_at"),
    )


def fact_sales(
    stg: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame, mode: str = "one_current"
) -> DataFrame:
    """Valid staging rows with the keys of the current dimension rows.

    The row id of the staging row is the sales key: unique, in staging order and free. Only the
    ``by_country`` customer dimension can repeat a staging row, so only it needs numbering.
    Dimensions that fit Spark's broadcast threshold are broadcast by Spark, others are shuffled. The countries,
    the fewest, come first, so that no shuffle carries their names.
    """
    placed = stg.where("is_valid").join(_country_lookup(countries), "country")
    rows = _with_customer(placed, scd2.current(customers)).join(_product_lookup(scd2.current(products)), "stock_code")
    if mode == "by_country":
        # The numbering writes its rows, so only the fact's columns go there.
        kept = rows.select("_source_row_id", "invoice_date_key", *[c for c in FACT_COLUMNS if c not in ("sales_key", "date_key")])
        rows = with_row_number(kept, [F.col("_source_row_id"), F.col("customer_key")], "__sales")
        return _shape(rows, "__sales")
    return _shape(rows)


def fact_sales_as_of(stg: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """Historical load: the dimension versions valid at the time of the invoice.

    An equi-join on the business key with the interval as residual; keys have few versions.
    """
    at = F.col("invoice_date")
    in_force = (F.col("__cf") <= at) & (F.col("__ct").isNull() | (at < F.col("__ct")))
    versions = products.select(
        F.col("stock_code").alias("__code"), "product_key", F.col(scd2.FROM).alias("__pf"), F.col(scd2.TO).alias("__pt")
    )
    sold = (F.col("stock_code") == F.col("__code")) & (F.col("__pf") <= at) & (F.col("__pt").isNull() | (at < F.col("__pt")))
    placed = stg.where("is_valid").join(_country_lookup(countries), "country")
    rows = _with_customer(placed, customers, in_force).join(versions, sold).drop("__code", "__pf", "__pt")
    return _shape(rows)


def lookup_failures(stg: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """Valid staging rows the load would leave out, with the first lookup that fails."""
    found = (
        stg.where("is_valid")
        .join(_product_lookup(scd2.current(products)), "stock_code", "left")
        .join(_country_lookup(countries), "country", "left")
    )
    reason = F.when(F.col("product_key").isNull(), "product not found").when(F.col("country_key").isNull(), "country not found")
    return found.select("_source_row_id", "invoice_no", "stock_code", "country", reason.alias("reason")).where("reason is not null")


def fact_unknown_member(stg: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """Load that keeps every valid row: failed product and country lookups get the key -1."""
    rows = (
        _with_customer(stg.where("is_valid"), scd2.current(customers))
        .join(_product_lookup(scd2.current(products)), "stock_code", "left")
        .join(_country_lookup(countries), "country", "left")
        .withColumn("product_key", F.coalesce("product_key", F.lit(UNKNOWN).cast("bigint")))
        .withColumn("country_key", F.coalesce("country_key", F.lit(UNKNOWN).cast("bigint")))
    )
    return _shape(rows)


def unknown_rows(fact: DataFrame) -> DataFrame:
    """Fact rows that name no product or no country."""
    return fact.where((F.col("product_key") == UNKNOWN) | (F.col("country_key") == UNKNOWN))


def repaired_rows(unknown: DataFrame, stg: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """The rows of `unknown_rows` whose member has arrived since, with its key; keys that are still unknown stay -1.

    The sales key is the staging row's id, so what the row named is read from there; only the unknown rows take part in any join.
    """
    named = unknown.join(stg.select(F.col("_source_row_id").alias("sales_key"), "stock_code", "country"), "sales_key")
    found = (
        named.join(_product_lookup(scd2.current(products)).withColumnRenamed("product_key", "__product"), "stock_code", "left")
        .join(_country_lookup(countries).withColumnRenamed("country_key", "__country"), "country", "left")
    )
    changed = ((F.col("product_key") == UNKNOWN) & F.col("__product").isNotNull()) | ((F.col("country_key") == UNKNOWN) & F.col("__country").isNotNull())
    keys = {
        c: F.when(F.col(c) == UNKNOWN, F.coalesce(F.col(late).cast(unknown.schema[c].dataType), F.col(c))).otherwise(F.col(c))
        for c, late in (("product_key", "__product"), ("country_key", "__country"))
    }
    return found.where(changed).withColumns(keys).select(*unknown.columns)


def repair_unknown(fact: DataFrame, stg: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """The fact after members arrived: equal to a load with the full dimensions. Publish it, or only its changed months."""
    late = materialize(repaired_rows(unknown_rows(fact), stg, products, countries), "late-members")
    # A small number of repaired rows is broadcast by Spark, and the fact is not shuffled.
    return fact.join(late.select("sales_key"), "sales_key", "left_anti").unionByName(late)


def fact_doc_variant(clean: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Variant over the clean-only staging rows: sales key by date and invoice, left joins only."""
    joined = (
        clean.join(customers.select("customer_id", "customer_key"), "customer_id", "left")
        .join(_product_lookup(products), "stock_code", "left")
        .join(dates.select("date", "date_key"), F.to_date("invoice_date") == F.col("date"), "left")
    )
    order = ["invoice_date", "invoice_no", "stock_code", "quantity", "unit_price", "customer_key", "product_key", "description", "country"]
    numbered = with_row_number(joined, [F.col(c).asc_nulls_first() for c in order], "sales_key")
    return numbered.select(
        "sales_key", "invoice_no", "customer_key", "product_key", "date_key", "quantity", "unit_price",
        F.col("total_price").alias("total_amount"),
    )


# --- incremental changes


def merge(fact: DataFrame, source: DataFrame, keys: tuple[str, ...] = ("invoice_no", "product_key")) -> DataFrame:
    """Upsert: the whole fact after updating matched rows and inserting the others.

    A source key that occurs twice is rejected. Every fact row with a matching key is updated; new
    rows continue the sales keys. Publish the result as a new table version.

    The keys the fact holds already are stored once, at most one row per source row, so the new rows
    are found without the fact; where Spark broadcasts the source, the fact is not shuffled at all.
    """
    source = materialize(source, "merge-source")
    scd2.reject_duplicates(source, keys)
    updated = [c for c in source.columns if c not in keys]
    incoming = source.select(*keys, *(F.col(c).alias(f"__{c}") for c in updated), F.lit(True).alias("__hit"))
    kept = fact.join(incoming, list(keys), "left").select(
        *(
            F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in fact.columns
        )
    )
    held = materialize(fact.select(*keys).join(source.select(*keys), list(keys), "left_semi").distinct(), "merge-held")
    unseen = source.join(held, list(keys), "left_anti")
    last_key = fact.agg(F.coalesce(F.max("sales_key"), F.lit(0).cast("bigint"))).scalar()
    numbered = with_row_number(unseen, [F.col(k) for k in keys], "__n").withColumn("sales_key", last_key + F.col("__n"))
    inserted = numbered.select(
        *(F.col(c) if c in numbered.columns else F.lit(None).cast(fact.schema[c].dataType).alias(c) for c in fact.columns)
    )
    return kept.unionByName(inserted)


def merge_months(spark: SparkSession, base: str, source: DataFrame, keys: tuple[str, ...] = ("invoice_no", "product_key")) -> DataFrame:
    """Upsert into a published fact (`layout.publish_clustered`); only the months of the source's days are read and replaced.

    One full outer join on the key gives updates and inserts, so the months are scanned once. A key's rows must lie in the month its source row names: a line
    does not move to another month by a merge (delete and insert it). A source key that occurs twice is rejected; every fact row with a matching key is
    updated. New rows continue the sales keys after the greatest ever given out, which the table's pointer holds, with gaps where source rows were matched.
    """
    source = materialize(source, "merge-source")
    scd2.reject_duplicates(source, keys)
    now = monthly.pointer(spark, base)
    months = sorted(row.m for row in source.select(F.expr("date_key div 100").cast("int").alias("m")).distinct().collect())  # one row a month
    if not months:
        return monthly.read(spark, base, at=now).drop(monthly.MONTH)
    held = monthly.read(spark, base, at=now)
    columns = [c for c in held.columns if c != monthly.MONTH]
    updated = [c for c in source.columns if c not in keys]
    numbered = with_row_number(source, [F.col(k) for k in keys], "__n")
    incoming = numbered.select(*keys, "__n", *(F.col(c).alias(f"__{c}") for c in updated))
    mine = held.where(F.col(monthly.MONTH).isin(months)).drop(monthly.MONTH)
    joined = mine.withColumn("__held", F.lit(True)).join(incoming, list(keys), "full")
    last_key = F.lit(now.high or 0).cast("bigint")
    values = {c: F.when(F.col("__n").isNotNull(), F.col(f"__{c}").cast(held.schema[c].dataType)).otherwise(F.col(c)) for c in updated}
    values["sales_key"] = F.when(F.col("__held"), F.col("sales_key")).otherwise(last_key + F.col("__n"))
    content = joined.select(*[values.get(c, F.col(c)).alias(c) for c in columns])
    return monthly.read(spark, base, at=monthly.publish(layout.clustered(content), base, months, "sales_key", now)).drop(monthly.MONTH)


# --- checks after the load


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def total_rows(fact: DataFrame) -> DataFrame:
    return fact.agg(_n("total_fact_rows"))


def _two_sources(fact: DataFrame, stg: DataFrame, *aggregates: Column, second: str = "STAGING (VALID)") -> DataFrame:
    loaded = fact.agg(*aggregates).select(F.lit("FACT TABLE").alias("source"), "*")
    staged = stg.where("is_valid").agg(*aggregates).select(F.lit(second).alias("source"), "*")
    return loaded.unionByName(staged)


def row_count_check(fact: DataFrame, stg: DataFrame) -> DataFrame:
    return _two_sources(fact, stg, _n("row_count"))


def revenue_check(fact: DataFrame, stg: DataFrame) -> DataFrame:
    revenue = F.sum("total_amount")
    return _two_sources(fact, stg, revenue.alias("total_revenue"), F.round(revenue, 2).alias("total_revenue_rounded"))


def guest_check(fact: DataFrame) -> DataFrame:
    every, known = F.count(F.lit(1)), F.count("customer_key")
    return fact.agg(
        every.alias("total_fact_rows"),
        known.alias("rows_with_customer"),
        (every - known).alias("rows_without_customer"),
        C.percent(every - known, every).alias("percent_guest_transactions"),
    )


def date_key_range(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.min("date_key").alias("min_date_key"),
        F.max("date_key").alias("max_date_key"),
        F.count_distinct("date_key").alias("distinct_dates"),
    )


def date_span(fact: DataFrame) -> DataFrame:
    ends = fact.agg(C.key_date(F.min("date_key")).alias("min_date"), C.key_date(F.max("date_key")).alias("max_date"))
    return ends.withColumn("days_span", F.datediff("max_date", "min_date"))


def orphans(fact: DataFrame, dim: DataFrame, key: str, name: str, skip_null: bool = False) -> DataFrame:
    """Fact rows whose key is in no dimension row.

    The fact is counted per key first, so the anti join sees one row per key, not per sale.
    """
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if skip_null:
        counts = counts.where(F.col(key).isNotNull())
    lost = counts.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def _without_orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension has, without shuffling the fact.

    The lost keys are found among the distinct keys and stored; there are normally none, so Spark
    sees a tiny table and broadcasts it.
    """
    lost = materialize(fact.select(key).distinct().join(dim.select(key), key, "left_anti"), "lost-keys")
    return fact.join(lost, key, "left_anti")


def newest_sales(
    fact: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame, categories: DataFrame,
    countries: DataFrame, k: int | None = 20,
) -> DataFrame:
    """Fact rows with all dimension attributes; the ``k`` newest, or all of them with ``k=None``."""
    filed = products.join(categories, "category_key").select(
        "product_key", "stock_code", F.col("description").alias("product_name"), "category_name"
    )
    calendar = dates.select("date_key", F.col("date").alias("invoice_date"), "year", "month_name")
    places = countries.select("country_key", "country_name", "region")
    rows = fact
    if k is not None:
        # Only rows that every inner join keeps compete; the k winners alone are then looked up.
        for dim, key in ((calendar, "date_key"), (places, "country_key"), (filed, "product_key")):
            rows = _without_orphans(rows, dim, key)
        rows = rows.orderBy(F.col("sales_key").desc()).limit(k)
    wide = (
        rows.join(calendar, "date_key").join(places, "country_key").join(filed, "product_key")
        .join(customers.select("customer_key", "customer_id"), "customer_key", "left")
        .select(
            "sales_key", "invoice_no", "invoice_date", "year", "month_name", "customer_id", "country_name", "region",
            "stock_code", "product_name", "category_name", "quantity", "unit_price", "total_amount",
        )
    )
    return wide if k is None else wide.orderBy(F.col("sales_key").desc())


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = None
    for name, table in tables.items():
        row = table.agg(_n("row_count")).select(F.lit(name).alias("table"), "row_count")
        counted = row if counted is None else counted.unionByName(row)
    return counted


def load_message(table: DataFrame, name: str) -> DataFrame:
    text = F.concat(F.lit(f"{name} populated successfully with "), F.count(F.lit(1)).cast("string"), F.lit(" rows"))
    return table.agg(text.alias("status"))
