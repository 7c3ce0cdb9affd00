"""Every query by name, over a folder of order tables.

The warehouse of a folder is built once per application and written to the shared work folder; the
queries read its tables, as reports read a loaded warehouse. It is rebuilt when the folder's tables
change.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import columns as C
from .functions import fixed_values as V
from .operators import monthly, scd2, storage
from .operators.ordering import with_row_number
from .plans import analytics, deltas, dims, fact, quality, querylog, reports, staging, summaries
from .plans.warehouse import Warehouse
from .sources import colocated, convert, files, layout, tables, textindex
from .streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# Parameters the queries are run with; the oracle SQL uses the same.
AS_OF = "2001-08-02"
SCD_MOMENT = "1998-06-15 00:00:00"
CHANGE_TIME = "2002-01-01 00:00:00"
LOG_NOW = "2024-01-30 00:00:00"
LOST_PART, LOST_COUNTRY = 83, 79  # lines whose part number these divide name a part or a country that no dimension has
ASTRAY = 50  # fact rows whose sales key this divides get a key that no dimension has
SLICE = (19960101, 19960331)
MERGE_YEAR = (19960101, 19961231)
LOOKUP = {"invoice": "100", "customer": 1, "product": "100", "country": "NATION_7", "text": "ring", "letters": "ri", "log": "purchase"}
TRACE = ("sales-1998.csv", 100000, 105000)
LOG_PAIR = ("10", "20")
SAMPLE_DAYS = [date(1995, 1, 1), date(1996, 6, 15), date(1998, 12, 25), date(2000, 12, 31)]

_WAREHOUSES: dict[tuple, Warehouse] = {}
_FEEDS: dict[tuple, str] = {}


def _stamp(spark: SparkSession, folder: str) -> tuple:
    """Size and time of the input tables, so that changed inputs are noticed."""
    parts = []
    for name in ("lineitem", "orders", "part", "customer", "nation", "region"):
        fs, path = storage._filesystem(spark, f"{folder}/{name}.parquet")
        status = fs.getFileStatus(path)
        parts += [status.getLen(), status.getModificationTime()]
    return tuple(parts)


def warehouse(spark: SparkSession, folder: str, variant: str = "base") -> Warehouse:
    """``moving`` customers change country over time; ``by_country`` keeps one current row per country."""
    key = (spark.sparkContext.applicationId, folder, variant, _stamp(spark, folder))
    if key not in _WAREHOUSES:
        raw = tables.raw_transactions(spark, folder, moving_customers=variant != "base")
        mode = "by_country" if variant == "by_country" else "one_current"
        base = storage.fresh_path(spark, f"warehouse-{variant}")
        _WAREHOUSES[key] = Warehouse(spark, raw, base, tables.region_rules(spark, folder), mode)
    return _WAREHOUSES[key]


# --- files written from the order tables, so that the file loaders have something to read


def _order_number() -> Column:
    return F.replace(F.col("invoice_no"), F.lit("C"), F.lit("")).cast("bigint")


def _feed_path(spark: SparkSession, folder: str, kind: str, write: Callable[[DataFrame, str], None]) -> str:
    """Where the raw rows lie as files of one kind; written at its first use, from one pass over the joined tables."""
    key = (spark.sparkContext.applicationId, folder, kind, _stamp(spark, folder))
    if key not in _FEEDS:
        path = storage.fresh_path(spark, f"feed-{kind}")
        write(tables.raw_transactions(spark, folder), path)
        _FEEDS[key] = path
    return _FEEDS[key]


def csv_feed(spark: SparkSession, folder: str) -> str:
    """CSV files with the raw rows, in a folder for the early and one for the late years. Every order number divisible by 103 has a field too many."""

    def write(raw: DataFrame, path: str) -> None:
        spoiled = F.when(_order_number() % 103 == 0, F.concat("country", F.lit(",extra"))).otherwise(F.col("country"))
        late = F.col("file_name") >= "sales-1999.csv"
        named = [F.col(name).alias(source) for source, name in V.SOURCE_COLUMNS.items()]
        lines = raw.withColumn("country", spoiled).where(late.isNotNull())
        # Quoted with a sign the loader does not know, so that the extra comma splits the field.
        lines.select(*named, F.when(late, "late").otherwise("early").alias("years")).write.partitionBy("years").option(
            "header", "true"
        ).option("quote", "~").csv(path)
        for years in ("early", "late"):
            storage.make_folder(spark, f"{path}/years={years}")  # also where no row fell

    return _feed_path(spark, folder, "csv", write)


def parquet_feed(spark: SparkSession, folder: str) -> str:
    """Parquet files with the raw rows, some columns typed."""
    typed = {"Quantity": "int", "Customer ID": "double"}
    columns = [F.col(name).cast(typed.get(source, "string")).alias(source) for source, name in V.SOURCE_COLUMNS.items()]
    return _feed_path(spark, folder, "parquet", lambda raw, path: raw.select(*columns).write.option("compression", storage.CODEC).parquet(path))


def _copy_csv(spark: SparkSession, folder: str, on_error: str = "CONTINUE") -> files.Load:
    return files.copy_csv(spark, csv_feed(spark, folder), on_error=on_error)


def _totals(history: DataFrame) -> DataFrame:
    """The history without file names and times, which differ from run to run."""
    return history.groupBy("status").agg(
        F.sum("row_count").alias("row_count"), F.sum("row_parsed").alias("row_parsed"), F.sum("error_count").alias("error_count")
    ).agg(F.sum("row_count").alias("row_count"), F.sum("row_parsed").alias("row_parsed"), F.sum("error_count").alias("error_count"))


def _incremental(spark: SparkSession, folder: str) -> DataFrame:
    path = csv_feed(spark, folder)
    history = files.copy_csv(spark, f"{path}/years=early").history
    return files.copy_new_csv(spark, path, history).rows.select(*files.RAW_COLUMNS)


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    target = storage.fresh_path(spark, "stream")
    rows = ingest.ingest_available(spark, csv_feed(spark, folder), f"{target}/rows", f"{target}/checkpoint")
    return rows.select(*files.RAW_COLUMNS)


def _csv_to_parquet(spark: SparkSession, folder: str) -> DataFrame:
    typed = parquet_feed(spark, folder)
    source = f"{typed}-plain-csv"
    if not storage.exists(spark, source):
        spark.read.parquet(typed).write.option("header", "true").csv(source)
    report = convert.csv_to_parquet(spark, source, storage.fresh_path(spark, "converted"))
    # Sizes depend on how the rows fall into files.
    return report.drop("csv_mb", "parquet_mb", "compression_pct")


def _by_status(history: DataFrame) -> DataFrame:
    now = F.current_timestamp().cast("timestamp_ntz")
    return files.failed_loads(history, now).select("status", "row_count", "error_count")


# --- changes applied to a loaded warehouse


def _customer_changes(w: Warehouse, spark: SparkSession, folder: str) -> DataFrame:
    now = w.customers.join(w.countries.select("country_key", F.col("country_name").alias("country")), "country_key", "left")
    return scd2.detect_changes(tables.customer_update(spark, folder), now, "customer_id", ["country"])


def _scd2_apply(w: Warehouse, spark: SparkSession, folder: str) -> DataFrame:
    moved = _customer_changes(w, spark, folder)
    # A move to a country that the dimension lacks brings the country with it.
    countries = storage.materialize(dims.add_countries(w.countries, moved.select(F.col("country").alias("country_name")), w.regions), "countries")
    named = countries.select("country_key", F.col("country_name").alias("country"))
    changes = moved.join(named, "country", "left").select("customer_id", "country_key")
    at = F.lit(CHANGE_TIME).cast("timestamp_ntz")
    published = storage.publish(
        scd2.apply(w.customers, changes, "customer_id", "customer_key", at), storage.fresh_path(spark, "customer-versions")
    )
    return published


def _scd2_deliver(w: Warehouse) -> DataFrame:
    """Customers' countries from two deliveries: the odd days first, then, long after, the even ones."""
    rows = staging.valid(w.stg).where("customer_id is not null")
    odd = F.dayofmonth("invoice_date") % 2 == 1
    held = storage.materialize(scd2.observations(rows.where(odd), "customer_id", "invoice_date", ["country"]), "observed")
    first = scd2.versions(held, "customer_id", ["country"])
    dim = storage.materialize(with_row_number(first, [F.col("customer_id"), F.col(scd2.FROM)], "customer_key"), "versions")
    after, _ = scd2.deliver(dim, held, rows.where(~odd), "customer_id", "customer_key", "invoice_date", ["country"])
    return after.select("customer_id", F.col("country").alias("country_name"), scd2.FROM, scd2.TO, scd2.CURRENT)


def _late_members(w: Warehouse) -> DataFrame:
    """Lines that named unknown products and countries, after these members arrived."""
    stg = _with_strangers(w.stg)
    before = storage.materialize(fact.fact_unknown_member(stg, w.customers, w.products, w.countries), "unknown-members")
    products = storage.materialize(dims.infer_products(w.products, stg), "products")
    countries = storage.materialize(dims.add_countries(w.countries, stg.where("is_valid").select(F.col("country").alias("country_name"))), "countries")
    after = fact.repair_unknown(before, stg, products, countries)
    return (
        after.join(products.select("product_key", "stock_code"), "product_key").join(countries.select("country_key", "country_name"), "country_key")
        .select("sales_key", "stock_code", "country_name", "quantity", "total_amount")
    )


def _unknown_by_country(w: Warehouse) -> DataFrame:
    """Revenue by country of a fact with unknown members: no line is lost."""
    sales = fact.fact_unknown_member(_with_strangers(w.stg), w.customers, w.products, w.countries)
    sums = sales.groupBy("country_key").agg(F.count(F.lit(1)).alias("line_count"), F.sum("total_amount").alias("revenue"))
    return dims.countries_with_unknown(w.countries).join(sums, "country_key").select("country_name", "region", "line_count", "revenue")


def _scd2_apply_product(w: Warehouse, spark: SparkSession, folder: str) -> DataFrame:
    """Products after a price list: moved prices and new descriptions make new versions."""
    moves = scd2.detect_price_moves(tables.price_update(spark, folder), w.products, "stock_code", also=["description"])
    changes = moves.select("stock_code", "description", F.col("new_price").alias("unit_price"))
    at = F.lit(CHANGE_TIME).cast("timestamp_ntz")
    return storage.publish(
        scd2.apply(w.products, changes, "stock_code", "product_key", at), storage.fresh_path(spark, "product-versions")
    )


def _corrected_lines(w: Warehouse) -> DataFrame:
    """A late delivery: half the price for the sales of one year, and each once more under a new invoice."""
    first, last = MERGE_YEAR
    lines = (
        w.clustered_fact.where(layout.month_filter(first, last)).groupBy("invoice_no", "product_key", "date_key", "country_key")
        .agg(F.sum("quantity").cast("int").alias("quantity"), F.max("unit_price").alias("unit_price"), F.max("customer_key").alias("customer_key"))
        .withColumn("unit_price", (F.col("unit_price") / 2).cast("decimal(10,2)"))
        .withColumn("total_amount", (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)"))
    )
    return lines.unionByName(lines.withColumn("invoice_no", F.concat(F.lit("N"), "invoice_no")))


def _published_fact(w: Warehouse, spark: SparkSession, label: str) -> str:
    """A copy of the fact that may be changed."""
    path = storage.fresh_path(spark, label)
    layout.publish_clustered(w.fact.drop("_loaded_at"), path)
    return path


def _fact_merge(w: Warehouse, spark: SparkSession) -> DataFrame:
    columns = [c for c in w.fact.columns if c not in ("sales_key", "_loaded_at")]
    return fact.merge_months(spark, _published_fact(w, spark, "merge-target"), _corrected_lines(w).select(columns)).drop("sales_key")


def _fact_slice_reload(w: Warehouse, spark: SparkSession) -> DataFrame:
    """In a copy of the fact, the days of the slice are replaced by their larger lines."""
    first, last = SLICE
    path = _published_fact(w, spark, "slice-target")
    corrected = monthly.read(spark, path, first // 100, last // 100).where("quantity > 5")
    return layout.reload_slice(spark, path, corrected, first, last)


def _slice_change(w: Warehouse) -> DataFrame:
    """The slice reload as a change: the days' lines go, the larger ones come."""
    rows = w.clustered_fact.where(layout.month_filter(*SLICE))
    return deltas.signed(rows.where("quantity > 5"), rows)


def _mv_refresh(w: Warehouse, spark: SparkSession) -> DataFrame:
    """The customer summary after the slice reload, from its state and the change."""
    kept = summaries.CUSTOMER_STATE
    change = deltas.State(*map(_kept("customer-change"), summaries.customer_state(_slice_change(w), w.dates)))
    _, part = deltas.merged(w.customer_state, change, kept)
    rows = deltas.refreshed(w.customer_summary, part, change, kept, lambda f: summaries.customer_figures(f, w.customers, w.countries))
    return storage.publish(rows, storage.fresh_path(spark, "customer-summary")).drop("customer_key")


def _mv_refresh_products(w: Warehouse, spark: SparkSession) -> DataFrame:
    """The same for products."""
    kept = summaries.PRODUCT_STATE
    change = deltas.State(*map(_kept("product-change"), summaries.product_state(_slice_change(w), w.dates)))
    _, part = deltas.merged(w.product_state, change, kept)
    rows = deltas.refreshed(w.product_summary, part, change, kept, lambda f: summaries.product_figures(f, w.products, w.categories))
    return storage.publish(rows, storage.fresh_path(spark, "product-summary"))


def _kept(label: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: storage.materialize(df, label)


def _mv_refresh_daily(w: Warehouse, spark: SparkSession) -> DataFrame:
    first, last = SLICE
    path = storage.fresh_path(spark, "daily-target")
    summaries.publish_daily(w.daily, path)
    after = w.clustered_fact.where(~F.col("date_key").between(first, last) | (F.col("quantity") > 5))
    return summaries.refresh_daily(spark, path, after, w.dates, first, last)


def _layout_cluster(w: Warehouse, spark: SparkSession) -> DataFrame:
    path = storage.fresh_path(spark, "clustered")
    layout.write_clustered(w.fact, path)
    return spark.read.parquet(path).drop(layout.MONTH)


def _layout_interleaved(w: Warehouse, spark: SparkSession) -> DataFrame:
    path = storage.fresh_path(spark, "interleaved")
    colocated.write_interleaved(w.fact, path)
    return spark.read.parquet(path)


def _layout_bucketed(w: Warehouse, spark: SparkSession, dim: DataFrame, key: str, business: str) -> DataFrame:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sales = colocated.write_bucketed(w.fact, storage.fresh_path(spark, f"sales-{key}"), key, buckets, "sales_key")
    return colocated.sales_by(sales, colocated.write_bucketed(dim, storage.fresh_path(spark, f"members-{key}"), key, buckets), key, business)


def _layout_substring(w: Warehouse, spark: SparkSession, text: str) -> DataFrame:
    path = storage.fresh_path(spark, "product-grams")
    textindex.write_index(w.products, path, "product_key", "description", 16)
    return textindex.search(spark, path, "product_key", "description", text)


def _layout_lookup(w: Warehouse, spark: SparkSession) -> DataFrame:
    path = storage.fresh_path(spark, "products-by-code")
    layout.write_point_lookup(w.products, path, "stock_code")
    return layout.point_lookup(spark, path, "stock_code", LOOKUP["product"])


# --- output types


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double, integers as bigint, dates and times as text, audit times left out."""
    columns = []
    for field in df.schema.fields:
        if field.name in ("_processed_at", "_loaded_at"):
            continue
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            column = C.moment_text(column)
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _over(build: Callable[[Warehouse], DataFrame], variant: str = "base") -> Query:
    return lambda spark, folder: comparable(build(warehouse(spark, folder, variant)))


def _with(build: Callable[[Warehouse, SparkSession, str], DataFrame], variant: str = "base") -> Query:
    return lambda spark, folder: comparable(build(warehouse(spark, folder, variant), spark, folder))


def _plain(build: Query) -> Query:
    return lambda spark, folder: comparable(build(spark, folder))


def _log(build: Callable[[DataFrame, Column], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(tables.query_log(spark, folder), F.lit(LOG_NOW).cast("timestamp_ntz")))


def _moving_versions(w: Warehouse) -> DataFrame:
    return w.customers.join(w.countries.select("country_key", "country_name"), "country_key", "left")


def _with_strangers(stg: DataFrame) -> DataFrame:
    """Staging rows of which some name a product or a country that the dimensions do not hold."""
    part = F.col("stock_code").cast("int")
    return stg.withColumns({
        "stock_code": F.when(part % LOST_PART == 0, F.concat(F.lit("X"), "stock_code")).otherwise(F.col("stock_code")),
        "country": F.when(part % LOST_COUNTRY == 0, "UNLISTED").otherwise(F.col("country")),
    })


def _orphans(dim: Callable[[Warehouse], DataFrame], key: str, name: str, skip_null: bool = False) -> Query:
    """Orphans of a fact of which some rows have a key that the whole dimension does not hold."""

    def count(w: Warehouse) -> DataFrame:
        astray = w.fact.withColumn(key, F.when(F.col("sales_key") % ASTRAY == 0, -F.col(key)).otherwise(F.col(key)))
        return fact.orphans(astray, dim(w), key, name, skip_null)

    return _over(count)


def _as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def queries() -> dict[str, Query]:
    raw_rows = lambda load: load.rows.select(*files.RAW_COLUMNS)
    return {
        # sources
        "src_list_files": lambda s, d: files.list_files(s, d, r".*/(lineitem|orders|part|customer)\.parquet"),
        "src_csv_preview": lambda s, d: files.preview_csv(s, csv_feed(s, d), ordered=True),
        "src_parquet_preview": lambda s, d: files.preview_parquet(s, parquet_feed(s, d), ordered=True),
        "src_copy_csv": _plain(lambda s, d: raw_rows(_copy_csv(s, d))),
        "src_copy_parquet": _plain(lambda s, d: raw_rows(files.copy_parquet(s, parquet_feed(s, d)))),
        "src_on_error": _plain(lambda s, d: raw_rows(_copy_csv(s, d, "SKIP_FILE_50%"))),
        "src_failed_rows": _plain(lambda s, d: files.validate_csv(s, csv_feed(s, d)).select("error", "raw_text")),
        "src_load_history": _plain(lambda s, d: _totals(_copy_csv(s, d).history)),
        "src_failed_loads": _plain(lambda s, d: _by_status(_copy_csv(s, d, "SKIP_FILE").history)),
        "src_incremental": _plain(_incremental),
        "src_incremental_stream": _plain(_stream),
        "src_trace_row": _over(lambda w: files.trace_invoice(w.raw, LOOKUP["invoice"])),
        "src_trace_row_range": _over(lambda w: files.trace_rows(w.raw, *TRACE)),
        "src_load_batches": _over(lambda w: files.load_batches(w.raw)),
        "raw_row_count": _over(lambda w: files.row_count(w.raw)),
        "raw_nulls": _over(lambda w: files.null_counts(w.raw)),
        "raw_audit": _over(lambda w: files.audit(w.raw)),
        "raw_sample": _over(lambda w: files.sample(w.raw.select(*files.RAW_COLUMNS), ordered=True)),
        "raw_country_dist": _over(lambda w: files.country_distribution(w.raw)),
        "csv_to_parquet": _plain(_csv_to_parquet),
        # staging
        "stg_orders": _over(lambda w: w.stg),
        "stg_is_valid": _over(lambda w: w.stg.groupBy("is_valid").agg(F.count(F.lit(1)).alias("rows"))),
        "stg_quality_issues": _over(lambda w: w.stg.where(~F.col("is_valid")).select("_source_row_id", "quality_issues")),
        "stg_source_row_id": _over(lambda w: w.stg.select("_source_row_id", "invoice_no")),
        "stg_load_summary": _over(lambda w: staging.load_summary(w.stg)),
        "stg_issue_breakdown": _over(lambda w: staging.issue_breakdown(w.stg)),
        "stg_date_range": _over(lambda w: staging.date_range(w.stg)),
        "stg_valid_summary": _over(lambda w: staging.valid_summary(w.stg)),
        "stg_guest_share": _over(lambda w: staging.guest_share(w.stg)),
        "stg_clean_only": _over(lambda w: staging.clean_only(w.raw)),
        "stg_transaction_type": _over(
            lambda w: staging.with_transaction_type(w.stg).groupBy("transaction_type").agg(
                F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("units")
            )
        ),
        "stg_dedup": _over(
            lambda w: staging.dedup(
                w.stg.select("invoice_no", "stock_code", "quantity", "unit_price", "_source_row_id"),
                ["invoice_no", "stock_code"], latest="_source_row_id",
            )
        ),
        # staging quality
        "dq_scorecard": _over(lambda w: quality.scorecard(w.raw, w.stg)),
        "dq_overall": _over(lambda w: quality.overall(w.stg)),
        "dq_success_rate": _over(lambda w: quality.success_rate(w.stg)),
        "dq_invalid_breakdown": _over(lambda w: quality.invalid_breakdown(w.stg)),
        "dq_revenue_stats": _over(lambda w: quality.revenue_stats(w.stg)),
        "dq_top_countries": _over(lambda w: quality.top_countries(w.stg)),
        "dq_top_products": _over(lambda w: quality.top_products(w.stg)),
        "dq_monthly": _over(lambda w: quality.monthly(w.stg)),
        "dq_weekday": _over(lambda w: quality.by_weekday(w.stg)),
        "dq_hourly": _over(lambda w: quality.hourly(w.stg)),
        "dq_customer_counts": _over(lambda w: quality.customer_counts(w.stg)),
        "dq_top_customers": _over(lambda w: quality.top_customers(w.stg)),
        "dq_outlier_amount": _over(lambda w: quality.amount_outliers(w.stg)),
        "dq_outlier_quantity": _over(lambda w: quality.quantity_outliers(w.stg)),
        "dq_date_key_sample": _over(lambda w: quality.date_key_sample(w.stg)),
        "dq_date_nulls": _over(lambda w: quality.date_nulls(w.stg)),
        "dq_completeness": _over(lambda w: quality.completeness(w.stg)),
        "dq_layer_counts": _over(lambda w: quality.layer_counts(w.raw, w.stg)),
        # dimensions
        "dim_date": _over(lambda w: w.dates),
        "dim_date_checks_1": _over(lambda w: dims.date_row_count(w.dates)),
        "dim_date_checks_2": _over(lambda w: dims.date_span(w.dates)),
        "dim_date_checks_3": _over(lambda w: dims.date_samples(w.dates, SAMPLE_DAYS)),
        "dim_date_checks_4": _over(lambda w: dims.date_weekend_split(w.dates)),
        "dim_date_checks_5": _over(lambda w: dims.date_years(w.dates)),
        "dim_country": _over(lambda w: w.countries),
        "dim_country_checks_1": _over(lambda w: dims.country_listing(w.countries)),
        "dim_country_checks_2": _over(lambda w: dims.countries_per_region(w.countries)),
        "dim_country_checks_3": _over(lambda w: dims.find_country(w.countries, LOOKUP["country"])),
        "dim_country_checks_4": _over(lambda w: dims.unnamed_countries(w.countries)),
        "dim_category": _over(lambda w: _category_use(w)),
        "dim_customer": _over(lambda w: w.customers),
        "dim_customer_by_country": _over(lambda w: w.customers, "by_country"),
        "dim_customer_checks_1": _over(lambda w: dims.customer_sample(w.customers)),
        "dim_customer_checks_2": _over(lambda w: dims.customers_by_currency(w.customers), "moving"),
        "dim_customer_checks_3": _over(lambda w: dims.customer_segments(w.customers)),
        "dim_customer_checks_4": _over(lambda w: dims.customers_by_country(w.customers, w.countries)),
        "dim_customer_checks_5": _over(lambda w: dims.customers_without_country(w.customers)),
        "dim_customer_checks_6": _over(lambda w: dims.longest_customers(w.customers)),
        "dim_product": _over(lambda w: w.products),
        "dim_product_checks_1": _over(lambda w: dims.product_sample(w.products)),
        "dim_product_checks_2": _over(lambda w: dims.products_by_currency(w.products)),
        "dim_product_checks_3": _over(lambda w: dims.product_price_bands(w.products)),
        "dim_product_checks_4": _over(lambda w: dims.products_by_category(w.products, w.categories)),
        "dim_product_checks_5": _over(lambda w: dims.dearest_products(w.products)),
        "dim_product_checks_6": _over(lambda w: dims.newest_products(w.products)),
        "dim_product_checks_7": _over(lambda w: dims.products_without_description(w.products)),
        "dim_product_categorise": _over(
            lambda w: dims.categorise(w.products, [(["RING"], 7), (["GIZMO", "WIDGET"], 6), (["PLATE"], 2), (["RIN", "GEAR"], 4)])
            .select("stock_code", "description", "category_key")
        ),
        # versions
        "scd2_current": _over(lambda w: scd2.current(_moving_versions(w)).select("customer_id", "country_name", scd2.FROM), "moving"),
        "scd2_as_of": _over(lambda w: scd2.as_of(_moving_versions(w), F.lit(SCD_MOMENT).cast("timestamp_ntz")).select("customer_id", "country_name", scd2.FROM, scd2.TO), "moving"),
        "scd2_history": _over(
            lambda w: scd2.history(_moving_versions(w), "customer_id", LOOKUP["customer"])
            .select("customer_id", "country_name", scd2.FROM, scd2.TO, scd2.CURRENT),
            "moving",
        ),
        "scd2_detect_customer": _with(_customer_changes),
        "scd2_detect_product": _with(lambda w, s, d: scd2.detect_price_moves(tables.price_update(s, d), w.products, "stock_code")),
        "scd2_detect_product_any": _with(
            lambda w, s, d: scd2.detect_price_moves(tables.price_update(s, d), w.products, "stock_code", also=["description"])
        ),
        "scd2_apply": _with(_scd2_apply),
        "scd2_apply_product": _with(_scd2_apply_product),
        "scd2_deliver": _over(_scd2_deliver, "moving"),
        "scd2_build": _over(lambda w: w.customers, "moving"),
        # fact
        "fact_sales": _over(lambda w: w.fact),
        "fact_sales_by_country": _over(lambda w: w.fact, "by_country"),
        "fact_sales_as_of": _over(lambda w: fact.fact_sales_as_of(w.stg, w.customers, w.products, w.countries), "moving"),
        "fact_lookup_failures": _over(lambda w: fact.lookup_failures(_with_strangers(w.stg), w.products, w.countries)),
        "fact_unknown_member": _over(lambda w: fact.fact_unknown_member(_with_strangers(w.stg), w.customers, w.products, w.countries)),
        "fact_unknown_by_country": _over(_unknown_by_country),
        "fact_late_members": _over(_late_members),
        "fact_slice_reload": _with(lambda w, s, d: _fact_slice_reload(w, s)),
        "fact_merge": _with(lambda w, s, d: _fact_merge(w, s)),
        "fact_doc_variant": _over(lambda w: fact.fact_doc_variant(staging.clean_only(w.raw), w.customers, w.products, w.dates)),
        "val_row_count": _over(lambda w: fact.row_count_check(w.fact, w.stg)),
        "val_row_count_by_country": _over(lambda w: fact.row_count_check(w.fact, w.stg), "by_country"),
        "val_revenue": _over(lambda w: fact.revenue_check(w.fact, w.stg)),
        "val_guest": _over(lambda w: fact.guest_check(w.fact)),
        "val_date_range_1": _over(lambda w: fact.date_key_range(w.fact)),
        "val_date_range_2": _over(lambda w: fact.date_span(w.fact)),
        "val_orphans_1": _orphans(lambda w: w.dates, "date_key", "orphaned_date_keys"),
        "val_orphans_2": _orphans(lambda w: w.products, "product_key", "orphaned_product_keys"),
        "val_orphans_3": _orphans(lambda w: w.countries, "country_key", "orphaned_country_keys"),
        "val_orphans_4": _orphans(lambda w: w.customers, "customer_key", "orphaned_customer_keys", skip_null=True),
        "val_sample": _over(lambda w: fact.newest_sales(w.fact, w.dates, w.customers, w.products, w.categories, w.countries)),
        "val_wide": _over(lambda w: fact.newest_sales(w.fact, w.dates, w.customers, w.products, w.categories, w.countries, k=None)),
        "load_counts": _over(lambda w: fact.load_counts(w.tables())),
        "val_total_rows": _over(lambda w: fact.total_rows(w.fact)),
        # reports
        "rep_country": _over(lambda w: reports.by_country(w.fact, w.countries)),
        "rep_region": _over(lambda w: reports.by_region(w.fact, w.countries)),
        "rep_month": _over(lambda w: reports.by_month(w.fact, w.dates)),
        "rep_year": _over(lambda w: reports.by_year(w.fact, w.dates)),
        "rep_weekend": _over(lambda w: reports.by_weekend(w.fact, w.dates)),
        "rep_products_revenue": _over(lambda w: reports.products_by_revenue(w.fact, w.products, w.categories)),
        "rep_category": _over(lambda w: reports.by_category(w.fact, w.products, w.categories)),
        "rep_products_units": _over(lambda w: reports.products_by_units(w.fact, w.products, w.categories)),
        "rep_customers": _over(lambda w: reports.top_customers(w.fact, w.customers, w.countries)),
        "rep_order_buckets": _over(lambda w: reports.order_buckets(w.customers)),
        "rep_guest": _over(lambda w: reports.guests_against_registered(w.fact)),
        "rep_sign": _over(lambda w: reports.by_sign(w.fact)),
        "rep_price_stats": _over(lambda w: reports.price_stats(w.fact)),
        "rep_key_nulls": _over(lambda w: reports.key_nulls(w.fact)),
        "rep_kpis": _over(lambda w: reports.kpis(w.fact)),
        # patterns
        "pat_customer_or_guest": _over(lambda w: reports.customer_or_guest(w.fact, w.customers)),
        "pat_order_totals_1": _over(lambda w: reports.order_count(w.fact)),
        "pat_order_totals_2": _over(lambda w: reports.order_totals(w.fact)),
        "pat_quarter": _over(lambda w: reports.by_quarter(w.fact, w.dates)),
        "pat_geo": _over(lambda w: reports.by_geography(w.fact, w.countries)),
        "pat_region_customers": _over(lambda w: reports.customers_by_region(w.fact, w.customers, w.countries)),
        "pat_customers_per_region": _over(lambda w: reports.customers_per_region(w.customers, w.countries)),
        "pat_products_per_category_1": _over(lambda w: reports.products_per_category(w.products, w.categories)),
        "pat_products_per_category_2": _over(lambda w: reports.product_listing(w.products, w.categories)),
        "pat_monthly_active": _over(lambda w: reports.monthly_active(w.fact, w.dates)),
        "pat_rfm_raw": _over(lambda w: reports.rfm_raw(w.fact, w.customers, _as_of())),
        "pat_customers_no_country": _over(lambda w: reports.customers_with_country(w.customers, w.countries)),
        "pat_clv_simple": _over(lambda w: reports.simple_lifetime_value(w.fact, w.customers)),
        "pat_product_simple": _over(lambda w: reports.simple_products(w.fact, w.products, w.categories)),
        "pat_description_revenue": _over(lambda w: reports.by_description(w.fact, w.products)),
        "pat_price_vs_list": _over(lambda w: reports.price_against_list(w.fact, w.products)),
        "pat_order_lines": _over(lambda w: reports.order_lines(w.fact, LOOKUP["invoice"])),
        "pat_point_lookup": _over(lambda w: reports.point_lookup(w.customers, "customer_id", LOOKUP["customer"])),
        "pat_range_sum": _over(lambda w: reports.range_sum(w.clustered_fact, *SLICE)),
        # analytics
        "clv": _over(lambda w: analytics.clv(w.fact, w.customers, w.countries, w.dates)),
        "clv_all": _over(lambda w: analytics.clv(w.fact, w.customers, w.countries, w.dates, k=None)),
        "rfm": _over(lambda w: analytics.rfm(w.fact, w.customers, w.dates, _as_of())),
        "rfm_all": _over(lambda w: analytics.rfm(w.fact, w.customers, w.dates, _as_of(), k=None)),
        "affinity": _over(lambda w: analytics.affinity(w.fact, w.products, min_support=2)),
        "affinity_descriptions": _over(lambda w: analytics.description_affinity(w.fact, w.products)),
        "product_performance": _over(lambda w: analytics.product_performance(w.fact, w.dates, w.products)),
        "customer_segments": _over(lambda w: analytics.customer_segments(w.fact, w.customers, w.countries)),
        "revenue_trends": _over(lambda w: analytics.revenue_trends(w.fact, w.dates)),
        "season_month": _over(lambda w: analytics.season_month(w.fact, w.dates)),
        "season_weekday": _over(lambda w: analytics.season_weekday(w.fact, w.dates)),
        "season_weekend": _over(lambda w: analytics.season_weekend(w.fact, w.dates)),
        "cohort_retention": _over(lambda w: analytics.cohort_retention(w.fact, w.customers, w.dates)),
        "cohort_pivot": _over(lambda w: analytics.cohort_pivot(w.fact, w.customers, w.dates)),
        "churn": _over(lambda w: analytics.churn(w.fact, w.customers, w.dates, _as_of())),
        "churn_rate": _over(lambda w: analytics.churn_rate(w.fact, w.customers, w.dates, _as_of())),
        "peak_days": _over(lambda w: analytics.peak_days(w.fact, w.dates)),
        "pareto": _over(lambda w: analytics.pareto(w.fact, w.dates)),
        "pareto_threshold": _over(lambda w: analytics.pareto_threshold(w.fact, w.dates)),
        # summaries
        "mv_customer_summary": _over(lambda w: summaries.with_days_since(w.customer_summary, _as_of())),
        "mv_product_summary": _over(lambda w: w.product_summary),
        "mv_daily_sales": _over(lambda w: w.daily),
        "mv_refresh": _with(lambda w, s, d: _mv_refresh(w, s)),
        "mv_refresh_products": _with(lambda w, s, d: _mv_refresh_products(w, s)),
        "mv_refresh_daily": _with(lambda w, s, d: _mv_refresh_daily(w, s)),
        "opt_top_customers": _over(lambda w: summaries.top_customers(w.customer_summary, _as_of())),
        "opt_top_products": _over(lambda w: summaries.top_products(w.product_summary)),
        "opt_monthly": _over(lambda w: summaries.monthly(w.daily)),
        "opt_weekend": _over(lambda w: summaries.weekend(w.daily)),
        "opt_compare": _over(
            lambda w: summaries.compare(
                summaries.customer_revenue_base(w.fact, w.customers), summaries.customer_revenue_summary(w.customer_summary)
            )
        ),
        # layout and query log
        "layout_cluster": _with(lambda w, s, d: _layout_cluster(w, s)),
        "layout_depth": _with(lambda w, s, d: layout.depth(layout.file_ranges(w.clustered_fact, "date_key"))),
        "layout_interleaved": _with(lambda w, s, d: _layout_interleaved(w, s)),
        "layout_depth_keys": _with(lambda w, s, d: colocated.depths(_layout_interleaved(w, s))),
        "layout_bucketed_products": _with(lambda w, s, d: _layout_bucketed(w, s, w.products, "product_key", "stock_code")),
        "layout_bucketed_customers": _with(lambda w, s, d: _layout_bucketed(w, s, w.customers, "customer_key", "customer_id")),
        "layout_point_lookup": _with(lambda w, s, d: _layout_lookup(w, s)),
        "layout_substring": _with(lambda w, s, d: _layout_substring(w, s, LOOKUP["text"])),
        "layout_substring_short": _with(lambda w, s, d: _layout_substring(w, s, LOOKUP["letters"])),
        "qlog_slowest": _log(lambda log, now: querylog.slowest(log, now, "sales")),
        "qlog_most_scanned": _log(lambda log, now: querylog.most_scanned(log, now, "sales")),
        "qlog_by_user": _log(lambda log, now: querylog.by_user(log, now, "sales")),
        "qlog_failed": _log(lambda log, now: querylog.failed(log, now, "sales")),
        "qlog_daily": _log(lambda log, now: querylog.daily(log, now, "sales")),
        "qlog_search": _log(lambda log, now: querylog.search(log, LOOKUP["log"])),
        "qlog_compare": _log(lambda log, now: querylog.compare(log, *LOG_PAIR)),
    }


def _category_use(w: Warehouse) -> DataFrame:
    """All categories, with the number of current products filed under each."""
    filed = dims.categorise(w.products)
    counts = scd2.current(filed).groupBy("category_key").agg(F.count(F.lit(1)).alias("products"))
    return w.categories.join(counts, "category_key", "left").withColumn("products", F.coalesce("products", F.lit(0)))
