"""Quality reports over the staging table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..operators.ordering import exact_percentiles
from .staging import issue_breakdown, metric_rows, valid


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _revenue(name: str = "total_revenue") -> Column:
    return F.sum("total_amount").alias(name)


def _mean_amount(name: str) -> Column:
    return C.mean(F.col("total_amount")).alias(name)


def _graded(value: Column, good: float, fair: float | None = None, strict: bool = False, worst: str = V.FAILED) -> Column:
    """Status by threshold; without ``fair`` there are only two grades."""
    passes = (lambda limit: value > limit) if strict else (lambda limit: value >= limit)
    grade = F.when(passes(good), V.PASSED)
    if fair is not None:
        grade = grade.when(passes(fair), V.WARNING)
    return grade.otherwise(worst)


def scorecard(raw: DataFrame, stg: DataFrame) -> DataFrame:
    """One title row and one row per check, from one pass over raw and one over staging."""
    raw_rows = raw.agg(F.count(F.lit(1)))
    good = F.col("is_valid")
    facts = stg.agg(
        _n("rows"),
        F.count_if(good).alias("good"),
        F.coalesce(F.sum(F.when(good, F.col("total_amount"))), F.lit(0).cast(C.SUM_TYPE)).alias("revenue"),
        F.min("invoice_date").alias("first"),
        F.max("invoice_date").alias("last"),
        F.count(F.when(good, F.col("customer_id"))).alias("with_customer"),
        F.count(F.when(good, F.col("description"))).alias("with_description"),
        F.count(F.when(good, F.col("invoice_date"))).alias("with_date"),
    ).select(
        "*",
        raw_rows.scalar().alias("raw_rows"),
        C.number_of(stg, "customer_id").alias("customers"),
        C.number_of(stg, "invoice_no").alias("invoices"),
        C.number_of(stg, "stock_code").alias("products"),
        C.number_of(stg, "country").alias("countries"),
    )

    c = F.col
    valid_pct = C.percent(c("good"), c("rows"))
    customer_pct = C.percent(c("with_customer"), c("good"))
    description_pct = C.percent(c("with_description"), c("good"))
    date_pct = C.percent(c("with_date"), c("good"))
    days = F.datediff("last", "first")
    text = lambda value: value.cast("string")
    pct = lambda value: F.concat(text(value.cast("decimal(7,2)")), F.lit("%"))
    ingest, quality, business = "1. Data Ingestion", "2. Data Quality", "3. Business Metrics"
    temporal, complete, structure = "4. Temporal Data", "5. Data Completeness", "6. Data Structure"
    transfer = F.when(c("rows") == c("raw_rows"), V.PASSED).when(c("rows") >= c("raw_rows") * 0.99, V.WARNING).otherwise(V.FAILED)
    money = F.when(c("revenue") > 0, V.PASSED).when(c("revenue") == 0, V.WARNING).otherwise(V.FAILED)
    ordered = F.when(c("last") > c("first"), V.PASSED).otherwise(V.FAILED)
    span = F.concat(F.to_date("first").cast("string"), F.lit(" to "), F.to_date("last").cast("string"))
    checks = [
        (V.SCORECARD_TITLE, None, None, None, None),
        (ingest, "Raw → Staging Records", F.concat(text(c("raw_rows")), F.lit(" → "), text(c("rows"))), "100% transfer", transfer),
        (quality, "Validation Success Rate", pct(valid_pct), "≥ 70%", _graded(valid_pct, 70, 50)),
        # Counting the invalid rows always passes.
        (quality, "Invalid Records Identified", text(c("rows") - c("good")), "Documented", F.lit(V.PASSED)),
        (business, "Total Revenue", F.concat(F.lit("$"), text(c("revenue"))), "> $0", money),
        (business, "Unique Customers", text(c("customers")), "> 1000", _graded(c("customers"), 1000, 500, strict=True)),
        (business, "Unique Products", text(c("products")), "> 100", _graded(c("products"), 100, strict=True, worst=V.WARNING)),
        (business, "Unique Countries", text(c("countries")), "> 10", _graded(c("countries"), 10, strict=True, worst=V.WARNING)),
        (temporal, "Date Range", span, "Valid dates", ordered),
        (temporal, "Date Coverage (days)", text(days), "> 30 days", _graded(days, 30, strict=True, worst=V.WARNING)),
        (complete, "Customer ID Coverage", pct(customer_pct), "≥ 60%", _graded(customer_pct, 60, 40)),
        (complete, "Product Description Coverage", pct(description_pct), "≥ 90%", _graded(description_pct, 90, 75)),
        (complete, "Invoice Date Coverage", pct(date_pct), "100%", _graded(date_pct, 100)),
        (structure, "Unique Invoice Numbers", text(c("invoices")), "> 0", _graded(c("invoices"), 0, strict=True)),
    ]
    names = ("check_category", "metric", "value", "threshold", "status")
    rows = [
        F.struct(*((v if isinstance(v, Column) else F.lit(v)).cast("string").alias(n) for n, v in zip(names, check)))
        for check in checks
    ]
    return facts.select(F.inline(F.array(*rows)))


def overall(stg: DataFrame) -> DataFrame:
    rows = valid(stg)
    return rows.agg(
        _n("total_records"),
        F.min("invoice_date").alias("earliest_transaction"),
        F.max("invoice_date").alias("latest_transaction"),
        F.datediff(F.max("invoice_date"), F.min("invoice_date")).alias("date_range_days"),
    ).select(
        "*",
        C.number_of(rows, "invoice_no").alias("unique_invoices"),
        C.number_of(rows, "customer_id").alias("unique_customers"),
        C.number_of(rows, "stock_code").alias("unique_products"),
        C.number_of(rows, "country").alias("unique_countries"),
    )


def success_rate(stg: DataFrame) -> DataFrame:
    every, good = F.count(F.lit(1)), F.count_if("is_valid")
    return stg.agg(
        F.first(F.lit("Validation Success Rate")).alias("metric"),
        every.alias("total_records"),
        good.alias("valid_records"),
        (every - good).alias("invalid_records"),
        C.percent(good, every).alias("success_rate_pct"),
    )


def invalid_breakdown(stg: DataFrame) -> DataFrame:
    return issue_breakdown(stg).withColumnRenamed("percentage", "percentage_of_invalid")


def revenue_stats(stg: DataFrame) -> DataFrame:
    amount = F.col("total_amount")
    middle = exact_percentiles(valid(stg), "total_amount", {"median": "0.5"}).scalar()
    return (
        valid(stg)
        .agg(
            F.sum(amount).alias("total_revenue"),
            _mean_amount("avg_transaction_amount"),
            F.min(amount).alias("min_transaction_amount"),
            F.max(amount).alias("max_transaction_amount"),
            F.round(F.stddev_samp(amount.cast("double")), 2).alias("stddev_transaction_amount"),
        )
        .select(
            "total_revenue", "avg_transaction_amount", F.round(middle, 2).alias("median_transaction_amount"),
            "min_transaction_amount", "max_transaction_amount", "stddev_transaction_amount",
        )
    )


def top_countries(stg: DataFrame, k: int = 10) -> DataFrame:
    return (
        valid(stg).groupBy("country")
        .agg(
            _n("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("invoice_no").alias("unique_invoices"),
            _revenue(),
            _mean_amount("avg_order_value"),
        )
        .orderBy(F.col("total_revenue").desc(), "country")
        .limit(k)
    )


def top_products(stg: DataFrame, k: int = 10) -> DataFrame:
    return (
        valid(stg).groupBy("stock_code", "description")
        .agg(
            F.sum("quantity").alias("total_quantity_sold"),
            _n("number_of_orders"),
            _revenue(),
            C.mean(F.col("unit_price")).alias("avg_unit_price"),
        )
        .orderBy(F.col("total_quantity_sold").desc(), "stock_code", "description")
        .limit(k)
    )


def monthly(stg: DataFrame) -> DataFrame:
    return (
        valid(stg).groupBy(F.substring(C.moment_text(F.col("invoice_date")), 1, 7).alias("year_month"))
        .agg(_n("order_count"), F.count_distinct("customer_id").alias("unique_customers"), _revenue("monthly_revenue"),
             _mean_amount("avg_order_value"))
        .orderBy("year_month")
    )


def by_weekday(stg: DataFrame, names: str = "short") -> DataFrame:
    day = F.col("invoice_date")
    return (
        valid(stg).groupBy(C.weekday_label(day, names).alias("day_of_week"), C.weekday_number(day).alias("number"))
        .agg(_n("order_count"), _revenue(), _mean_amount("avg_order_value"))
        .orderBy("number")
        .drop("number")
    )


def hourly(stg: DataFrame) -> DataFrame:
    return valid(stg).groupBy(F.hour("invoice_date").alias("hour_of_day")).agg(_n("order_count"), _revenue()).orderBy("hour_of_day")


def customer_counts(stg: DataFrame) -> DataFrame:
    counts = valid(stg).agg(_n("n"), F.count("customer_id").alias("known"), F.count_distinct("customer_id").alias("customers"))
    return metric_rows(
        counts,
        {
            "Total Valid Records": F.col("n"),
            "Records with Customer ID": F.col("known"),
            "Records without Customer ID (Guest Checkout)": F.col("n") - F.col("known"),
            "Unique Customers": F.col("customers"),
        },
        "bigint",
    )


def top_customers(stg: DataFrame, k: int = 10) -> DataFrame:
    return (
        valid(stg).where("customer_id is not null").groupBy("customer_id")
        .agg(_n("order_count"), F.count_distinct("invoice_no").alias("unique_invoices"), _revenue(), _mean_amount("avg_order_value"))
        .orderBy(F.col("total_revenue").desc(), "customer_id")
        .limit(k)
    )


def _outliers(stg: DataFrame, column: str, shown: list[str], label: str, fraction: str, k: int) -> DataFrame:
    cut = exact_percentiles(valid(stg), column, {"cut": fraction}).scalar()
    return (
        valid(stg).where(F.col(column) > cut)
        .orderBy(F.col(column).desc(), "_source_row_id")
        .limit(k)
        .select(*shown, F.lit(label).alias("outlier_type"))
    )


def amount_outliers(stg: DataFrame, fraction: str = "0.99", k: int = 20) -> DataFrame:
    shown = ["invoice_no", "invoice_date", "customer_id", "country", "quantity", "unit_price", "total_amount"]
    return _outliers(stg, "total_amount", shown, "High value transaction", fraction, k)


def quantity_outliers(stg: DataFrame, fraction: str = "0.99", k: int = 20) -> DataFrame:
    shown = ["invoice_no", "stock_code", "description", "quantity", "unit_price", "total_amount"]
    return _outliers(stg, "quantity", shown, "High quantity order", fraction, k)


def date_key_sample(stg: DataFrame, k: int = 10) -> DataFrame:
    return (
        valid(stg).groupBy("invoice_date_key")
        .agg(_n("record_count"), F.min("invoice_date").alias("min_date"), F.max("invoice_date").alias("max_date"))
        .orderBy("invoice_date_key")
        .limit(k)
    )


def date_nulls(stg: DataFrame) -> DataFrame:
    return valid(stg).agg(
        F.count_if(F.col("invoice_date_key").isNull()).alias("null_date_keys"),
        F.count_if(F.col("invoice_date").isNull()).alias("null_invoice_dates"),
    )


def completeness(stg: DataFrame) -> DataFrame:
    checked = ["invoice_no", "stock_code", "description", "country", "customer_id", "quantity", "unit_price", "invoice_date"]
    counts = valid(stg).agg(_n("n"), *(F.count(c).alias(c) for c in checked))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n").alias("total_records"),
            F.col(c).alias("non_null_count"),
            (F.col("n") - F.col(c)).alias("null_count"),
            C.percent(F.col(c), F.col("n")).alias("completeness_pct"),
        )
        for c in checked
    ]
    return counts.select(F.inline(F.array(*rows)))


def layer_counts(raw: DataFrame, stg: DataFrame) -> DataFrame:
    counts = stg.agg(_n("n"), F.count_if("is_valid").alias("good")).select("*", raw.agg(F.count(F.lit(1))).scalar().alias("raw"))
    return metric_rows(
        counts,
        {
            "RAW Layer": F.col("raw"),
            "STAGING Layer (All)": F.col("n"),
            "STAGING Layer (Valid)": F.col("good"),
            "STAGING Layer (Invalid)": F.col("n") - F.col("good"),
        },
        "bigint",
        ("layer", "total_records"),
    )
