"""Raw text rows to typed, validated staging rows ("validate and flag": no row is dropped silently)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..operators.ordering import number_ranged, range_sorted
from ..operators.storage import fixed_now

# Invoice and date first; the rest makes the order total, so equal rows still spread over tasks.
ROW_ORDER = (
    "invoice_no", "invoice_date", "stock_code", "description", "quantity", "unit_price",
    "customer_id", "country", "file_name", "file_row_number",
)


def _rules() -> list[tuple[Column, str]]:
    quantity, price = F.col("quantity"), F.col("unit_price")
    return [
        (F.col("raw_invoice").isNull(), V.MISSING_INVOICE),
        (quantity.isNull(), V.QUANTITY_TEXT),
        (quantity <= 0, V.QUANTITY_RANGE),
        (price.isNull(), V.PRICE_TEXT),
        (price <= 0, V.PRICE_RANGE),
        (F.col("invoice_date").isNull(), V.BAD_DATE),
        # Tested on the invoice number as delivered, before trimming.
        (F.left("raw_invoice", F.lit(1)) == "C", V.CANCELLED),
    ]


def parse(raw: DataFrame, keep: tuple[str, ...] = (), all_issues: bool = False) -> DataFrame:
    """Typed columns, validity and first failing rule; row-wise, so no shuffle.

    ``all_issues`` adds the array of every failing rule.
    """
    typed = raw.select(
        F.col("invoice_no").alias("raw_invoice"),
        *(F.trim(c).alias(c) for c in ("invoice_no", "stock_code", "description", "country")),
        C.whole_number(F.col("quantity")).alias("quantity"),
        C.price(F.col("unit_price")).alias("unit_price"),
        C.moment(F.col("invoice_date")).alias("invoice_date"),
        C.whole_number(F.col("customer_id")).alias("customer_id"),
        *keep,
    )
    issue = C.first_match(_rules())
    derived = [
        "invoice_no", "stock_code", "description", "country", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("total_amount"),
        "invoice_date",
        C.date_key(F.col("invoice_date")).alias("invoice_date_key"),
        "customer_id",
        issue.isNull().alias("is_valid"),
        issue.alias("quality_issues"),
    ]
    if all_issues:
        found = F.array(*(F.when(condition, F.lit(text)) for condition, text in _rules()))
        derived.append(F.array_compact(found).alias("all_issues"))
    return typed.select(*derived, *keep)


def stg_orders(raw: DataFrame) -> DataFrame:
    """Staging table with ``_source_row_id`` numbered by invoice and date as delivered.

    One shuffle: the raw rows are range-sorted, parsed in the same stage and written once.
    """
    present = raw.where(F.col("invoice_no").isNotNull())
    ranged = range_sorted(present, [F.col(c).asc_nulls_first() for c in ROW_ORDER])
    numbered, _ = number_ranged(parse(ranged, keep=("__pos",)), "_source_row_id", "stg_orders")
    return numbered.withColumn("_processed_at", fixed_now(raw.sparkSession))


def valid(stg: DataFrame) -> DataFrame:
    return stg.where("is_valid")


def load_summary(stg: DataFrame) -> DataFrame:
    total, good = F.count(F.lit(1)), F.count_if("is_valid")
    counts = stg.agg(total.alias("total"), good.alias("good"))
    return metric_rows(
        counts,
        {
            "Total Rows Loaded": F.col("total"),
            "Valid Rows": F.col("good"),
            "Invalid Rows": F.col("total") - F.col("good"),
            "Validation Success Rate": C.percent(F.col("good"), F.col("total")),
        },
        "decimal(22,2)",
    )


def metric_rows(one_row: DataFrame, values: dict[str, Column], type_: str, names: tuple[str, str] = ("metric", "value")) -> DataFrame:
    """Turn one row of aggregates into one row per metric, without scanning again."""
    rows = [F.struct(F.lit(text).alias(names[0]), value.cast(type_).alias(names[1])) for text, value in values.items()]
    return one_row.select(F.inline(F.array(*rows)))


def issue_breakdown(stg: DataFrame) -> DataFrame:
    counts = stg.where(~F.col("is_valid")).groupBy("quality_issues").agg(F.count(F.lit(1)).alias("issue_count"))
    # One row per rule.
    share = C.percent(F.col("issue_count"), F.sum("issue_count").over(Window.partitionBy()))
    return counts.withColumn("percentage", share).orderBy(F.col("issue_count").desc(), "quality_issues")


def date_range(stg: DataFrame) -> DataFrame:
    ends = valid(stg).agg(F.min("invoice_date").alias("a"), F.max("invoice_date").alias("b"))
    texts = {
        "Earliest Transaction": C.moment_text(F.col("a")),
        "Latest Transaction": C.moment_text(F.col("b")),
        "Date Range (Days)": F.datediff("b", "a"),
    }
    return metric_rows(ends, texts, "string")


def valid_summary(stg: DataFrame) -> DataFrame:
    rows = valid(stg)
    money = rows.agg(F.sum("total_amount").alias("total_revenue"), C.mean(F.col("total_amount")).alias("avg_transaction_value"))
    return money.select(
        C.number_of(rows, "invoice_no").alias("unique_invoices"),
        C.number_of(rows, "customer_id").alias("unique_customers"),
        C.number_of(rows, "stock_code").alias("unique_products"),
        C.number_of(rows, "country").alias("unique_countries"),
        "*",
    )


def guest_share(stg: DataFrame) -> DataFrame:
    guests = F.count_if(F.col("customer_id").isNull())
    return valid(stg).agg(
        F.count(F.lit(1)).alias("total_valid_records"),
        guests.alias("records_without_customer_id"),
        C.percent(guests, F.count(F.lit(1))).alias("percentage_without_customer_id"),
    )


def clean_only(raw: DataFrame) -> DataFrame:
    """Variant that drops instead of flagging: positive quantity and price, known customer."""
    typed = raw.select(
        "invoice_no",
        "stock_code",
        F.trim("description").alias("description"),
        C.whole_number(F.col("quantity")).alias("quantity"),
        C.moment(F.col("invoice_date")).alias("invoice_date"),
        C.price(F.col("unit_price")).alias("unit_price"),
        C.whole_number(F.col("customer_id")).alias("customer_id"),
        F.upper("country").alias("country"),
    )
    kept = typed.where("quantity > 0 and unit_price > 0 and customer_id is not null")
    return kept.withColumn("total_price", (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)"))


def with_transaction_type(stg: DataFrame) -> DataFrame:
    return stg.withColumn("transaction_type", F.when(F.col("quantity") < 0, "RETURN").otherwise("SALE"))


def dedup(rows: DataFrame, keys: list[str], latest: str | None = None) -> DataFrame:
    """One row per key: any of several equal ones, or the one with the largest ``latest`` value.

    Written as an aggregate, so duplicates are dropped before the shuffle and a key that holds
    much of the data is no burden on one task.
    """
    others = [c for c in rows.columns if c not in keys]
    row = F.struct(*([latest] if latest else []), *[c for c in others if c != latest])
    kept = rows.groupBy(*keys).agg(F.max(row).alias("kept"))
    return kept.select(*keys, *(F.col(f"kept.{c}").alias(c) for c in others)).select(*rows.columns)
