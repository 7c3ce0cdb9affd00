from decimal import Decimal

from helpers import line, raw, tuples
from pyspark.sql import functions as F

from saleshouse.functions import fixed_values as V
from saleshouse.plans import quality, staging


def issues(spark, *rows):
    return [r[0] for r in tuples(staging.parse(raw(spark, rows)), "quality_issues")]


def test_one_row_per_rule(spark):
    rows = [
        line(), line(quantity="x"), line(quantity="0"), line(quantity="-3"), line(price="n/a"), line(price="0"),
        line(price="-1"), line(day="not a date"), line(day=None), line(invoice="C1"),
    ]
    assert issues(spark, *rows) == [
        None, V.QUANTITY_TEXT, V.QUANTITY_RANGE, V.QUANTITY_RANGE, V.PRICE_TEXT, V.PRICE_RANGE, V.PRICE_RANGE,
        V.BAD_DATE, V.BAD_DATE, V.CANCELLED,
    ]


def test_first_rule_wins_and_all_are_available(spark):
    row = line(invoice="C9", quantity="-1", price="n/a")
    assert issues(spark, row) == [V.QUANTITY_RANGE]
    every = staging.parse(raw(spark, [row, line()]), all_issues=True)
    assert tuples(every, "all_issues") == [([V.QUANTITY_RANGE, V.PRICE_TEXT, V.CANCELLED],), ([],)]


def test_cancellation_is_tested_before_trimming(spark):
    out = staging.parse(raw(spark, [line(invoice=" C1")]))
    assert tuples(out, "invoice_no", "is_valid") == [("C1", True)]


def test_numbers_as_text(spark):
    out = staging.parse(raw(spark, [line(quantity="6.0", customer="17850.0"), line(quantity="2.5", customer="x", price="1.005")]))
    assert tuples(out, "quantity", "customer_id", "unit_price", "total_amount") == [
        (6, 17850, Decimal("2.00"), Decimal("12.00")),
        (3, None, Decimal("1.01"), Decimal("3.03")),
    ]


def test_rows_without_invoice_are_dropped_and_others_numbered(spark):
    rows = [line(invoice="2"), line(invoice=None), line(invoice="10"), line(invoice="1", day="2010-01-06"), line(invoice="1")]
    out = staging.stg_orders(raw(spark, rows))
    numbered = sorted(tuples(out, "_source_row_id", "invoice_no", "invoice_date_key"))
    assert [(n, i) for n, i, _ in numbered] == [(1, "1"), (2, "1"), (3, "10"), (4, "2")]
    assert numbered[0][2] == 20100105


def test_staging_twice_is_the_same(spark):
    source = raw(spark, [line(invoice=str(i % 7), code=str(i % 3)) for i in range(60)])
    first, second = (sorted(tuples(staging.stg_orders(source).drop("_processed_at"))) for _ in range(2))
    assert first == second


def test_valid_and_invalid_make_total(spark):
    out = staging.stg_orders(raw(spark, [line(), line(quantity="0"), line(invoice="C1"), line()]))
    values = dict(tuples(staging.load_summary(out)))
    assert values["Total Rows Loaded"] == values["Valid Rows"] + values["Invalid Rows"] == 4
    assert values["Validation Success Rate"] == 50


def test_clean_only(spark):
    rows = [line(country="france"), line(customer=None), line(quantity="-1"), line(price="0")]
    assert tuples(staging.clean_only(raw(spark, rows)), "country", "total_price") == [("FRANCE", Decimal("2.00"))]


def test_dedup(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, n int, t string")
    assert sorted(tuples(staging.dedup(df, ["k"], latest="n"))) == [("a", 3, "y"), ("b", 1, None)]
    assert staging.dedup(df.union(df), ["k", "n", "t"]).count() == 4


def test_scorecard_grades(spark):
    rows = [line(), line(invoice=None), line(customer=None)]
    source = raw(spark, rows)
    card = {r.metric: (r.value, r.status) for r in quality.scorecard(source, staging.stg_orders(source)).collect()}
    assert card["Raw → Staging Records"] == ("3 → 2", V.FAILED)
    assert card["Customer ID Coverage"] == ("50.00%", V.WARNING)
    assert card["Unique Customers"] == ("1", V.FAILED)
    assert card["Unique Products"][1] == V.WARNING
    assert card["Date Range"][1] == V.FAILED
    assert card["Total Revenue"] == ("$4.00", V.PASSED)
    assert card[None] == (None, None)


def test_scorecard_without_valid_rows(spark):
    source = raw(spark, [line(quantity="0")])
    card = {r.metric: r.status for r in quality.scorecard(source, staging.stg_orders(source)).collect()}
    assert card["Total Revenue"] == V.WARNING
    assert card["Validation Success Rate"] == V.FAILED


def test_outliers_are_above_the_exact_percentile(spark):
    out = staging.stg_orders(raw(spark, [line(invoice=str(i), quantity=str(i)) for i in range(1, 301)]))
    got = sorted(r.quantity for r in quality.quantity_outliers(out).collect())
    assert got == [298, 299, 300]


def test_weekday_in_order(spark):
    rows = [line(day=f"2010-01-0{d} 00:00:00") for d in range(3, 10)]
    names = [r.day_of_week for r in quality.by_weekday(staging.stg_orders(raw(spark, rows))).collect()]
    assert names == ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def test_completeness_counts(spark):
    out = staging.stg_orders(raw(spark, [line(), line(text=None), line(customer=None)]))
    shares = {r.column_name: (r.null_count, r.completeness_pct) for r in quality.completeness(out).collect()}
    assert shares["description"] == (1, Decimal("66.67")) and shares["invoice_no"] == (0, Decimal("100.00"))


def test_row_wise_parse_does_not_shuffle(spark):
    plan = staging.parse(raw(spark, [line()]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_transaction_type(spark):
    out = staging.with_transaction_type(staging.parse(raw(spark, [line(quantity="-1"), line()])))
    assert tuples(out.select(F.col("transaction_type"))) == [("RETURN",), ("SALE",)]
