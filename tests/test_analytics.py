from datetime import date, timedelta
from decimal import Decimal

import pytest
from helpers import Shop, line, tuples
from pyspark.sql import functions as F

from saleshouse.plans import analytics as a
from saleshouse.plans import reports, summaries


def day(text):
    return F.lit(text).cast("date")


def test_clv_ties_share_a_rank(spark):
    rows = [
        line(invoice="1", customer="1", price="10.00"),
        line(invoice="2", customer="2", price="5.00"),
        line(invoice="3", customer="2", price="5.00", day="2010-01-09 00:00:00"),
        line(invoice="4", customer="3", price="1.00"),
        line(invoice="5", customer=None, price="99.00"),
    ]
    shop = Shop(spark, rows)
    got = tuples(
        a.clv(shop.fact, shop.customers, shop.countries, shop.dates),
        "customer_id", "total_orders", "customer_lifespan_days", "revenue_per_day", "revenue_rank",
    )
    assert got == [(1, 1, 0, None, 1), (2, 2, 4, Decimal("2.50"), 1), (3, 1, 0, None, 3)]
    every = a.clv(shop.fact, shop.customers, shop.countries, shop.dates, k=None)
    assert sorted(tuples(every, "customer_id", "revenue_rank")) == [(1, 1), (2, 1), (3, 3)]


def test_rfm_scores(spark):
    rows = [line(invoice=f"{c}-{i}", customer=str(c), price=f"{c}.00", day=f"2010-01-{c:02d} 00:00:00") for c in range(1, 8) for i in range(c)]
    shop = Shop(spark, rows)
    out = a.rfm(shop.fact, shop.customers, shop.dates, day("2010-02-01"), k=None)
    scores = {r.customer_id: (r.recency_days, r.recency_score, r.frequency_score, r.monetary_score) for r in out.collect()}
    assert scores[7] == (25, 5, 5, 5) and scores[1] == (31, 1, 1, 1)
    assert [scores[c][1] for c in range(1, 8)] == [1, 1, 2, 2, 3, 4, 5]
    segments = {r.customer_id: r.customer_segment for r in out.collect()}
    assert (segments[7], segments[6], segments[5], segments[3], segments[1]) == (
        "Champions", "Champions", "Loyal Customers", "Potential Loyalists", "At Risk",
    )


def test_rfm_of_one_customer(spark):
    shop = Shop(spark, [line()])
    row = a.rfm(shop.fact, shop.customers, shop.dates).first()
    assert (row.recency_days, row.rfm_total_score, row.customer_segment) == (0, 3, "At Risk")


def test_affinity_counts_a_product_once_per_invoice(spark):
    rows = [line(invoice=str(i), code=c) for i in range(3) for c in "ABA"] + [line(invoice="9", code="C")]
    shop = Shop(spark, rows)
    got = tuples(a.affinity(shop.fact, shop.products, min_support=2))
    assert got == [("A", "thing", "B", "thing", 3, Decimal("75.00"))]


def test_product_performance_ranks_among_the_best(spark):
    rows = [line(code="A", price="9.00", day=f"2010-0{m}-01 00:00:00") for m in (1, 2, 4)]
    rows += [line(code="B", price="10.00", day="2010-01-01 00:00:00"), line(code="C", price="11.00", day="2010-01-01 00:00:00")]
    shop = Shop(spark, rows)
    got = tuples(a.product_performance(shop.fact, shop.dates, shop.products, k=2), "stock_code", "month", "monthly_rank", "cumulative_revenue", "moving_avg_3month")
    assert got == [
        ("A", 1, 2, Decimal("9.00"), Decimal("9.00")), ("A", 2, 1, Decimal("18.00"), Decimal("9.00")),
        ("A", 4, 1, Decimal("27.00"), Decimal("9.00")), ("C", 1, 1, Decimal("11.00"), Decimal("11.00")),
    ]


def test_segments_at_exact_percentiles(spark):
    shop = Shop(spark, [line(customer=str(c), price=f"{c}.00") for c in range(1, 12)])
    got = tuples(a.customer_segments(shop.fact, shop.customers, shop.countries), "customer_value_segment", "customer_count")
    assert got == [("High Value", 2), ("Medium Value", 3), ("Low Value", 6)]


def months(spark, skip=()):
    rows, start = [], date(2010, 1, 1)
    for m in range(14):
        first = date(2010 + m // 12, m % 12 + 1, 1)
        if m not in skip:
            rows.append(line(invoice=str(m), price=f"{10 + m}.00", day=f"{first} 00:00:00"))
    return Shop(spark, rows)


def test_trends(spark):
    rows = a.revenue_trends(*(lambda s: (s.fact, s.dates))(months(spark))).collect()
    assert rows[0].mom_revenue_change is None and rows[1].mom_growth_pct == Decimal("10.00")
    assert rows[12].revenue_same_month_last_year == Decimal("10.00") and rows[12].yoy_growth_pct == Decimal("120.00")
    assert rows[2].moving_avg_3month == Decimal("11.00") and rows[1].moving_avg_3month == Decimal("10.50")


def test_trends_count_rows_unless_the_calendar_is_filled(spark):
    shop = months(spark, skip=(3,))
    plain = a.revenue_trends(shop.fact, shop.dates).collect()
    assert len(plain) == 13 and plain[12].revenue_same_month_last_year == Decimal("10.00") and plain[12].month == 2
    filled = a.revenue_trends(shop.fact, shop.dates, calendar=True).collect()
    assert len(filled) == 14 and filled[13].revenue_same_month_last_year == Decimal("11.00")
    assert (filled[3].revenue, filled[3].order_count, filled[4].mom_growth_pct) == (Decimal("0.00"), 0, None)


def test_cohorts(spark):
    rows = [
        line(invoice="1", customer="1", day="2010-01-05 00:00:00"), line(invoice="2", customer="1", day="2010-02-05 00:00:00"),
        line(invoice="3", customer="2", day="2010-01-31 00:00:00"), line(invoice="4", customer="2", day="2011-02-01 00:00:00"),
        line(invoice="5", customer="3", day="2010-02-01 00:00:00"),
    ]
    shop = Shop(spark, rows)
    got = tuples(a.cohort_retention(shop.fact, shop.customers, shop.dates), "cohort_month", "cohort_size", "months_since_first_order", "retention_rate_pct")
    jan, feb = date(2010, 1, 1), date(2010, 2, 1)
    assert got == [(jan, 2, 0, Decimal("100.00")), (jan, 2, 1, Decimal("50.00")), (feb, 1, 0, Decimal("100.00"))]


def test_cohort_without_month_zero(spark):
    shop = Shop(spark, [line(invoice="1", customer="1"), line(invoice="2", customer="2")])
    customers = shop.customers.withColumn("first_order_date", F.when(F.col("customer_id") == 2, day("2009-11-01")).otherwise(F.col("first_order_date")))
    idle = customers.where("customer_id = 1").withColumn("customer_key", F.lit(77).cast("bigint"))
    customers = customers.unionByName(idle)
    assert [r.cohort_month for r in a.cohort_retention(shop.fact, customers, shop.dates).collect()] == [date(2010, 1, 1)]
    wide = tuples(a.cohort_pivot(shop.fact, customers, shop.dates), "cohort_month", "cohort_size", "month_0", "month_2")
    assert wide == [("2009-11", 1, 0, 1), ("2010-01", 2, 1, 0)]


def test_churn_limits(spark):
    today = date(2012, 1, 1)
    rows = [line(invoice=str(n), customer=str(n), day=f"{today - timedelta(days=n)} 00:00:00") for n in (90, 91, 180, 181, 365, 366)]
    shop = Shop(spark, rows)
    got = tuples(a.churn(shop.fact, shop.customers, shop.dates, day("2012-01-01")), "customer_status", "customer_count")
    assert got == [("Active (0-90 days)", 1), ("At Risk (91-180 days)", 2), ("Churning (181-365 days)", 2), ("Churned (365+ days)", 1)]
    assert a.churn_rate(shop.fact, shop.customers, shop.dates, day("2012-01-01")).first()[0] == Decimal("16.67")


def test_pareto_ties_and_end(spark):
    prices = {"2010-01-01": "5.00", "2010-01-02": "5.00", "2010-01-03": "2.00"}
    shop = Shop(spark, [line(invoice=d, day=f"{d} 00:00:00", price=p) for d, p in prices.items()])
    got = tuples(a.pareto(shop.fact, shop.dates), "rank", "cumulative_revenue", "cumulative_pct", "days_pct")
    assert got == [
        (1, Decimal("10.00"), Decimal("83.33"), Decimal("33.33")), (2, Decimal("10.00"), Decimal("83.33"), Decimal("66.67")),
        (3, Decimal("12.00"), Decimal("100.00"), Decimal("100.00")),
    ]
    assert tuples(a.pareto_threshold(shop.fact, shop.dates)) == [(1, Decimal("33.33"), Decimal("83.33"))]
    assert a.pareto_threshold(shop.fact, shop.dates, threshold=100).first().days == 3


def test_days_outside_the_calendar_drop_out_of_date_reports(spark):
    shop = Shop(spark, [line(), line(day="2020-01-01 00:00:00", price="50.00")])
    assert reports.by_year(shop.fact, shop.dates).count() == 1
    assert reports.kpis(shop.fact).first().total_revenue == Decimal("52.00")
    assert a.clv(shop.fact, shop.customers, shop.countries, shop.dates).first().lifetime_revenue == Decimal("2.00")


def test_price_stats(spark):
    shop = Shop(spark, [line(price=p) for p in ("1.00", "1.00", "2.00", "4.01")])
    assert tuples(reports.price_stats(shop.fact)) == [
        ("Minimum Price", Decimal("1.00"), 2), ("Maximum Price", Decimal("4.01"), 1),
        ("Average Price", Decimal("2.00"), None), ("Median Price", Decimal("1.50"), None),
    ]


def test_guest_is_a_text(spark):
    shop = Shop(spark, [line(), line(customer=None), line(customer=None)])
    assert dict(tuples(reports.customer_or_guest(shop.fact, shop.customers))) == {"7": Decimal("2.00"), "GUEST": Decimal("4.00")}


def test_signs(spark):
    shop = Shop(spark, [line(), line(), line(), line()])
    sales = shop.fact.withColumn("quantity", F.when(F.col("sales_key") == 1, -1).when(F.col("sales_key") == 2, 0).otherwise(1))
    got = dict(tuples(reports.by_sign(sales), "transaction_type", "percent_of_rows"))
    assert got == {"Returns/Refunds": 25, "Zero Quantity (Data Issue)": 25, "Normal Sales": 50}


def test_summary_equals_base(spark):
    shop = Shop(spark, [line(invoice=str(i), customer=str(i % 3), price=f"{i}.50") for i in range(1, 20)])
    summary = summaries.customer_summary(shop.fact, shop.customers, shop.countries, shop.dates)
    compared = summaries.compare(summaries.customer_revenue_base(shop.fact, shop.customers), summaries.customer_revenue_summary(summary))
    assert sorted(tuples(compared)) == [("base", 3, 0), ("summary", 3, 0)]
    wrong = summaries.customer_revenue_summary(summary).withColumn("lifetime_revenue", F.col("lifetime_revenue") + F.when(F.col("customer_id") == 1, 1).otherwise(0))
    assert sorted(tuples(summaries.compare(summaries.customer_revenue_base(shop.fact, shop.customers), wrong))) == [("base", 3, 1), ("summary", 3, 1)]


def test_refresh_of_touched_customers(spark):
    shop = Shop(spark, [line(invoice=str(i), customer=str(i % 4)) for i in range(1, 20)])
    before = summaries.customer_summary(shop.fact, shop.customers, shop.countries, shop.dates)
    # Customer 1 loses some sales, customer 2 all of them.
    gone = "(invoice_no = '1' or customer_key = 3)"
    after = shop.fact.where(f"customer_key is null or not {gone}")

    def recompute(keys):
        return summaries.customer_summary(after.join(keys, "customer_key", "left_semi"), shop.customers, shop.countries, shop.dates)

    refreshed = summaries.refresh_keyed(before, "customer_key", shop.fact.where(gone), recompute)
    full = summaries.customer_summary(after, shop.customers, shop.countries, shop.dates)
    assert sorted(tuples(refreshed)) == sorted(tuples(full)) and refreshed.count() == 3


@pytest.mark.parametrize("report", [reports.by_region, reports.by_geography])
def test_region_totals(spark, report):
    shop = Shop(spark, [line(country=c) for c in ("France", "Germany", "Japan")])
    column = "total_revenue" if report is reports.by_region else "revenue"
    assert report(shop.fact, shop.countries).agg(F.sum(column)).first()[0] == Decimal("6.00")
