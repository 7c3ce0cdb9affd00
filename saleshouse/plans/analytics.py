"""Customer, product and time analytics over the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..operators.ordering import exact_percentiles, top_ranked, with_ntile, with_rank
from ..operators.pairs import frequent_pairs
from ..operators.storage import materialize
from .reports import dated, day_type


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _orders(name: str) -> Column:
    return F.count_distinct("invoice_no").alias(name)


def _whole(value: Column) -> Column:
    return F.sum(value).over(Window.partitionBy())


def latest_day(fact: DataFrame) -> Column:
    """Default as-of date: the last day with a sale."""
    return C.key_date(fact.agg(F.max("date_key")).scalar())


# --- customers


def clv(fact: DataFrame, customers: DataFrame, countries: DataFrame, dates: DataFrame, k: int | None = 100) -> DataFrame:
    """Lifetime value per customer and country of sale; ``k=None`` ranks all of them."""
    amount = F.col("total_amount")
    sums = (
        dated(fact.where("customer_key is not null"), dates, "date").groupBy("customer_key", "country_key")
        .agg(
            _orders("total_orders"),
            F.sum(amount).alias("lifetime_revenue"),
            C.mean(amount).alias("avg_order_value"),
            F.min("date").alias("first_purchase_date"),
            F.max("date").alias("last_purchase_date"),
        )
    )
    span = F.col("customer_lifespan_days")
    named = (
        sums.join(countries.select("country_key", "country_name"), "country_key")
        .join(customers.select("customer_key", "customer_id"), "customer_key")
        .withColumn("customer_lifespan_days", F.datediff("last_purchase_date", "first_purchase_date"))
        .withColumn("revenue_per_day", F.when(span > 0, C.ratio(F.col("lifetime_revenue"), span, 2)))
    )
    ties = ["customer_id", "customer_key", "country_name"]
    if k is None:
        ranked = with_rank(materialize(named, "clv"), "lifetime_revenue", "revenue_rank")
    else:
        ranked = top_ranked(named, "lifetime_revenue", ties, k, "revenue_rank")
    return ranked.select(
        "customer_id", "country_name", "total_orders", "lifetime_revenue", "avg_order_value", "first_purchase_date",
        "last_purchase_date", "customer_lifespan_days", "revenue_per_day", "revenue_rank",
    )


def rfm(fact: DataFrame, customers: DataFrame, dates: DataFrame, as_of: Column | None = None, k: int | None = 100) -> DataFrame:
    """Recency, frequency and monetary quintiles; 5 is best, ties are split by customer id."""
    as_of = latest_day(fact) if as_of is None else as_of
    sums = dated(fact.where("customer_key is not null"), dates, "date").groupBy("customer_key").agg(
        F.max("date").alias("last"), _orders("frequency"), F.sum("total_amount").alias("monetary_value")
    )
    scored = sums.join(customers.select("customer_key", "customer_id"), "customer_key").select(
        "customer_key", "customer_id", F.datediff(as_of, "last").alias("recency_days"), "frequency", "monetary_value"
    )
    unique = [F.col("customer_id"), F.col("customer_key")]
    for order, score in [
        (F.col("recency_days").desc(), "recency_score"),
        (F.col("frequency").asc(), "frequency_score"),
        (F.col("monetary_value").asc(), "monetary_score"),
    ]:
        scored = with_ntile(scored, 5, [order, *unique], score)
    total = F.col("rfm_total_score")
    stale = F.col("recency_score") <= 2
    champions, loyal, potential, at_risk, hibernating, attention = V.RFM_SEGMENTS
    segment = C.first_match(
        [
            (total >= 12, champions),
            (total >= 9, loyal),
            (total >= 6, potential),
            (stale & (F.col("frequency_score") <= 2), at_risk),
            (stale, hibernating),
        ],
        attention,
    )
    scored = scored.withColumn(
        "rfm_total_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    ).withColumn("customer_segment", segment)
    if k is not None:
        scored = scored.orderBy(total.desc(), F.col("monetary_value").desc(), *unique).limit(k)
    return scored.select(
        "customer_id", "recency_days", "frequency", "monetary_value", "recency_score", "frequency_score",
        "monetary_score", "rfm_total_score", "customer_segment",
    )


def customer_segments(
    fact: DataFrame, customers: DataFrame, countries: DataFrame, high: str = V.HIGH_SPEND, medium: str = V.MEDIUM_SPEND
) -> DataFrame:
    """Spend tiers at exact percentiles, per tier and home country.

    The load only keeps sales of known products, so the product dimension is not read.
    """
    amount = F.col("total_amount")
    sums = fact.where("customer_key is not null").groupBy("customer_key").agg(
        _orders("orders"),
        F.sum(amount).alias("spend"),
        C.mean(amount, 10).alias("line_mean"),
        F.count_distinct("product_key").alias("products"),
    )
    home = customers.select("customer_key", "country_key").join(countries.select("country_key", "country_name"), "country_key")
    summary = materialize(sums.join(home, "customer_key"), "customer-summary")
    cuts = exact_percentiles(summary, "spend", {"high": high, "medium": medium})
    top, middle, low = V.SPEND_TIERS
    tiered = summary.select(
        "*", cuts.select("high").scalar().alias("high"), cuts.select("medium").scalar().alias("medium")
    ).withColumn(
        "customer_value_segment",
        F.when(F.col("spend") >= F.col("high"), top).when(F.col("spend") >= F.col("medium"), middle).otherwise(low),
    )
    place = F.when(F.col("customer_value_segment") == top, 1).when(F.col("customer_value_segment") == middle, 2).otherwise(3)
    return (
        tiered.groupBy("customer_value_segment", "country_name")
        .agg(
            _n("customer_count"),
            C.mean(F.col("spend")).alias("avg_total_spend"),
            C.mean(F.col("orders"), 1).alias("avg_orders_per_customer"),
            # The mean of the customers' line means, so it is not taken through a money type.
            F.round(F.avg("line_mean"), 2).alias("avg_order_value"),
            C.mean(F.col("products"), 1).alias("avg_unique_products"),
        )
        .orderBy(place, F.col("customer_count").desc(), "country_name")
    )


def _last_orders(fact: DataFrame, customers: DataFrame, dates: DataFrame, as_of: Column) -> DataFrame:
    last = dated(fact.where("customer_key is not null"), dates, "date").groupBy("customer_key").agg(F.max("date").alias("last"))
    known = last.join(customers.select("customer_key"), "customer_key")
    return known.select(F.datediff(as_of, "last").alias("days"))


def churn(
    fact: DataFrame, customers: DataFrame, dates: DataFrame, as_of: Column | None = None, status: list | None = None
) -> DataFrame:
    as_of = latest_day(fact) if as_of is None else as_of
    status = status or V.CHURN_STATUS
    rules = [(F.col("days") <= limit, name) for limit, name in status[:-1]]
    counts = _last_orders(fact, customers, dates, as_of).groupBy(C.first_match(rules, status[-1][1]).alias("customer_status")).agg(
        _n("customer_count"), C.mean(F.col("days"), 0).cast("bigint").alias("avg_days_since_last_order"), F.min("days").alias("least")
    )
    return (
        counts.withColumn("percentage", C.percent(F.col("customer_count"), _whole(F.col("customer_count"))))
        .orderBy("least")
        .select("customer_status", "customer_count", "percentage", "avg_days_since_last_order")
    )


def churn_rate(fact: DataFrame, customers: DataFrame, dates: DataFrame, as_of: Column | None = None, after: int = 365) -> DataFrame:
    as_of = latest_day(fact) if as_of is None else as_of
    lost = F.count_if(F.col("days") > after)
    return _last_orders(fact, customers, dates, as_of).agg(C.percent(lost, F.count(F.lit(1))).alias("churn_rate_pct"))


def _active_months(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per customer and month with an order."""
    return dated(fact.where("customer_key is not null"), dates, "date").select(
        "customer_key", C.month_start(F.col("date")).alias("order_month")
    ).distinct()


def _cohorts(customers: DataFrame) -> DataFrame:
    return customers.select("customer_key", C.month_start(F.col("first_order_date")).alias("cohort_month"))


def cohort_retention(fact: DataFrame, customers: DataFrame, dates: DataFrame, months: int = 12) -> DataFrame:
    """Long form. Cohorts without anyone in month 0 are left out: they have no base."""
    since = C.months_crossed(F.col("cohort_month"), F.col("order_month"))
    counts = _active_months(fact, dates).join(_cohorts(customers), "customer_key").groupBy(
        "cohort_month", since.alias("months_since_first_order")
    ).agg(_n("retained_customers"))
    # One row per cohort and month from here on; the base is the cohort's month-0 row.
    base = F.when(F.col("months_since_first_order") == 0, F.col("retained_customers"))
    sized = counts.withColumn("cohort_size", F.max(base).over(Window.partitionBy("cohort_month")))
    return (
        sized.where(F.col("cohort_size").isNotNull() & (F.col("months_since_first_order") <= months))
        .select(
            "cohort_month", "cohort_size", "months_since_first_order", "retained_customers",
            C.percent(F.col("retained_customers"), F.col("cohort_size")).alias("retention_rate_pct"),
        )
        .orderBy("cohort_month", "months_since_first_order")
    )


def cohort_pivot(fact: DataFrame, customers: DataFrame, dates: DataFrame, months: tuple[int, ...] = (0, 1, 2, 3, 6)) -> DataFrame:
    """Wide form; customers without any order stay in their cohort's size."""
    since = C.months_crossed(F.col("cohort_month"), F.col("order_month"))
    joined = _cohorts(customers).join(_active_months(fact, dates), "customer_key", "left")
    # A customer has one row per active month, so counting rows of a month counts customers.
    first_row = F.count_distinct("customer_key").alias("cohort_size")
    return (
        joined.groupBy("cohort_month").agg(first_row, *(F.count_if(since == m).alias(f"month_{m}") for m in months))
        .orderBy("cohort_month")
        .withColumn("cohort_month", F.date_format("cohort_month", "yyyy-MM"))
    )


# --- products


def affinity(fact: DataFrame, products: DataFrame, min_support: int = 10, k: int | None = 50) -> DataFrame:
    """Products bought together, with the share of all invoices."""
    pairs = frequent_pairs(fact, "invoice_no", "product_key", min_support, k)
    invoices = fact.agg(F.count_distinct("invoice_no")).scalar()
    named = products.select("product_key", "stock_code", "description")

    def side(letter: str) -> DataFrame:
        return named.select(
            F.col("product_key").alias(letter), F.col("stock_code").alias(f"product_{letter}_code"),
            F.col("description").alias(f"product_{letter}_desc"),
        )

    shown = pairs.join(side("a"), "a").join(side("b"), "b").select("*", invoices.alias("invoices"))
    return shown.orderBy(F.col("n").desc(), "a", "b").select(
        "product_a_code", "product_a_desc", "product_b_code", "product_b_desc",
        F.col("n").alias("times_purchased_together"), C.percent(F.col("n"), F.col("invoices")).alias("co_purchase_percentage"),
    )


def description_affinity(fact: DataFrame, products: DataFrame, min_support: int = 10, k: int | None = 50) -> DataFrame:
    """The same for product descriptions, where several products share one."""
    items = fact.select("invoice_no", "product_key").join(products.select("product_key", "description"), "product_key")
    invoices = fact.agg(F.count_distinct("invoice_no")).scalar()
    pairs = frequent_pairs(items, "invoice_no", "description", min_support, k).select("*", invoices.alias("invoices"))
    return pairs.orderBy(F.col("n").desc(), "a", "b").select(
        F.col("a").alias("product_a_desc"), F.col("b").alias("product_b_desc"),
        F.col("n").alias("times_purchased_together"), C.percent(F.col("n"), F.col("invoices")).alias("co_purchase_percentage"),
    )


def product_performance(fact: DataFrame, dates: DataFrame, products: DataFrame, k: int = 5, frame: int = 3) -> DataFrame:
    """Monthly figures of the k best products.

    The k products are found from one sum per product; the monthly figures are then computed for
    their sales only. ``monthly_rank`` ranks among the k.
    """
    totals = dated(fact, dates).groupBy("product_key").agg(F.sum("total_amount").alias("revenue"))
    best = (
        totals.join(products.select("product_key", "stock_code"), "product_key").groupBy("stock_code")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "stock_code")
        .limit(k)
    )
    # k stock codes, and their versions: at most one per code and day.
    chosen = products.select("product_key", "stock_code", "description").join(F.broadcast(best.select("stock_code")), "stock_code", "left_semi")
    monthly = (
        dated(fact, dates, "year", "month", "month_name").join(F.broadcast(chosen), "product_key")
        .groupBy("year", "month", "month_name", "stock_code", "description")
        .agg(F.sum("quantity").alias("units_sold"), F.sum("total_amount").alias("revenue"))
    )
    in_month = Window.partitionBy("year", "month").orderBy(F.col("revenue").desc())
    timeline = Window.partitionBy("stock_code").orderBy("year", "month", "description")
    trailing = timeline.rowsBetween(1 - frame, 0)
    return monthly.select(
        "*",
        F.rank().over(in_month).alias("monthly_rank"),
        F.sum("revenue").over(timeline.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_revenue"),
        C.ratio(F.sum("revenue").over(trailing), F.count("revenue").over(trailing), 2).alias("moving_avg_3month"),
    ).orderBy("stock_code", "year", "month")


# --- time: from here on, results have one row per month or day, so plain windows are small


def _monthly(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return dated(fact, dates, "year", "month", "month_name").groupBy("year", "month", "month_name").agg(
        F.sum("total_amount").alias("revenue"), _orders("order_count"), F.count_distinct("customer_key").alias("unique_customers")
    )


def revenue_trends(fact: DataFrame, dates: DataFrame, frame: int = 3, calendar: bool = False) -> DataFrame:
    """Month over month, year over year (12 rows back) and a trailing mean.

    With ``calendar=True`` months without sales are filled in first, so that 12 rows are 12 months.
    """
    months = _monthly(fact, dates)
    if calendar:
        sold = months.agg(F.min(F.col("year") * 12 + F.col("month")).alias("a"), F.max(F.col("year") * 12 + F.col("month")).alias("b"))
        every = dates.select("year", "month", "month_name").distinct()
        number = F.col("year") * 12 + F.col("month")
        inside = every.where(number.between(sold.select("a").scalar(), sold.select("b").scalar()))
        months = inside.join(months, ["year", "month", "month_name"], "left").fillna(0, ["order_count", "unique_customers"])
        months = months.withColumn("revenue", F.coalesce("revenue", F.lit(0).cast(C.SUM_TYPE)))
    timeline = Window.orderBy("year", "month")
    trailing = timeline.rowsBetween(1 - frame, 0)
    revenue = F.col("revenue")
    before, last_year = F.lag("revenue").over(timeline), F.lag("revenue", 12).over(timeline)
    return months.select(
        "year", "month", "month_name", "revenue", "order_count", "unique_customers",
        C.ratio(revenue, F.col("order_count"), 2).alias("avg_order_value"),
        (revenue - before).alias("mom_revenue_change"),
        C.percent(revenue - before, before).alias("mom_growth_pct"),
        last_year.alias("revenue_same_month_last_year"),
        C.percent(revenue - last_year, last_year).alias("yoy_growth_pct"),
        C.ratio(F.sum("revenue").over(trailing), F.count("revenue").over(trailing), 2).alias("moving_avg_3month"),
    ).orderBy("year", "month")


def season_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    amount = F.col("total_amount")
    months = dated(fact, dates, "month", "month_name").groupBy("month", "month_name").agg(
        F.sum(amount).alias("total_revenue"), _orders("total_orders"), C.mean(amount).alias("avg_transaction_value")
    )
    return (
        months.withColumn("revenue_percentage", C.percent(F.col("total_revenue"), _whole(F.col("total_revenue"))))
        .withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("total_revenue").desc())))
        .orderBy("month")
        .drop("month")
    )


def season_weekday(fact: DataFrame, dates: DataFrame) -> DataFrame:
    day = ["day_name", "day_of_week", "is_weekend"]
    return dated(fact, dates, *day).groupBy(*day).agg(
        _orders("order_count"),
        F.sum("total_amount").alias("total_revenue"),
        C.mean(F.col("total_amount")).alias("avg_order_value"),
        F.count_distinct("customer_key").alias("unique_customers"),
    ).orderBy("day_of_week")


def season_weekend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """``avg_daily_revenue`` is the mean per line, whatever its name says."""
    return (
        dated(fact, dates, "date", "is_weekend").groupBy(day_type(F.col("is_weekend")).alias("day_type"))
        .agg(
            F.count_distinct("date").alias("days_count"),
            F.sum("total_amount").alias("total_revenue"),
            C.mean(F.col("total_amount")).alias("avg_daily_revenue"),
            _orders("total_orders"),
        )
        .withColumn("avg_orders_per_day", C.ratio(F.col("total_orders"), F.col("days_count"), 2))
    )


def peak_days(fact: DataFrame, dates: DataFrame, k: int = 20) -> DataFrame:
    attributes = ["date", "day_name", "month_name", "year"]
    days = dated(fact, dates, *attributes).groupBy(*attributes).agg(
        F.sum("total_amount").alias("daily_revenue"), _orders("order_count"), F.count_distinct("customer_key").alias("unique_customers")
    )
    return top_ranked(days, "daily_revenue", ["date"], k, "revenue_rank")


def _ranked_days(fact: DataFrame, dates: DataFrame) -> DataFrame:
    days = dated(fact, dates, "date").groupBy("date").agg(F.sum("total_amount").alias("revenue"))
    by_revenue = Window.orderBy(F.col("revenue").desc())
    return days.select(
        "date",
        "revenue",
        # Equal days share one running total; their rank is split by date.
        F.sum("revenue").over(by_revenue).alias("cumulative_revenue"),
        F.row_number().over(Window.orderBy(F.col("revenue").desc(), "date")).alias("rank"),
        F.sum("revenue").over(Window.partitionBy()).alias("total"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("days"),
    )


def pareto(fact: DataFrame, dates: DataFrame, k: int = 50) -> DataFrame:
    return (
        _ranked_days(fact, dates).where(F.col("rank") <= k)
        .select(
            "rank", "date", F.col("revenue").alias("daily_revenue"), "cumulative_revenue",
            C.percent(F.col("cumulative_revenue"), F.col("total")).alias("cumulative_pct"),
            C.percent(F.col("rank"), F.col("days")).alias("days_pct"),
        )
        .orderBy("rank")
    )


def pareto_threshold(fact: DataFrame, dates: DataFrame, threshold: int = 80) -> DataFrame:
    """How many of the best days make up ``threshold`` percent of all revenue."""
    reached = F.col("cumulative_revenue") * 100 >= F.col("total") * threshold
    first = _ranked_days(fact, dates).where(reached).orderBy("rank").limit(1)
    return first.select(
        F.col("rank").alias("days"),
        C.percent(F.col("rank"), F.col("days")).alias("days_pct"),
        C.percent(F.col("cumulative_revenue"), F.col("total")).alias("cumulative_pct"),
    )
