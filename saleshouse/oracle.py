"""The catalog's queries once more, as plain SQL for DuckDB, to check results against.

Money is handled as whole cents here, so that sums and roundings are exact integer arithmetic.
Every answer is cast to the same few types as the catalog's output: bigint, double, text, boolean.
"""

from __future__ import annotations

from . import catalog as K
from .functions import fixed_values as V

# --- small pieces of SQL


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def ratio(top: str, bottom: str, digits: int = 2) -> str:
    """Whole numbers divided and rounded half away from zero, exactly."""
    scale = 10**digits
    t, b = f"CAST({top} AS HUGEINT)", f"NULLIF(CAST({bottom} AS HUGEINT), 0)"
    rounded = f"((2 * abs({t}) * {scale} + abs({b})) // (2 * abs({b})))"
    return f"(CAST(sign({t}) * sign({b}) * {rounded} AS DOUBLE) / {scale})"


def cents_ratio(top: str, bottom: str, digits: int = 2) -> str:
    """Cents divided by a count, as money."""
    return ratio(top, f"({bottom}) * 100", digits)


def pct(part: str, whole: str, digits: int = 2) -> str:
    return ratio(f"({part}) * 100", whole, digits)


def half_up(value: str, digits: int) -> str:
    """Rounding of a non-negative double that only approximates its exact value."""
    return f"(floor(({value}) * {10**digits} + 0.5 + 1e-7) / {10**digits})"


_CASTS = {
    "i": "CAST({0} AS BIGINT)",
    "f": "CAST({0} AS DOUBLE)",
    "s": "CAST({0} AS VARCHAR)",
    "b": "CAST({0} AS BOOLEAN)",
    "d": "strftime(CAST({0} AS DATE), '%Y-%m-%d')",
    "t": "strftime(CAST({0} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
}


def _typed(spec: str, body: str, before: str = "") -> str:
    """``spec`` lists the answer's columns as name:type."""
    columns = []
    for item in spec.split():
        name, kind = item.split(":")
        columns.append(_CASTS[kind].format(f'answer."{name}"') + f' AS "{name}"')
    return f"{before} SELECT {', '.join(columns)} FROM ({body}) AS answer"


# --- the layers as common table expressions

_RAW = """
raw AS (
  SELECT (CASE WHEN o_orderkey % 11 = 0 THEN 'C' ELSE '' END) || o_orderkey AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS stock_code,
         p_name AS description,
         CASE WHEN l_partkey % 89 = 0 THEN '0'
              WHEN o_orderkey % 11 = 0 AND o_orderkey % 22 <> 0 THEN CAST(-CAST(l_quantity AS INTEGER) AS VARCHAR)
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE WHEN o_orderkey % 101 = 0 THEN 'not a date'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS invoice_date,
         CASE WHEN l_partkey % 97 = 0 THEN 'n/a'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) END AS unit_price,
         CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         'NATION_' || ({nation} % 25) AS country,
         o_orderdate + to_hours(CAST(24 + o_orderkey % 24 AS INTEGER)) AS load_timestamp,
         'sales-' || year(o_orderdate) || '.csv' AS file_name,
         o_orderkey * 10 + l_linenumber AS file_row_number,
         o_orderkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
)"""

_STG = f"""
typed AS (
  SELECT *, TRY_CAST(quantity AS INTEGER) AS q, CAST(TRY_CAST(unit_price AS DECIMAL(10,2)) * 100 AS BIGINT) AS price_c,
         TRY_CAST(invoice_date AS TIMESTAMP) AS ts, TRY_CAST(customer_id AS INTEGER) AS buyer,
         row_number() OVER (ORDER BY invoice_no, invoice_date, stock_code, description, quantity, unit_price,
                            customer_id NULLS FIRST, country, file_name, file_row_number) AS _source_row_id
  FROM raw WHERE invoice_no IS NOT NULL
),
stg AS (
  SELECT invoice_no, stock_code, description, country, q AS quantity, price_c, q * price_c AS amount_c, ts AS invoice_date,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS invoice_date_key, buyer AS customer_id,
         CASE WHEN q IS NULL THEN {_text(V.QUANTITY_TEXT)} WHEN q <= 0 THEN {_text(V.QUANTITY_RANGE)}
              WHEN price_c IS NULL THEN {_text(V.PRICE_TEXT)} WHEN price_c <= 0 THEN {_text(V.PRICE_RANGE)}
              WHEN ts IS NULL THEN {_text(V.BAD_DATE)} WHEN invoice_no LIKE 'C%' THEN {_text(V.CANCELLED)} END AS quality_issues,
         quality_issues IS NULL AS is_valid, _source_row_id
  FROM typed
),
v AS (SELECT * FROM stg WHERE is_valid)"""

_DIMS = """
ends AS (SELECT min(year(invoice_date)) AS y0, max(year(invoice_date)) AS y1 FROM v),
cal AS (
  SELECT CAST(strftime(day0, '%Y%m%d') AS INTEGER) AS date_key, CAST(day0 AS DATE) AS date, year(day0) AS year,
         quarter(day0) AS quarter, month(day0) AS month, strftime(day0, '%b') AS month_name, day(day0) AS day,
         dayofweek(day0) AS day_of_week, strftime(day0, '%a') AS day_name, dayofweek(day0) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS day0 FROM ends)
),
ctry AS (
  SELECT row_number() OVER (ORDER BY country) AS country_key, country AS country_name, NULL AS country_code,
         coalesce(r_name, 'Other') AS region
  FROM (SELECT DISTINCT country FROM v WHERE country IS NOT NULL)
  LEFT JOIN nation ON n_name = country LEFT JOIN region ON r_regionkey = n_regionkey
),
prod AS (
  SELECT row_number() OVER (ORDER BY stock_code) AS product_key, stock_code, max(description) AS description, 1 AS category_key,
         (2 * sum(price_c) + count(*)) // (2 * count(*)) AS list_c, CAST(min(invoice_date) AS DATE) AS first_sold_date
  FROM v GROUP BY stock_code
)"""

_CUSTOMER_VERSIONS = """
life AS (
  SELECT customer_id, CAST(min(invoice_date) AS DATE) AS first_order_date, CAST(max(invoice_date) AS DATE) AS last_order_date,
         count(DISTINCT invoice_no) AS total_lifetime_orders
  FROM v WHERE customer_id IS NOT NULL GROUP BY customer_id
),
placed AS (SELECT DISTINCT customer_id, CAST(invoice_date AS DATE) AS day0, country FROM v WHERE customer_id IS NOT NULL),
moves AS (
  SELECT * FROM placed
  QUALIFY country IS DISTINCT FROM lag(country) OVER (PARTITION BY customer_id ORDER BY day0)
),
cust AS (
  SELECT row_number() OVER (ORDER BY customer_id, day0) AS customer_key, customer_id, country_key, country,
         first_order_date, last_order_date, total_lifetime_orders, CAST(day0 AS TIMESTAMP) AS _effective_from,
         CAST(lead(day0) OVER (PARTITION BY customer_id ORDER BY day0) AS TIMESTAMP) AS _effective_to,
         lead(day0) OVER (PARTITION BY customer_id ORDER BY day0) IS NULL AS _is_current
  FROM moves JOIN life USING (customer_id) LEFT JOIN ctry ON country = country_name
)"""

_CUSTOMER_BY_COUNTRY = """
cust AS (
  SELECT row_number() OVER (ORDER BY customer_id, country) AS customer_key, customer_id, country_key, country,
         CAST(min(invoice_date) AS DATE) AS first_order_date, CAST(max(invoice_date) AS DATE) AS last_order_date,
         count(DISTINCT invoice_no) AS total_lifetime_orders, CAST(CAST(min(invoice_date) AS DATE) AS TIMESTAMP) AS _effective_from,
         CAST(NULL AS TIMESTAMP) AS _effective_to, TRUE AS _is_current
  FROM v LEFT JOIN ctry ON country = country_name WHERE customer_id IS NOT NULL GROUP BY customer_id, country, country_key
)"""

_FACT = """
f AS (
  SELECT {key} AS sales_key, invoice_date_key AS date_key, customer_key, product_key, ctry.country_key, invoice_no,
         quantity, price_c, amount_c
  FROM v LEFT JOIN cust ON v.customer_id = cust.customer_id AND _is_current
  JOIN prod ON v.stock_code = prod.stock_code JOIN ctry ON v.country = country_name
),
star AS (
  SELECT f.*, cal.* EXCLUDE (date_key), ctry.country_name, ctry.region, cust.customer_id, cust.country AS home,
         prod.stock_code, prod.description
  FROM f JOIN cal USING (date_key) JOIN ctry USING (country_key) JOIN prod USING (product_key)
  LEFT JOIN cust USING (customer_key)
)"""


def _layers(variant: str = "base") -> str:
    nation = "c_nationkey" if variant == "base" else "(c_nationkey + year(o_orderdate))"
    customers = _CUSTOMER_BY_COUNTRY if variant == "by_country" else _CUSTOMER_VERSIONS
    key = "row_number() OVER (ORDER BY _source_row_id, customer_key)" if variant == "by_country" else "_source_row_id"
    parts = [_RAW.replace("{nation}", nation), _STG, _DIMS, customers, _FACT.replace("{key}", key)]
    return "WITH " + ",".join(parts)


_LOG = """WITH log AS (
  SELECT CAST(event_id AS VARCHAR) AS query_id,
         'SELECT ' || event_type || ' FROM fact_sales WHERE k = ' || regexp_extract(props, '([0-9]+)', 1) || repeat(' AND true', 12) AS query_text,
         CASE WHEN user_id % 3 = 0 THEN 'sandbox' ELSE 'sales' END AS database_name, 'production' AS schema_name,
         CAST(user_id AS VARCHAR) AS user_name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
         CAST(round(value * 1000) AS BIGINT) AS total_elapsed_time,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 1048576 AS bytes_scanned,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS rows_produced,
         CASE WHEN event_type = 'error' THEN 'E' || regexp_extract(props, '([0-9]+)', 1) END AS error_code,
         CASE WHEN event_type = 'error' THEN 'event reported an error' END AS error_message,
         ts AS start_time
  FROM events
),
day_log AS (
  SELECT * FROM log
  WHERE ts_end(start_time, total_elapsed_time) >= TIMESTAMP '{now}' - INTERVAL 24 HOUR
    AND start_time <= TIMESTAMP '{now}' AND database_name = 'sales'
)""".replace("ts_end(start_time, total_elapsed_time)", "start_time + to_milliseconds(total_elapsed_time)").replace("{now}", K.LOG_NOW)

# --- answers used more than once

_STG_SPEC = (
    "invoice_no:s stock_code:s description:s country:s quantity:i unit_price:f total_amount:f invoice_date:t "
    "invoice_date_key:i customer_id:i is_valid:b quality_issues:s _source_row_id:i"
)
_CUST_SPEC = (
    "customer_key:i customer_id:i country_key:i first_order_date:d last_order_date:d total_lifetime_orders:i "
    "_effective_from:t _effective_to:t _is_current:b"
)
_PRODUCT_SPEC = (
    "product_key:i stock_code:s description:s category_key:i unit_price:f first_sold_date:d _effective_from:t "
    "_effective_to:t _is_current:b"
)
_PRODUCT = (
    "SELECT *, list_c / 100 AS unit_price, first_sold_date AS _effective_from, NULL AS _effective_to, TRUE AS _is_current FROM prod"
)
_FACT_SPEC = "sales_key:i date_key:i customer_key:i product_key:i country_key:i invoice_no:s quantity:i unit_price:f total_amount:f"
_FACT_ROWS = "SELECT *, price_c / 100 AS unit_price, amount_c / 100 AS total_amount FROM f"
_RAW_SPEC = "invoice_no:s stock_code:s description:s quantity:s invoice_date:s unit_price:s customer_id:s country:s"
_REVENUE = "sum(amount_c) / 100"
_MEAN_LINE = cents_ratio("sum(amount_c)", "count(*)")
_MEAN_LINE_6 = cents_ratio("sum(amount_c)", "count(*)", 6)
_ORDERS = "count(DISTINCT invoice_no)"
_DAY_TYPE = "CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END"
_SLICE = f"BETWEEN {K.SLICE[0]} AND {K.SLICE[1]}"
_CATEGORY = _text(V.CATEGORIES[0])

_CLV = f"""
  SELECT *, CASE WHEN customer_lifespan_days > 0 THEN {cents_ratio('c', 'customer_lifespan_days')} END AS revenue_per_day,
         c / 100 AS lifetime_revenue, rank() OVER (ORDER BY c DESC) AS revenue_rank
  FROM (SELECT customer_key, customer_id, country_name, {_ORDERS} AS total_orders, sum(amount_c) AS c, {_MEAN_LINE} AS avg_order_value,
               min(date) AS first_purchase_date, max(date) AS last_purchase_date, max(date) - min(date) AS customer_lifespan_days
        FROM star WHERE customer_key IS NOT NULL GROUP BY ALL)"""
_CLV_SPEC = (
    "customer_id:i country_name:s total_orders:i lifetime_revenue:f avg_order_value:f first_purchase_date:d "
    "last_purchase_date:d customer_lifespan_days:i revenue_per_day:f revenue_rank:i"
)
_CHAMPIONS, _LOYAL, _POTENTIAL, _AT_RISK, _HIBERNATING, _ATTENTION = map(_text, V.RFM_SEGMENTS)
_RFM = f"""
  SELECT *, r + fr + m AS rfm_total_score, c / 100 AS monetary_value, r AS recency_score, fr AS frequency_score, m AS monetary_score,
         CASE WHEN r + fr + m >= 12 THEN {_CHAMPIONS} WHEN r + fr + m >= 9 THEN {_LOYAL} WHEN r + fr + m >= 6 THEN {_POTENTIAL}
              WHEN r <= 2 AND fr <= 2 THEN {_AT_RISK} WHEN r <= 2 THEN {_HIBERNATING} ELSE {_ATTENTION} END AS customer_segment
  FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_id, customer_key) AS r,
               ntile(5) OVER (ORDER BY frequency, customer_id, customer_key) AS fr,
               ntile(5) OVER (ORDER BY c, customer_id, customer_key) AS m
        FROM (SELECT customer_key, customer_id, DATE '{K.AS_OF}' - max(date) AS recency_days, {_ORDERS} AS frequency, sum(amount_c) AS c
              FROM star WHERE customer_key IS NOT NULL GROUP BY ALL))"""
_RFM_SPEC = (
    "customer_id:i recency_days:i frequency:i monetary_value:f recency_score:i frequency_score:i monetary_score:i "
    "rfm_total_score:i customer_segment:s"
)
_CUSTOMER_DAYS = f"""(SELECT DATE '{K.AS_OF}' - max(date) AS days FROM star WHERE customer_key IS NOT NULL GROUP BY customer_key)"""
_ACTIVE = """(SELECT DISTINCT customer_key, date_trunc('month', date) AS order_month FROM star WHERE customer_key IS NOT NULL)"""
_COHORTS = "(SELECT customer_key, date_trunc('month', first_order_date) AS cohort_month FROM cust)"
_MONTHS = "date_diff('month', cohort_month, order_month)"
_RANKED_DAYS = """(SELECT date, c, sum(c) OVER (ORDER BY c DESC) AS upto, row_number() OVER (ORDER BY c DESC, date) AS rank,
                          sum(c) OVER () AS total, count(*) OVER () AS n
                   FROM (SELECT date, sum(amount_c) AS c FROM star GROUP BY date))"""
_DAILY = f"""SELECT date_key, date, year, quarter, month, month_name, day_name, is_weekend, {_ORDERS} AS order_count,
                    count(DISTINCT customer_key) AS unique_customers, sum(quantity) AS total_items_sold,
                    {_REVENUE} AS daily_revenue, {_MEAN_LINE_6} AS avg_transaction_value, sum(amount_c) AS c
             FROM {{rows}} GROUP BY ALL"""
_DAILY_SPEC = (
    "date_key:i date:d year:i quarter:i month:i month_name:s day_name:s is_weekend:b order_count:i unique_customers:i "
    "total_items_sold:i daily_revenue:f avg_transaction_value:f"
)
_CUSTOMER_SUMMARY = f"""SELECT star.customer_key, star.customer_id, home AS country_name, cust.first_order_date, cust.last_order_date,
                               {_ORDERS} AS total_orders, sum(quantity) AS total_items_purchased, {_REVENUE} AS lifetime_revenue,
                               {_MEAN_LINE_6} AS avg_order_value, max(date) AS most_recent_order_date,
                               DATE '{K.AS_OF}' - max(date) AS days_since_last_order
                        FROM star JOIN cust USING (customer_key) WHERE {{where}} GROUP BY ALL"""
_CUSTOMER_SUMMARY_SPEC = (
    "customer_id:i country_name:s first_order_date:d last_order_date:d total_orders:i total_items_purchased:i "
    "lifetime_revenue:f avg_order_value:f most_recent_order_date:d"
)
_PRODUCT_SUMMARY = f"""SELECT product_key, stock_code, description, {_CATEGORY} AS category_name, {_ORDERS} AS times_ordered,
                              sum(quantity) AS total_quantity_sold, {_REVENUE} AS total_revenue,
                              {cents_ratio('sum(price_c)', 'count(*)', 6)} AS avg_selling_price,
                              count(DISTINCT customer_key) AS unique_customers, min(date) AS first_sale_date, max(date) AS last_sale_date
                       FROM star WHERE {{where}} GROUP BY product_key, stock_code, description"""
_AFTER_RELOAD = f"(date_key NOT {_SLICE} OR quantity > 5)"


def _top_products(order: str) -> tuple[str, str]:
    body = f"""SELECT stock_code, description, {_CATEGORY} AS category_name, sum(quantity) AS total_units_sold,
                      {cents_ratio('sum(price_c)', 'count(*)')} AS avg_selling_price, {_REVENUE} AS total_revenue,
                      {_ORDERS} AS orders_containing_product
               FROM star GROUP BY stock_code, description ORDER BY {order} DESC, stock_code LIMIT 10"""
    return (
        "stock_code:s description:s category_name:s total_units_sold:i avg_selling_price:f total_revenue:f orders_containing_product:i",
        body,
    )


def _pairs(item: str, least: int) -> str:
    return f"""SELECT a, b, n, {pct('n', '(SELECT count(DISTINCT invoice_no) FROM f)')} AS co_purchase_percentage
               FROM (SELECT x.{item} AS a, y.{item} AS b, count(*) AS n
                     FROM (SELECT DISTINCT invoice_no, {item} FROM star) x JOIN (SELECT DISTINCT invoice_no, {item} FROM star) y
                       ON x.invoice_no = y.invoice_no AND x.{item} < y.{item}
                     GROUP BY 1, 2 HAVING count(*) >= {least})
               ORDER BY n DESC, a, b LIMIT 50"""


def _stack(source: str, rows: list[tuple[str, str]], name: str = "metric", value: str = "value") -> str:
    return " UNION ALL ".join(f"SELECT {_text(text)} AS {name}, {sql} AS {value} FROM {source}" for text, sql in rows)


def _scorecard() -> str:
    one = f"""(SELECT count(*) AS n, count(*) FILTER (WHERE is_valid) AS good, count(DISTINCT customer_id) AS customers,
                      count(DISTINCT invoice_no) AS invoices, count(DISTINCT stock_code) AS products, count(DISTINCT country) AS countries,
                      sum(amount_c) FILTER (WHERE is_valid) AS c, min(invoice_date) AS a, max(invoice_date) AS z,
                      count(customer_id) FILTER (WHERE is_valid) AS wc, count(description) FILTER (WHERE is_valid) AS wd,
                      count(invoice_date) FILTER (WHERE is_valid) AS wt, (SELECT count(*) FROM raw) AS r
               FROM stg)"""
    ok, warn, bad = map(_text, (V.PASSED, V.WARNING, V.FAILED))

    def percent(part: str, whole: str) -> str:
        return f"printf('%.2f%%', {pct(part, whole)})"

    def grade(value: str, *limits: tuple[str, str], worst: str = bad) -> str:
        return "CASE " + " ".join(f"WHEN {value} {test} THEN {status}" for test, status in limits) + f" ELSE {worst} END"

    rows = [
        ("1. Data Ingestion", "Raw → Staging Records", "r || ' → ' || n", "100% transfer", grade("n", ("= r", ok), (">= r * 0.99", warn))),
        ("2. Data Quality", "Validation Success Rate", percent("good", "n"), "≥ 70%", grade("100 * good", (">= 70 * n", ok), (">= 50 * n", warn))),
        ("2. Data Quality", "Invalid Records Identified", "CAST(n - good AS VARCHAR)", "Documented", ok),
        ("3. Business Metrics", "Total Revenue", "'$' || CAST(CAST(c AS DECIMAL(22,0)) / 100 AS DECIMAL(22,2))", "> $0", grade("c", ("> 0", ok), ("= 0", warn))),
        ("3. Business Metrics", "Unique Customers", "CAST(customers AS VARCHAR)", "> 1000", grade("customers", ("> 1000", ok), ("> 500", warn))),
        ("3. Business Metrics", "Unique Products", "CAST(products AS VARCHAR)", "> 100", grade("products", ("> 100", ok), worst=warn)),
        ("3. Business Metrics", "Unique Countries", "CAST(countries AS VARCHAR)", "> 10", grade("countries", ("> 10", ok), worst=warn)),
        ("4. Temporal Data", "Date Range", "strftime(a, '%Y-%m-%d') || ' to ' || strftime(z, '%Y-%m-%d')", "Valid dates", grade("z", ("> a", ok))),
        ("4. Temporal Data", "Date Coverage (days)", "CAST(date_diff('day', a, z) AS VARCHAR)", "> 30 days", grade("date_diff('day', a, z)", ("> 30", ok), worst=warn)),
        ("5. Data Completeness", "Customer ID Coverage", percent("wc", "good"), "≥ 60%", grade("100 * wc", (">= 60 * good", ok), (">= 40 * good", warn))),
        ("5. Data Completeness", "Product Description Coverage", percent("wd", "good"), "≥ 90%", grade("100 * wd", (">= 90 * good", ok), (">= 75 * good", warn))),
        ("5. Data Completeness", "Invoice Date Coverage", percent("wt", "good"), "100%", grade("wt", ("= good", ok))),
        ("6. Data Structure", "Unique Invoice Numbers", "CAST(invoices AS VARCHAR)", "> 0", grade("invoices", ("> 0", ok))),
    ]
    title = f"SELECT {_text(V.SCORECARD_TITLE)} AS check_category, NULL AS metric, NULL AS value, NULL AS threshold, NULL AS status"
    checks = [f"SELECT {_text(a)}, {_text(b)}, {value}, {_text(limit)}, {status} FROM {one}" for a, b, value, limit, status in rows]
    return " UNION ALL ".join([title, *checks])


def _log_answers() -> dict[str, tuple[str, str]]:
    seconds, gigabytes = ratio("total_elapsed_time", "1000", 6), ratio("bytes_scanned", "1073741824", 6)
    return {
        "qlog_slowest": (
            "query_id:s query_text:s database_name:s schema_name:s execution_status:s execution_time_seconds:f bytes_scanned:i rows_produced:i start_time:t",
            f"SELECT *, {seconds} AS execution_time_seconds FROM day_log WHERE execution_status = 'SUCCESS' ORDER BY total_elapsed_time DESC, query_id LIMIT 20",
        ),
        "qlog_most_scanned": (
            "query_id:s query_snippet:s execution_time_seconds:f gb_scanned:f rows_produced:i",
            f"""SELECT *, substr(query_text, 1, 100) AS query_snippet, {seconds} AS execution_time_seconds, {gigabytes} AS gb_scanned
                FROM day_log WHERE bytes_scanned > 0 ORDER BY bytes_scanned DESC, query_id LIMIT 10""",
        ),
        "qlog_by_user": (
            "user_name:s query_count:i total_execution_seconds:f avg_execution_seconds:f total_gb_scanned:f",
            f"""SELECT user_name, count(*) AS query_count, {ratio('sum(total_elapsed_time)', '1000', 6)} AS total_execution_seconds,
                       {ratio('sum(total_elapsed_time)', 'count(*) * 1000', 6)} AS avg_execution_seconds,
                       {ratio('sum(bytes_scanned)', '1073741824', 6)} AS total_gb_scanned
                FROM day_log WHERE execution_status = 'SUCCESS' GROUP BY user_name""",
        ),
        "qlog_failed": (
            "query_id:s query_text:s error_code:s error_message:s start_time:t",
            "SELECT * FROM day_log WHERE execution_status = 'FAILED' ORDER BY start_time DESC, query_id LIMIT 20",
        ),
        "qlog_daily": (
            "query_date:d daily_query_count:i daily_execution_seconds:f",
            f"""SELECT CAST(start_time AS DATE) AS query_date, count(*) AS daily_query_count,
                       {ratio('sum(total_elapsed_time)', '1000', 6)} AS daily_execution_seconds
                FROM log WHERE database_name = 'sales' AND start_time >= TIMESTAMP '{K.LOG_NOW}' - INTERVAL 30 DAY
                  AND start_time <= TIMESTAMP '{K.LOG_NOW}' GROUP BY 1""",
        ),
        "qlog_search": (
            "query_id:s query_text:s total_elapsed_time:i bytes_scanned:i",
            f"SELECT * FROM log WHERE contains(query_text, {_text(K.LOOKUP['log'])}) ORDER BY start_time DESC, query_id LIMIT 5",
        ),
        "qlog_compare": (
            "version:s total_elapsed_time:i bytes_scanned:i",
            f"""SELECT CASE query_id WHEN '{K.LOG_PAIR[0]}' THEN 'Baseline' ELSE 'Optimized' END AS version, * FROM log
                WHERE query_id IN ('{K.LOG_PAIR[0]}', '{K.LOG_PAIR[1]}')""",
        ),
    }


def _source_answers() -> dict[str, tuple[str, str]]:
    good = "o_orderkey % 103 <> 0"
    columns = [item.split(":")[0] for item in _RAW_SPEC.split()]
    fields = " || ',' || ".join(f"coalesce({c}, '')" for c in columns[:-1])
    firsts = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return {
        "src_copy_csv": (_RAW_SPEC, f"SELECT * FROM raw WHERE {good}"),
        "src_copy_parquet": (_RAW_SPEC, "SELECT * REPLACE (CASE WHEN customer_id IS NOT NULL THEN customer_id || '.0' END AS customer_id) FROM raw"),
        "src_csv_preview": (_RAW_SPEC, f"SELECT * FROM raw ORDER BY {firsts} LIMIT 10"),
        "src_parquet_preview": (
            _RAW_SPEC,
            "SELECT * FROM (SELECT * REPLACE (CASE WHEN customer_id IS NOT NULL THEN customer_id || '.0' END AS customer_id) FROM raw) "
            f"ORDER BY {firsts} LIMIT 10",
        ),
        "raw_sample": (_RAW_SPEC, f"SELECT * FROM raw ORDER BY {firsts} LIMIT 10"),
        "src_on_error": (_RAW_SPEC, f"SELECT * FROM raw WHERE {good}"),
        "src_failed_rows": (
            "error:s raw_text:s",
            f"SELECT 'number of fields does not match' AS error, {fields} || ',~' || country || ',extra~' AS raw_text FROM raw WHERE NOT ({good})",
        ),
        "src_load_history": (
            "row_count:i row_parsed:i error_count:i",
            f"SELECT count(*) FILTER (WHERE {good}) AS row_count, count(*) AS row_parsed, count(*) FILTER (WHERE NOT ({good})) AS error_count FROM raw",
        ),
        "src_incremental": (_RAW_SPEC, f"SELECT * FROM raw WHERE {good} AND file_name >= 'sales-1999.csv'"),
        "src_incremental_stream": (_RAW_SPEC, f"SELECT * FROM raw WHERE {good}"),
        "src_trace_row": ("file_name:s file_row_number:i invoice_no:s", f"SELECT * FROM raw WHERE invoice_no = {_text(K.LOOKUP['invoice'])}"),
        "src_trace_row_range": (
            f"{_RAW_SPEC} load_timestamp:t file_name:s file_row_number:i",
            f"SELECT * FROM raw WHERE file_name = '{K.TRACE[0]}' AND file_row_number BETWEEN {K.TRACE[1]} AND {K.TRACE[2]}",
        ),
        "src_load_batches": (
            "load_hour:t rows_loaded:i",
            "SELECT date_trunc('hour', load_timestamp) AS load_hour, count(*) AS rows_loaded FROM raw GROUP BY 1",
        ),
        "raw_row_count": ("total_rows:i distinct_files:i", "SELECT count(*) AS total_rows, count(DISTINCT file_name) AS distinct_files FROM raw"),
        "raw_nulls": (
            "total_rows:i " + " ".join(f"null_{c}:i" for c in columns if c != "description"),
            "SELECT count(*) AS total_rows, " + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in columns) + " FROM raw",
        ),
        "raw_audit": (
            "earliest_load:t latest_load:t file_count:i min_row_number:i max_row_number:i",
            """SELECT min(load_timestamp) AS earliest_load, max(load_timestamp) AS latest_load, count(DISTINCT file_name) AS file_count,
                      min(file_row_number) AS min_row_number, max(file_row_number) AS max_row_number FROM raw""",
        ),
        "raw_country_dist": (
            "country:s transaction_count:i percentage:f",
            f"""SELECT country, n AS transaction_count, {pct('n', 'sum(n) OVER ()')} AS percentage
                FROM (SELECT country, count(*) AS n FROM raw GROUP BY country) ORDER BY n DESC, country LIMIT 10""",
        ),
        "csv_to_parquet": (
            "row_count:i column_count:i first_date:s last_date:s unique_invoices:i unique_products:i unique_customers:i",
            f"""SELECT count(*) AS row_count, 8 AS column_count, min(invoice_date) AS first_date, max(invoice_date) AS last_date,
                       {_ORDERS} AS unique_invoices, count(DISTINCT stock_code) AS unique_products,
                       count(DISTINCT customer_id) AS unique_customers FROM raw""",
        ),
    }


def _staging_answers() -> dict[str, tuple[str, str]]:
    n, good = "count(*)", "count(*) FILTER (WHERE is_valid)"
    breakdown = f"""SELECT quality_issues, n AS issue_count, {pct('n', 'sum(n) OVER ()')} AS percentage
                    FROM (SELECT quality_issues, count(*) AS n FROM stg WHERE NOT is_valid GROUP BY 1)"""
    amount = "amount_c / 100"
    completeness = ["invoice_no", "stock_code", "description", "country", "customer_id", "quantity", "price_c", "invoice_date"]

    def outliers(column: str, label: str) -> str:
        return f"""SELECT *, price_c / 100 AS unit_price, {amount} AS total_amount, {_text(label)} AS outlier_type FROM v
                   WHERE {column} > (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.99) FROM v)
                   ORDER BY {column} DESC, _source_row_id LIMIT 20"""

    return {
        "stg_orders": (_STG_SPEC, f"SELECT *, price_c / 100 AS unit_price, {amount} AS total_amount FROM stg"),
        "stg_is_valid": ("is_valid:b rows:i", "SELECT is_valid, count(*) AS rows FROM stg GROUP BY 1"),
        "stg_quality_issues": ("_source_row_id:i quality_issues:s", "SELECT * FROM stg WHERE quality_issues IS NOT NULL"),
        "stg_source_row_id": ("_source_row_id:i invoice_no:s", "SELECT * FROM stg"),
        "stg_load_summary": (
            "metric:s value:f",
            _stack("stg", [("Total Rows Loaded", n), ("Valid Rows", good), ("Invalid Rows", f"{n} - {good}"), ("Validation Success Rate", pct(good, n))]),
        ),
        "stg_issue_breakdown": ("quality_issues:s issue_count:i percentage:f", breakdown),
        "stg_date_range": (
            "metric:s value:s",
            _stack("v", [
                ("Earliest Transaction", "strftime(min(invoice_date), '%Y-%m-%d %H:%M:%S')"),
                ("Latest Transaction", "strftime(max(invoice_date), '%Y-%m-%d %H:%M:%S')"),
                ("Date Range (Days)", "CAST(date_diff('day', min(invoice_date), max(invoice_date)) AS VARCHAR)"),
            ]),
        ),
        "stg_valid_summary": (
            "unique_invoices:i unique_customers:i unique_products:i unique_countries:i total_revenue:f avg_transaction_value:f",
            f"""SELECT {_ORDERS} AS unique_invoices, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT stock_code) AS unique_products,
                       count(DISTINCT country) AS unique_countries, {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_transaction_value FROM v""",
        ),
        "stg_guest_share": (
            "total_valid_records:i records_without_customer_id:i percentage_without_customer_id:f",
            f"""SELECT count(*) AS total_valid_records, count(*) - count(customer_id) AS records_without_customer_id,
                       {pct('count(*) - count(customer_id)', 'count(*)')} AS percentage_without_customer_id FROM v""",
        ),
        "stg_clean_only": (
            "invoice_no:s stock_code:s description:s quantity:i invoice_date:t unit_price:f customer_id:i country:s total_price:f",
            f"""SELECT * REPLACE (upper(country) AS country), price_c / 100 AS unit_price, {amount} AS total_price FROM stg
                WHERE quantity > 0 AND price_c > 0 AND customer_id IS NOT NULL""",
        ),
        "stg_transaction_type": (
            "transaction_type:s rows:i units:i",
            "SELECT CASE WHEN quantity < 0 THEN 'RETURN' ELSE 'SALE' END AS transaction_type, count(*) AS rows, sum(quantity) AS units FROM stg GROUP BY 1",
        ),
        "stg_dedup": (
            "invoice_no:s stock_code:s quantity:i unit_price:f _source_row_id:i",
            """SELECT *, price_c / 100 AS unit_price FROM stg
               QUALIFY row_number() OVER (PARTITION BY invoice_no, stock_code ORDER BY _source_row_id DESC) = 1""",
        ),
        "dq_scorecard": ("check_category:s metric:s value:s threshold:s status:s", _scorecard()),
        "dq_overall": (
            "total_records:i unique_invoices:i unique_customers:i unique_products:i unique_countries:i earliest_transaction:t latest_transaction:t date_range_days:i",
            f"""SELECT count(*) AS total_records, {_ORDERS} AS unique_invoices, count(DISTINCT customer_id) AS unique_customers,
                       count(DISTINCT stock_code) AS unique_products, count(DISTINCT country) AS unique_countries, min(invoice_date) AS earliest_transaction,
                       max(invoice_date) AS latest_transaction, date_diff('day', min(invoice_date), max(invoice_date)) AS date_range_days FROM v""",
        ),
        "dq_success_rate": (
            "metric:s total_records:i valid_records:i invalid_records:i success_rate_pct:f",
            f"SELECT 'Validation Success Rate' AS metric, {n} AS total_records, {good} AS valid_records, {n} - {good} AS invalid_records, {pct(good, n)} AS success_rate_pct FROM stg",
        ),
        "dq_invalid_breakdown": (
            "quality_issues:s issue_count:i percentage_of_invalid:f",
            f"SELECT quality_issues, issue_count, percentage AS percentage_of_invalid FROM ({breakdown})",
        ),
        "dq_revenue_stats": (
            "total_revenue:f avg_transaction_amount:f median_transaction_amount:f min_transaction_amount:f max_transaction_amount:f stddev_transaction_amount:f",
            f"""SELECT {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_transaction_amount,
                       {half_up('median(CAST(amount_c AS DOUBLE)) / 100', 2)} AS median_transaction_amount, min(amount_c) / 100 AS min_transaction_amount,
                       max(amount_c) / 100 AS max_transaction_amount, {half_up('stddev_samp(CAST(amount_c AS DOUBLE)) / 100', 2)} AS stddev_transaction_amount FROM v""",
        ),
        "dq_top_countries": (
            "country:s order_count:i unique_customers:i unique_invoices:i total_revenue:f avg_order_value:f",
            f"""SELECT country, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers, {_ORDERS} AS unique_invoices,
                       {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_order_value FROM v GROUP BY 1 ORDER BY sum(amount_c) DESC, 1 LIMIT 10""",
        ),
        "dq_top_products": (
            "stock_code:s description:s total_quantity_sold:i number_of_orders:i total_revenue:f avg_unit_price:f",
            f"""SELECT stock_code, description, sum(quantity) AS total_quantity_sold, count(*) AS number_of_orders, {_REVENUE} AS total_revenue,
                       {cents_ratio('sum(price_c)', 'count(*)')} AS avg_unit_price FROM v GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
        ),
        "dq_monthly": (
            "year_month:s order_count:i unique_customers:i monthly_revenue:f avg_order_value:f",
            f"""SELECT strftime(invoice_date, '%Y-%m') AS year_month, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers,
                       {_REVENUE} AS monthly_revenue, {_MEAN_LINE} AS avg_order_value FROM v GROUP BY 1""",
        ),
        "dq_weekday": (
            "day_of_week:s order_count:i total_revenue:f avg_order_value:f",
            f"SELECT strftime(invoice_date, '%a') AS day_of_week, count(*) AS order_count, {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_order_value FROM v GROUP BY 1",
        ),
        "dq_hourly": (
            "hour_of_day:i order_count:i total_revenue:f",
            f"SELECT hour(invoice_date) AS hour_of_day, count(*) AS order_count, {_REVENUE} AS total_revenue FROM v GROUP BY 1",
        ),
        "dq_customer_counts": (
            "metric:s value:i",
            _stack("v", [
                ("Total Valid Records", n), ("Records with Customer ID", "count(customer_id)"),
                ("Records without Customer ID (Guest Checkout)", "count(*) - count(customer_id)"), ("Unique Customers", "count(DISTINCT customer_id)"),
            ]),
        ),
        "dq_top_customers": (
            "customer_id:i order_count:i unique_invoices:i total_revenue:f avg_order_value:f",
            f"""SELECT customer_id, count(*) AS order_count, {_ORDERS} AS unique_invoices, {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_order_value
                FROM v WHERE customer_id IS NOT NULL GROUP BY 1 ORDER BY sum(amount_c) DESC, 1 LIMIT 10""",
        ),
        "dq_outlier_amount": (
            "invoice_no:s invoice_date:t customer_id:i country:s quantity:i unit_price:f total_amount:f outlier_type:s",
            outliers("amount_c", "High value transaction"),
        ),
        "dq_outlier_quantity": (
            "invoice_no:s stock_code:s description:s quantity:i unit_price:f total_amount:f outlier_type:s",
            outliers("quantity", "High quantity order"),
        ),
        "dq_date_key_sample": (
            "invoice_date_key:i record_count:i min_date:t max_date:t",
            "SELECT invoice_date_key, count(*) AS record_count, min(invoice_date) AS min_date, max(invoice_date) AS max_date FROM v GROUP BY 1 ORDER BY 1 LIMIT 10",
        ),
        "dq_date_nulls": (
            "null_date_keys:i null_invoice_dates:i",
            "SELECT count(*) - count(invoice_date_key) AS null_date_keys, count(*) - count(invoice_date) AS null_invoice_dates FROM v",
        ),
        "dq_completeness": (
            "column_name:s total_records:i non_null_count:i null_count:i completeness_pct:f",
            " UNION ALL ".join(
                f"""SELECT '{'unit_price' if c == 'price_c' else c}' AS column_name, count(*) AS total_records, count({c}) AS non_null_count,
                           count(*) - count({c}) AS null_count, {pct(f'count({c})', 'count(*)')} AS completeness_pct FROM v"""
                for c in completeness
            ),
        ),
        "dq_layer_counts": (
            "layer:s total_records:i",
            " UNION ALL ".join([
                "SELECT 'RAW Layer' AS layer, count(*) AS total_records FROM raw",
                _stack("stg", [("STAGING Layer (All)", n), ("STAGING Layer (Valid)", good), ("STAGING Layer (Invalid)", f"{n} - {good}")], "layer", "total_records"),
            ]),
        ),
    }


def _dimension_answers() -> dict[str, tuple[str, str]]:
    country_spec = "country_key:i country_name:s country_code:s region:s"
    sample_days = ", ".join(f"DATE '{day}'" for day in K.SAMPLE_DAYS)
    (one, _, a1, b1), (_, _, a2, b2), (_, _, a3, b3), (_, _, a4, b4) = V.ORDER_SEGMENTS

    def segment(*names: str) -> str:
        low, some, many, most = map(_text, names)
        o = "total_lifetime_orders"
        return f"CASE WHEN {o} = {one} THEN {low} WHEN {o} BETWEEN 2 AND 5 THEN {some} WHEN {o} BETWEEN 6 AND 10 THEN {many} ELSE {most} END"

    under, to5, to10, to20, over = map(_text, V.PRICE_BANDS)
    categories = " UNION ALL ".join(f"SELECT {i} AS category_key, {_text(c)} AS category_name" for i, c in enumerate(V.CATEGORIES, 1))
    keyword = "CASE " + " ".join(
        f"WHEN {' OR '.join(f'contains(upper(description), {_text(w)})' for w in words)} THEN {key}" for words, key in V.CATEGORY_KEYWORDS
    ) + " ELSE 1 END"
    product_top = "stock_code:s description:s unit_price:f first_sold_date:d"
    return {
        "dim_date": ("date_key:i date:d year:i quarter:i month:i month_name:s day:i day_of_week:i day_name:s is_weekend:b", "SELECT * FROM cal"),
        "dim_date_checks_1": ("total_rows:i", "SELECT count(*) AS total_rows FROM cal"),
        "dim_date_checks_2": (
            "earliest_date:d latest_date:d total_days:i",
            "SELECT min(date) AS earliest_date, max(date) AS latest_date, max(date) - min(date) + 1 AS total_days FROM cal",
        ),
        "dim_date_checks_3": (
            "date_key:i date:d year:i quarter:i month_name:s day_name:s is_weekend:b", f"SELECT * FROM cal WHERE date IN ({sample_days})",
        ),
        "dim_date_checks_4": (
            "is_weekend:b day_count:i percentage:f",
            f"SELECT is_weekend, count(*) AS day_count, {pct('count(*)', '(SELECT count(*) FROM cal)')} AS percentage FROM cal GROUP BY 1",
        ),
        "dim_date_checks_5": (
            "year:i days_in_year:i year_start:d year_end:d",
            "SELECT year, count(*) AS days_in_year, min(date) AS year_start, max(date) AS year_end FROM cal GROUP BY 1",
        ),
        "dim_country": (country_spec, "SELECT * FROM ctry"),
        "dim_country_checks_1": (country_spec, "SELECT * FROM ctry"),
        "dim_country_checks_2": ("region:s country_count:i", "SELECT region, count(*) AS country_count FROM ctry GROUP BY 1"),
        "dim_country_checks_3": (country_spec, f"SELECT * FROM ctry WHERE country_name = {_text(K.LOOKUP['country'])}"),
        "dim_country_checks_4": ("null_countries:i", "SELECT count(*) - count(country_name) AS null_countries FROM ctry"),
        "dim_category": (
            "category_key:i category_name:s products:i",
            f"""SELECT c.*, count(stock_code) AS products FROM ({categories}) c
                LEFT JOIN (SELECT stock_code, {keyword} AS filed FROM prod) ON filed = category_key GROUP BY ALL""",
        ),
        "dim_customer": (_CUST_SPEC, "SELECT * FROM cust"),
        "dim_customer_by_country": (_CUST_SPEC, "SELECT * FROM cust"),
        "dim_customer_checks_1": (_CUST_SPEC, "SELECT * FROM cust ORDER BY customer_key LIMIT 10"),
        "dim_customer_checks_2": ("_is_current:b customer_count:i", "SELECT _is_current, count(*) AS customer_count FROM cust GROUP BY 1"),
        "dim_customer_checks_3": (
            "customer_segment:s customer_count:i", f"SELECT {segment(a1, a2, a3, a4)} AS customer_segment, count(*) AS customer_count FROM cust GROUP BY 1",
        ),
        "dim_customer_checks_4": (
            "country_name:s region:s customer_count:i",
            """SELECT country_name, region, count(*) AS customer_count FROM cust JOIN ctry USING (country_key)
               WHERE _is_current GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10""",
        ),
        "dim_customer_checks_5": ("customers_without_country:i", "SELECT count(*) - count(country_key) AS customers_without_country FROM cust"),
        "dim_customer_checks_6": (
            "customer_id:i total_lifetime_orders:i first_order_date:d last_order_date:d customer_tenure_days:i",
            """SELECT *, last_order_date - first_order_date AS customer_tenure_days FROM cust WHERE _is_current
               ORDER BY total_lifetime_orders DESC, customer_id LIMIT 10""",
        ),
        "dim_product": (_PRODUCT_SPEC, _PRODUCT),
        "dim_product_checks_1": (_PRODUCT_SPEC, f"{_PRODUCT} ORDER BY product_key LIMIT 10"),
        "dim_product_checks_2": ("_is_current:b product_count:i", f"SELECT _is_current, count(*) AS product_count FROM ({_PRODUCT}) GROUP BY 1"),
        "dim_product_checks_3": (
            "price_range:s product_count:i",
            f"""SELECT CASE WHEN list_c < 100 THEN {under} WHEN list_c <= 500 THEN {to5} WHEN list_c <= 1000 THEN {to10}
                            WHEN list_c <= 2000 THEN {to20} ELSE {over} END AS price_range, count(*) AS product_count FROM prod GROUP BY 1""",
        ),
        "dim_product_checks_4": ("category_name:s product_count:i", f"SELECT {_CATEGORY} AS category_name, count(*) AS product_count FROM prod"),
        "dim_product_checks_5": (product_top, f"{_PRODUCT} ORDER BY list_c DESC, stock_code LIMIT 10"),
        "dim_product_checks_6": (product_top, f"{_PRODUCT} ORDER BY first_sold_date DESC, stock_code LIMIT 10"),
        "dim_product_checks_7": (
            "products_without_description:i",
            "SELECT count(*) FILTER (WHERE coalesce(trim(description), '') = '') AS products_without_description FROM prod",
        ),
        "dim_product_categorise": (
            "stock_code:s description:s category_key:i",
            """SELECT stock_code, description, CASE WHEN description ILIKE '%ring%' THEN 7 WHEN description ILIKE '%gizmo%' OR description ILIKE '%widget%' THEN 6
                      WHEN description ILIKE '%plate%' THEN 2 WHEN description ILIKE '%rin%' OR description ILIKE '%gear%' THEN 4 ELSE 1 END AS category_key FROM prod""",
        ),
        "rep_order_buckets": (
            "order_count_bucket:s customer_count:i percent_of_customers:f",
            f"""SELECT {segment(b1, b2, b3, b4)} AS order_count_bucket, count(DISTINCT customer_id) AS customer_count,
                       {pct('count(DISTINCT customer_id)', '(SELECT count(DISTINCT customer_id) FROM cust)')} AS percent_of_customers
                FROM cust WHERE _is_current GROUP BY 1""",
        ),
    }


def _version_answers() -> dict[str, tuple[str, str]]:
    moment = f"TIMESTAMP '{K.SCD_MOMENT}'"
    update = """(SELECT CAST(c_custkey AS INTEGER) AS customer_id,
                        'NATION_' || ((c_nationkey + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END) % 25) AS country FROM customer)"""
    changed = f"""(SELECT n.* FROM {update} n LEFT JOIN cust ON cust.customer_id = n.customer_id AND cust.country = n.country AND _is_current
                   WHERE cust.customer_id IS NULL)"""
    prices = """(SELECT CAST(p_partkey AS VARCHAR) AS stock_code, p_name || CASE WHEN p_partkey % 7 = 0 THEN ' (new)' ELSE '' END AS description,
                        CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 5000 AS BIGINT) AS new_c FROM part)"""
    at = f"TIMESTAMP '{K.CHANGE_TIME}'"
    moved = f"SELECT stock_code, list_c / 100 AS old_price, new_c / 100 AS new_price FROM prod JOIN {prices} n USING (stock_code)"
    return {
        "scd2_current": ("customer_id:i country_name:s _effective_from:t", "SELECT *, country AS country_name FROM cust WHERE _effective_to IS NULL"),
        "scd2_as_of": (
            "customer_id:i country_name:s _effective_from:t _effective_to:t",
            f"SELECT *, country AS country_name FROM cust WHERE _effective_from <= {moment} AND coalesce(_effective_to, TIMESTAMP '9999-12-31') > {moment}",
        ),
        "scd2_history": (
            "customer_id:i country_name:s _effective_from:t _effective_to:t _is_current:b",
            f"SELECT *, country AS country_name FROM cust WHERE customer_id = {K.LOOKUP['customer']}",
        ),
        "scd2_detect_customer": ("customer_id:i country:s", f"SELECT * FROM {changed}"),
        "scd2_detect_product": ("stock_code:s old_price:f new_price:f", f"{moved} WHERE abs(new_c - list_c) * 10 > list_c"),
        "scd2_detect_product_any": (
            "stock_code:s description:s old_price:f new_price:f",
            f"""SELECT stock_code, n.description, list_c / 100 AS old_price, new_c / 100 AS new_price FROM prod JOIN {prices} n USING (stock_code)
                WHERE abs(new_c - list_c) * 10 > list_c OR n.description IS DISTINCT FROM prod.description""",
        ),
        "scd2_apply": (
            _CUST_SPEC,
            f"""SELECT o.customer_key, o.customer_id, o.country_key, o.first_order_date, o.last_order_date, o.total_lifetime_orders, o._effective_from,
                       CASE WHEN x.customer_id IS NULL THEN o._effective_to ELSE {at} END AS _effective_to, x.customer_id IS NULL AS _is_current
                FROM cust o LEFT JOIN {changed} x USING (customer_id)
                UNION ALL
                SELECT (SELECT max(customer_key) FROM cust) + row_number() OVER (ORDER BY x.customer_id), x.customer_id, ctry.country_key,
                       first_order_date, last_order_date, total_lifetime_orders, {at}, NULL, TRUE
                FROM {changed} x JOIN ctry ON x.country = country_name LEFT JOIN cust ON cust.customer_id = x.customer_id""",
        ),
        "scd2_apply_product": (
            _PRODUCT_SPEC,
            f"""WITH n AS (SELECT stock_code, n.description, new_c FROM prod JOIN {prices} n USING (stock_code)
                           WHERE abs(new_c - list_c) * 10 > list_c OR n.description IS DISTINCT FROM prod.description)
                SELECT product_key, p.stock_code, p.description, category_key, list_c / 100 AS unit_price, first_sold_date,
                       CAST(first_sold_date AS TIMESTAMP) AS _effective_from, CASE WHEN n.stock_code IS NULL THEN NULL ELSE {at} END AS _effective_to,
                       n.stock_code IS NULL AS _is_current
                FROM prod p LEFT JOIN n USING (stock_code)
                UNION ALL
                SELECT (SELECT max(product_key) FROM prod) + row_number() OVER (ORDER BY stock_code), stock_code, n.description, category_key, new_c / 100,
                       first_sold_date, {at}, NULL, TRUE
                FROM n JOIN prod USING (stock_code)""",
        ),
        "scd2_deliver": (
            "customer_id:i country_name:s _effective_from:t _effective_to:t _is_current:b", "SELECT *, country AS country_name FROM cust",
        ),
        "scd2_build": (_CUST_SPEC, "SELECT * FROM cust"),
    }


def _fact_answers() -> dict[str, tuple[str, str]]:
    strange = f"""(SELECT _source_row_id, invoice_no, CASE WHEN CAST(stock_code AS INT) % {K.LOST_PART} = 0 THEN 'X' ELSE '' END || stock_code AS stock_code,
                          CASE WHEN CAST(stock_code AS INT) % {K.LOST_COUNTRY} = 0 THEN 'UNLISTED' ELSE country END AS country FROM v)"""
    no_part, no_country = "stock_code NOT IN (SELECT stock_code FROM prod)", "country NOT IN (SELECT country_name FROM ctry)"
    astray = f"SELECT * REPLACE (CASE WHEN sales_key % {K.ASTRAY} = 0 THEN -{{0}} ELSE {{0}} END AS {{0}}) FROM f"
    year = f"BETWEEN {K.MERGE_YEAR[0]} AND {K.MERGE_YEAR[1]}"
    source = f"""(SELECT invoice_no, product_key, date_key, country_key, max(customer_key) AS customer_key, sum(quantity) AS quantity,
                         (max(price_c) + 1) // 2 AS price_c FROM f WHERE date_key {year} GROUP BY ALL)"""
    wide = f"""SELECT *, date AS invoice_date, description AS product_name, {_CATEGORY} AS category_name, price_c / 100 AS unit_price,
                      amount_c / 100 AS total_amount FROM star"""
    wide_spec = (
        "sales_key:i invoice_no:s invoice_date:d year:i month_name:s customer_id:i country_name:s region:s stock_code:s product_name:s "
        "category_name:s quantity:i unit_price:f total_amount:f"
    )
    both = "SELECT 'FACT TABLE' AS source, {0} FROM f UNION ALL SELECT 'STAGING (VALID)', {0} FROM v"
    sales = _FACT_SPEC.replace("sales_key:i ", "")
    layer = {"raw_transactions": "raw", "stg_orders": "stg", "dim_date": "cal", "dim_country": "ctry", "dim_customer": "cust",
             "dim_product": "prod", "fact_sales": "f"}
    return {
        "fact_sales": (_FACT_SPEC, _FACT_ROWS),
        "fact_sales_by_country": (_FACT_SPEC, _FACT_ROWS),
        "fact_sales_as_of": (
            _FACT_SPEC,
            """SELECT _source_row_id AS sales_key, invoice_date_key AS date_key, customer_key, product_key, ctry.country_key, invoice_no, quantity,
                      price_c / 100 AS unit_price, amount_c / 100 AS total_amount
               FROM v LEFT JOIN cust ON v.customer_id = cust.customer_id AND invoice_date >= _effective_from
                                    AND (_effective_to IS NULL OR invoice_date < _effective_to)
               JOIN prod ON v.stock_code = prod.stock_code AND invoice_date >= first_sold_date JOIN ctry ON v.country = country_name""",
        ),
        "fact_lookup_failures": (
            "_source_row_id:i invoice_no:s stock_code:s country:s reason:s",
            f"SELECT *, CASE WHEN {no_part} THEN 'product not found' ELSE 'country not found' END AS reason FROM {strange} WHERE {no_part} OR {no_country}",
        ),
        "fact_unknown_member": (
            _FACT_SPEC,
            f"""SELECT * REPLACE (CASE WHEN {no_part} THEN -1 ELSE product_key END AS product_key, CASE WHEN {no_country} THEN -1 ELSE country_key END AS country_key),
                       price_c / 100 AS unit_price, amount_c / 100 AS total_amount
                FROM f JOIN (SELECT _source_row_id AS sales_key, stock_code, country FROM {strange}) USING (sales_key)""",
        ),
        "fact_unknown_by_country": (
            "country_name:s region:s line_count:i revenue:f",
            f"""SELECT coalesce(country_name, 'Unknown') AS country_name, coalesce(region, {_text(V.OTHER_REGION)}) AS region, count(*) AS line_count, sum(amount_c) / 100 AS revenue
                FROM f JOIN (SELECT _source_row_id AS sales_key, country FROM {strange}) USING (sales_key) LEFT JOIN ctry ON country = country_name GROUP BY ALL""",
        ),
        "fact_late_members": (
            "sales_key:i stock_code:s country_name:s quantity:i total_amount:f",
            f"""SELECT sales_key, x.stock_code, x.country AS country_name, quantity, amount_c / 100 AS total_amount
                FROM f JOIN (SELECT _source_row_id AS sales_key, stock_code, country FROM {strange}) x USING (sales_key)""",
        ),
        "fact_slice_reload": (_FACT_SPEC, f"SELECT * FROM ({_FACT_ROWS}) WHERE {_AFTER_RELOAD}"),
        "fact_merge": (
            sales,
            f"""SELECT f.date_key, f.customer_key, f.product_key, f.country_key, f.invoice_no, coalesce(s.quantity, f.quantity) AS quantity,
                       coalesce(s.price_c, f.price_c) / 100 AS unit_price, coalesce(s.quantity * s.price_c, f.amount_c) / 100 AS total_amount
                FROM f LEFT JOIN {source} s ON s.invoice_no = f.invoice_no AND s.product_key = f.product_key
                UNION ALL
                SELECT date_key, customer_key, product_key, country_key, 'N' || invoice_no, quantity, price_c / 100, quantity * price_c / 100 FROM {source}""",
        ),
        "fact_doc_variant": (
            "sales_key:i invoice_no:s customer_key:i product_key:i date_key:i quantity:i unit_price:f total_amount:f",
            """SELECT row_number() OVER (ORDER BY s.invoice_date NULLS FIRST, invoice_no, s.stock_code, quantity, price_c, customer_key NULLS FIRST,
                                         product_key NULLS FIRST, s.description, s.country) AS sales_key,
                      invoice_no, customer_key, product_key, date_key, quantity, price_c / 100 AS unit_price, amount_c / 100 AS total_amount
               FROM stg s LEFT JOIN cust ON s.customer_id = cust.customer_id LEFT JOIN prod ON s.stock_code = prod.stock_code
               LEFT JOIN cal ON CAST(s.invoice_date AS DATE) = date
               WHERE quantity > 0 AND price_c > 0 AND s.customer_id IS NOT NULL""",
        ),
        "val_row_count": ("source:s row_count:i", both.format("count(*) AS row_count")),
        "val_row_count_by_country": ("source:s row_count:i", both.format("count(*) AS row_count")),
        "val_revenue": ("source:s total_revenue:f total_revenue_rounded:f", both.format(f"{_REVENUE} AS total_revenue, {_REVENUE} AS total_revenue_rounded")),
        "val_guest": (
            "total_fact_rows:i rows_with_customer:i rows_without_customer:i percent_guest_transactions:f",
            f"""SELECT count(*) AS total_fact_rows, count(customer_key) AS rows_with_customer, count(*) - count(customer_key) AS rows_without_customer,
                       {pct('count(*) - count(customer_key)', 'count(*)')} AS percent_guest_transactions FROM f""",
        ),
        "val_date_range_1": (
            "min_date_key:i max_date_key:i distinct_dates:i",
            "SELECT min(date_key) AS min_date_key, max(date_key) AS max_date_key, count(DISTINCT date_key) AS distinct_dates FROM f",
        ),
        "val_date_range_2": ("min_date:d max_date:d days_span:i", "SELECT min(date) AS min_date, max(date) AS max_date, max(date) - min(date) AS days_span FROM star"),
        **{
            f"val_orphans_{n}": (
                f"orphaned_{key}s:i",
                f"SELECT count(*) AS orphaned_{key}s FROM ({astray.format(key)}) WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {dim})",
            )
            for n, (key, dim) in enumerate({"date_key": "cal", "product_key": "prod", "country_key": "ctry", "customer_key": "cust"}.items(), 1)
        },
        "val_sample": (wide_spec, f"{wide} ORDER BY sales_key DESC LIMIT 20"),
        "val_wide": (wide_spec, wide),
        "load_counts": (
            "table:s row_count:i",
            " UNION ALL ".join([f"SELECT '{name}' AS \"table\", count(*) AS row_count FROM {cte}" for name, cte in layer.items()] + ["SELECT 'dim_category', 8"]),
        ),
        "val_total_rows": ("total_fact_rows:i", "SELECT count(*) AS total_fact_rows FROM f"),
        "layout_cluster": (_FACT_SPEC, _FACT_ROWS),
        "layout_interleaved": (_FACT_SPEC, _FACT_ROWS),
    }


def _report_answers() -> dict[str, tuple[str, str]]:
    keys = {"Date Key": "date_key", "Customer Key": "customer_key", "Product Key": "product_key", "Country Key": "country_key"}
    mean_price = cents_ratio("sum(price_c)", "count(*)")
    return {
        "rep_country": (
            "country_name:s order_lines:i total_units_sold:i total_revenue:f avg_line_item_value:f distinct_orders:i",
            f"""SELECT country_name, count(*) AS order_lines, sum(quantity) AS total_units_sold, {_REVENUE} AS total_revenue,
                       {_MEAN_LINE} AS avg_line_item_value, {_ORDERS} AS distinct_orders FROM star GROUP BY 1 ORDER BY sum(amount_c) DESC, 1 LIMIT 10""",
        ),
        "rep_region": (
            "region:s countries_in_region:i order_lines:i total_revenue:f avg_line_item_value:f",
            f"""SELECT region, count(DISTINCT country_name) AS countries_in_region, count(*) AS order_lines, {_REVENUE} AS total_revenue,
                       {_MEAN_LINE} AS avg_line_item_value FROM star GROUP BY 1""",
        ),
        "rep_month": (
            "year:i quarter:i month:i month_name:s monthly_revenue:f order_count:i line_item_count:i avg_line_item_value:f",
            f"""SELECT year, quarter, month, month_name, {_REVENUE} AS monthly_revenue, {_ORDERS} AS order_count, count(*) AS line_item_count,
                       {_MEAN_LINE} AS avg_line_item_value FROM star GROUP BY ALL""",
        ),
        "rep_year": (
            "year:i annual_revenue:f total_orders:i active_customers:i avg_order_value:f",
            f"""SELECT year, {_REVENUE} AS annual_revenue, {_ORDERS} AS total_orders, count(DISTINCT customer_key) AS active_customers,
                       {cents_ratio('sum(amount_c)', _ORDERS)} AS avg_order_value FROM star GROUP BY 1""",
        ),
        "rep_weekend": (
            "is_weekend:b day_type:s order_lines:i total_revenue:f avg_line_item_value:f order_count:i",
            f"""SELECT is_weekend, {_DAY_TYPE} AS day_type, count(*) AS order_lines, {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_line_item_value,
                       {_ORDERS} AS order_count FROM star GROUP BY 1""",
        ),
        "rep_products_revenue": _top_products("sum(amount_c)"),
        "rep_products_units": _top_products("sum(quantity)"),
        "rep_category": (
            "category_name:s product_count:i total_units_sold:i total_revenue:f avg_line_item_value:f orders_containing_category:i",
            f"""SELECT {_CATEGORY} AS category_name, count(DISTINCT product_key) AS product_count, sum(quantity) AS total_units_sold,
                       {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_line_item_value, {_ORDERS} AS orders_containing_category FROM star""",
        ),
        "rep_customers": (
            "customer_id:i country_name:s total_lifetime_orders:i total_units_purchased:i total_lifetime_value:f avg_line_item_value:f orders_in_period:i",
            f"""SELECT star.customer_id, home AS country_name, total_lifetime_orders, sum(quantity) AS total_units_purchased, {_REVENUE} AS total_lifetime_value,
                       {_MEAN_LINE} AS avg_line_item_value, {_ORDERS} AS orders_in_period
                FROM star JOIN cust USING (customer_key) GROUP BY 1, 2, 3 ORDER BY sum(amount_c) DESC, 1 LIMIT 10""",
        ),
        "rep_guest": (
            "customer_type:s order_lines:i order_count:i total_revenue:f avg_line_item_value:f percent_of_revenue:f",
            f"""SELECT CASE WHEN customer_key IS NULL THEN 'Guest Transaction' ELSE 'Registered Customer' END AS customer_type, count(*) AS order_lines,
                       {_ORDERS} AS order_count, {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_line_item_value,
                       {pct('sum(amount_c)', '(SELECT sum(amount_c) FROM f)')} AS percent_of_revenue FROM f GROUP BY 1""",
        ),
        "rep_sign": (
            "transaction_type:s row_count:i total_amount:f percent_of_rows:f",
            f"""SELECT CASE sign(quantity) WHEN -1 THEN 'Returns/Refunds' WHEN 0 THEN 'Zero Quantity (Data Issue)' ELSE 'Normal Sales' END AS transaction_type,
                       count(*) AS row_count, {_REVENUE} AS total_amount, {pct('count(*)', '(SELECT count(*) FROM f)')} AS percent_of_rows FROM f GROUP BY 1""",
        ),
        "rep_price_stats": (
            "metric:s value:f row_count:i",
            f"""SELECT 'Minimum Price' AS metric, min(price_c) / 100 AS value, count(*) FILTER (WHERE price_c = (SELECT min(price_c) FROM f)) AS row_count FROM f
                UNION ALL SELECT 'Maximum Price', max(price_c) / 100, count(*) FILTER (WHERE price_c = (SELECT max(price_c) FROM f)) FROM f
                UNION ALL SELECT 'Average Price', {mean_price}, NULL FROM f
                UNION ALL SELECT 'Median Price', {half_up('median(CAST(price_c AS DOUBLE)) / 100', 2)}, NULL FROM f""",
        ),
        "rep_key_nulls": (
            "dimension:s total_rows:i non_null_count:i null_count:i",
            " UNION ALL ".join(
                f"SELECT '{name}' AS dimension, count(*) AS total_rows, count({key}) AS non_null_count, count(*) - count({key}) AS null_count FROM f"
                for name, key in keys.items()
            ),
        ),
        "rep_kpis": (
            "total_revenue:f avg_line_item_value:f total_line_items:i total_orders:i total_units_sold:i active_customers:i guest_transactions:i "
            "products_sold:i countries_served:i avg_order_value:f avg_items_per_order:f revenue_per_customer:f",
            f"""SELECT {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_line_item_value, count(*) AS total_line_items, {_ORDERS} AS total_orders,
                       sum(quantity) AS total_units_sold, count(DISTINCT customer_key) AS active_customers, count(*) - count(customer_key) AS guest_transactions,
                       count(DISTINCT product_key) AS products_sold, count(DISTINCT country_key) AS countries_served,
                       {cents_ratio('sum(amount_c)', _ORDERS)} AS avg_order_value, {ratio('count(*)', _ORDERS)} AS avg_items_per_order,
                       {cents_ratio('sum(amount_c)', 'count(DISTINCT customer_key)')} AS revenue_per_customer FROM f""",
        ),
        "pat_customer_or_guest": ("customer:s revenue:f", f"SELECT coalesce(CAST(customer_id AS VARCHAR), 'GUEST') AS customer, {_REVENUE} AS revenue FROM star GROUP BY 1"),
        "pat_order_totals_1": ("order_count:i", f"SELECT {_ORDERS} AS order_count FROM f"),
        "pat_order_totals_2": ("invoice_no:s order_total:f", f"SELECT invoice_no, {_REVENUE} AS order_total FROM f GROUP BY 1"),
        "pat_quarter": ("year:i quarter:i quarterly_revenue:f", f"SELECT year, quarter, {_REVENUE} AS quarterly_revenue FROM star GROUP BY ALL"),
        "pat_geo": ("region:s country_name:s revenue:f", f"SELECT region, country_name, {_REVENUE} AS revenue FROM star GROUP BY ALL"),
        "pat_region_customers": (
            "region:s country_name:s customer_count:i total_revenue:f",
            f"""SELECT c.region, c.country_name, count(DISTINCT customer_key) AS customer_count, {_REVENUE} AS total_revenue
                FROM f JOIN cust USING (customer_key) JOIN ctry c ON c.country_key = cust.country_key WHERE _is_current GROUP BY 1, 2""",
        ),
        "pat_customers_per_region": (
            "region:s customer_count:i", "SELECT region, count(DISTINCT customer_id) AS customer_count FROM cust JOIN ctry USING (country_key) GROUP BY 1",
        ),
        "pat_products_per_category_1": ("category_name:s product_count:i", f"SELECT {_CATEGORY} AS category_name, count(*) AS product_count FROM prod"),
        "pat_products_per_category_2": (
            "stock_code:s description:s category_name:s unit_price:f", f"SELECT stock_code, description, {_CATEGORY} AS category_name, list_c / 100 AS unit_price FROM prod",
        ),
        "pat_monthly_active": (
            "year:i month_name:s monthly_revenue:f active_customers:i",
            f"SELECT year, month_name, {_REVENUE} AS monthly_revenue, count(DISTINCT customer_key) AS active_customers FROM star GROUP BY 1, 2",
        ),
        "pat_rfm_raw": (
            "customer_id:i recency_days:i frequency:i monetary_value:f",
            f"""SELECT customer_id, DATE '{K.AS_OF}' - last_order_date AS recency_days, total_lifetime_orders AS frequency, {_REVENUE} AS monetary_value
                FROM cust LEFT JOIN f USING (customer_key) WHERE _is_current GROUP BY ALL""",
        ),
        "pat_customers_no_country": ("customer_id:i country_name:s", "SELECT customer_id, country_name FROM cust LEFT JOIN ctry USING (country_key) WHERE _is_current"),
        "pat_clv_simple": (
            "customer_id:i order_count:i lifetime_value:f avg_line_item:f",
            f"""SELECT customer_id, {_ORDERS} AS order_count, {_REVENUE} AS lifetime_value, {_MEAN_LINE_6} AS avg_line_item
                FROM star WHERE customer_key IS NOT NULL GROUP BY 1""",
        ),
        "pat_product_simple": (
            "stock_code:s description:s category_name:s units_sold:i revenue:f",
            f"SELECT stock_code, description, {_CATEGORY} AS category_name, sum(quantity) AS units_sold, {_REVENUE} AS revenue FROM star GROUP BY 1, 2",
        ),
        "pat_description_revenue": ("description:s revenue:f", f"SELECT description, {_REVENUE} AS revenue FROM star GROUP BY 1"),
        "pat_price_vs_list": (
            "stock_code:s avg_paid:f list_price:f diff:f",
            f"SELECT stock_code, {mean_price} AS avg_paid, list_c / 100 AS list_price, 0 AS diff FROM f JOIN prod USING (product_key) GROUP BY stock_code, list_c",
        ),
        "pat_order_lines": (_FACT_SPEC, f"SELECT * FROM ({_FACT_ROWS}) WHERE invoice_no = {_text(K.LOOKUP['invoice'])}"),
        "pat_point_lookup": (_CUST_SPEC, f"SELECT * FROM cust WHERE customer_id = {K.LOOKUP['customer']}"),
        "pat_range_sum": ("total_revenue:f", f"SELECT {_REVENUE} AS total_revenue FROM f WHERE date_key {_SLICE}"),
        "layout_point_lookup": (_PRODUCT_SPEC, f"SELECT * FROM ({_PRODUCT}) WHERE stock_code = {_text(K.LOOKUP['product'])}"),
        "layout_bucketed_products": (
            "stock_code:s line_count:i units:i revenue:f",
            f"SELECT stock_code, count(*) AS line_count, sum(quantity) AS units, {_REVENUE} AS revenue FROM f JOIN prod USING (product_key) GROUP BY 1",
        ),
        "layout_bucketed_customers": (
            "customer_id:i line_count:i units:i revenue:f",
            f"SELECT cust.customer_id, count(*) AS line_count, sum(quantity) AS units, {_REVENUE} AS revenue FROM f JOIN cust USING (customer_key) GROUP BY 1",
        ),
        "layout_substring_short": (_PRODUCT_SPEC, f"SELECT * FROM ({_PRODUCT}) WHERE contains(description, {_text(K.LOOKUP['letters'])})"),
        "layout_substring": (_PRODUCT_SPEC, f"SELECT * FROM ({_PRODUCT}) WHERE contains(description, {_text(K.LOOKUP['text'])})"),
    }


def _analytics_answers() -> dict[str, tuple[str, str]]:
    high, medium, low = map(_text, V.SPEND_TIERS)
    tiers = f"""(SELECT *, quantile_cont(CAST(c AS DOUBLE), {V.HIGH_SPEND}) OVER () AS hi, quantile_cont(CAST(c AS DOUBLE), {V.MEDIUM_SPEND}) OVER () AS mid
                 FROM (SELECT customer_key, home, {_ORDERS} AS orders, sum(amount_c) AS c, count(*) AS n, count(DISTINCT product_key) AS products
                       FROM star WHERE customer_key IS NOT NULL GROUP BY 1, 2))"""
    status = "CASE " + " ".join(f"WHEN days <= {limit} THEN {_text(name)}" for limit, name in V.CHURN_STATUS[:-1]) + f" ELSE {_text(V.CHURN_STATUS[-1][1])} END"
    cohort = f"""(SELECT cohort_month, {_MONTHS} AS m, count(DISTINCT customer_key) AS n FROM {_COHORTS} JOIN {_ACTIVE} USING (customer_key) GROUP BY 1, 2)"""
    months = f"""(SELECT year, month, month_name, sum(amount_c) AS c, {_ORDERS} AS order_count, count(DISTINCT customer_key) AS unique_customers
                  FROM star GROUP BY ALL)"""
    best = "(SELECT stock_code FROM star GROUP BY 1 ORDER BY sum(amount_c) DESC, 1 LIMIT 5)"
    last, year_ago = "lag(c) OVER w", "lag(c, 12) OVER w"
    return {
        "clv": (_CLV_SPEC, f"{_CLV} ORDER BY c DESC, customer_id, customer_key, country_name LIMIT 100"),
        "clv_all": (_CLV_SPEC, _CLV),
        "rfm": (_RFM_SPEC, f"{_RFM} ORDER BY r + fr + m DESC, c DESC, customer_id LIMIT 100"),
        "rfm_all": (_RFM_SPEC, _RFM),
        "affinity": (
            "product_a_code:s product_a_desc:s product_b_code:s product_b_desc:s times_purchased_together:i co_purchase_percentage:f",
            f"""SELECT pa.stock_code AS product_a_code, pa.description AS product_a_desc, pb.stock_code AS product_b_code, pb.description AS product_b_desc,
                       n AS times_purchased_together, co_purchase_percentage
                FROM ({_pairs('product_key', 2)}) JOIN prod pa ON pa.product_key = a JOIN prod pb ON pb.product_key = b""",
        ),
        "affinity_descriptions": (
            "product_a_desc:s product_b_desc:s times_purchased_together:i co_purchase_percentage:f",
            f"SELECT a AS product_a_desc, b AS product_b_desc, n AS times_purchased_together, co_purchase_percentage FROM ({_pairs('description', 10)})",
        ),
        "product_performance": (
            "year:i month:i month_name:s stock_code:s description:s units_sold:i revenue:f monthly_rank:i cumulative_revenue:f moving_avg_3month:f",
            f"""SELECT *, c / 100 AS revenue, rank() OVER (PARTITION BY year, month ORDER BY c DESC) AS monthly_rank,
                       sum(c) OVER (t ROWS UNBOUNDED PRECEDING) / 100 AS cumulative_revenue,
                       {cents_ratio('sum(c) OVER (t ROWS 2 PRECEDING)', 'count(*) OVER (t ROWS 2 PRECEDING)')} AS moving_avg_3month
                FROM (SELECT year, month, month_name, stock_code, description, sum(quantity) AS units_sold, sum(amount_c) AS c
                      FROM star SEMI JOIN {best} b USING (stock_code) GROUP BY ALL)
                WINDOW t AS (PARTITION BY stock_code ORDER BY year, month, description)""",
        ),
        "customer_segments": (
            "customer_value_segment:s country_name:s customer_count:i avg_total_spend:f avg_orders_per_customer:f avg_order_value:f avg_unique_products:f",
            f"""SELECT CASE WHEN c >= hi THEN {high} WHEN c >= mid THEN {medium} ELSE {low} END AS customer_value_segment, home AS country_name,
                       count(*) AS customer_count, {cents_ratio('sum(c)', 'count(*)')} AS avg_total_spend, {ratio('sum(orders)', 'count(*)', 1)} AS avg_orders_per_customer,
                       {half_up('avg(c / n) / 100', 2)} AS avg_order_value, {ratio('sum(products)', 'count(*)', 1)} AS avg_unique_products
                FROM {tiers} GROUP BY 1, 2""",
        ),
        "revenue_trends": (
            "year:i month:i month_name:s revenue:f order_count:i unique_customers:i avg_order_value:f mom_revenue_change:f mom_growth_pct:f "
            "revenue_same_month_last_year:f yoy_growth_pct:f moving_avg_3month:f",
            f"""SELECT *, c / 100 AS revenue, {cents_ratio('c', 'order_count')} AS avg_order_value, (c - {last}) / 100 AS mom_revenue_change,
                       {pct(f'c - {last}', last)} AS mom_growth_pct, {year_ago} / 100 AS revenue_same_month_last_year,
                       {pct(f'c - {year_ago}', year_ago)} AS yoy_growth_pct,
                       {cents_ratio('sum(c) OVER (w ROWS 2 PRECEDING)', 'count(*) OVER (w ROWS 2 PRECEDING)')} AS moving_avg_3month
                FROM {months} WINDOW w AS (ORDER BY year, month)""",
        ),
        "season_month": (
            "month_name:s total_revenue:f total_orders:i avg_transaction_value:f revenue_percentage:f revenue_rank:i",
            f"""SELECT month_name, {_REVENUE} AS total_revenue, {_ORDERS} AS total_orders, {_MEAN_LINE} AS avg_transaction_value,
                       {pct('sum(amount_c)', '(SELECT sum(amount_c) FROM star)')} AS revenue_percentage, rank() OVER (ORDER BY sum(amount_c) DESC) AS revenue_rank
                FROM star GROUP BY month_name""",
        ),
        "season_weekday": (
            "day_name:s day_of_week:i is_weekend:b order_count:i total_revenue:f avg_order_value:f unique_customers:i",
            f"""SELECT day_name, day_of_week, is_weekend, {_ORDERS} AS order_count, {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_order_value,
                       count(DISTINCT customer_key) AS unique_customers FROM star GROUP BY 1, 2, 3""",
        ),
        "season_weekend": (
            "day_type:s days_count:i total_revenue:f avg_daily_revenue:f total_orders:i avg_orders_per_day:f",
            f"""SELECT {_DAY_TYPE} AS day_type, count(DISTINCT date) AS days_count, {_REVENUE} AS total_revenue, {_MEAN_LINE} AS avg_daily_revenue,
                       {_ORDERS} AS total_orders, {ratio(_ORDERS, 'count(DISTINCT date)')} AS avg_orders_per_day FROM star GROUP BY 1""",
        ),
        "cohort_retention": (
            "cohort_month:d cohort_size:i months_since_first_order:i retained_customers:i retention_rate_pct:f",
            f"""SELECT k.cohort_month, b.n AS cohort_size, k.m AS months_since_first_order, k.n AS retained_customers, {pct('k.n', 'b.n')} AS retention_rate_pct
                FROM {cohort} k JOIN {cohort} b ON b.cohort_month = k.cohort_month AND b.m = 0 WHERE k.m <= 12""",
        ),
        "cohort_pivot": (
            "cohort_month:s cohort_size:i month_0:i month_1:i month_2:i month_3:i month_6:i",
            "SELECT strftime(cohort_month, '%Y-%m') AS cohort_month, count(DISTINCT customer_key) AS cohort_size, "
            + ", ".join(f"count(DISTINCT customer_key) FILTER (WHERE {_MONTHS} = {m}) AS month_{m}" for m in (0, 1, 2, 3, 6))
            + f" FROM {_COHORTS} LEFT JOIN {_ACTIVE} USING (customer_key) GROUP BY 1",
        ),
        "churn": (
            "customer_status:s customer_count:i percentage:f avg_days_since_last_order:i",
            f"""SELECT {status} AS customer_status, count(*) AS customer_count, {pct('count(*)', f'(SELECT count(*) FROM {_CUSTOMER_DAYS})')} AS percentage,
                       {ratio('sum(days)', 'count(*)', 0)} AS avg_days_since_last_order FROM {_CUSTOMER_DAYS} GROUP BY 1""",
        ),
        "churn_rate": ("churn_rate_pct:f", f"SELECT {pct('count(*) FILTER (WHERE days > 365)', 'count(*)')} AS churn_rate_pct FROM {_CUSTOMER_DAYS}"),
        "peak_days": (
            "date:d day_name:s month_name:s year:i daily_revenue:f order_count:i unique_customers:i revenue_rank:i",
            f"""SELECT date, day_name, month_name, year, {_REVENUE} AS daily_revenue, {_ORDERS} AS order_count, count(DISTINCT customer_key) AS unique_customers,
                       rank() OVER (ORDER BY sum(amount_c) DESC) AS revenue_rank FROM star GROUP BY 1, 2, 3, 4 ORDER BY sum(amount_c) DESC, date LIMIT 20""",
        ),
        "pareto": (
            "rank:i date:d daily_revenue:f cumulative_revenue:f cumulative_pct:f days_pct:f",
            f"""SELECT rank, date, c / 100 AS daily_revenue, upto / 100 AS cumulative_revenue, {pct('upto', 'total')} AS cumulative_pct,
                       {pct('rank', 'n')} AS days_pct FROM {_RANKED_DAYS} WHERE rank <= 50""",
        ),
        "pareto_threshold": (
            "days:i days_pct:f cumulative_pct:f",
            f"""SELECT rank AS days, {pct('rank', 'n')} AS days_pct, {pct('upto', 'total')} AS cumulative_pct
                FROM {_RANKED_DAYS} WHERE upto * 100 >= total * 80 ORDER BY rank LIMIT 1""",
        ),
    }


def _summary_answers() -> dict[str, tuple[str, str]]:
    daily = _DAILY.format(rows="star")
    everyone = _CUSTOMER_SUMMARY.format(where="TRUE")
    every_product = _PRODUCT_SUMMARY.format(where="TRUE")
    mean_day = cents_ratio("sum(c)", "count(*)", 6)
    per_customer = "(SELECT count(DISTINCT customer_id) FROM star WHERE customer_key IS NOT NULL)"
    return {
        "mv_customer_summary": ("customer_key:i " + _CUSTOMER_SUMMARY_SPEC + " days_since_last_order:i", everyone),
        "mv_product_summary": (
            "product_key:i stock_code:s description:s category_name:s times_ordered:i total_quantity_sold:i total_revenue:f avg_selling_price:f "
            "unique_customers:i first_sale_date:d last_sale_date:d",
            every_product,
        ),
        "mv_refresh_products": (
            "product_key:i stock_code:s description:s category_name:s times_ordered:i total_quantity_sold:i total_revenue:f avg_selling_price:f "
            "unique_customers:i first_sale_date:d last_sale_date:d",
            _PRODUCT_SUMMARY.format(where=_AFTER_RELOAD),
        ),
        "mv_daily_sales": (_DAILY_SPEC, daily),
        "mv_refresh": (_CUSTOMER_SUMMARY_SPEC, _CUSTOMER_SUMMARY.format(where=_AFTER_RELOAD)),
        "mv_refresh_daily": (_DAILY_SPEC, _DAILY.format(rows=f"(SELECT * FROM star WHERE {_AFTER_RELOAD})")),
        "opt_top_customers": (
            "customer_id:i country_name:s total_orders:i lifetime_revenue:f avg_order_value:f days_since_last_order:i",
            f"SELECT * FROM ({everyone}) WHERE lifetime_revenue > 1000 ORDER BY lifetime_revenue DESC, customer_id LIMIT 50",
        ),
        "opt_top_products": (
            "stock_code:s description:s category_name:s total_revenue:f total_quantity_sold:i unique_customers:i",
            f"SELECT * FROM ({every_product}) ORDER BY total_revenue DESC, stock_code LIMIT 20",
        ),
        "opt_monthly": (
            "year:i month_name:s monthly_revenue:f monthly_orders:i avg_daily_revenue:f",
            f"SELECT year, month_name, sum(c) / 100 AS monthly_revenue, sum(order_count) AS monthly_orders, {mean_day} AS avg_daily_revenue FROM ({daily}) GROUP BY 1, 2",
        ),
        "opt_weekend": (
            "day_type:s days_count:i total_revenue:f avg_daily_revenue:f total_orders:i",
            f"""SELECT {_DAY_TYPE} AS day_type, count(*) AS days_count, sum(c) / 100 AS total_revenue, {mean_day} AS avg_daily_revenue,
                       sum(order_count) AS total_orders FROM ({daily}) GROUP BY 1""",
        ),
        "opt_compare": (
            "version:s row_count:i differing_rows:i",
            f"SELECT 'base' AS version, {per_customer} AS row_count, 0 AS differing_rows UNION ALL SELECT 'summary', {per_customer}, 0",
        ),
    }


# Queries that run on the customers who move, or on one current row per customer and country.
_VARIANT = {
    **dict.fromkeys(["scd2_current", "scd2_as_of", "scd2_history", "scd2_build", "scd2_deliver", "fact_sales_as_of", "dim_customer_checks_2"], "moving"),
    **dict.fromkeys(["dim_customer_by_country", "fact_sales_by_country", "val_row_count_by_country"], "by_country"),
}


def oracle_sql() -> dict[str, str]:
    answers = {
        **_source_answers(), **_staging_answers(), **_dimension_answers(), **_version_answers(), **_fact_answers(),
        **_report_answers(), **_analytics_answers(), **_summary_answers(),
    }
    sql = {name: _typed(spec, body, _layers(_VARIANT.get(name, "base"))) for name, (spec, body) in answers.items()}
    sql |= {name: _typed(spec, body, _LOG) for name, (spec, body) in _log_answers().items()}
    return sql
