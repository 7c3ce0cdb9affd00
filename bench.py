"""Time the loads and the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
step runs once on the small tables of BENCH_WARM_DIR first, so that compiling the JVM's code is not
measured; set it to an empty text to measure a cold start.
"""

from __future__ import annotations

import json
import os
import sys
import time

from saleshouse import catalog
from saleshouse.session import local_session
from saleshouse.sources import files

QUERIES = [
    "clv", "rfm", "affinity", "affinity_descriptions", "product_performance", "customer_segments", "revenue_trends",
    "season_month", "season_weekday", "season_weekend", "cohort_retention", "cohort_pivot", "churn", "peak_days", "pareto",
    "dq_scorecard", "dq_revenue_stats", "dq_outlier_amount", "rep_country", "rep_products_revenue", "rep_category",
    "rep_customers", "rep_kpis", "val_sample", "mv_customer_summary", "mv_product_summary", "mv_daily_sales",
    "opt_top_customers", "opt_monthly", "fact_sales_as_of", "fact_merge", "scd2_build",
]


def loads(spark, folder):
    """The pipeline's steps in order; each writes its table."""
    csv, parquet = catalog.csv_feed(spark, folder), catalog.parquet_feed(spark, folder)
    warehouse = catalog.warehouse(spark, folder)
    moving = catalog.warehouse(spark, folder, "moving")
    return {
        "load_csv": lambda: files.copy_csv(spark, csv).rows.count(),
        "load_parquet": lambda: files.copy_parquet(spark, parquet).rows.count(),
        "load_staging": lambda: warehouse.stg.count(),
        "load_dimensions": lambda: [t.count() for t in (warehouse.dates, warehouse.countries, warehouse.customers, warehouse.products)],
        "load_fact": lambda: warehouse.fact.count(),
        "load_history": lambda: (moving.customers.count(), moving.products.count()),
    }


def run(spark, folder) -> dict[str, float]:
    queries = catalog.queries()
    steps = loads(spark, folder)
    steps |= {name: (lambda q=queries[name]: q(spark, folder).write.format("noop").mode("overwrite").save()) for name in QUERIES}
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    # The tables are single files with one row group, read by one task. Broadcasting the orders would
    # keep the rest of the load in that task; a shuffle join spreads it over all cores.
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "saleshouse-bench", broadcast_limit="1m")
    if warm and os.path.isdir(warm):
        run(spark, warm)
    seconds = run(spark, folder)
    spark.stop()
    scale = os.path.basename(folder).removeprefix("sf")
    line = {"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}
    sys.stdout.write(json.dumps(line) + "\n")


if __name__ == "__main__":
    main()
