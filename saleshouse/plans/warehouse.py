"""All layers of one warehouse, each built on first use, written, and read back by later queries."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monthly, storage
from ..sources import layout
from . import deltas, dims, fact, staging, summaries


class Warehouse:
    """``raw`` are raw_transactions rows; tables are written below ``base``."""

    def __init__(
        self, spark: SparkSession, raw: DataFrame, base: str, regions: DataFrame | None = None, customer_mode: str = "one_current"
    ):
        self.spark, self.raw, self.base = spark, raw, base.rstrip("/")
        self.regions, self.customer_mode = regions, customer_mode

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        return storage.publish(df, f"{self.base}/{name}")

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_orders(self.raw)

    @cached_property
    def dates(self) -> DataFrame:
        """Whole years from the first to the last valid order."""
        ends = staging.valid(self.stg).agg(F.year(F.min("invoice_date")).alias("a"), F.year(F.max("invoice_date")).alias("b")).first()
        if ends.a is None:
            raise ValueError("no valid order line to take the calendar from")
        return self._table(dims.dim_date(self.spark, date(ends.a, 1, 1), date(ends.b, 12, 31)).coalesce(1), "dim_date")

    @cached_property
    def countries(self) -> DataFrame:
        return self._table(dims.dim_country(self.stg, self.regions), "dim_country")

    @cached_property
    def categories(self) -> DataFrame:
        return dims.dim_category(self.spark)

    @cached_property
    def customers(self) -> DataFrame:
        return self._table(dims.dim_customer(self.stg, self.countries, self.customer_mode), "dim_customer")

    @cached_property
    def products(self) -> DataFrame:
        return self._table(dims.dim_product(self.stg), "dim_product")

    @cached_property
    def fact_path(self) -> str:
        path = f"{self.base}/fact_sales"
        layout.publish_clustered(fact.fact_sales(self.stg, self.customers, self.products, self.countries, self.customer_mode), path)
        return path

    @cached_property
    def clustered_fact(self) -> DataFrame:
        """The fact with its month column, for filters that should skip folders."""
        return monthly.read(self.spark, self.fact_path)

    @cached_property
    def fact(self) -> DataFrame:
        return self.clustered_fact.drop(layout.MONTH)

    @cached_property
    def customer_summary(self) -> DataFrame:
        return self._table(summaries.customer_summary(self.fact, self.customers, self.countries, self.dates), "mv_customer_summary")

    @cached_property
    def product_summary(self) -> DataFrame:
        return self._table(summaries.product_summary(self.fact, self.products, self.categories, self.dates), "mv_product_summary")

    def _state(self, state: deltas.State, name: str) -> deltas.State:
        return deltas.State(*[self._table(df, f"{name}_{part}") for part, df in state._asdict().items()])

    @cached_property
    def customer_state(self) -> deltas.State:
        """What keeps the customer summary current without the fact."""
        return self._state(summaries.customer_state(self.fact, self.dates), "mv_customer_state")

    @cached_property
    def product_state(self) -> deltas.State:
        return self._state(summaries.product_state(self.fact, self.dates), "mv_product_state")

    @cached_property
    def daily_path(self) -> str:
        path = f"{self.base}/mv_daily_sales"
        summaries.publish_daily(summaries.daily_sales(self.fact, self.dates), path)
        return path

    @cached_property
    def daily(self) -> DataFrame:
        return summaries.read_daily(self.spark, self.daily_path)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "raw_transactions": self.raw,
            "stg_orders": self.stg,
            "dim_date": self.dates,
            "dim_country": self.countries,
            "dim_customer": self.customers,
            "dim_category": self.categories,
            "dim_product": self.products,
            "fact_sales": self.fact,
        }
