"""Small hand-made inputs."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from saleshouse.plans import dims, fact, staging



def raw(spark, rows):
    """Rows as (invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country)."""
    schema = (
        "invoice_no string, stock_code string, description string, quantity string, invoice_date string, "
        "unit_price string, customer_id string, country string, file_name string, file_row_number bigint"
    )
    return spark.createDataFrame([(*row, "f.csv", i) for i, row in enumerate(rows, 1)], schema)


def line(invoice="1", code="A", quantity="1", day="2010-01-05 10:00:00", price="2.00", customer="7", country="France", text="thing"):
    return (invoice, code, text, quantity, day, price, customer, country)


class Shop:
    """Layers over a few raw rows, each built when a test asks for it."""

    def __init__(self, spark, rows, mode="one_current", years=(2009, 2013)):
        self.spark, self.raw, self.mode, self.years = spark, raw(spark, rows), mode, years

    @cached_property
    def stg(self):
        return staging.stg_orders(self.raw)

    @cached_property
    def dates(self):
        first, last = self.years
        return dims.dim_date(self.spark, date(first, 1, 1), date(last, 12, 31))

    @cached_property
    def countries(self):
        return dims.dim_country(self.stg)

    @cached_property
    def categories(self):
        return dims.dim_category(self.spark)

    @cached_property
    def customers(self):
        return dims.dim_customer(self.stg, self.countries, self.mode)

    @cached_property
    def products(self):
        return dims.dim_product(self.stg)

    @cached_property
    def fact(self):
        return fact.fact_sales(self.stg, self.customers, self.products, self.countries, self.mode).cache()


def tuples(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
