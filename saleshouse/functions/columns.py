"""Column expressions shared by the layers. All are built-in functions, none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_TYPE = "decimal(22,2)"


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Exact decimal quotient, rounded half up; NULL when the denominator is zero.

    decimal(22,2) by decimal(22,2) keeps 16 fraction digits, so rounding twice does no harm.
    """
    divisor = F.nullif(denominator.cast(SUM_TYPE), F.lit(0).cast(SUM_TYPE))
    return F.round(numerator.cast(SUM_TYPE) / divisor, digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part * 100, whole, digits)


def mean(value: Column, digits: int = 2) -> Column:
    """Aggregate: mean of a decimal or integer column, rounded half up."""
    return ratio(F.sum(value), F.count(value), digits)


def whole_number(text: Column) -> Column:
    """Text to int, NULL when not numeric; fractions round half up, so '17850.0' is 17850."""
    return F.round(text.try_cast("decimal(38,10)"), 0).try_cast("int")


def price(text: Column) -> Column:
    return text.try_cast("decimal(10,2)")


def moment(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def moment_text(moment: Column) -> Column:
    """Text to the second. A format function would go through the session's time zone and its gaps."""
    return F.substring(moment.cast("timestamp_ntz").cast("string"), 1, 19)


def hour_start(moment: Column) -> Column:
    """Start of the hour of a time without zone."""
    return moment - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(moment), F.extract(F.lit("SECOND"), moment))


def date_key(date: Column) -> Column:
    """YYYYMMDD as int."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def key_date(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def months_crossed(earlier: Column, later: Column) -> Column:
    """Month boundaries between two dates."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def weekday_number(date: Column) -> Column:
    """0 = Sunday."""
    return F.dayofweek(date) - 1


def month_label(date: Column, names: str = "short") -> Column:
    return F.date_format(date, "MMM" if names == "short" else "MMMM")


def weekday_label(date: Column, names: str = "short") -> Column:
    return F.date_format(date, "E" if names == "short" else "EEEE")


def first_match(rules: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """CASE WHEN over a rule list: the first true condition gives the value."""
    (condition, value), *rest = rules
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(otherwise)) if otherwise is not None else chain


def number_of(rows: DataFrame, column: str) -> Column:
    """Number of different values, as a value to select beside one row of aggregates.

    Several COUNT(DISTINCT) in one aggregate send every row once for each; this reads one column
    and combines equal values before the shuffle.
    """
    return rows.where(F.col(column).isNotNull()).select(column).distinct().agg(F.count(F.lit(1))).scalar()
