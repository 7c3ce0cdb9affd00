"""Layouts for more than one question: an order on two keys at once, and tables dealt by a join key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import CODEC
from .layout import depth, file_ranges

BITS = 6  # of each key in the interleaved order
_PLACE = "__place"


def cut_points(table: DataFrame, keys: tuple[str, str]) -> list[list]:
    """For each key the values that split the rows into about ``2 ** BITS`` equal parts, ascending; fewer where one value fills several parts."""
    shares = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    found = table.agg(*[F.percentile_approx(k, shares, 10_000).alias(f"p{n}") for n, k in enumerate(keys)]).first()
    return [sorted(set(values or [])) for values in found]


def part_number(key: str, cuts: list) -> Column:
    """Which part a value is in, 0 to ``2 ** BITS - 1``: few parts are spread over all bits, so no key's high bits stay empty. Null is in the first."""
    if not cuts:
        return F.lit(0)
    # Plain comparisons, which Spark compiles; a function over an array would be interpreted for each row.
    before = reduce(lambda a, b: a + b, [F.when(F.lit(c) <= F.col(key), 1).otherwise(0) for c in cuts])
    return F.floor(before * F.lit(1 << BITS) / F.lit(len(cuts) + 1)).cast("int")


def interleaved(one: Column, two: Column) -> Column:
    """The bits of both numbers by turns, the highest of ``one`` first."""

    def bit(number: Column, k: int, to: int) -> Column:
        return F.shiftleft(F.shiftright(number, k).bitwiseAND(F.lit(1)), to)

    bits = [b for k in range(BITS) for b in (bit(one, k, 2 * k + 1), bit(two, k, 2 * k))]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write_interleaved(
    fact: DataFrame, path: str, keys: tuple[str, str] = ("date_key", "country_key"), spread: str = "sales_key", files: int | None = None
) -> None:
    """Order the files so that a filter on either key alone skips most of them; an order by one key after the other serves the first key only.

    The cut points take one pass over two columns. A value that holds much of the data is one part of its key and is split by the other key and by ``spread``.
    """
    one, two = (part_number(k, cuts) for k, cuts in zip(keys, cut_points(fact, keys)))
    # A column, not an expression of the order: a sort works its expressions out again at each comparison.
    placed = fact.withColumn(_PLACE, interleaved(one, two))
    order = [_PLACE, *keys, spread]
    ordered = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    ordered.sortWithinPartitions(*order).drop(_PLACE).write.mode("overwrite").option("compression", CODEC).parquet(path)


def depths(table: DataFrame, keys: tuple[str, ...] = ("date_key", "country_key")) -> DataFrame:
    """How far the table's files overlap on each key: key, files, average_overlaps, average_depth."""
    each = [depth(file_ranges(table, k)).select(F.lit(k).alias("key"), "*") for k in keys]
    return reduce(DataFrame.unionAll, each)


def write_bucketed(table: DataFrame, path: str, key: str, buckets: int, spread: str | None = None, splits: int = 8) -> DataFrame:
    """Write ``table`` dealt and sorted by ``key``, and return it: joins and groups on ``key`` with tables of as many buckets need no shuffle.

    With ``spread``, a column of many values, each bucket is written by ``splits`` tasks, so a key with much of the data does not fall to one.
    Rows without a key lie first in their bucket, where a join that never meets them skips their row groups.
    """
    spark: SparkSession = table.sparkSession
    deal = [F.pmod(F.hash(key), F.lit(buckets))]
    if spread:
        deal.append(F.pmod(F.xxhash64(spread), F.lit(splits)))
    dealt = table.repartition(buckets * (splits if spread else 1), *deal)
    name = "bucketed_" + "".join(c if c.isalnum() else "_" for c in path)[-60:].lower()
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the session's name; the files stay
    return found


def sales_by(fact: DataFrame, dim: DataFrame, key: str, business: str) -> DataFrame:
    """Lines, units and revenue for each business key; reduced by ``key`` before the join, and both read where they lie if dealt by it."""
    sums = fact.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("quantity").alias("units"), F.sum("total_amount").alias("revenue")
    )
    named = dim.select(key, business).join(sums, key)
    return named.groupBy(business).agg(F.sum("line_count").alias("line_count"), F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
