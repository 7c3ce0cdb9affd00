"""Global ordering without a single-task window.

Spark runs ``row_number() over (order by x)`` in one task. Here rows are range-partitioned and
sorted, so partition p holds rows that all precede those of partition p+1. The sorted rows are
written once (range bounds are sampled, so a recomputation could place rows differently) and each
partition's size is counted. The prefix sums of those sizes turn a local position into a global
one. Only these sums, one number per range partition, pass through the driver; they travel in the
plan as a literal, so a numbered table stays a plain scan and an unused number costs nothing.

The order passed in must be total (end it with a unique column), so that a value shared by a third
of all rows is still split over many partitions.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from decimal import Decimal
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize

_POS = "__pos"
_LOCAL_BITS = 33  # monotonically_increasing_id: partition id above, row index below


def range_sorted(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in global order, each marked with its partition and its index there."""
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POS, F.monotonically_increasing_id())
    )


def _part() -> Column:
    return F.shiftright(F.col(_POS), _LOCAL_BITS).cast("int")


def _part_sums(stored: DataFrame, value: Column) -> list:
    """Sum of ``value`` per range partition: at most ``spark.sql.shuffle.partitions`` numbers."""
    sums = {row.part: row.total for row in stored.groupBy(_part().alias("part")).agg(F.sum(value).alias("total")).collect()}
    return [sums.get(part) or 0 for part in range(max(sums, default=0) + 1)]


def _per_part(values: list, type_: str) -> Column:
    """A row's partition's value: one text literal, folded to an array when the plan is optimized."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{type_}>"), _part())


def _sum_before(sums: list, type_: str) -> Column:
    """Sum of all earlier partitions."""
    return _per_part([0, *accumulate(sums[:-1])], type_)


def number_ranged(ranged: DataFrame, name: str, label: str = "numbered") -> tuple[DataFrame, int]:
    """Row numbers 1..N for the output of :func:`range_sorted` (or a row-wise projection of it), and N."""
    stored = materialize(ranged, label)
    sizes = _part_sums(stored, F.lit(1))
    local = F.col(_POS).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return stored.withColumn(name, _sum_before(sizes, "bigint") + local + 1).drop(_POS), sum(sizes)


def with_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    return number_ranged(range_sorted(df, order), name)[0]


def with_ntile(df: DataFrame, buckets: int, order: Sequence[Column], name: str) -> DataFrame:
    """NTILE: the first N mod n buckets hold one row more than the others."""
    numbered, rows = number_ranged(range_sorted(df, order), "__row")
    small, extra = divmod(rows, buckets)
    in_large = extra * (small + 1)
    tile = F.when(F.col("__row") <= in_large, F.ceil(F.col("__row") / (small + 1))).otherwise(
        extra + F.ceil((F.col("__row") - in_large) / max(small, 1))
    )
    return numbered.withColumn(name, tile.cast("int")).drop("__row")


def _local_running(value: str) -> Column:
    return F.sum(value).over(Window.partitionBy(_part()).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0))


def with_running_total(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Running total over the whole table, for rows whose order columns are unique."""
    type_ = df.select(F.sum(value)).schema[0].dataType.simpleString()
    stored = materialize(range_sorted(df, order), "running")
    before = _sum_before(_part_sums(stored, F.col(value)), type_)
    return stored.withColumn(name, (before + _local_running(value)).cast(type_)).drop(_POS)


def with_rank(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """RANK over the whole table: equal values share the rank of their first row.

    Rows of one value are spread over range partitions by a hash of the row, and ranked in each. Where a partition
    begins with the value the one before ended with, that value's rank is carried over.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    stored = materialize(range_sorted(df, [order, F.xxhash64(*df.columns)]), "ranked")
    ranked = stored.withColumn("__local", F.rank().over(Window.partitionBy(_part()).orderBy(order)))
    found = {
        row.part: row
        for row in ranked.groupBy(_part().alias("part")).agg(
            F.min_by(value, _POS).alias("low"), F.max_by(value, _POS).alias("high"),
            F.count(F.lit(1)).alias("n"), F.max("__local").alias("last"),
        ).collect()
    }
    # One number per range partition: the rank of its first value, and the rows before it.
    first_ranks, rows_before, before, carried = [], [], 0, None
    for part in range(max(found, default=0) + 1):
        rows_before.append(before)
        row = found.get(part)
        if row is None:
            first_ranks.append(0)
            continue
        first = carried[1] if carried and carried[0] == row.low else before + 1
        first_ranks.append(first)
        carried = (row.high, first if row.last == 1 else before + row.last)
        before += row.n
    rank = F.when(F.col("__local") == 1, _per_part(first_ranks, "bigint")).otherwise(_per_part(rows_before, "bigint") + F.col("__local"))
    return ranked.withColumn(name, rank).drop("__local", _POS)


def top_ranked(df: DataFrame, value: str, ties: Sequence[str], k: int, name: str) -> DataFrame:
    """The k largest rows with their RANK. Exact: no row outside the top k can outrank one inside."""
    top = df.orderBy(F.col(value).desc(), *ties).limit(k)
    return top.withColumn(name, F.rank().over(Window.orderBy(F.col(value).desc())))


def exact_percentiles(df: DataFrame, column: str, fractions: dict[str, str]) -> DataFrame:
    """One row with the interpolated percentiles (PERCENTILE_CONT) of ``column``.

    ``fractions`` maps output names to decimal texts such as ``"0.99"``. Values are counted first
    (map-side combined) and the counts are put in value order. The counts per range partition tell
    which partitions hold the values on either side of each position; only those few are read again.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("decimal(20,6)").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stored = materialize(range_sorted(counted, [F.col("v")]), "values")
    upto = list(accumulate(_part_sums(stored, F.col("n"))))
    rows = upto[-1]

    picks, outputs, wanted = [], [], set()

    def value_at(position: int, name: str) -> None:
        part = min(bisect_right(upto, position), len(upto) - 1)
        wanted.add(part)
        left = position - (upto[part - 1] if part else 0)
        picks.append(F.min(F.when((F.col("part") == part) & (F.col("running") > left), F.col("v"))).alias(name))

    for name, fraction in fractions.items():
        position = (max(rows, 1) - 1) * Decimal(fraction)
        value_at(int(position), f"{name}_low")
        value_at(ceil(position), f"{name}_high")
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        outputs.append((low + (high - low) * F.lit(position - int(position))).cast("decimal(20,6)").alias(name))

    needed = F.lit(False)
    for part in sorted(wanted):  # position ranges, so that Parquet statistics skip the other files
        needed = needed | F.col(_POS).between(part << _LOCAL_BITS, ((part + 1) << _LOCAL_BITS) - 1)
    near = stored.where(needed).select("v", _part().alias("part"), _local_running("n").alias("running"))
    return near.agg(*picks).select(*outputs)
