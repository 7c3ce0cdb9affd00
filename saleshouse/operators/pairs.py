"""Item pairs that occur together in many baskets: exact, with every basket spread over tasks by blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

# Items of one basket that meet in one join key, about.
BLOCK = 512


def _with_support(rows: DataFrame, least: int) -> DataFrame:
    """Rows whose item is in at least ``least`` baskets: no pair is more frequent than its items.

    The frequent items are stored, so that Spark sees their size and sends few items to the rows instead of dealing all rows by item.
    """
    frequent = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return rows.join(materialize(frequent.select("item"), "frequent-items"), "item", "left_semi")


def _sized(rows: DataFrame, block: int) -> DataFrame:
    """Each row with the number of blocks of its basket."""
    return rows.join(rows.groupBy("basket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "basket")


def _dealt(sized: DataFrame) -> DataFrame:
    placed = sized.withColumn("own", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")


def block_rows(rows: DataFrame, block: int) -> DataFrame:
    """Each row with the block of its item in its basket (``own``), once for every block of the basket (``other``)."""
    return _dealt(_sized(rows, block))


def frequent_pairs(baskets: DataFrame, basket: str, item: str, min_support: int, k: int | None, block: int = BLOCK) -> DataFrame:
    """Pairs ``a < b`` of items that share at least ``min_support`` baskets, and their count ``n``.

    With ``k``, only the k most frequent (ties by ``a, b``). A basket's items fall into blocks of about ``block``
    by hash, and each pair of blocks is a join key of its own, so a basket with very many items is joined by
    many tasks. Baskets of one block meet where counting them has put their rows, without a shuffle more. Counts are combined before the shuffle.
    """
    rows = materialize(
        baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item")).where("basket is not null and item is not null").distinct(),
        "baskets",
    )
    sized = _sized(_with_support(rows, min_support), block)
    one = sized.where("blocks = 1")
    within = one.select("basket", F.col("item").alias("a")).join(one.select("basket", F.col("item").alias("b")), "basket")
    spread = _dealt(sized.where("blocks > 1"))
    left = spread.select("basket", F.col("own").alias("p"), F.col("other").alias("q"), F.col("item").alias("a"))
    right = spread.select("basket", F.col("other").alias("p"), F.col("own").alias("q"), F.col("item").alias("b"))
    across = left.join(right, ["basket", "p", "q"])
    met = within.select("a", "b").unionByName(across.select("a", "b")).where("a < b")
    counts = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support)
    return counts if k is None else counts.orderBy(F.col("n").desc(), "a", "b").limit(k)
