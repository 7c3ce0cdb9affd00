"""Substring search by an index of trigrams.

Three tables below one folder: the rows themselves in parts by a hash of their key, the postings (gram, key, part) ordered by gram, and the
number of keys of each gram. A text of n letters has a gram from each letter: that letter and the next two, filled up with ``END`` behind the last, so a phrase
of one or two letters is the beginning of a gram. A search reads the postings of the phrase's rarest grams, intersects them, reads
the rows of the keys that are left, and looks at their text. No row is missed; a row whose grams stand apart is dropped by the last look.

A gram that many rows hold is many files of postings in order, not one task's group. Null texts have no grams and are never found; an empty phrase finds
every text, as a scan would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\x00"
PART = "__part"
RAREST = 3  # grams whose postings are read


def grams(text: Column) -> Column:
    """The different grams of a text."""
    filled = F.concat(text, F.lit(END + END))
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    found = F.array_distinct(F.transform(places, lambda k: F.substring(filled, k, 3)))
    return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<string>"))


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def write_index(rows: DataFrame, path: str, key: str, column: str, parts: int = 64) -> None:
    """Write rows, postings and counts below ``path``; ``key`` is unique. A table of n rows wants about n / 100,000 parts."""
    placed = rows.withColumn(PART, part_of(F.col(key), parts))
    placed.limit(0).write.mode("overwrite").parquet(f"{path}/shape")  # a table of no parts has no file to take its columns from
    placed.repartition(PART).sortWithinPartitions(PART, key).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    postings = placed.select(F.explode(grams(F.col(column))).alias("gram"), F.col(key).alias("key"), F.col(PART).alias("part"))
    ordered = postings.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key")
    ordered.write.mode("overwrite").parquet(f"{path}/postings")
    counts = rows.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("keys"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts")


def rarest(spark: SparkSession, path: str, phrase: str, k: int = RAREST) -> list[str]:
    """Of the grams of a phrase of three letters or more, the ``k`` that fewest rows hold; empty if one of them stands nowhere."""
    wanted = sorted({phrase[i : i + 3] for i in range(len(phrase) - 2)})
    found = spark.read.parquet(f"{path}/counts").where(F.col("gram").isin(wanted)).orderBy("keys", "gram").collect()  # at most one row a gram
    return [row["gram"] for row in found[:k]] if len(found) == len(wanted) else []


def candidates(spark: SparkSession, path: str, phrase: str) -> DataFrame:
    """(key, part) of the rows that may hold a phrase of one letter or more."""
    postings = spark.read.parquet(f"{path}/postings")
    if len(phrase) < 3:
        return postings.where(F.col("gram").startswith(phrase)).select("key", "part").distinct()
    few = rarest(spark, path, phrase)
    if not few:
        return postings.where(F.lit(False)).select("key", "part")
    if len(few) == 1:
        return postings.where(F.col("gram") == few[0]).select("key", "part")
    held = postings.where(F.col("gram").isin(few)).groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    return held.where(F.col("n") == len(few)).select("key", "part")


def search(spark: SparkSession, path: str, key: str, column: str, phrase: str) -> DataFrame:
    """The rows whose ``column`` contains ``phrase``; only the parts of keys found in the index are read."""
    rows = spark.read.schema(spark.read.parquet(f"{path}/shape").schema).parquet(f"{path}/rows")
    if not phrase:
        return rows.where(F.col(column).isNotNull()).drop(PART)
    found = candidates(spark, path, phrase)
    joined = rows.join(found, (rows[PART] == found["part"]) & (rows[key] == found["key"]), "left_semi")
    return joined.where(F.col(column).contains(phrase)).drop(PART)
