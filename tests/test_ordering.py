import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from saleshouse.operators import ordering as o
from saleshouse.session import cluster_settings


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value."""
    rng = random.Random(3)
    rows = [(i, 5 if i % 3 == 0 else rng.randint(0, 40), rng.randint(1, 10_000) / 100) for i in range(1013)]
    return spark.createDataFrame(rows, "id int, v int, m double").withColumn("m", F.col("m").cast("decimal(12,2)")).repartition(7)


def same(left, right):
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, right.collect()))


def test_row_number(skewed):
    order = [F.col("v").desc(), F.col("id")]
    same(
        o.with_row_number(skewed, order, "n").select("id", "n"),
        skewed.select("id", F.row_number().over(Window.orderBy(*order)).alias("n")),
    )


def test_unused_number_costs_nothing(skewed):
    numbered, rows = o.number_ranged(o.range_sorted(skewed, [F.col("id")]), "n")
    assert rows == 1013
    plan = numbered.select("v")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "ReadSchema: struct<v:int>" in plan
    # The offsets are one folded literal, not computed row by row.
    assert "split(" not in numbered._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rows", [1013, 1, 3, 5, 7])
def test_ntile(skewed, rows):
    part = skewed.where(F.col("id") < rows)
    order = [F.col("v"), F.col("id")]
    same(
        o.with_ntile(part, 5, order, "t").select("id", "t"),
        part.select("id", F.ntile(5).over(Window.orderBy(*order)).alias("t")),
    )


@pytest.mark.parametrize("descending", [True, False])
def test_rank(skewed, descending):
    by = F.col("v").desc() if descending else F.col("v").asc()
    same(
        o.with_rank(skewed, "v", "r", descending).select("id", "r"),
        skewed.select("id", F.rank().over(Window.orderBy(by)).alias("r")),
    )


def test_top_ranked_shares_ranks(skewed):
    top = o.top_ranked(skewed, "v", ["id"], 30, "r").select("id", "r")
    plain = skewed.select("id", "v", F.rank().over(Window.orderBy(F.col("v").desc())).alias("r"))
    same(top, plain.orderBy(F.col("v").desc(), "id").limit(30).select("id", "r"))


def test_running_total(skewed):
    sums = skewed.groupBy("v").agg(F.sum("m").alias("m"))
    same(
        o.with_running_total(sums, [F.col("v")], "m", "t").select("v", "t"),
        sums.select("v", F.sum("m").over(Window.orderBy("v")).alias("t")),
    )


@pytest.mark.parametrize("rows", [1013, 1, 2, 11])
def test_percentiles(skewed, rows):
    part = skewed.where(F.col("id") < rows)
    got = o.exact_percentiles(part, "m", {"a": "0.5", "b": "0.90", "c": "0.99", "d": "0.60"}).first()
    want = part.selectExpr("percentile(m, array(0.5, 0.9, 0.99, 0.6)) as p").first().p
    assert [float(x) for x in got] == pytest.approx(want, abs=1e-6)


def test_percentiles_of_nothing(skewed):
    assert o.exact_percentiles(skewed.where("id < 0"), "m", {"a": "0.5"}).first().a is None


def test_cluster_settings_follow_the_input():
    settings = cluster_settings(100 << 40)
    assert settings["spark.sql.shuffle.partitions"] == "409600"
    assert cluster_settings(1)["spark.sql.shuffle.partitions"] == "200"


def test_rows_are_spread(skewed):
    """Even one repeated sort value is split over partitions, because the order is total."""
    constant = skewed.withColumn("v", F.lit(1))
    spark = skewed.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = o.range_sorted(constant, [F.col("v"), F.col("id")]).select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts == 4
