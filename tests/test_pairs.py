import itertools
import random
from collections import Counter

import pytest

from saleshouse.operators import pairs


def brute(baskets, least, k):
    held = {}
    for basket, item in baskets:
        held.setdefault(basket, set()).add(item)
    counts = Counter()
    for items in held.values():
        counts.update(itertools.combinations(sorted(items), 2))
    rows = sorted(((-n, a, b) for (a, b), n in counts.items() if n >= least))
    return [(a, b, -n) for n, a, b in (rows if k is None else rows[:k])]


def make(seed, baskets=60, items=25, giants=2):
    rng = random.Random(seed)
    rows = []
    for basket in range(baskets):
        rows += [(basket, rng.randint(0, rng.choice([5, items]))) for _ in range(rng.randint(1, 6))]
    for basket in range(baskets, baskets + giants):
        rows += [(basket, item) for item in range(items)]
        rows += [(basket, 0)] * 40  # repeated lines of one product
    return rows


@pytest.mark.parametrize("least,k,block,giants", [(2, 10, 64, 2), (3, 10, 3, 2), (4, None, 3, 2), (2, 5, 2, 6), (5, 7, 4, 4), (1, 400, 3, 3)])
def test_equals_enumeration(spark, least, k, block, giants):
    rows = make(least * 7 + block, giants=giants)
    df = spark.createDataFrame(rows, "b int, i int")
    got = [tuple(r) for r in pairs.frequent_pairs(df, "b", "i", least, k, block).collect()]
    want = brute(rows, least, k)
    assert (got if k else sorted(got)) == (want if k else sorted(want))


def test_equal_large_baskets_are_spread(spark):
    """Three equal baskets of 600 items: no join key holds more than a small part of a basket's pairs."""
    rows = [(basket, item) for basket in range(3) for item in range(600)]
    df = spark.createDataFrame(rows, "basket int, item int")
    keys = pairs.block_rows(df, 50).groupBy("basket", "own", "other").count()
    assert keys.count() == 3 * 12 * 12 and keys.agg({"count": "max"}).first()[0] < 100
    found = pairs.frequent_pairs(df, "basket", "item", 3, None, 50)
    assert found.count() == 600 * 599 // 2 and found.agg({"n": "min"}).first()[0] == 3


def test_no_baskets(spark):
    assert pairs.frequent_pairs(spark.createDataFrame([], "b int, i int"), "b", "i", 2, 5).collect() == []
