"""The trigram index finds what a scan finds, and reads only the parts it must."""

import random

from pyspark.sql import functions as F

from saleshouse.sources import textindex

ROWS = [(1, "red ring box"), (2, "ringing string"), (3, "RING"), (4, None), (5, ""), (6, "ri"), (7, "r"), (8, "bring in gin"), (9, "äöü rin g"), (10, "aXa\x00"), (11, "ring")]
PHRASES = ["ring", "ri", "r", "", "RING", "ing st", "äö", "ü", "zzz", "zz", "string", "n g", "in gin", "red ring box", "g", "\x00", "rinng", "a"]


def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string").withColumn("key", F.lit("k")).withColumn("gram", F.lit("g"))


def test_search_equals_scan(spark, tmp_path):
    df, path = table(spark, ROWS), str(tmp_path / "index")
    textindex.write_index(df, path, "id", "text", 3)
    for phrase in PHRASES:
        found = textindex.search(spark, path, "id", "text", phrase)
        assert found.columns == df.columns
        assert sorted(r.id for r in found.collect()) == [i for i, t in ROWS if t is not None and phrase in t], phrase


def test_search_of_random_texts(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choice("abc ") for _ in range(rnd.randrange(0, 12)))) for i in range(400)]
    path = str(tmp_path / "index")
    textindex.write_index(table(spark, rows), path, "id", "text", 4)
    for n in (1, 2, 3, 4, 5, 7):
        phrase = "".join(rnd.choice("abc ") for _ in range(n))
        got = sorted(r.id for r in textindex.search(spark, path, "id", "text", phrase).collect())
        assert got == [i for i, t in rows if phrase in t], phrase


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "index")
    textindex.write_index(table(spark, ROWS).where("id < 0"), path, "id", "text", 2)
    for phrase in ("ring", "r", ""):
        assert textindex.search(spark, path, "id", "text", phrase).count() == 0


def test_rows_are_read_for_the_keys_found_only(spark, tmp_path):
    rows = [(i, f"thing {i}") for i in range(300)] + [(1000, "needle")]
    path = str(tmp_path / "index")
    textindex.write_index(table(spark, rows), path, "id", "text", 30)
    found = textindex.search(spark, path, "id", "text", "needle")
    assert [r.id for r in found.collect()] == [1000]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan  # parts without a key of the index are not opened
    assert "In(gram" in plan.replace("PushedFilters: [", "") or "gram IN" in plan
    few = textindex.rarest(spark, path, "thing 17")
    assert len(few) == 3 and "thi" not in few  # the gram that all rows hold is left aside
    assert textindex.rarest(spark, path, "thing?") == []
