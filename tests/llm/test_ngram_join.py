import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from saleshouse.llm import ngram_join as g
from saleshouse.llm.tables import read

from .data import SMALL, docs, groups, words


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                links.append((a, b))
    return {i: (len(sets[i]), label) for i, label in groups(links, ids).items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in g.near_duplicates(df).collect()}


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert result(read(spark, SMALL, "documents")) == brute(rows)


def test_near_copies_at_the_threshold(spark):
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  two"), (6, "one two three"), (7, "ä B"), (8, "Ä b")]
    for i in range(10, 60):  # families of copies with some words changed: similarities on both sides of 0.8
        text = list(base)
        for _ in range(rnd.randrange(0, 4)):
            text[rnd.randrange(60)] = f"x{rnd.randrange(50)}"
        rows.append((i, " ".join(text[: rnd.randrange(50, 61)])))
    assert result(docs(spark, rows)) == brute(rows)


def test_repeated_ids_and_empty_table(spark):
    assert result(docs(spark, [])) == {}
    found = result(docs(spark, [(1, "a b c d e f"), (1, "g h i j k l"), (2, "a b c d e f"), (3, "g h i j k l")]))
    assert {i: c for i, (_, c) in found.items()} == {1: 1, 2: 1, 3: 1}


def test_every_text_of_an_id_links(spark):
    def near(name, k):
        return " ".join(f"{name}{j}" if j else f"{name}x{k}" for j in range(40))

    rows = []
    for k in range(8):  # each id has two texts, and a near copy of either is another id
        a, b = f"a{k}w", f"b{k}w"
        rows += [(10 * k, near(a, 0)), (10 * k, near(b, 0)), (10 * k + 1, near(a, 1)), (10 * k + 2, near(b, 1))]
    assert {i: c for i, (_, c) in result(docs(spark, rows)).items()} == {i: i // 10 * 10 for i, _ in rows}


sets_of = st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1, max_size=30), sets_of, st.sampled_from([50, 80, 100]))
def test_trie_counts(probe, sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = g.trie_overlaps(np.array(sorted(probe), np.uint64), arrays, percent, step=4)
    for s, o in zip(sets, got):
        both = len(probe & s)
        assert o == (both if 100 * both >= percent * len(probe | s) else -1)


def test_bitmaps_leave_no_similar_pair_out(spark):
    rnd = random.Random(11)
    rows, truth = [], []
    for _ in range(400):
        size = rnd.choice([1, 3, 60, 64, 65, 120, 130, 500, 1100])
        one = {rnd.getrandbits(63) for _ in range(size)}
        two = set(one)
        for _ in range(rnd.randrange(0, 1 + size // 4)):
            two.discard(rnd.choice(sorted(one)))
            if rnd.random() < 0.6:
                two.add(rnd.getrandbits(63))
        two = two or one
        a, b = (g.bitmap(np.array(sorted(s), np.uint64)).tolist() for s in (one, two))
        rows.append((len(rows), len(one), len(two), a, b))
        truth.append(100 * len(one & two) >= 80 * len(one | two))
    df = spark.createDataFrame(rows, "i int, a_n bigint, b_n bigint, a_map array<bigint>, b_map array<bigint>")
    got = {r.i: r.ok for r in df.select("i", g.maps_allow("a_", "b_", 80).alias("ok")).collect()}
    assert all(got[i] for i, t in enumerate(truth) if t) and sum(got.values()) < 400


def test_rows_without_an_id_come_out(spark):
    rows = [(1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "a b c d e f")]
    got = sorted((tuple(r) for r in g.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    assert got == [(1, 2, 1), (2, 2, 1), (None, 0, None), (None, 2, None)]
