import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from saleshouse.llm import conversation_trie as ct
from saleshouse.llm import parse_dedup as pd
from saleshouse.llm import whitening as wh
from saleshouse.llm.tables import text_bytes

from .data import ODD_TEXTS, SMALL, odd

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for *_, r, x in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + turns[c][h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, own in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
            leaves[path[:d]] += children[path] == 0
    found = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in own if len(whole[c]) == len(path))
        up = members[path[:-1]][0] if path else None
        found.append((own[0], len(path), up, len(own), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def some_turns():
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice("ab"), rnd.choice(["x", "yy", "ö€", None])) for c in [*range(-40, 60), 200, 201, 305] for t in range(rnd.randrange(0, 12))]
    return rows + [(7, None, None, "x"), (None, 1, "a", "x"), (7, 1, "a", "x"), (7, 1, "a", "x"), (200, 3, "a", None)]


@pytest.mark.parametrize("shard, band", [(ct.SHARD, ct.BAND), (60, 3), (1, 1)])
def test_trie_against_plain(spark, shard, band):
    df = spark.createDataFrame(some_turns(), TURNS).selectExpr("*", "1 AS a", "2 AS pos", "3 AS conv", "4 AS __row", "5 AS leaf")
    got = sorted(map(tuple, ct.prefix_trie(df, shard, band).collect()), key=str)
    assert got == plain_trie(some_turns())


def test_trie_against_sql(spark):
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = [r for r in some_turns() if r[0] is None or r[0] >= 0]
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = sorted(map(tuple, ct.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()), key=str)
    assert got == sorted(db.execute(ct.SQL).fetchall(), key=str)


def test_trie_of_nothing_and_of_one(spark):
    assert ct.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    one = [(4, 1, "user", "a"), (None, 1, "user", "b")]  # crc32("4") % 6 > 0 and no conversation 0: without turns
    assert zlib.crc32(b"4") % 6
    assert [tuple(r) for r in ct.prefix_trie(spark.createDataFrame(one, TURNS)).collect()] == [(4, 0, None, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest())]


def test_bits():
    assert ct.bits(0b1000000000101) == [0, 2, 12]


def plain_passages(texts):
    """(n_bytes, n_removed, n_spans, kept_sha256) of every text."""
    raws, times, out = [(t or "").encode() for t in texts], defaultdict(int), []
    for raw in raws:
        for p in range(len(raw) - pd.LENGTH + 1):
            times[raw[p : p + pd.LENGTH]] += 1
    for raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - pd.LENGTH + 1):
            if times[raw[p : p + pd.LENGTH]] > 1:
                gone[p : p + pd.LENGTH] = b"\1" * pd.LENGTH
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def some_texts():
    rnd = random.Random(2)

    def text(n, letters="abcdefgh "):
        return "".join(rnd.choice(letters) for _ in range(n))

    common = [text(300), text(900), text(200), "äö€" * 50, "ab" * 400]
    texts = []
    for _ in range(200):
        parts = [text(rnd.randrange(0, 700)) if rnd.random() < 0.6 else rnd.choice(common)[: rnd.choice([199, 200, 201, 900])] for _ in range(rnd.randrange(0, 5))]
        texts.append("".join(parts))
    texts += [None, "", "a" * 5000, "ab" * 3000 + "c", text(50) * 20, text(199), "x" * 200, "y" * 201, texts[3], texts[3], texts[4] + "z"]
    # Copies that differ in one letter, at every distance from an end.
    long = text(1500)
    return texts + [long[:k] + "#" + long[k + 1 :] for k in range(0, 1500, 37)]


def test_passages_against_plain(spark):
    texts = some_texts()
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS id", "2 AS print", "3 AS key", "4 AS raw", "5 AS gone")
    got = sorted((tuple(r) for r in pd.without_repeats(df).collect()), key=str)
    want = plain_passages(texts)
    assert sorted((g[:5] for g in got), key=str) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)
    assert all(hashlib.sha256(g[5]).hexdigest() == g[4] and len(g[5]) == g[1] - g[2] for g in got)
    assert sum(w[1] for w in want) > 50_000


def test_passages_against_sql(spark):
    rows = [(i, t) for i, t in enumerate(some_texts()[:60])]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = sorted(map(tuple, pd.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).drop("kept").collect()))
    assert got == sorted(db.execute(pd.SQL).fetchall())


def test_passages_of_odd_and_no_rows(spark):
    got = pd.without_repeats(odd(spark)).collect()
    texts = [*ODD_TEXTS, "text without an id", None, ODD_TEXTS[8], ODD_TEXTS[8]]
    assert sorted(tuple(r)[1:5] for r in got) == sorted(plain_passages(texts))
    assert pd.without_repeats(odd(spark).limit(0)).count() == 0


def test_triggers_follow_from_the_text_around_them(monkeypatch):
    rnd = random.Random(5)
    data = np.frombuffer(bytes(rnd.choice(b"abc ") for _ in range(20_000)), np.uint8)
    whole = pd.triggers(data)
    assert np.diff(whole).max() <= pd.WINDOW
    reach = pd.WINDOW - 1
    part = pd.triggers(data[5_000:9_000]) + 5_000
    inside = whole[(whole >= 5_000 + reach) & (whole <= 9_000 - pd.WIDTH - reach)]
    assert part.tolist() == inside.tolist()
    monkeypatch.setattr(pd, "_BLOCK", 777)  # the same in small blocks
    assert pd.triggers(data).tolist() == whole.tolist()


def test_a_string_has_one_phrase():
    texts = [t for t in some_texts() if t]
    import pyarrow as pa

    data, starts = text_bytes(pa.chunked_array([pa.array(texts)]))
    text, _, first, last = pd.phrases(data, starts)
    for k in range(len(texts)):
        own = sorted(p for t, a, b in zip(text, first, last) if t == k for p in range(a, b + 1))
        assert own == list(range(starts[k], starts[k + 1] - 1 - pd.LENGTH + 1))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def plain_whitening(x, weight, components=16):
    total = weight.sum()
    s = (x * weight[:, None]).sum(axis=0)
    c = x - s / total
    v = (c * weight[:, None]).T @ c / total
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return int(total), s, c @ axes / np.sqrt(values), values / np.trace(v)


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_whitening_against_numpy(spark, weights):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(80, 20)).astype(np.float32) * np.linspace(0.2, 3, 20, dtype=np.float32)
    rows = [(i, base[k].tolist()) for i, k in enumerate([*range(80), *[5] * 60, 7, 7])]
    rows += [(None, base[3].tolist())]
    bad = [(900, None), (901, [1.0] * 19 + [None]), (902, [1.0] * 19 + [float("nan")]), (903, [float("inf")] + [1.0] * 19), (904, []), (905, [1.0, 2.0])]
    df = vectors(spark, rows + bad).selectExpr("*", "1 AS k1", "2 AS x", "3 AS ident", "4 AS w")
    got = wh.whitened(df, weights=weights).collect()
    x = np.array([np.floor(64 * np.float64(np.float32(v))) for _, v in rows]).astype(np.int64) + 1_000_000
    distinct, times = np.unique(x, axis=0, return_counts=True)
    n, s, y, explained = plain_whitening(distinct, times if weights == "counts" else np.ones(len(distinct), np.int64))
    place = {tuple(v): k for k, v in enumerate(distinct)}
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    signs = {}
    by_id = defaultdict(dict)
    for r in got:
        by_id[r.vec_id][r.component] = r
    for (i, _), v in zip(rows, x):
        for c in range(1, 17):
            r, want = by_id[i][c], y[place[tuple(v)], c - 1]
            sign = signs.setdefault(c, np.sign(want * r.whitened))
            assert r.whitened == pytest.approx(sign * want, abs=1e-9) and r.explained == pytest.approx(explained[c - 1], rel=1e-9)
            assert r.deviation == int(((n * v - s) ** 2).sum())


def test_whitening_of_few_vectors(spark):
    assert wh.whitened(vectors(spark, [])).count() == 0
    assert wh.whitened(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector has no axis
    two = sorted(map(tuple, wh.whitened(vectors(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])])).collect()))
    assert [r[:4] for r in two] == [(1, 1, 2, 4096), (2, 1, 2, 4096), (2, 1, 2, 4096)]
    assert [abs(r[4]) for r in two] == pytest.approx([1, 1, 1]) and two[0][4] == pytest.approx(-two[1][4])
    assert two[0][5] == pytest.approx(1)


def test_exact_deviations():
    x = np.array([[1 << 40, 0], [0, 5]], np.int64)
    assert wh.deviations(x, 2, [1 << 40, 5]) == [None, None]
    assert wh.deviations(x % 1000, 2, [776, 5]) == [602201, 602201]


def test_production_queries_on_small_tables(spark):
    embeddings = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert wh.op13_whitening(spark, SMALL).count() == 16 * embeddings
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, pd.op12_prefix_free(spark, SMALL).collect()))
    assert got == sorted((d.doc_id, *w) for d, w in zip(docs, plain_passages([d.text for d in docs])))
