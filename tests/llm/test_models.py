"""Quality, language, licenses and vectors."""

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from saleshouse.llm import language_id as li
from saleshouse.llm import license_scan as ls
from saleshouse.llm import quality_model as qm
from saleshouse.llm import vector_search as vs
from saleshouse.llm.tables import SpanHasher, read

from .data import FOLDER, docs, odd


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_on_held_out_labels(spark):
    got = {r.doc_id: r for r in qm.op3_quality_ftrl(spark, FOLDER).collect()}
    labels = [(r.doc_id, r.quality) for r in read(spark, FOLDER, "labels").collect() if r.quality is not None and r.doc_id in got]
    assert len(got) == read(spark, FOLDER, "documents").count()
    assert all(r.held_out == (remainder(i, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(got[i].score, q) for i, q in labels if remainder(i, 3) == 1]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    order = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert order > 0.9, order
    assert np.mean([(s >= 0.5) == q for s, q in held]) > 0.9


def test_quality_scores_are_dot_products(spark):
    weights = np.random.default_rng(1).standard_normal(qm.DIMENSIONS)
    df = odd(spark)
    got = sorted((str(r.doc_id), round(r.score, 9)) for r in qm.scored(df, weights).collect())
    expected = []
    for r in df.select("doc_id", "text").collect():
        counts, tokens = plain_features(r.text)
        total = sum(weights[i] * n for i, n in counts.items()) / max(tokens, 1) ** 0.5 + weights[0]
        expected.append((str(r.doc_id), round(1 / (1 + np.exp(-np.clip(total, -35, 35))), 9)))
    assert got == sorted(expected)


def plain_features(text):
    """How often each feature stands in a text, and its tokens: words, runs of signs, and pairs of neighbours."""
    hasher = SpanHasher()
    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", (text or "").encode("utf-8", "surrogatepass"))
    names = [int(hasher(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0]) for t in tokens]
    pairs = [int(qm._SAME) if a == b else int(qm.mix(np.uint64([(3 * a + b) % 2**64]))[0]) for a, b in zip(names, names[1:])]
    return Counter((h >> 20) % (qm.DIMENSIONS - 1) + 1 for h in [*names, *pairs]), len(tokens)


def plain_ftrl(examples):
    """FTRL-proximal, one weight after the other."""
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= qm.L1:
            return 0.0
        return -(z[i] - math.copysign(qm.L1, z[i])) / ((qm.BETA + math.sqrt(n[i])) / qm.ALPHA + qm.L2)

    for _ in range(qm.EPOCHS):
        for x, label in examples:
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / qm.ALPHA * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_ftrl_against_a_plain_loop():
    rnd = np.random.default_rng(12)
    sparse = [({0: 1.0} | {int(i): float(rnd.random()) for i in rnd.integers(1, 60, 7)}, int(rnd.random() < 0.4)) for _ in range(300)]
    got = qm.trained([(np.array([*x]), np.array([*x.values()]), label) for x, label in sparse])
    expected = plain_ftrl(sparse)
    assert np.count_nonzero(got) == sum(w != 0 for w in expected.values()) > 20
    assert all(abs(got[i] - w) < 1e-9 for i, w in expected.items())


def test_quality_fit_against_plain_training(spark):
    """Texts of many shapes; one row stands three times, and one id on two texts."""
    rows = [(k, t) for k, t in enumerate(["good good text, indeed!", None, "", "  ", "a b a b", "x" * 5000 + " é é", "Ⅷ -- !!", "bad 12 12"] * 5)]
    rows += [rows[0]] * 2 + [(4, "another text of four")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(45)] + [(3, None), (5, 1)], "doc_id bigint, quality int")
    got = qm.fit(docs(spark, rows), labels, "quality", qm.in_fold("doc_id", 3) != 1)
    groups = {}
    shard = {r.doc_id: r.s for r in labels.selectExpr("doc_id", f"pmod(xxhash64(doc_id, 'shard'), {qm.SHARDS}) AS s").collect()}
    prints = {r.text: r.p for r in docs(spark, rows).selectExpr("text", "xxhash64(text) AS p").collect()}
    for i, text in set(rows):
        if remainder(i, 3) != 1:
            counts, tokens = plain_features(text)
            x = {0: 1.0} | {f: c / math.sqrt(max(tokens, 1)) for f, c in counts.items()}
            order = (int(qm.mix(np.uint64([i]))[0]), i % 2, prints[text])
            groups.setdefault(shard[i], []).append((order, x, i % 2))
    total = sum(map(len, groups.values()))
    expected = np.zeros(qm.DIMENSIONS)
    for group in groups.values():
        for i, w in plain_ftrl([(x, label) for _, x, label in sorted(group, key=lambda e: e[0])]).items():
            expected[i] += w * len(group) / total
    assert np.count_nonzero(expected) and np.abs(got - expected).max() < 1e-6


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    weights = qm.fit(odd(spark), labels, "quality", qm.in_fold("doc_id", 3) != 1)
    assert {r.score for r in qm.scored(odd(spark), weights).collect()} == {0.5}
    assert qm.scored(docs(spark, []), weights).count() == 0


def test_ftrl_separates():
    rnd = np.random.default_rng(4)
    examples = [(np.array([0, 1 + (k % 2), 3 + rnd.integers(50)]), np.array([1.0, 1.0, 0.5]), k % 2) for k in range(400)]
    w = qm.trained(examples)
    assert w[2] > 0.5 > -0.5 > w[1]


def test_language_on_held_out_documents(spark):
    got = li.op7_language_zstd(spark, FOLDER).collect()
    truth = {r.doc_id: r.lang for r in read(spark, FOLDER, "documents").collect()}
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert len(got) == len(truth) and all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert np.mean([r.rejected for r in got]) < 0.02


def test_language_of_odd_texts(spark):
    contents = {"en": b"the and of to in that is with " * 9, "de": "und der die das nicht über für ".encode() * 9}
    got = li.identified(odd(spark), contents).collect()
    assert len(got) == odd(spark).count()
    for r in got:
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == none and (not none or (r.rejected and r.score == 0))
    assert {r.lang_pred for r in li.identified(odd(spark), {}).collect()} == {"und"}
    assert li.dictionaries(docs(spark, []), li.in_fold("doc_id", 5) != 0) == {}


def test_language_of_long_texts(spark):
    table = read(spark, "/root/testdata/sf0.1", "documents")
    judge = li.Judge(li.dictionaries(table, li.in_fold("doc_id", 5) != 0))
    by = {}
    for r in table.where("lang is not null and n_chars > 500").select("lang", "text").orderBy("doc_id").collect():
        by.setdefault(r.lang, []).append(r.text)
    assert len(by) > 1
    for lang, texts in by.items():
        long = " ".join(texts)
        long = long * -(-4_000_000 // len(long))
        for size in (3_000, 300_000, 1_000_000, 4_000_000):
            found, _, rejected = judge(long[:size])
            assert (found, rejected) == (lang, False), (lang, size)


def test_language_against_a_plain_loop(spark):
    """Every text in equal pieces, each compressed with every dictionary; the least sum wins."""
    import zstandard

    table = read(spark, FOLDER, "documents").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    contents = li.dictionaries(read(spark, FOLDER, "documents"), li.in_fold("doc_id", 5) != 0)
    assert len(contents) > 1 and all(8 <= len(x) <= li.DICTIONARY_BYTES for x in contents.values())
    own = {}
    for lang, content in contents.items():
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=li.LEVEL)
        own[lang] = zstandard.ZstdCompressor(dict_data=raw, level=li.LEVEL, write_content_size=False)

    def expected(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0, True
        words = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in text.lower().encode("utf-8", "surrogatepass")).split()
        rest, count = b" ".join(words), 1
        while count * 32_768 < len(rest):
            count += 1
        sizes = {x: 0 for x in own}
        for k in range(count):
            for lang, compressor in own.items():
                sizes[lang] += len(compressor.compress(rest[len(rest) * k // count : len(rest) * (k + 1) // count]))
        first, second = sorted((n, lang) for lang, n in sizes.items())[:2]
        return first[1], 1 / sum(2.0 ** -min(n - first[0], 60) for n in sizes.values()), second[0] - first[0] < 0.002 * first[0]

    for r in li.identified(table, contents).collect():
        lang, score, rejected = expected(r.text)
        assert (r.lang_pred, r.rejected) == (lang, rejected) and abs(r.score - score) < 1e-12


def test_dictionaries_hold_parts_from_all_over(spark):
    for size in (1, 255, 256, 700, 5000, 9999):
        got = li.excerpt(bytes(k % 251 for k in range(10_000)), size)
        assert len(got) == size
    marks = " ".join(f"{a}{b}{c}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst" for c in "abcdefghijklmnopqrst")
    got = li.excerpt(marks.encode(), 4000).decode()
    assert all(f" {a}" in got for a in "bcdefghijklmnopqrs")
    assert li.level([5, 100, 7], 30) == 18 and li.level([1, 2], 30) == 2 and li.level([], 30) == 0
    # Two long texts and a short one fill the dictionary; null ids and ties do no harm.
    rows = [(1, "x", marks * 20), (None, "x", marks * 20), (2, "x", "zu kurz"), (3, "x", None), (4, None, marks), (5, "y", "abc")]
    table = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").selectExpr("*", "1 AS k", "2 AS content", "3 AS n")
    got = li.dictionaries(table, li.F.lit(True))
    assert set(got) == {"x"} and li.DICTIONARY_BYTES - 8 <= len(got["x"]) <= li.DICTIONARY_BYTES and b"zu kurz" in got["x"]


TEXTS = [
    "Licensed under CC BY-NC 4.0. All rights reserved.", "GNU General Public License, version 3 or later", "SPDX-License-Identifier: Apache-2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "cc by cc by cc by-sa 4.0", "all rights all rights reserved",
    "the omitted mitten", "Distributed under the MIT license; MIT license", "This is released under the terms of the GNU Lesser General Public License v2.1",
]


def test_licenses_against_plain_scanning(spark):
    rules = ls.rules()
    assert len(rules) > 300
    df = docs(spark, list(enumerate(TEXTS)) + [(50, None), (51, "")])
    for r in ls.scanned(df).collect():
        text = dict(enumerate(TEXTS)).get(r.doc_id) or ""
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(k, label) for p, label in ls.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        hits = set()
        for rule in rules:  # every rule, no prefilter
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", f" {' '.join(w)} "):
                first = f" {' '.join(w)} "[: m.start()].count(" ") - 1
                hits.add(ls.Hit(rule.label, first, first + len(m[0].split()), rule.priority, rule.confidence))
        rank = lambda h: (h.priority, h.first - h.end, h.first, h.label)
        kept = {h for h in hits if not any(o != h and o.first <= h.first and h.end <= o.end and rank(o) < rank(h) for o in hits)}
        assert r.n_words == len(w) and sorted(map(tuple, r.places)) == sorted(places)
        assert {tuple(h) for h in r.hits} == {tuple(h) for h in kept}


def alternatives(pattern):
    """Texts that a pattern of the rules matches: every way through its groups, once with and once without optional parts."""
    import itertools
    from re import _parser

    def ways(parsed):
        parts = []
        for op, value in parsed:
            name = str(op)
            if name == "LITERAL":
                parts.append([chr(value)])
            elif name == "IN":
                parts.append([chr(v) if str(o) == "LITERAL" else "4" if "DIGIT" in str(v) else "w" for o, v in value])
            elif name == "BRANCH":
                parts.append([x for branch in value[1] for x in ways(branch)])
            elif name == "SUBPATTERN":
                parts.append(ways(value[3]))
            elif name == "MAX_REPEAT":
                parts.append([""] * (value[0] == 0) + ways(value[2]))
            else:
                raise AssertionError(name)
        return ["".join(x) for x in itertools.product(*parts)]

    return ways(_parser.parse(pattern))


def test_every_alternative_of_a_rule_passes_the_gate():
    own = tuple(ls.rules())
    patterns = ls._compiled(own)[1]
    for label, key, pattern in [*ls.NAMES, *ls.NOTICES]:
        for text in alternatives(pattern):
            for words in (f" {text} ", f" licensed under the {text} "):
                plain = {(own[k].label, m.start(), m.end()) for k, p in enumerate(patterns) for m in p.finditer(words) if own[k].label == label}
                starts = {(h.label, h.first, h.end) for h in ls.gated(words, own) if h.label == label}
                assert plain and {(x, words.count(" ", 0, a) - 1, words.count(" ", 0, b)) for x, a, b in plain} == starts, text
    assert {h.label for h in ls.gated(ls.padded_words("Licensed under the FreeBSD license")[0], own)} == {"bsd-2-clause"}
    assert {h.label for h in ls.gated(ls.padded_words("released under 0BSD")[0], own)} == {"0bsd"}


def test_licenses_in_a_long_text():
    words, n = ls.padded_words("Größe: licensed under cc by 4.0 " * 60_000)  # 2 MB; took a minute when spaces were counted anew for each hit
    start = time.perf_counter()
    assert ls.phrase_places(words) == [(7 * k + 3, "cc-by") for k in range(60_000)] and n == 420_000
    hits = ls.unsuppressed(ls.gated(words, tuple(ls.rules())))
    assert [(h.label, h.first, h.end) for h in hits] == [("cc-by-4.0", 7 * k + 1, 7 * k + 7) for k in range(60_000)]
    assert time.perf_counter() - start < 30


def test_license_labels(spark):
    df = ls.scanned(docs(spark, list(enumerate(TEXTS))))
    labels = {r.doc_id: {h.label for h in r.hits} for r in df.collect()}
    assert labels[0] == {"cc-by-nc-4.0", "reserved"} or labels[0] == {"cc-by-nc-4.0"}
    assert labels[1] == {"gpl-3.0"} and labels[2] == {"apache-2.0"} and labels[3] == {"mit"} and not labels[6] and labels[7] == {"mit"}
    assert ls.scanned(odd(spark)).count() == odd(spark).count() and ls.scanned(docs(spark, [])).count() == 0


def brute(ids, x, asked, k=20):
    out = {}
    for q in asked:
        scores = (x * x[ids.index(q)]).sum(axis=1)
        out[q] = sorted((-s, i) for s, i in zip(scores, ids) if i != q)[:k]
    return out


def test_vectors_reach_the_recall(spark):
    rows = read(spark, FOLDER, "embeddings").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    truth = brute(ids, x, [i for i in ids if i % 20 == 0])
    got = {}
    for r in vs.op2_multi_index(spark, FOLDER).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(truth)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in truth[q]})
    assert hits / (20 * len(truth)) >= 0.9


def test_probing_finds_every_code_within_the_radius():
    rnd = np.random.default_rng(6)
    codes = rnd.integers(0, 2**16, (3000, 4), dtype=np.uint16)
    codes[:500] = codes[0] ^ (1 << rnd.integers(0, 16, (500, 4))).astype(np.uint16)
    index = vs.MultiIndex(codes)
    for radius in (0, 3, 7, 12, 25):
        for q in codes[:40:8]:
            distance = np.bitwise_count(codes ^ q).sum(axis=1)
            assert set(index.within(q, radius, 0)) == set(np.flatnonzero(distance <= radius))


def test_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20 * k, [float(k), 1.0, 0.0]) for k in range(4)] + [
        (1, None), (40, None), (60, [nan, 1.0, 0.0]), (7, [0.0, 0.0, 0.0]), (9, [1.0, None, 2.0]), (11, [inf, 1.0, 1.0]), (13, [1.0]), (15, []),
        (None, [1.0, 1.0, 1.0]), (100, [2.0, 1.0, 0.0]), (101, [2.0, 1.0, 0.0]), (102, [2.0, 1.0, 0.0]), (101, [2.0, 1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "0 AS v", "1 AS block", "2 AS score", "3 AS rank")
    got = [tuple(r) for r in vs.nearest(df, "embedding", vs.F.col("vec_id") % 20 == 0, 2).orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 20, 1.0), (0, 2, 40, 1.0), (20, 1, 60, 4.0), (20, 2, 40, 3.0), (40, 1, 60, 7.0), (40, 2, 100, 5.0),
        (60, 1, 40, 7.0), (60, 2, 100, 7.0), (100, 1, 60, 7.0), (100, 2, 40, 5.0),
    ]
    assert vs.nearest(df.limit(0), "embedding", vs.F.col("vec_id") % 20 == 0).count() == 0
    assert vs.nearest(df.where("vec_id = 20"), "embedding", vs.F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("dimension", [3, 40])
def test_vectors_of_any_length(spark, dimension):
    rnd = np.random.default_rng(8)
    x = rnd.standard_normal((400, dimension)) * rnd.random((400, 1)) * 5
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    truth = brute(list(range(400)), x, range(0, 400, 20))
    got = {}
    for r in vs.nearest(df, "embedding", vs.F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for _, i in truth[q]}) / 20 for q in truth]) >= 0.9
