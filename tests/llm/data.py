"""Small inputs and plain helpers of the tests in this folder."""

from __future__ import annotations

import re

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    """Rows as (doc_id, text[, lang[, source]])."""
    filled = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(filled, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def groups(links, ids):
    """Smallest id that links reach, for every id."""
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: root(i) for i in ids}


CLASHING = ["label", "key", "n", "print", "line", "score", "rejected", "size", "copies", "host", "node", "ids", "class", "part"]
ODD_TEXTS = [None, "", " ", "\n\n", "...", "a", "ä ö ü", "x\x00y \u2028 z", "Same text here, five words and more.", "Same text here, five words and more.", "word " * 30_000, "日本語 " * 50]


def odd(spark):
    """Null ids, sources and languages, empty and long texts, repeated rows, and columns of clashing names."""
    rows = [(i, t, ["en", None, "de"][i % 3], ["s", None][i % 2]) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "text without an id", "en", "s"), (None, None, None, None), rows[8], rows[8]]
    df = docs(spark, rows)
    for name in CLASHING:
        df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df
