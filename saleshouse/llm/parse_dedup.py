"""Repeated passages by prefix-free parsing.

A byte goes where a string of ``LENGTH`` bytes that covers it starts anywhere else. Sorting every suffix of the corpus would find all such strings;
parsing makes the sort one of phrases. A place is a trigger where the hash of the ``WIDTH`` bytes from it is least within some ``WINDOW`` places in a row, so
triggers follow from the text around them alone, and of each ``WINDOW`` places one is a trigger. Every string of ``LENGTH`` bytes has its first
inner trigger, the same in each of its occurrences; the strings with one first trigger are its phrase, from the earliest start to the latest end.

* Dictionary: phrases that are equal are one class; of a class that occurs twice, every occurrence goes as a whole, without a look at its strings.
* Parse order: the bytes around the trigger that all strings of a phrase hold are the phrase's key. Phrases whose key stands only once cannot have a repeated string and are
  left out; these are nearly all phrases of text that does not repeat.
* Corpus order: only for different phrases of one key, one of each class, the strings themselves are compared.

Order in the two suffix arrays is needed only as far as neighbours are equal for ``LENGTH`` bytes. So ranks are hashes and the sorts are Spark's aggregates, in which a
phrase that a third of all documents hold is counted before the shuffle; a sort would bring its whole run into one task.

Equal texts are one text first: if it stands twice and is long enough, nothing of it stays.

Defined results: a null text has no bytes and no spans, and the hash of the empty string. Repeated rows are occurrences like others. Texts shorter than ``LENGTH`` stay whole.
Null ids come out as they are. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Scratch, mix, read, text_bytes, text_chunks

LENGTH = 200
WINDOW = 64
WIDTH = 8
_BEFORE, _AFTER = WINDOW - 1, LENGTH - 2 * (WINDOW - 1)  # bytes before and from a trigger that all its strings hold
_EMPTY = hashlib.sha256(b"").hexdigest()
_BLOCK = 1 << 20  # places whose hashes are held at once


def sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` of every ``size`` values in a row; ``size`` is a power of two."""
    step = 1
    while step < size:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def triggers(data: np.ndarray) -> np.ndarray:
    """Places that are least within some ``WINDOW`` places in a row, ascending."""
    places, found = len(data) - WIDTH + 1, []
    for first in range(WINDOW - 1, max(places - WINDOW + 1, 0), _BLOCK):
        last = min(first + _BLOCK, places - WINDOW + 1)  # places first .. last - 1, with WINDOW - 1 more on either side
        own = data[first - WINDOW + 1 : last + WINDOW - 1 + WIDTH - 1].astype(np.uint64)
        value = own[: len(own) - WIDTH + 1].copy()
        for k in range(1, WIDTH):
            value |= own[k : len(own) - WIDTH + 1 + k] << np.uint64(8 * k)
        value = mix(value + np.uint64(0x9E3779B97F4A7C15))
        least = sliding(sliding(value, WINDOW, np.minimum), WINDOW, np.maximum)
        found.append(first + np.flatnonzero(value[WINDOW - 1 : WINDOW - 1 + len(least)] == least))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def phrases(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, trigger, first, last) of every phrase: the strings from ``first`` to ``last`` have this first inner trigger.

    ``data`` and ``starts`` as `text_bytes` gives them; places count from the beginning of ``data``.
    """
    at = triggers(data)
    text = np.searchsorted(starts, at, "right") - 1
    low, high = starts[text], starts[text + 1] - 1  # the text's bytes
    inner = (at - low >= WINDOW - 1) & (at <= high - WIDTH - WINDOW + 1)
    at, text, low, high = at[inner], text[inner], low[inner], high[inner]
    before = np.concatenate(([-1], at[:-1]))
    before = np.where(np.concatenate(([True], text[1:] != text[:-1]))[: len(at)], low - 1 + WINDOW - 1, before[: len(at)])
    first = np.maximum(low, before - WINDOW + 2)
    last = np.minimum(at - WINDOW + 1, high - LENGTH)
    some = first <= last
    return text[some], at[some], first[some], last[some]


def parsed(texts: DataFrame) -> DataFrame:
    """(key, phrase, id, lo, hi) of every phrase of the texts (id, text): lo and hi are the first and last start of its strings."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for chunk in text_chunks(batches):
            data, starts = text_bytes(chunk["text"])
            raw = data.tobytes()
            text, at, first, last = phrases(data, starts)
            key = [xxhash.xxh3_64_intdigest(raw[t - _BEFORE : t + _AFTER]) for t in at.tolist()]
            phrase = [xxhash.xxh3_64_intdigest(raw[a : b + LENGTH], 1) for a, b in zip(first.tolist(), last.tolist())]
            ids = chunk["id"].combine_chunks().take(pa.array(text))
            low = starts[text]
            columns = [np.array(key, np.uint64).view(np.int64), np.array(phrase, np.uint64).view(np.int64), ids, (first - low).astype(np.int32), (last - low).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["key", "phrase", "id", "lo", "hi"])

    return texts.mapInArrow(rows, "key bigint, phrase bigint, id bigint, lo int, hi int")


def strings_of(held: DataFrame) -> DataFrame:
    """(s1, s2, id, p) for every string of the ranges of starts in ``held`` (id, text, ranges)."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for name, text, ranges in zip(batch["id"].to_pylist(), batch["text"], batch["ranges"].to_pylist()):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                places = [p for r in ranges for p in range(r["lo"], r["hi"] + 1)]
                for at in range(0, len(places), _BLOCK):
                    some = places[at : at + _BLOCK]
                    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[p : p + LENGTH]) for p in some), np.int64).reshape(-1, 2)
                    columns = [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.full(len(some), name, np.int64)), pa.array(some, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, ["s1", "s2", "id", "p"])

    return held.mapInArrow(rows, "s1 bigint, s2 bigint, id bigint, p int")


def removed(held: DataFrame, length: int = LENGTH) -> DataFrame:
    """(print, n_removed, n_spans, kept_sha256, kept); ``held``: print, text, ranges of starts of repeated strings (not null)."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for text, ranges in zip(batch["text"], batch["ranges"].to_pylist()):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                spans: list[list[int]] = []
                for lo, hi in sorted((r["lo"], r["hi"] + length) for r in ranges):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                kept = b"".join(raw[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(raw)]))
                out.append((sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch["print"], *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["print", "n_removed", "n_spans", "kept_sha256", "kept"])

    return held.mapInArrow(rows, "print binary, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def repeated_ranges(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, lo, hi) for the different texts (id, print, text; dealt by print) that hold repeated strings: ranges of their starts."""
    parse = parsed(texts.select("id", "text"))
    # Kept before it is joined, so that Spark can split a key that very many phrases have.
    twice = scratch.keep(parse.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "keys")
    shared = scratch.keep(parse.join(twice, "key", "left_semi"), "phrases")
    classes = shared.groupBy("key", "phrase").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "lo", "hi")).alias("one"))
    classes = scratch.keep(classes, "dictionary")
    whole = shared.join(classes.where("n > 1").select("key", "phrase"), ["key", "phrase"], "left_semi").select("id", "lo", "hi")

    mixed = scratch.keep(classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("key"), "mixed")
    open_ = classes.join(mixed, "key", "left_semi").select("one.*")
    strings = scratch.keep(strings_of(with_ranges(texts, open_)), "strings")
    again = scratch.keep(strings.groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("s1", "s2"), "again")
    single = strings.join(again, ["s1", "s2"], "left_semi").select("id", F.col("p").alias("lo"), F.col("p").alias("hi"))
    found = scratch.keep(whole.unionAll(single), "ranges")
    scratch.drop(twice, shared, classes, mixed, strings, again)
    return found


def with_ranges(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """id, print, text and ranges of the texts for which there are ``ranges`` (id, lo, hi); the texts stay where they lie."""
    lists = ranges.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    named = lists.join(texts.select("id", "print"), "id").select("print", "ranges")
    return texts.select("print", "id", "text").join(named, "print")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay) of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", "text", raw.alias("raw"), F.unhex(F.sha2(raw, 256)).alias("print"), F.octet_length(raw).cast("bigint").alias("n_bytes"))
    texts = rows.where(F.col("n_bytes") >= LENGTH).groupBy("print").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("times"))
    texts = scratch.keep_dealt(texts.withColumn("id", F.monotonically_increasing_id()), "texts", "print")
    shorter = removed(with_ranges(texts.where("times = 1"), repeated_ranges(texts, scratch)).select("print", "text", "ranges"))
    gone = texts.where("times > 1").select("print", F.lit(True).alias("gone"))
    verdicts = shorter.withColumn("gone", F.lit(False)).unionByName(gone, allowMissingColumns=True)
    all_gone, zero, one = F.coalesce("gone", F.lit(False)), F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return rows.join(verdicts, "print", "left").select(
        "doc_id", "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(all_gone, one).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(all_gone, F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("print")))).alias("kept_sha256"),
        F.when(all_gone, F.lit(b"")).otherwise(F.coalesce("kept", "raw")).alias("kept"),
    )


def op12_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat anywhere in strings of 200 bytes, taken out."""
    return without_repeats(read(spark, sf_dir, "documents")).drop("kept")


SQL = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
n AS (SELECT k, doc_id, raw, octet_length(raw) AS n_bytes FROM d),
w AS (SELECT k, p, raw[p + 1:p + 200] AS s FROM (SELECT k, raw, unnest(range(0, n_bytes - 199)) AS p FROM n)),
again AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT k, p, p > coalesce(lag(p) OVER (PARTITION BY k ORDER BY p) + 200, -1) AS new FROM w SEMI JOIN again USING (s)),
numbered AS (SELECT k, p, sum(new::BIGINT) OVER (PARTITION BY k ORDER BY p) AS g FROM hit),
span AS (SELECT k, g, min(p) AS lo, max(p) + 200 AS hi FROM numbered GROUP BY k, g),
piece AS (  -- what stays before each span, and after the last
  SELECT k, coalesce(lag(hi) OVER (PARTITION BY k ORDER BY lo), 0) AS a, lo AS b FROM span
  UNION ALL SELECT n.k, coalesce(max(span.hi), 0), any_value(n.n_bytes) FROM n LEFT JOIN span ON span.k = n.k GROUP BY n.k),
kept AS (SELECT k, string_agg(hex(raw[a + 1:b]), '' ORDER BY a) AS rest FROM piece JOIN n USING (k) WHERE b > a GROUP BY k),
gone AS (SELECT k, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY k)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM n LEFT JOIN gone USING (k) LEFT JOIN kept USING (k)
"""
