"""License scan: ordered signature rules, keyword prefilter, and suppression of contained detections.

The rules (`license_values`) are every name in every form, plus notices that need no name: some hundreds of regular expressions.
A text is brought to words in lower case with single spaces. One pass of an Aho-Corasick automaton finds
which keywords it holds, and only the rules of these keywords are run. A detection that lies inside one of
higher priority, or inside a longer one of equal priority, is suppressed. Phrases of the base are found
wherever their words stand and are never suppressed.

Defined results: null and empty text have no words and no detections: zero counts, null places, empty label lists, score 0.
A null doc_id and repeated rows are scanned as any other row. Places may overlap and each counts. An empty table gives an empty result.
Only doc_id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_values import FORMS, NAMES, NOTICES, PHRASES
from .tables import read

BASE_CONFIDENCE = 0.9
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


class Hit(NamedTuple):
    label: str
    first: int  # word
    end: int  # word after the last
    priority: int
    confidence: float


def rules() -> list[Rule]:
    """Every rule, in order of priority."""
    named = [Rule(label, key, form.replace("{name}", name), rank, sure) for label, key, name in NAMES for _, form, rank, sure in FORMS]
    spelled = [
        Rule(label, "spdx", r"spdx license identifier " + label.replace(".", " ").replace("-", " "), 1, 1.0) for label, _, _ in NAMES
    ]
    plain = [Rule(label, key, pattern, 1, 0.9) for label, key, pattern in NOTICES]
    return sorted([*plain, *spelled, *named], key=lambda r: r.priority)


@lru_cache(maxsize=2)
def _compiled(own: tuple[Rule, ...]):
    """Automaton of the keywords, whose values are the numbers of their rules, and the compiled patterns."""
    by_key: dict[str, list[int]] = {}
    for k, rule in enumerate(own):
        by_key.setdefault(rule.keyword, []).append(k)
    automaton = ahocorasick.Automaton()
    for key, numbers in by_key.items():
        automaton.add_word(key, numbers)  # anywhere, as in freebsd and 0bsd
    automaton.make_automaton()
    return automaton, [re.compile(f"(?<= )(?:{r.pattern})(?= )") for r in own]


def padded_words(text: str | None) -> tuple[str, int]:
    """The words in lower case, a space before, between and after them, and their number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass") if words else " ", len(words)


def spaces_before(words: str, places: list[int]) -> list[int]:
    """How many spaces stand before each place. The spaces are looked for once, so many places cost no more passes."""
    if not places:
        return []
    spaces = np.flatnonzero(np.frombuffer(words.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
    return np.searchsorted(spaces, places).tolist()


def phrase_places(words: str, phrases=PHRASES) -> list[tuple[int, str]]:
    """(word, label) of every place where a phrase's words stand."""
    places, labels = [], []
    for phrase, label in phrases:
        at = words.find(f" {phrase} ")
        while at >= 0:
            places.append(at)
            labels.append(label)
            at = words.find(f" {phrase} ", at + 1)
    return list(zip(spaces_before(words, places), labels))


def gated(words: str, own: tuple[Rule, ...]) -> list[Hit]:
    """Detections of the rules whose keyword the words hold."""
    automaton, patterns = _compiled(own)
    numbers = {k for _, some in automaton.iter(words) for k in some} if len(automaton) else ()
    found = [(own[k], m.start(), m[0].count(" ") + 1) for k in sorted(numbers) for m in patterns[k].finditer(words)]
    first = spaces_before(words, [at for _, at, _ in found])
    return [Hit(r.label, k - 1, k - 1 + n, r.priority, r.confidence) for (r, _, n), k in zip(found, first)]


def unsuppressed(hits: list[Hit]) -> list[Hit]:
    """Hits that lie in no hit of higher priority, nor in a longer one of equal priority; of equal ones the first label stays.

    Taken in that order, a hit is suppressed if one taken before starts no later and ends no earlier. The
    furthest end for each start is kept ascending, so a hit costs a binary search.
    """
    kept, starts, ends = [], [], []  # of hits that no other covers: both ascending
    for hit in sorted(set(hits), key=lambda h: (h.priority, h.first - h.end, h.first, h.label)):
        at = bisect_right(starts, hit.first)
        if at and ends[at - 1] >= hit.end:
            continue
        kept.append(hit)
        low = at - (at > 0 and starts[at - 1] == hit.first)
        high = at
        while high < len(ends) and ends[high] <= hit.end:
            high += 1
        starts[low:high], ends[low:high] = [hit.first], [hit.end]
    return kept


def scanned(docs: DataFrame, own: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, places array<struct<word, label>> of the phrases, hits array<struct<label, first, end, priority, confidence>>."""
    chosen = tuple(rules() if own is None else own)

    def scan(batches: Iterator[pa.RecordBatch]):
        place = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
        hit = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("priority", pa.int32()), ("confidence", pa.float64())]))
        for batch in batches:
            counts, places, hits = [], [], []
            for text in batch["text"].to_pylist():
                words, n = padded_words(text)
                counts.append(n)
                places.append([{"word": w, "label": x} for w, x in phrase_places(words)])
                hits.append([h._asdict() for h in unsuppressed(gated(words, chosen))])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(places, place), pa.array(hits, hit)], ["doc_id", "n_words", "places", "hits"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan,
        f"doc_id {kind}, n_words bigint, places array<struct<word: bigint, label: string>>, "
        "hits array<struct<label: string, first: bigint, end: bigint, priority: int, confidence: double>>",
    )


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places and all labels of every document; the score is that of the surest detection."""
    found = scanned(read(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct("places.label"))
    every = F.array_sort(F.array_distinct(F.concat("places.label", "hits.label")))
    sure = F.greatest(
        F.coalesce(F.array_max("hits.confidence"), F.lit(0.0)), F.when(F.size("places") > 0, BASE_CONFIDENCE).otherwise(0.0)
    )
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), sure.alias("score"),
    )
