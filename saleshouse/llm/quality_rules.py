"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule has a name and a condition that rejects. A bounded sample tells which documents a rule rejects
and what it costs, apart from the job that measures it. The next rule is always the one with most rejection per cost among the documents
that those before it leave, and a document leaves the cascade at its first hit. All rules must pass, so the order moves only work, never the verdict.

Defined results: a null or empty text has no words and fails the base (fewer than 50 words). A null doc_id and
repeated rows are judged as any other row. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Scratch, read

SAMPLE = 2_000  # documents, at most, that cost and selectivity are estimated on
REPEATS = 10  # of the sample when a rule is timed
PARTS = 8  # that the sample is timed in
LEAST_SECONDS = 0.001  # what a rule costs that takes no measurable time


class Rule(NamedTuple):
    name: str
    rejects: Callable[[], Column]


def _share(pattern: str, percent: int, of: str) -> Column:
    return 100 * F.regexp_count("text", F.lit(pattern)) > percent * F.col(of)


# Conditions over text, the measures below, n_lines. Shares are in percent.
RULES = [
    Rule("symbols", lambda: 100 * F.col("n_symbols") > 30 * F.col("n_words")),
    Rule("repeated_lines", lambda: 100 * F.col("n_dup_lines") > 40 * F.col("n_lines")),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 20 * F.col("n_words")),
    Rule("capitals", lambda: _share("\\p{Lu}", 50, "word_chars")),
    Rule("exclamations", lambda: _share("!", 50, "n_words")),
    Rule("digits", lambda: _share("[0-9]", 30, "word_chars")),
    Rule("few_letters", lambda: 100 * F.regexp_count("text", F.lit("\\p{L}")) < 50 * F.col("word_chars")),
    Rule("addresses", lambda: _share("https?://", 20, "n_words")),
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body (or a lambda in it) uses it."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, "[\\x09-\\x0D]", " "), " "), lambda w: w != "")


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Window hashes are sorted; only where two neighbours are equal are places sorted along with them.
    """

    def covered(places: Column) -> Column:
        # Windows at p and q share words when q - p < 3.
        return F.aggregate(
            F.sequence(F.lit(1), F.size(places) - 1), F.lit(3).cast("bigint"),
            lambda sum_, k: sum_ + F.least(F.lit(3), F.get(places, k) - F.get(places, k - 1)).cast("bigint"),
        )

    def places(hashes: Column) -> Column:
        def twice(sorted_: Column) -> Column:
            def same(e: Column, k: Column) -> Column:
                before, after = F.get(sorted_, k - 1), F.get(sorted_, k + 1)
                return e["h"].eqNullSafe(before["h"]) | e["h"].eqNullSafe(after["h"])

            return F.sort_array(F.transform(F.filter(sorted_, same), lambda e: e["i"]))

        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), twice)

    def repeats(hashes: Column) -> Column:
        some = let(
            F.sort_array(hashes),
            lambda s: F.exists(F.sequence(F.lit(1), F.size(s) - 1), lambda k: F.get(s, k) == F.get(s, k - 1)),
        )
        return F.when(some, let(places(hashes), covered)).otherwise(F.lit(0).cast("bigint"))

    windows = let(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        ),
    )
    return F.when(F.size(words) >= 4, let(windows, repeats)).otherwise(F.lit(0).cast("bigint"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text and the base measures, all bigint."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return (
        docs.select("doc_id", text.alias("text"))
        .select("*", _words(F.col("text")).alias("__words"), lines.alias("__lines"))
        .select(
            "doc_id", "text",
            F.size("__words").cast("bigint").alias("n_words"),
            F.aggregate("__words", F.lit(0).cast("bigint"), lambda n, w: n + F.length(w)).alias("word_chars"),
            F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            F.size("__lines").cast("bigint").alias("n_lines"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
            _repeated_words(F.col("__words")).alias("n_repeat_words"),
        )
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    )


def rule_costs(sample: DataFrame, rules: list[Rule]) -> dict[str, float]:
    """Seconds of each rule over ``REPEATS`` times the sample, without those that a job takes that only looks at the rows.

    Counts of one sample are done in less time than a job needs to start; over many repeats the rule is what is timed.
    """
    once, many = (sample.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.lit(n)))) for n in (1, REPEATS))

    def seconds(condition: Column) -> float:
        once.agg(F.count_if(condition)).collect()  # compiles
        start = time.perf_counter()
        many.agg(F.count_if(condition)).collect()
        return time.perf_counter() - start

    idle = seconds(F.isnull("text"))
    return {r.name: max(seconds(r.rejects()) - idle, LEAST_SECONDS) for r in rules}


def by_rejection_per_cost(hits: dict[tuple[bool, ...], int], costs: list[float]) -> list[int]:
    """Places of the rules: the next is always that which rejects most per cost of the documents that those before have left.

    ``hits`` says of how many documents each combination of verdicts is. Equal rates go to the cheaper rule, then to the first.
    """
    order, left = [], dict(hits)
    while len(order) < len(costs):
        rest = [k for k in range(len(costs)) if k not in order]
        rejected = {k: sum(n for verdicts, n in left.items() if verdicts[k]) for k in rest}
        order.append(min(rest, key=lambda k: (-rejected[k] / costs[k], costs[k], k)))
        left = {verdicts: n for verdicts, n in left.items() if not verdicts[order[-1]]}
    return order


def cascade_order(docs: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules by rejection per cost, both estimated on at most ``SAMPLE`` documents that pass the base."""
    rows = docs.count()
    scratch = Scratch(docs.sparkSession)
    some = docs.sample(min(1.0, 1.5 * SAMPLE / max(rows, 1)), seed=7).limit(SAMPLE)
    sample = scratch.keep(measured(some).where("not base_failed").repartition(PARTS), "sample")
    verdicts = [F.coalesce(r.rejects(), F.lit(False)).alias(f"v{k}") for k, r in enumerate(rules)]
    # At most SAMPLE combinations.
    found = sample.select(*verdicts).groupBy(*[f"v{k}" for k in range(len(rules))]).count().collect()
    costs = rule_costs(sample, rules)
    scratch.drop(sample)
    return [rules[k] for k in by_rejection_per_cost({tuple(r[:-1]): r[-1] for r in found}, [costs[r.name] for r in rules])]


def cascaded(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Base measures and verdict of every document; rejected_by is the base or the first rule that hit."""
    ordered = cascade_order(docs, rules)
    first = F.when(F.col("base_failed"), F.lit("base"))
    for rule in ordered:  # a CASE tries its branches one after the other
        first = first.when(rule.rejects(), F.lit(rule.name))
    return measured(docs).withColumn("rejected_by", first).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("rejected_by").isNull().alias("kept"), "rejected_by",
    )


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every document. Which rule hit first depends on the measured costs, so it is left out."""
    return cascaded(read(spark, sf_dir, "documents")).drop("rejected_by")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, k, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS k FROM w)),
twice AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, k + j AS p FROM twice, (SELECT unnest(range(0, 3)) AS j)) GROUP BY doc_id),
m AS (SELECT w.doc_id, text, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 40 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 100 * len(regexp_extract_all(text, '\p{Lu}')) > 50 * word_chars OR 100 * len(regexp_extract_all(text, '!')) > 50 * n_words
    OR 100 * len(regexp_extract_all(text, '[0-9]')) > 30 * word_chars OR 100 * len(regexp_extract_all(text, '\p{L}')) < 50 * word_chars
    OR 100 * len(regexp_extract_all(text, 'https?://')) > 20 * n_words) AS kept
FROM b
"""
