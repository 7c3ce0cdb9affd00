import random
from collections import Counter

from saleshouse.llm import quality_rules as q

from .data import docs, odd, words


def repeated_words(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    return len({i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)})


def test_base_against_plain_python(spark):
    rnd = random.Random(2)
    rows = [(k, "".join(rnd.choice(["a", "b", "cc", " ", " ", "\n", "\t", "#", "ä"]) for _ in range(rnd.randrange(0, 120)))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, "x y z x y z"), (503, "x x x x")]
    for r in q.measured(docs(spark, rows)).collect():
        text = dict(rows)[r.doc_id] or ""
        lines = [x for x in text.split("\n") if words(x)]
        assert r.n_words == len(words(text)) and r.word_chars == sum(map(len, words(text)))
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == repeated_words(text)


def test_order_does_not_change_the_verdict(spark):
    text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)) + " "
    df = docs(spark, [(k, text + s) for k, s in enumerate(["", "#" * 40, "!" * 80, "1" * 500, "É" * 900])])
    base = {r.doc_id: r.kept for r in q.cascaded(df).collect()}
    assert base == {r.doc_id: r.kept for r in q.cascaded(df, q.RULES[::-1]).collect()}
    assert base[0] and not any(base[k] for k in (1, 2, 3, 4))


def test_rules_with_more_rejection_per_cost_come_first(spark):
    hits = q.Rule("hits", lambda: q.F.col("n_words") > 0)
    misses = q.Rule("misses", lambda: q.F.col("n_words") < 0)
    df = docs(spark, [(k, " ".join(f"w{k}x{j}" for j in range(60))) for k in range(50)])
    assert [r.name for r in q.cascade_order(df, [misses, hits])] == ["hits", "misses"]


def test_costs_are_those_of_the_rules(spark):
    """A rule that scans the text ten times costs more than one that looks at a number, however long a job takes."""
    cheap = q.Rule("cheap", lambda: q.F.col("n_words") < 0)
    dear = q.Rule("dear", lambda: sum((q.F.regexp_count("text", q.F.lit(f"[a-{x}]+q")) for x in "mnopqrstuv"), q.F.lit(0)) < 0)
    sample = q.measured(docs(spark, [(k, " ".join(f"w{k}x{j}" for j in range(400))) for k in range(300)])).repartition(4)
    path = q.Scratch(spark).keep(sample, "costs")
    costs = q.rule_costs(path, [cheap, dear])
    assert costs["dear"] > 10 * costs["cheap"] > 0
    # Both reject the same documents; the cheap one comes first although it was given last.
    every = [q.Rule("dear", lambda: dear.rejects() | (q.F.col("n_words") > 0)), q.Rule("cheap", lambda: q.F.col("n_words") > 0)]
    df = docs(spark, [(k, " ".join(f"w{k}x{j}" for j in range(400))) for k in range(300)])
    assert [r.name for r in q.cascade_order(df, every)] == ["cheap", "dear"]


def test_order_counts_only_what_is_left():
    # Rule 1 rejects what rule 0 rejects already, rule 2 rejects fewer but others.
    hits = {(True, True, False): 60, (True, False, False): 5, (False, False, True): 20, (False, True, True): 1, (False, False, False): 14}
    assert q.by_rejection_per_cost(hits, [1.0, 1.0, 1.0]) == [0, 2, 1]
    assert q.by_rejection_per_cost(hits, [10.0, 1.0, 1.0]) == [1, 2, 0]
    assert q.by_rejection_per_cost({}, [2.0, 1.0, 1.0]) == [1, 2, 0] and q.by_rejection_per_cost({}, []) == []


def test_odd_rows_and_no_rows(spark):
    assert q.cascaded(odd(spark)).count() == odd(spark).count()
    assert q.cascaded(docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = q.cascaded(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
