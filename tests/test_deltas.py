"""Summaries kept by added and removed rows equal those of the whole fact."""

import random

import pytest
from pyspark.sql import functions as F

from saleshouse.plans import deltas, summaries
from saleshouse.plans.deltas import State

from helpers import Shop, line, tuples


def shop(spark):
    rnd = random.Random(8)
    rows = [
        line(
            invoice=str(rnd.randrange(25)), code=rnd.choice("ABCD"), quantity=str(rnd.randrange(1, 9)), day=f"2010-0{rnd.randrange(1, 8)}-1{rnd.randrange(10)} 10:00:00",
            price=f"{rnd.randrange(1, 30)}.{rnd.randrange(10)}5", customer=rnd.choice(["7", "8", "9", None]),
        )
        for _ in range(80)
    ]
    return Shop(spark, rows)


def kinds(s):
    return {
        "customer": (summaries.CUSTOMER_STATE, summaries.customer_state, lambda f: summaries.customer_figures(f, s.customers, s.countries), lambda f: summaries.customer_summary(f, s.customers, s.countries, s.dates)),
        "product": (summaries.PRODUCT_STATE, summaries.product_state, lambda f: summaries.product_figures(f, s.products, s.categories), lambda f: summaries.product_summary(f, s.products, s.categories, s.dates)),
    }


CHANGES = {
    "insert": ("false", "sales_key % 5 = 0"),
    "delete": ("date_key < 20100401 or customer_key = 2", "false"),
    "delete all of a group": ("customer_key = 1 or product_key = 3", "false"),
    "update": ("sales_key % 3 = 0", "sales_key % 3 = 0"),
    "nothing": ("false", "false"),
}


@pytest.mark.parametrize("kind", ["customer", "product"])
def test_any_change_equals_the_rebuild(spark, kind):
    s = shop(spark)
    kept, state_of, shape, rebuild = kinds(s)[kind]
    # Of two thirds of the rows, so that an insert can bring new groups, dates and invoices.
    now = s.fact.where("sales_key % 5 <> 0")
    summary, state = rebuild(now).cache(), State(*[df.cache() for df in state_of(now, s.dates)])
    for name, (gone, come) in CHANGES.items():
        removed = now.where(F.coalesce(F.expr(gone), F.lit(False)))
        pool = s.fact if name == "insert" else now.withColumn("quantity", F.lit(3)).withColumn("date_key", F.lit(20100520)).withColumn("invoice_no", F.concat(F.lit("U"), "invoice_no"))
        added = pool.where(come)
        change = State(*[df.cache() for df in state_of(deltas.signed(added, removed), s.dates)])
        after = now.join(removed.select("sales_key"), "sales_key", "left_anti").select(*now.columns).unionByName(added)
        whole, part = deltas.merged(state, change, kept)
        got = deltas.refreshed(summary, part, change, kept, shape)
        want = rebuild(after)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert sorted(tuples(got)) == sorted(tuples(want)), name
        again = state_of(after, s.dates)  # and the state is that of the whole fact, ready for the next change
        assert sorted(tuples(whole.support)) == sorted(tuples(again.support)), name
        assert sorted(tuples(whole.totals), key=str) == sorted(tuples(again.totals), key=str), name


def test_changes_add_up_in_any_order(spark):
    s = shop(spark)
    kept, state_of, *_ = kinds(s)["customer"]
    parts = [State(*[df.cache() for df in state_of(s.fact.where(f"sales_key % 4 = {k}"), s.dates)]) for k in range(4)]

    def total(order):
        state = parts[order[0]]
        for k in order[1:]:
            state, _ = deltas.merged(state, parts[k], kept)
        return sorted(tuples(state.totals)), sorted(tuples(state.support))

    assert total([0, 1, 2, 3]) == total([3, 1, 0, 2])


def test_the_refresh_does_not_read_the_fact(spark, tmp_path):
    s = shop(spark)
    kept, state_of, shape, rebuild = kinds(s)["customer"]
    s.fact.write.parquet(str(tmp_path / "history"))
    fact = spark.read.parquet(str(tmp_path / "history"))
    saved = {}
    for name, df in {**state_of(fact, s.dates)._asdict(), "summary": rebuild(fact)}.items():
        df.write.parquet(str(tmp_path / name))
        saved[name] = spark.read.parquet(str(tmp_path / name))
    change = state_of(deltas.signed(s.fact.where("sales_key = 1"), None), s.dates)
    _, part = deltas.merged(State(saved["totals"], saved["support"]), change, kept)
    plan = deltas.refreshed(saved["summary"], part, change, kept, shape)._jdf.queryExecution().optimizedPlan().toString()
    assert "history" not in plan


def test_removing_what_is_not_there(spark):
    s = shop(spark)
    kept, state_of, *_ = kinds(s)["customer"]
    state = state_of(s.fact.where("sales_key < 10"), s.dates)
    change = state_of(deltas.signed(None, s.fact.where("sales_key >= 10")), s.dates)
    with pytest.raises(Exception, match="does not hold"):
        deltas.merged(state, change, kept)[0].totals.collect()


def test_empty_state(spark):
    s = shop(spark)
    kept, state_of, shape, rebuild = kinds(s)["product"]
    nothing = state_of(s.fact.limit(0), s.dates)
    _, part = deltas.merged(nothing, state_of(s.fact, s.dates), kept)
    got = deltas.refreshed(rebuild(s.fact.limit(0)), part, state_of(s.fact, s.dates), kept, shape)
    assert sorted(tuples(got)) == sorted(tuples(rebuild(s.fact)))
