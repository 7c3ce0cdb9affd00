"""Connected components, and components of a similarity graph whose candidate links come from shared keys.

Nothing here passes ids or links through the driver: only row counts and check sums do.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch

TESTS = 8
ROUNDS = 3
RUNS = ["run", "run2", "run3"]
AT_ONCE = 1 << 20  # rows of the ids that have met go through the shuffles of a round together, where there are so many
MOST_KEYS = 512  # of an id that travel with each of its rows in the last step; with more, its pairs are met at each common key


def stars(edges: DataFrame) -> bool:
    """Whether every u of the edges (u, v; u > v) has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down")).unionAll(edges.select(F.col("v").alias("id"), F.lit(0).alias("down")))
    return ends.groupBy("id").agg(F.sum("down").alias("down"), F.min("down").alias("root")).where("down > 1 or down = 1 and root = 0").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, label) of every end of ``edges`` (a, b: bigint): the smallest id that links reach.

    Alternating stars: every vertex hangs its larger neighbours, then its smaller ones, on the least
    vertex it sees, until every vertex hangs on a smallest one. A vertex with very many neighbours is a hot key only in a
    minimum that is combined before the shuffle and in a join that Spark can split. Empty in, empty out;
    self-links, repeated and reversed links do no harm; links with a null end are passed over.
    """
    now = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while not stars(now):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = scratch.keep(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star"
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.keep(hung.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "star")
        scratch.drop(now, large)
        now = after
    return scratch.keep(
        now.select(F.col("u").alias("id"), F.col("v").alias("label")).unionAll(
            now.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
        ),
        "labels",
    )


def together(parts: list[DataFrame]) -> list[DataFrame]:
    """The tables in their order, several as one until they have ``AT_ONCE`` rows."""
    groups, held = [], AT_ONCE
    for part in parts:
        if held >= AT_ONCE:
            groups.append(part)
            held = 0
        else:
            groups[-1] = groups[-1].unionAll(part)
        held += part.count()
    return groups


def linked(
    postings: DataFrame | list[DataFrame],
    carried: list[str],
    fits: Callable[[str, str], Column],
    verify: Callable[[DataFrame], DataFrame],
    scratch: Scratch,
    details: DataFrame | None = None,
    close: Callable[[str, str], Column] | None = None,
    once: bool = True,
    sources: tuple[DataFrame, ...] = (),
    passes: int = 1,
    split: Callable[[DataFrame], DataFrame] | None = None,
    last: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, label) for the components of the graph that links ids with a common key if ``verify`` confirms them.

    ``postings`` holds (key, id, *carried); ``fits`` is a necessary condition on two rows' carried columns, given
    the prefixes of their names; ``verify`` takes candidates (a, b) and returns those that are links.
    ``details`` (id, more columns) and ``close``, another condition that also sees them, keep pairs of the last step from
    becoming rows; it need hold only at the least key of both. With ``once`` off a pair is met at every common key, for ``fits``
    that may hold at some of them only. ``sources`` are tables of ``scratch`` that only ``postings`` read; they are dropped as soon as the ids have met.
    The ids meet in so many ``passes``, each over a part of the keys, so that the first shuffle, the widest, takes less disk at once.
    Postings may also come as a list, each with all rows of its keys; then the sources go one by one with the postings of their place.
    ``split`` names, in the columns ``RUNS`` it adds, parts of a key across which no two rows fit; it may leave out rows that fit no other. Ids meet within these parts only.
    ``last`` returns the links among the rows (key, id, *carried, label) of the last step, for operators that meet and test pairs in one task,
    without a row for each; ``details``, ``close`` and ``once`` are not used then.
    Ids without a link are left out.

    Emitting all pairs of a key is quadratic where thousands of near copies share it. So the ids of a key are
    first tested against one centre only (of the centres an id meets, the one it shares most keys with). Then, in rounds, each key takes
    another centre by hash, and an id is tested against up to ``TESTS`` centres of other components, until a round finds few links or ``ROUNDS``
    are done: at most ``TESTS`` pairs an id and round. After that only ids of one key that are in different components so far are paired, each pair at
    one key: every link not yet implied is still tested, so no component is missed.
    Rounds and last step take the parts of the keys one after the other, ``AT_ONCE`` rows or more at a time, so that their shuffles take less disk at once.
    """
    extra = [F.col(c) for c in carried]

    def centred(rows: DataFrame, group: str, order: Column, key: list[str] = ["key"]) -> DataFrame:
        """Each row with the centre of its key, the least by ``order``, for keys whose rows differ in ``group``."""
        # With the centre's own order first in the struct, its least is the centre. A window, not an aggregate that is joined: most keys
        # are of one row, so the aggregate sent every row a second time, and wider.
        own = Window.partitionBy(*key)
        centre = F.min(F.struct(order.alias("__order"), "id", *extra)).over(own)
        every = rows.where("key is not null").select("*", F.min(group).over(own).alias("__lo"), F.max(group).over(own).alias("__hi"), centre.alias("__c"))
        return every.where("__lo <> __hi").drop("__lo", "__hi").withColumn("__c", F.col("__c").dropFields("__order"))

    def common(rows: DataFrame, differs: Column) -> DataFrame:
        """(id, centre, n): how many keys an id has in common with a centre."""
        pair = rows.select("*", F.col("__c.id").alias("centre"), *[F.col(f"__c.{c}").alias(f"centre_{c}") for c in carried])
        return pair.where(differs & fits("", "centre_")).groupBy("id", "centre").agg(F.count(F.lit(1)).alias("n"))

    def best(shared: DataFrame, most: int) -> DataFrame:
        if most == 1:
            one = shared.groupBy("id").agg(F.max_by("centre", F.struct("n", -F.col("centre"))).alias("b"))
            return one.select(F.col("id").alias("a"), "b")
        # An id meets no more centres than it has keys.
        some = shared.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "centre")), False), 1, most).alias("some"))
        return some.select(F.col("id").alias("a"), F.explode("some.centre").alias("b"))

    def meeting(rows: DataFrame) -> DataFrame:
        if split is None:
            return centred(rows, "id", F.col("id"))
        found = centred(split(rows.where("key is not null")), "id", F.col("id"), ["key", *RUNS])
        return found.withColumn("key", F.xxhash64("key", *RUNS)).drop(*RUNS)

    if isinstance(postings, list):
        parts, last_read = postings, [[source] for source in sources]
    else:
        parts = [postings.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == k) for k in range(passes)] if passes > 1 else [postings]
        last_read = [[]] * (passes - 1) + [list(sources)]
    made = []
    for part, read_here in zip(parts, last_read, strict=True):
        made.append(scratch.keep(meeting(part), "met"))
        scratch.drop(*read_here)
    parts, met = made, reduce(DataFrame.unionAll, made)
    tested = scratch.keep(best(common(met, F.col("id") != F.col("__c.id")), 1), "pairs")
    labels = components(scratch.keep(verify(tested), "links"), scratch)

    def joined(more: DataFrame) -> DataFrame:
        """Labels after more links; what is known hangs on its label already."""
        return components(labels.select(F.col("id").alias("a"), F.col("label").alias("b")).unionAll(more), scratch)

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))

    rest, plain = [group.drop("__c") for group in together(parts)], carried
    carried = [*carried, "label"]
    extra.append(F.col("label"))
    for turn in range(ROUNDS):
        open_rows = [centred(labelled(part), "label", F.xxhash64("id", "key", F.lit(turn))) for part in rest]
        shared = [common(rows, F.col("label") != F.col("__c.label")) for rows in open_rows]
        if len(shared) > 1:
            shared = [scratch.keep(counts, "common") for counts in shared]
            every = reduce(DataFrame.unionAll, shared).groupBy("id", "centre").agg(F.sum("n").alias("n"))
        else:
            every = shared[0]
        pairs = scratch.keep(best(every, TESTS), "pairs")
        scratch.drop(*shared)
        more = scratch.keep(verify(pairs), "links")
        tested = tested.unionAll(pairs)
        labels = joined(more)
        if more.count() * 20 < pairs.count():
            break

    # What is left: rows of a key in different components. Not paired again: pairs already tested.
    carried = plain + ["label"]
    own = Window.partitionBy("key")
    ends = [F.min("label").over(own).alias("__lo"), F.max("label").over(own).alias("__hi")]
    left = [scratch.keep(labelled(part).select("*", *ends).where("__lo <> __hi").drop("__lo", "__hi"), "left") for part in rest]
    rows = differing = scratch.union(left)
    scratch.drop(*parts)
    if last is not None:
        found = scratch.keep(last(differing), "links")
        scratch.drop(differing)
        return joined(found)
    one_key = F.lit(True)
    if once:
        # All keys that ids of different components share are among these, so a pair is met at the least of them only.
        held = rows.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("__keys"))
        held = held.withColumn("__keys", F.when(F.size("__keys") <= MOST_KEYS, F.col("__keys")))
        details = held if details is None else held.join(details, "id")
        one_key = F.coalesce(F.array_min(F.array_intersect("a___keys", "b___keys")) == F.col("a_key"), F.lit(True))
    if details is not None:
        rows = rows.join(details, "id")
        carried = [*carried, *[c for c in details.columns if c != "id"]]
    rows = scratch.keep(rows, "rest")
    scratch.drop(differing)
    condition = fits("a_", "b_") & (close("a_", "b_") if close else F.lit(True)) & one_key
    left = rows.select(F.col("key").alias("a_key"), *[F.col(c).alias(f"a_{c}") for c in ["id", *carried]])
    right = rows.select(F.col("key").alias("b_key"), *[F.col(c).alias(f"b_{c}") for c in ["id", *carried]])
    pairs = (
        left.join(right, (F.col("a_key") == F.col("b_key")) & (F.col("a_label") < F.col("b_label")) & condition)
        .select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
        .distinct()
    )
    done = tested.unionAll(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = scratch.keep(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
    result = joined(scratch.keep(verify(pairs), "links"))
    scratch.drop(rows, pairs)
    return result
