"""Mixing sources to target weights with pivotal dependent rounding.

Every source gets a target number of words, and each of its documents the same fractional number of copies, target
divided by source size. The whole part is certain; the fractional parts are rounded in pairs: one document of a pair
takes copies from the other, in proportion to their words, until one of the two is whole. Which way is drawn such that every
document keeps its expected copies, and the words of a pair never change. So the words taken of a source differ from its target by
the last document's at most.

The documents of a source are dealt by a hash to groups of about ``GROUP``. Each group leaves at most one document with a
fraction; these residuals meet in groups of groups, ``FAN`` at a time, until one remains for a source. Draws depend on
seed, source, level and group alone, so that runs agree.

Defined results: null or empty text has size 0 and takes nothing. A null source is a source of its own, last in order. Rows
equal in doc_id, source, size and text hash are one document that stands several times. Of its ``times`` rows, the whole part of
``times * x`` take one copy more for certain, and one row's leftover fraction is rounded, so that a repeated row weighs as one of its rows. Null
ids count as equal.
If all sizes are 0, all targets are 0. An empty table gives an empty result. Only doc_id, text and source are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_row_number
from .tables import Scratch, read

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SHARE = 1.5  # of all words
MOST = 2.0  # copies
GROUP = 4096
FAN = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, documents, target. Sources at their limit keep it; the rest is shared by weight again until none is above."""
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count(F.lit(1)).alias("documents"))
    place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    sources = with_row_number(totals, [F.col("source").asc_nulls_last()], "n")
    sources = scratch.keep(sources.withColumn("weight", place).drop("n"), "sources")
    wanted = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    rate, limit = None, F.col("source_size") * most
    while True:
        # One row per pass; a source once at its limit stays there, because the rate only grows.
        full = F.lit(False) if rate is None else F.col("weight") * rate >= limit
        fixed, weight = sources.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        after = (wanted - (fixed or 0)) / weight if weight else rate
        if after is None or after == rate:
            break
        rate = after
    target = F.least(F.col("weight") * F.lit(rate or 0.0), limit)
    return sources.select("source", "source_size", "documents", target.alias("target"))


def rounded(fractions: np.ndarray, words: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, int]:
    """Fractions after pairwise rounding, and the place of the one that is still a fraction, or -1."""
    x, v = fractions.tolist(), words.tolist()
    draws = random.random(len(x)).tolist()
    held = -1
    for k in range(len(x)):
        if not 0.0 < x[k] < 1.0:
            continue
        if held < 0:
            held = k
            continue
        give, take = min((1 - x[held]) * v[held], x[k] * v[k]), min(x[held] * v[held], (1 - x[k]) * v[k])
        if draws[k] * (give + take) < take:  # held gains `give` words of k
            whole_held, whole_k = (1 - x[held]) * v[held] <= give, x[k] * v[k] <= give
            x[held], x[k] = 1.0 if whole_held else x[held] + give / v[held], 0.0 if whole_k else x[k] - give / v[k]
        else:  # k gains `take` words of held
            whole_held, whole_k = x[held] * v[held] <= take, (1 - x[k]) * v[k] <= take
            x[held], x[k] = 0.0 if whole_held else x[held] - take / v[held], 1.0 if whole_k else x[k] + take / v[k]
        if 0.0 < x[k] < 1.0:
            held = k
        elif not 0.0 < x[held] < 1.0:
            held = -1
    return np.array(x), held


def mixed(docs: DataFrame, seed: int = 0, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, source, size, print (text hash), times (equal rows), source_size, target, copies of every different document.

    Where some of equal rows take one copy more than the others, there is a row for either.
    """
    scratch = Scratch(docs.sparkSession)
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("print"))
    sizes = scratch.keep(sizes.groupBy("doc_id", "source", "size", "print").agg(F.count(F.lit(1)).alias("times")), "sizes")
    by_source = scratch.keep(targets(sizes, scratch, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    groups = F.ceil(F.col("documents") / GROUP)
    known = by_source.withColumnRenamed("source", "of")
    more = F.when(F.col("size") > 0, F.col("times") * (rate - F.floor(rate))).otherwise(0.0)  # rows with one copy more
    units = sizes.join(known, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "print", "times", "source_size", "target", F.floor(rate).cast("bigint").alias("base"),
        F.floor(more).cast("bigint").alias("sure"), (more - F.floor(more)).alias("x"),
        F.pmod(F.xxhash64("doc_id", "size", "print"), groups).cast("bigint").alias("part"),
    )
    levels, count = 1, by_source.agg(F.max(groups)).first()[0] or 1
    while count > 1:
        levels, count = levels + 1, -(-count // FAN)

    def reduce(level: int):
        def one(group: pa.Table) -> pa.Table:
            # Long documents first, so that a residual tends to be short.
            group = group.take(pc.sort_indices(group, [("size", "descending"), ("doc_id", "ascending"), ("print", "ascending"), ("times", "ascending")]))
            part = group["part"][0].as_py()
            random = np.random.default_rng(xxhash.xxh3_64_intdigest(f"{seed} {level} {part} {group['source'][0].as_py()!r}"))
            x, held = rounded(group["x"].to_numpy(), group["size"].to_numpy(), random)
            if held >= 0 and level == levels - 1:
                x[held] = float(random.random() < x[held])
            names = group.column_names
            group = group.set_column(names.index("x"), "x", pa.array(x))
            return group.set_column(names.index("part"), "part", pa.array([part // FAN] * len(x), pa.int64()))

        return one

    settled, left = [], units
    for level in range(levels):
        done = scratch.keep(left.groupBy("source", "part").applyInArrow(reduce(level), units.schema), "rounded")
        fraction = (F.col("x") > 0) & (F.col("x") < 1)
        settled.append(done.where(~fraction))
        left = done.where(fraction)
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionAll(more)
    raised = F.col("sure") + F.col("x").cast("bigint")
    both = F.array(
        F.struct((F.col("times") - raised).alias("times"), F.col("base").alias("copies")),
        F.struct(raised.alias("times"), (F.col("base") + 1).alias("copies")),
    )
    rows = rows.withColumn("taken", F.explode(F.filter(both, lambda z: z["times"] > 0)))
    return rows.select("doc_id", "source", "size", "print", "taken.times", "source_size", "target", "taken.copies")


def repeated(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    ids = ["doc_id", "source", "size", "print"]
    names = ["__id", "__source", "__words", "__print"]
    taken = mix.groupBy(*ids).agg(
        F.min("copies").alias("__low"), F.max("copies").alias("__high"), F.min_by("times", F.col("copies")).alias("__lower")
    ).withColumnsRenamed(dict(zip(ids, names)))
    own = docs.withColumns({"__size": word_count(F.col("text")), "__own": F.xxhash64("text")})
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__size") == F.col("__words")) & (F.col("__own") == F.col("__print"))
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def copied(rows: DataFrame, copies: Column) -> DataFrame:
        many = rows.withColumn("__copies", copies.cast("int")).where("__copies > 0")
        return many.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).drop("__copy")

    alike = copied(own.join(taken.where("__high > 0 and __low = __high"), same), F.col("__low"))
    parted = taken.where("__low < __high")
    if parted.isEmpty():
        return alike
    # Of equal rows, the first by number take the lower count. A global order, so that no task has all rows of one document.
    rows = own.join(parted, same)
    spread = [F.col(c).asc_nulls_last() for c in names] + [F.xxhash64(*columns)]
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(with_row_number(rows, spread, "__n"), "numbered")
    least = rows.groupBy(*names).agg(F.min("__n").alias("__least")).toDF(*[f"{c}_of" for c in names], "__least")
    equal = F.lit(True)
    for c in names:
        equal = equal & F.col(c).eqNullSafe(F.col(f"{c}_of"))
    rows = rows.join(least, equal)
    return alike.unionByName(copied(rows, F.when(F.col("__n") - F.col("__least") < F.col("__lower"), F.col("__low")).otherwise(F.col("__high"))))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document, one row for each row of the table."""
    rows = mixed(read(spark, sf_dir, "documents")).withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
