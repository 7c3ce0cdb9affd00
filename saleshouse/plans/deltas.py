"""Summaries that are kept current by what was added and removed, without the history.

A state holds, for each group, sums that rows can be added to and taken from (``totals``), and for each column whose different values or extremes a summary needs, how
many rows hold each value (``support``). A value goes when its last row goes, so distinct counts, first and last days follow from the
state alone. A change is the state of the rows added, less that of the rows removed: an updated row is both. States add up in any order.

Only groups that a change touches are merged and summarised again; the others' rows pass through. A small change is broadcast by Spark, and then
nothing of the state is shuffled but the touched groups. Removing rows that were never added raises an error when the state is read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

WEIGHT = "__weight"


class Kept(NamedTuple):
    """What a state holds: the group, columns to sum, and columns whose values are counted."""

    group: str
    sums: tuple[str, ...]
    values: tuple[str, ...]


class State(NamedTuple):
    totals: DataFrame  # group, rows, and for each sum its total and how many rows are not null
    support: DataFrame  # group, what (name of the column), value (as text), rows


def signed(added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
    """Added and removed rows with their weight."""
    parts = [rows.withColumn(WEIGHT, F.lit(weight)) for rows, weight in ((added, 1), (removed, -1)) if rows is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def state_of(rows: DataFrame, kept: Kept) -> State:
    """The state of rows, or of a change (rows with a weight). Rows without a group are left out."""
    weighted = rows.where(F.col(kept.group).isNotNull())
    if WEIGHT not in rows.columns:
        weighted = weighted.withColumn(WEIGHT, F.lit(1))
    w = F.col(WEIGHT)
    parts = [F.sum(w).alias("rows")]
    for c in kept.sums:
        parts += [F.sum(F.col(c) * w).cast(C.SUM_TYPE).alias(c), F.sum(F.when(F.col(c).isNotNull(), w).otherwise(0)).alias(f"{c}__n")]
    totals = weighted.groupBy(kept.group).agg(*parts)
    # One pass: each row gives one value for each column, counted before the shuffle.
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("string").alias("value")) for c in kept.values]))
    held = weighted.select(kept.group, WEIGHT, values.alias("held")).select(kept.group, WEIGHT, "held.*").where("value is not null")
    support = held.groupBy(kept.group, "what", "value").agg(F.sum(WEIGHT).alias("rows"))
    return State(totals, support.where("rows <> 0"))


def _added_up(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    summed = old.unionByName(new).groupBy(*keys).agg(*[F.sum(c).cast(old.schema[c].dataType).alias(c) for c in old.columns if c not in keys])
    checked = F.when(F.col("rows") < 0, F.raise_error(F.lit("rows were removed that the state does not hold")).cast("boolean")).otherwise(F.col("rows") > 0)
    return summed.where(checked).select(*old.columns)


def merged(state: State, change: State, kept: Kept) -> tuple[State, State]:
    """The state after a change, and the part of it that belongs to touched groups."""
    touched = change.totals.select(kept.group).distinct()
    keys = {"totals": [kept.group], "support": [kept.group, "what", "value"]}
    parts, whole = {}, {}
    for name in State._fields:
        old, new = getattr(state, name), getattr(change, name)
        parts[name] = _added_up(old.join(touched, kept.group, "left_semi"), new, keys[name])
        whole[name] = old.join(touched, kept.group, "left_anti").unionByName(parts[name])
    return State(**whole), State(**parts)


def figures(state: State, kept: Kept) -> DataFrame:
    """One row a group: the totals, and for each counted column ``<column>__values`` (different ones), ``__first`` and ``__last`` (as text)."""
    held = []
    for c in kept.values:
        mine = F.col("what") == c
        held += [F.count_if(mine).alias(f"{c}__values"), F.min(F.when(mine, F.col("value"))).alias(f"{c}__first"), F.max(F.when(mine, F.col("value"))).alias(f"{c}__last")]
    return state.totals.join(state.support.groupBy(kept.group).agg(*held), kept.group)


def refreshed(summary: DataFrame, part: State, change: State, kept: Kept, shape: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A summary after a change: rows of untouched groups as they are, those of touched ones from ``shape(figures)``."""
    touched = change.totals.select(kept.group).distinct()
    return summary.join(touched, kept.group, "left_anti").unionByName(shape(figures(part, kept)).select(*summary.columns))


def mean_of(column: str, digits: int) -> Column:
    """The mean of a sum's column, rounded half up."""
    return C.ratio(F.col(column), F.col(f"{column}__n"), digits)
