"""Type 2 dimensions: versions with a half-open validity interval [_effective_from, _effective_to).

An interval closed at both ends would match two versions on the day of a change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_row_number
from .storage import materialize

FROM, TO, CURRENT = "_effective_from", "_effective_to", "_is_current"


def current(dim: DataFrame) -> DataFrame:
    return dim.where(CURRENT)


def covers(moment: Column) -> Column:
    """Condition: the version is valid at ``moment``."""
    return (F.col(FROM) <= moment) & (F.col(TO).isNull() | (moment < F.col(TO)))


def as_of(dim: DataFrame, moment: Column) -> DataFrame:
    return dim.where(covers(moment))


def history(dim: DataFrame, key: str, value: object) -> DataFrame:
    return dim.where(F.col(key) == value).orderBy(FROM)


def observations(rows: DataFrame, key: str, at: str, tracked: Sequence[str]) -> DataFrame:
    """(key, day, at, state): the latest state seen on each day, all that versions depend on.

    Combined before the shuffle, so however many rows a key has, one row per day is left. Rows without a time are left out.
    """
    seen = F.max(F.struct(F.col(at).alias("at"), F.struct(*tracked).alias("state"))).alias("last")
    return rows.where(F.col(at).isNotNull()).groupBy(key, F.to_date(at).alias("day")).agg(seen).select(key, "day", "last.*")


def more_observations(held: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Observations of both: in whatever order deliveries come, the result is the same."""
    last = F.max(F.struct("at", "state")).alias("last")
    return held.unionByName(new).groupBy(key, "day").agg(last).select(key, "day", "last.*")


def versions(observed: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """All versions of observed keys: a new version starts on each day a tracked column changes. The windows see one row per day and key."""
    timeline = Window.partitionBy(key).orderBy("day")
    previous = F.lag("state").over(timeline)
    starts = observed.withColumn("previous", previous).where(
        F.col("previous").isNull() | ~F.col("previous").eqNullSafe(F.col("state"))
    )
    until = F.lead("day").over(timeline)
    return starts.select(
        key,
        *(F.col(f"state.{c}").alias(c) for c in tracked),
        F.col("day").cast("timestamp_ntz").alias(FROM),
        until.cast("timestamp_ntz").alias(TO),
        until.isNull().alias(CURRENT),
    )


def build(rows: DataFrame, key: str, at: str, tracked: Sequence[str]) -> DataFrame:
    """All versions from a full history."""
    return versions(observations(rows, key, at, tracked), key, tracked)


def deliver(
    dim: DataFrame, held: DataFrame, rows: DataFrame, key: str, surrogate: str, at: str, tracked: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The dimension and its observations after a delivery whose rows may lie anywhere in time.

    A row before the last version splits an interval, moves its beginning, or joins two that it makes equal; a key may come several times.
    Deliveries in any order lead to the versions that `build` makes of all rows at once. Only keys that the delivery names are
    built again; the other keys' versions pass through. A version that begins where one of the key began before keeps its surrogate key
    and its columns beyond the tracked ones; others continue the surrogate keys, with columns beyond the tracked ones from the key's last version.
    `dropped` finds the surrogate keys that are no more. Rows without a key or a time are left out.
    """
    new = materialize(observations(rows.where(F.col(key).isNotNull()), key, at, tracked), "delivery")
    touched = new.select(key).distinct()
    mine = materialize(more_observations(held.join(touched, key, "left_semi"), new, key), "observed")
    observed = held.join(touched, key, "left_anti").unionByName(mine)

    before = dim.join(touched, key, "left_semi")
    others = [c for c in dim.columns if c not in (key, surrogate, FROM, TO, CURRENT, *tracked)]
    ids = before.groupBy(key, FROM).agg(F.min(F.struct(F.col(surrogate).alias("id"), *others)).alias("old"))
    carried = before.groupBy(key).agg(F.max_by(F.struct(F.lit(1), *others), F.struct(FROM, surrogate)).alias("carried"))
    rebuilt = versions(mine, key, tracked).join(ids, [key, FROM], "left").join(carried, key, "left")
    filled = rebuilt.select(
        key, *tracked, FROM, TO, CURRENT, F.col("old.id").alias(surrogate),
        *[F.when(F.col("old").isNotNull(), F.col(f"old.{c}")).otherwise(F.col(f"carried.{c}")).cast(dim.schema[c].dataType).alias(c) for c in others],
    )
    filled = materialize(filled, "versions")
    last_key = dim.agg(F.coalesce(F.max(surrogate), F.lit(0).cast("bigint"))).scalar()
    fresh = with_row_number(filled.where(F.col(surrogate).isNull()), [F.col(key), F.col(FROM)], "__n")
    added = fresh.withColumn(surrogate, (last_key + F.col("__n")).cast(dim.schema[surrogate].dataType))
    kept = dim.join(touched, key, "left_anti").select(*dim.columns)
    for part in (filled.where(F.col(surrogate).isNotNull()), added):
        kept = kept.unionByName(part.select(*dim.columns))
    return kept, observed


def dropped(before: DataFrame, after: DataFrame, surrogate: str) -> DataFrame:
    """Versions of ``before`` whose surrogate key ``after`` does not have: facts that name them need another."""
    return before.join(after.select(surrogate), surrogate, "left_anti")


def detect_changes(new: DataFrame, dim: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that differ from the current version, or whose key is unknown.

    Null-safe, where ``NOT IN`` would return nothing as soon as one NULL is present.
    """
    now = current(dim).select(key, *tracked).alias("now")
    same = F.col(f"new.{key}").eqNullSafe(F.col(f"now.{key}"))
    for column in tracked:
        same = same & F.col(f"new.{column}").eqNullSafe(F.col(f"now.{column}"))
    return new.alias("new").join(now, same, "left_anti")


def detect_price_moves(
    new: DataFrame, dim: DataFrame, key: str, price: str = "unit_price", threshold: str = "0.10", also: Sequence[str] = ()
) -> DataFrame:
    """Keys whose price moved by more than ``threshold``, or one of the ``also`` columns changed."""
    now = current(dim).select(key, F.col(price).alias("old_price"), *(F.col(c).alias(f"old_{c}") for c in also))
    # |n - o| > t·o instead of a quotient: exact at the threshold, and safe for a zero price.
    limit = F.abs("old_price") * F.lit(threshold).cast("decimal(6,4)")
    changed = F.abs(F.col(price) - F.col("old_price")) > limit
    for column in also:
        changed = changed | ~F.col(column).eqNullSafe(F.col(f"old_{column}"))
    return new.join(now, key).where(changed).select(key, *also, "old_price", F.col(price).alias("new_price"))


def reject_duplicates(rows: DataFrame, keys: Sequence[str]) -> None:
    repeated = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"more than one source row for key {tuple(repeated[0])[:-1]}")


def apply(dim: DataFrame, changes: DataFrame, key: str | Sequence[str], surrogate: str, at: Column) -> DataFrame:
    """The whole dimension after closing the changed versions at ``at`` and adding the new ones.

    ``changes`` holds the key and any attributes that changed; the others carry over from the
    version being closed. Unknown keys are inserted. Publish the result as a new table version.
    Where a customer may have several current versions, one a country, the key is both columns; a key that has several
    all the same gets one new version, carried over from the newest. For changes before the last version, see `deliver`.
    """
    keys = [key] if isinstance(key, str) else list(key)
    reject_duplicates(changes, keys)
    given = [c for c in changes.columns if c not in keys]
    at = at.cast("timestamp_ntz")
    touched = changes.select(*keys, F.lit(True).alias("__touched"))
    expiring = F.col(CURRENT) & F.col("__touched").isNotNull()
    kept = (
        dim.join(touched, keys, "left")
        .withColumn(TO, F.when(expiring, at).otherwise(F.col(TO)))
        .withColumn(CURRENT, F.col(CURRENT) & F.col("__touched").isNull())
        .select(*dim.columns)
    )
    carried = [c for c in dim.columns if c not in (*keys, surrogate, FROM, TO, CURRENT, *given)]
    newest = current(dim).groupBy(*keys).agg(F.max_by(F.struct(F.lit(1), *carried), surrogate).alias("__carried"))
    fresh = changes.join(newest, keys, "left").select(*changes.columns, *[F.col(f"__carried.{c}").alias(c) for c in carried])
    last_key = dim.agg(F.coalesce(F.max(surrogate), F.lit(0).cast("bigint"))).scalar()
    numbered = with_row_number(fresh, [F.col(k) for k in keys], "__n")
    added = (
        numbered.withColumn(surrogate, last_key + F.col("__n"))
        .withColumn(FROM, at)
        .withColumn(TO, F.lit(None).cast("timestamp_ntz"))
        .withColumn(CURRENT, F.lit(True))
        .select(*dim.columns)
    )
    return kept.unionByName(added)
