"""A table in months, some of which are replaced at once.

A month is written beside the old one and never over it. A pointer, one small file, names the folder of each month; the newest readable pointer is the
table. So readers that have begun end with the rows they began with, and a job that dies leaves the old table (a load that no pointer names, or a pointer
that does not parse, is passed over). Two writers that start from the same pointer want the same file name: the second one fails and
changes nothing. `vacuum` deletes what no kept pointer names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import CODEC, _filesystem, delete, shuffles_go

MONTH = "sales_month"
_LOAD = "__load"


class ChangedMeanwhile(RuntimeError):
    """Another writer published first."""


class Pointer(NamedTuple):
    number: int
    months: dict[int, str]  # folder of each month
    schema: dict  # of the rows, without the month
    high: int | None  # greatest surrogate key ever given out


def _pointers(spark: SparkSession, base: str) -> list[int]:
    fs, pattern = _filesystem(spark, f"{base}/pointers/*.json")
    return sorted(int(found.getPath().getName().removesuffix(".json")) for found in fs.globStatus(pattern) or [])


def _name(base: str, number: int) -> str:
    return f"{base}/pointers/{number:010d}.json"


def _read_pointer(spark: SparkSession, base: str, number: int) -> Pointer | None:
    """A pointer, or None where its writer died half way."""
    fs, path = _filesystem(spark, _name(base, number))
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Pointer(number, {int(m): load for m, load in found["months"].items()}, found["schema"], found["high"])


def pointer(spark: SparkSession, base: str) -> Pointer | None:
    """The newest pointer that was written to its end."""
    found = (_read_pointer(spark, base, number) for number in reversed(_pointers(spark, base)))
    return next((p for p in found if p), None)


def _point(spark: SparkSession, base: str, new: Pointer) -> None:
    fs, path = _filesystem(spark, _name(base, new.number))
    if fs.exists(path):
        raise ChangedMeanwhile(f"pointer {new.number} of {base} is there already")
    try:
        stream = fs.create(path, False)
    except Exception as e:  # the other writer came between
        raise ChangedMeanwhile(f"pointer {new.number} of {base} is there already") from e
    stream.write(bytearray(json.dumps(new._replace(months={str(m): x for m, x in new.months.items()})._asdict()).encode()))
    stream.close()


def publish(rows: DataFrame, base: str, months: Sequence[int] | None = None, surrogate: str | None = None, based_on: Pointer | None = None) -> Pointer:
    """Make ``rows`` (with their month) the content of ``months``, or of the whole table; a month without rows is empty afterwards.

    ``based_on`` is the pointer that ``rows`` were computed from, by default the newest; where another has been published since, nothing changes.
    """
    spark = rows.sparkSession
    old = based_on or pointer(spark, base)
    load = uuid.uuid4().hex[:12]
    seen = Observation()
    high = F.max(surrogate) if surrogate else F.lit(None).cast("bigint")
    observed = rows.observe(seen, high.alias("high"), F.count(F.lit(1)).alias("rows"))
    path = f"{base}/data/{_LOAD}={load}"
    with shuffles_go(spark):
        observed.write.option("compression", CODEC).partitionBy(MONTH).parquet(path)
    fs, pattern = _filesystem(spark, f"{path}/{MONTH}=*")
    written = {int(found.getPath().getName().split("=")[1]) for found in fs.globStatus(pattern) or []}
    if months is not None and not written <= set(months):
        raise ValueError(f"rows of months {sorted(written - set(months))} that are not to be replaced")
    kept = {} if months is None or old is None else {m: x for m, x in old.months.items() if m not in set(months)}
    schema = T.StructType([f for f in rows.schema.fields if f.name != MONTH])
    highs = [h for h in (old.high if old else None, seen.get["high"]) if h is not None]
    now = pointer(spark, base)
    if (now.number if now else 0) != (old.number if old else 0):
        raise ChangedMeanwhile(f"{base} has changed since pointer {old.number if old else 0}")
    number = max(_pointers(spark, base), default=0) + 1  # beyond pointers whose writer died, too
    new = Pointer(number, kept | dict.fromkeys(written, load), schema.jsonValue(), max(highs, default=None))
    _point(spark, base, new)
    return new


def read(spark: SparkSession, base: str, first: int | None = None, last: int | None = None, at: Pointer | None = None) -> DataFrame:
    """The table with its month, or months ``first``..``last`` of it, as the newest pointer (or ``at``) names it."""
    now = at or pointer(spark, base)
    if now is None:
        raise FileNotFoundError(f"no published table at {base}")
    schema = T.StructType.fromJson(now.schema)
    paths = [f"{base}/data/{_LOAD}={x}/{MONTH}={m}" for m, x in sorted(now.months.items()) if (first is None or m >= first) and (last is None or m <= last)]
    whole = T.StructType([*schema.fields, T.StructField(_LOAD, T.StringType()), T.StructField(MONTH, T.IntegerType())])
    if not paths:
        return spark.createDataFrame([], whole).drop(_LOAD)
    return spark.read.schema(whole).option("basePath", f"{base}/data").parquet(*paths).drop(_LOAD)


def vacuum(spark: SparkSession, base: str, keep: int = 1) -> None:
    """Delete pointers but the newest ``keep``, and loads that none of these names. Call it when no reader of an older one is at work."""
    newest = pointer(spark, base)
    numbers = [n for n in _pointers(spark, base) if newest is None or n <= newest.number]
    kept = [p for p in (_read_pointer(spark, base, n) for n in numbers[-keep:]) if p]
    held = {load for p in kept for load in p.months.values()}
    fs, pattern = _filesystem(spark, f"{base}/data/{_LOAD}=*")
    for found in fs.globStatus(pattern) or []:
        if found.getPath().getName().split("=")[1] not in held:
            fs.delete(found.getPath(), True)
    for number in numbers[:-keep]:
        delete(spark, _name(base, number))
