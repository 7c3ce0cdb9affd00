"""Whitening of vectors by a covariance in which equal vectors are held once, with a weight.

Vectors are brought to whole numbers and equal ones are grouped before anything is multiplied. The fit weighs a distinct vector
by one or by how often it stands (``weights``). Sums per dimension are exact whole numbers; the covariance is a matrix product of
centred vectors, added up in each task and then once for each row of the matrix. Its principal axes, a problem of the dimension's
size, are found on the driver. Every distinct vector is whitened once and joined back to its rows, so a vector that a third of all
rows hold costs one projection; the join reads narrow rows, which Spark splits where a key is hot.

What passes through the driver: sums and one matrix of the dimension's size.

Defined results: rows whose vector is null, empty, of another length than most valid rows (a tie: the longer), or holds null or
non-finite entries are left out. A null vec_id and repeated rows stay. Entries are held within +-2**53 / ``SCALE``. Axes whose
eigenvalue is zero to double precision are left out, so a table of one distinct vector, like an empty one, gives an empty result.
A deviation beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Scratch, read

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
_LIMIT = float(1 << 53)


class Fit(NamedTuple):
    n: int  # weight of the fit list
    sums: list[int]  # of each dimension, exact
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # dimension x components
    trace: float


def whole_vectors(vectors: DataFrame, ident: str, column: str) -> DataFrame:
    """(ident, k1, k2, x) for the rows that take part: x in whole numbers, and two hashes that name it."""
    finite = F.forall("__v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    valid = vectors.select(F.col(ident).alias("__ident"), F.col(column).alias("__v")).where((F.size("__v") > 0) & finite)
    lengths = valid.groupBy(F.size("__v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    valid = valid.where(F.size("__v") == (lengths[0]["n"] if lengths else 0))
    held = F.transform("__v", lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-_LIMIT)), F.lit(_LIMIT))) + OFFSET)
    x = valid.select(F.col("__ident").alias("ident"), held.alias("x"))
    return x.select("ident", F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), "x").alias("k2"), "x")


def _matrix(batch: pa.RecordBatch, column: str, kind) -> np.ndarray:
    lists = batch[column]
    return np.asarray(lists.flatten(), kind).reshape(len(lists), -1)


def whole_sums(distinct: DataFrame) -> tuple[int, list[int]]:
    """The weight of all rows, and the exact weighted sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x, w = _matrix(batch, "x", np.int64), batch["w"].to_numpy()
            if not len(w):
                continue
            fits = float(np.abs(x).max()) * float(w.sum()) < 2.0**62
            total = (x * w[:, None]).sum(axis=0) if fits else (x.astype(object) * w[:, None]).sum(axis=0)
            values = [int(w.sum()), *map(int, total)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array([str(v) for v in values])], ["i", "s"])

    rows = distinct.select("x", "w").mapInArrow(add, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = [int(row.s) for row in sorted(rows)]
    return (sums[0], sums[1:]) if sums else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n: the whole part exactly, then the rest."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def weighted_mean(rows: DataFrame, column: str, n: int) -> np.ndarray:
    """Mean of arrays of doubles."""

    def add(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            if len(batch):
                part = batch["w"].to_numpy() @ _matrix(batch, column, np.float64)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "s"])

    found = rows.select(column, "w").mapInArrow(add, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return np.array([row.s for row in sorted(found)]) / n


def covariance(rows: DataFrame, column: str, n: int, centre) -> np.ndarray:
    """Weighted covariance of ``centre(batch)``, with divisor n: one product in each batch, one sum for each row of the matrix."""

    def multiply(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            if len(batch):
                c = centre(batch)
                part = (c * batch["w"].to_numpy()[:, None]).T @ c
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total))], ["i", "row"])

    def summed(table: pa.Table) -> pa.Table:
        rows = np.stack(table["row"].to_pylist()).sum(axis=0)
        return pa.table({"i": table["i"][:1], "row": pa.array([rows], pa.list_(pa.float64()))})

    parts = rows.select(column, "w").mapInArrow(multiply, "i int, row array<double>")
    found = parts.groupBy("i").applyInArrow(summed, "i int, row array<double>").collect()
    return np.array([row.row for row in sorted(found)]) / n


def fitted(distinct: DataFrame, components: int) -> Fit | None:
    """Principal axes of the distinct vectors (x, w); None without any axis."""
    n, sums = whole_sums(distinct)
    if not n:
        return None
    v = covariance(distinct, "x", n, lambda batch: centred(_matrix(batch, "x", np.int64), n, sums))
    values, axes = np.linalg.eigh((v + v.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    kept = int((values[:components] > len(values) * np.finfo(float).eps * max(values[0], 0.0)).sum())
    return Fit(n, sums, values[:kept], axes[:, :kept], float(np.trace(v))) if kept else None


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - sums)**2, exact; None beyond a long."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    d = x - whole
    if x.shape[1] * (float(n) * (float(np.abs(d).max()) + 1)) ** 2 < 2.0**63:
        return ((n * d - rest) ** 2).sum(axis=1).tolist()
    exact = ((d.astype(object) * n - rest.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whitened(vectors: DataFrame, ident: str = "vec_id", column: str = "embedding", weights: str = "one", components: int = COMPONENTS) -> DataFrame:
    """ident, component, n, deviation, whitened, explained, identity_error of every row that takes part and every component.

    ``weights``: "one" holds each distinct vector once in the fit, "counts" as often as it stands.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = whole_vectors(vectors, ident, column)
    weight = F.lit(1).cast("bigint") if weights == "one" else F.count(F.lit(1))
    distinct = scratch.keep(rows.groupBy("k1", "k2").agg(F.first("x").alias("x"), weight.alias("w")), "distinct")
    fit = fitted(distinct, components)
    kind = dict(vectors.dtypes)[ident]
    if fit is None:
        empty = f"{ident} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], empty)
    axes = fit.axes / np.sqrt(fit.values)

    def project(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if len(batch):
                x = _matrix(batch, "x", np.int64)
                out = centred(x, fit.n, fit.sums) @ axes
                columns = [batch["k1"], batch["k2"], batch["w"], pa.array(deviations(x, fit.n, fit.sums), pa.int64()), pa.array(list(out), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "w", "deviation", "y"])

    once = scratch.keep(distinct.mapInArrow(project, "k1 bigint, k2 bigint, w bigint, deviation bigint, y array<double>"), "whitened")
    mean = weighted_mean(once, "y", fit.n)
    identity = covariance(once, "y", fit.n, lambda batch: _matrix(batch, "y", np.float64) - mean)
    error = float(np.abs(identity - np.eye(len(identity))).max())
    scratch.drop(distinct)
    shares = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
    joined = rows.select("ident", "k1", "k2").join(once.drop("w"), ["k1", "k2"])
    long = joined.select("ident", "deviation", F.posexplode("y").alias("at", "whitened"))
    return long.select(
        F.col("ident").alias(ident), (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 16 whitened components of every embedding; the fit holds each distinct vector once."""
    return whitened(read(spark, sf_dir, "embeddings"))
