"""Nearest vectors by multi-index hashing over learned rotated binary codes.

A bounded sample teaches the codes: principal axes of the vectors, then ``ROTATIONS`` rotations, each started at
random and turned step by step so that the signs of the turned sample lie as near to it as they can. The signs of
all rotations are the code. A code is split into substrings of 16 bits, each indexed by value. Two codes within the
radius r = m * a + b of m substrings agree up to a bits in one of the first b + 1 substrings or up to a - 1 bits in one of
the others, so probing these values retrieves every code within the radius; codes beyond it are left out after
that, and the rest is ranked by the floats in double precision.

Inner products are turned into angles by one more component, which fills every stored vector up to the largest norm;
queries get zero there. The radius is such that it held ``HELD`` of the true neighbours in the sample. A query with
fewer than ``LEAST`` times k codes in the radius in a block takes that many nearest codes of the block.

Every query must meet every block of the index: rows are dealt to blocks of about ``BLOCK`` vectors, queries to blocks of about
``QUERIES``; each pair of blocks is a task that builds the block's index and returns k rows a query.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components
take no part, neither does a null vec_id. Of rows with one vec_id the least vector counts. Equal scores go to the smaller
vec_id. Fewer than k candidates: all of them. No valid query or an empty table: empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import Scratch, hash_share, read

SAMPLE = 4096
ROTATIONS = 4
STEPS = 20
HELD = 0.98
LEAST = 10  # times k codes of a block that are ranked by floats at least
BLOCK = 16_384
QUERIES = 2_048


class Codes(NamedTuple):
    mean: np.ndarray
    axes: np.ndarray  # dimension x bits
    norm: float  # the largest
    radius: int

    def of(self, vectors: np.ndarray, stored: bool) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        x = vectors / self.norm
        last = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1))) if stored else np.zeros(len(x))
        if not stored:
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
        bits = np.column_stack((x, last)) @ self.axes > self.mean
        return np.packbits(bits, axis=1).view(np.uint16)


def learned(sample: np.ndarray, norm: float, k: int, seed: int = 11) -> Codes:
    """Codes and radius from sample vectors."""
    x = sample / norm
    filled = np.column_stack((x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))))
    mean = filled.mean(axis=0)
    _, _, turn = np.linalg.svd(filled - mean, full_matrices=False)
    width = max(16, len(turn) // 16 * 16)  # whole substrings; axes of least spread are left out
    axes = np.zeros((filled.shape[1], width))
    axes[:, : min(width, len(turn))] = turn[:width].T
    flat = (filled - mean) @ axes
    random = np.random.default_rng(seed)
    rotations = []
    for _ in range(ROTATIONS):
        rotation = np.linalg.qr(random.standard_normal((width, width)))[0]
        for _ in range(STEPS):
            u, _, v = np.linalg.svd(np.sign(flat @ rotation).T @ flat)
            rotation = v.T @ u.T
        rotations.append(rotation)
    turned = axes @ np.hstack(rotations)
    codes = Codes(mean @ turned, turned, norm, 0)
    own, asked = codes.of(sample, True), codes.of(sample[:256], False)
    near = np.argsort(-(sample[:256] @ sample.T), axis=1, kind="stable")[:, 1 : k + 1]
    distances = np.bitwise_count(own[near] ^ asked[:, None, :]).sum(axis=2, dtype=np.int64)
    radius = int(np.quantile(distances, HELD)) if distances.size else 16 * own.shape[1]
    return codes._replace(radius=radius)


class MultiIndex:
    """Substring tables of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for part in codes.T:
            order = np.argsort(part, kind="stable")
            values, counts = np.unique(part, return_counts=True)
            self.tables.append((values, counts, order))

    def within(self, code: np.ndarray, radius: int, least: int) -> np.ndarray:
        """Rows whose code is within the radius; at least the ``least`` nearest."""
        share, rest = divmod(radius, len(self.tables))
        met = np.zeros(len(self.codes), bool)
        for k, (values, counts, order) in enumerate(self.tables):
            near = np.bitwise_count(values ^ code[k]) <= share - (k > rest)
            met[order[np.repeat(near, counts)]] = True
        rows = np.flatnonzero(met)
        rows = rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64) <= radius]
        if len(rows) < least:
            distance = np.bitwise_count(self.codes ^ code).sum(axis=1, dtype=np.int64)
            limit = np.partition(distance, least - 1)[least - 1] if len(distance) > least else np.inf
            rows = np.flatnonzero(distance <= limit)
        return rows


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """vec_id and v (double array) of the rows that take part, one for each id."""
    v = F.transform(vector, lambda x: x.cast("double"))
    found = vectors.select("vec_id", v.alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)"
    )
    length = found.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("times")).orderBy(F.desc("times"), "n").first()
    one = found.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(F.min("v").alias("v"))
    return one.where(F.size("v") == (length["n"] if length else 0))


def nearest(vectors: DataFrame, vector: str, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found of every query row."""
    spark = vectors.sparkSession
    rows = Scratch(spark).keep(usable(vectors, vector), "vectors")
    schema = "query_id bigint, vec_id bigint, score double"
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    queries = rows.where(is_query)
    # One row; the norm is taken over all rows.
    count, asked, norm = rows.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(size)).first()
    blocks, parts = max(1, -(-count // BLOCK)), max(1, -(-asked // QUERIES))
    few = rows.where(hash_share("vec_id", SAMPLE, count))
    sample = few.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    codes = spark.sparkContext.broadcast(learned(np.array([r["v"] for r in sample]), norm, k) if sample else None)

    def numbered(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(salt: str, n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    stored = rows.select("vec_id", "v", dealt("block", blocks).alias("block"), numbered(parts).alias("part"))
    searched = queries.select("vec_id", "v", numbered(blocks).alias("block"), dealt("part", parts).alias("part"))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = table["v"].combine_chunks()
        return table["vec_id"].to_numpy(), lists.flatten().to_numpy().reshape(len(lists), -1)

    def search(one: pa.Table, two: pa.Table) -> pa.Table:
        out = [], [], []
        if one.num_rows and two.num_rows:
            (ids, x), (asked_ids, q) = matrix(one), matrix(two)
            index, asked_codes = MultiIndex(codes.value.of(x, True)), codes.value.of(q, False)
            for query_id, vector_, code in zip(asked_ids.tolist(), q, asked_codes):
                found = index.within(code, codes.value.radius, LEAST * (k + 1))
                found = found[ids[found] != query_id]
                scores = (x[found] * vector_).sum(axis=1)
                best = np.lexsort((ids[found], -scores))[:k]
                out[0].extend([query_id] * len(best))
                out[1].extend(ids[found[best]].tolist())
                out[2].extend(scores[best].tolist())
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    pairs = stored.groupBy("block", "part").cogroup(searched.groupBy("block", "part")).applyInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows by inner product of every vector whose id is divisible by 20."""
    return nearest(read(spark, sf_dir, "embeddings"), "embedding", F.col("vec_id") % 20 == 0)
