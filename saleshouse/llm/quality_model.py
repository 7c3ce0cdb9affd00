"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Tokens are runs of letters and digits, and runs of signs, as they stand in the text; features are single tokens
and pairs of neighbours, hashed to ``DIMENSIONS`` weights. A pair of equal tokens is one feature for all tokens, so that
repetition of any word counts. Counts are divided by the root of the number of tokens.

Training reads at most ``TRAIN_ROWS`` labels, those with the least hash of their id; texts become feature counts where they are read. ``SHARDS`` groups of
these are trained side by side for ``EPOCHS`` passes each and their weights averaged; only these weights reach the driver.
Every text is scored whole, as one sparse dot product.

Defined results: null and empty text have no features and get the score of the bias. Labels that are null, or whose
document is missing, teach nothing; without any label every score is 0.5. Repeated rows get equal scores; a repeated label
and a row repeated with its text count once. A null doc_id is scored and not held out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import SPACES, SpanHasher, hash_share, in_fold, mix, read, text_bytes, text_chunks

DIMENSIONS = 1 << 18  # a power of two
TRAIN_ROWS = 16_000
SHARDS = 8
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 1.0

_KIND = np.full(256, 2, np.int8)  # 0: white space, 1: letters and digits, 2: signs
_KIND[SPACES] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_SAME = np.uint64(0x5BD1E995)


def features(texts: pa.ChunkedArray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight indices of all texts' features, one text after the other, where each starts, and tokens per text."""
    data, starts = text_bytes(texts)
    kind = _KIND[data]
    edges = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1], [True]))) if len(kind) else np.zeros(1, np.int64)
    first, last = edges[:-1], edges[1:]
    real = kind[first] > 0
    first, last = first[real], last[real]
    tokens = hasher(data, first, last)
    bounds = np.searchsorted(first, starts)
    count = np.diff(bounds)
    pairs = mix(tokens[:-1] * np.uint64(3) + tokens[1:])
    pairs[tokens[:-1] == tokens[1:]] = _SAME
    flat = np.zeros(2 * len(tokens), np.uint64)
    flat[::2] = tokens
    flat[1:-1:2] = pairs
    keep = np.ones(len(flat), bool)
    keep[2 * bounds[1:][count > 0] - 1] = False  # the pair that begins with a text's last token
    index = (flat[keep] >> np.uint64(20)) % np.uint64(DIMENSIONS - 1) + np.uint64(1)  # 0 is the bias
    return index.astype(np.int64), np.concatenate(([0], np.cumsum(np.maximum(2 * count - 1, 0)))), count


def trained(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights after FTRL-proximal updates over (indices, values, label) in the order given."""
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)

    def weights(i) -> np.ndarray:
        rate = (BETA + np.sqrt(n[i])) / ALPHA + L2
        return np.where(np.abs(z[i]) <= L1, 0.0, (np.sign(z[i]) * L1 - z[i]) / rate)

    for _ in range(EPOCHS):
        for i, x, label in examples:
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(slice(None))


def fit(docs: DataFrame, labels: DataFrame, label: str, allowed: Column) -> np.ndarray:
    """Averaged weights; ``allowed`` tells from doc_id which labels may be learned from."""
    usable = labels.where(F.col(label).isNotNull() & allowed).select("doc_id", F.col(label).cast("int").alias("label"))
    few = usable.where(hash_share("doc_id", TRAIN_ROWS, usable.count())).distinct()
    chosen = few.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(TRAIN_ROWS)
    # At most TRAIN_ROWS pairs of numbers, so the broadcast is bounded.
    rows = docs.select("doc_id", F.xxhash64("text").alias("print"), "text").join(F.broadcast(chosen), "doc_id")

    def counted(batches: Iterator[pa.RecordBatch]):
        hasher = SpanHasher()
        for chunk in text_chunks(batches):
            index, starts, count = features(chunk["text"], hasher)
            own = np.repeat(np.arange(len(count)), np.diff(starts)) * DIMENSIONS
            both, times = np.unique(own + index, return_counts=True)
            bounds = pa.array(np.searchsorted(both, np.arange(len(count) + 1) * DIMENSIONS).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (both % DIMENSIONS, times)]
            known = [chunk[c].combine_chunks() for c in ("doc_id", "label", "print")]
            yield pa.RecordBatch.from_arrays([*known, *lists, pa.array(count)], ["doc_id", "label", "print", "index", "times", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = f"doc_id {kind}, label int, print bigint, index array<int>, times array<int>, tokens bigint"
    # Numbers of at most DIMENSIONS features a row, not texts, go to the groups; a row that stands several times teaches once.
    rows = rows.select("doc_id", "label", "print", "text").mapInArrow(counted, known).dropDuplicates(["doc_id", "label", "print"])
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)))

    def shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(order=part["doc_id"].map(lambda i: mix(np.uint64([i % 2**64]))[0])).sort_values(["order", "label", "print"])
        examples = []
        for index, times, tokens, label_ in zip(part["index"], part["times"], part["tokens"], part["label"]):
            x = np.asarray(times) / np.sqrt(max(int(tokens), 1))
            examples.append((np.concatenate(([0], np.asarray(index, np.int64))), np.concatenate(([1.0], x)), int(label_)))
        return pd.DataFrame({"weights": [trained(examples).astype(np.float32).tobytes()], "rows": [len(part)]})

    found = rows.groupBy("shard").applyInPandas(shard, "weights binary, rows bigint").collect()
    if not found:
        return np.zeros(DIMENSIONS)
    return np.average([np.frombuffer(r["weights"], np.float32) for r in found], axis=0, weights=[r["rows"] for r in found])


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]):
        hasher, w = SpanHasher(), shared.value
        for chunk in text_chunks(batches):
            index, starts, count = features(chunk["text"], hasher)
            sums = np.concatenate(([0.0], w[index], [0.0]))
            total = np.add.reduceat(sums, starts[:-1] + 1) if len(count) else np.zeros(0)
            total = np.where(count > 0, total, 0.0) / np.sqrt(np.maximum(count, 1)) + w[0]
            yield pa.RecordBatch.from_arrays(
                [chunk["doc_id"].combine_chunks(), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], ["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def op3_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of the ids is held out from training."""
    docs, fold = read(spark, sf_dir, "documents"), in_fold("doc_id", 3)
    weights = fit(docs, read(spark, sf_dir, "labels"), "quality", fold != 1)
    return scored(docs, weights).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
