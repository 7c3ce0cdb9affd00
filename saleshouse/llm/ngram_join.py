"""Near-duplicate documents: an exact Jaccard join of word n-gram sets with prefix trees.

Every set is put in one global order: first the n-grams that are not common, by hash, then the common ones,
by how often they occur. Sets with Jaccard similarity t or more share an n-gram among the first
n - ceil(t * n) + 1 of each, so these n-grams are the keys by which sets meet (`components.linked`).
Candidates pass a bound from parity bitmaps; then the sets that meet one probe are stored in a trie, and one
traversal counts all overlaps: sets with a common beginning share its count, and a subtree is left as soon
as the remaining lengths cannot reach the similarity.

Which n-grams count as common only moves work about, never results. They are counted over all documents, in
chunks: an n-gram with a share of ``1 / COMMON`` of all has that share in some chunk, so there are at most
``COMMON`` of them, which bounds the broadcast list.

Defined results: null text, empty text and text without words have no n-grams and no links; a text of fewer
words than n has one n-gram, its whole sequence. Rows with a null id have no links and a null component; a repeated id
counts once, with the union of its rows' links. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components, linked
from .tables import SPACES, Scratch, SpanHasher, mix, read, runs, text_bytes, text_chunks

N = 5
PERCENT = 80  # least similarity
COMMON = 1 << 22
_COUNT_AT_ONCE = 4 << 20  # n-grams that a task counts at once
_BLOCK = 256  # sets in one trie
_HIGH = np.uint64(1) << np.uint64(63)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: pa.ChunkedArray, n: int, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of each text, ascending, one text after the other, and where each text starts."""
    data, starts = text_bytes(texts)
    lower = _LOWER[data]
    first, last = runs(~SPACES[lower])
    words = hasher(lower, first, last)
    bounds = np.searchsorted(first, starts)  # of each text's words
    count = np.diff(bounds)
    hashes = np.zeros(len(words), np.uint64)
    for k in range(n):
        hashes[: len(words) - k] += words[k:] * mix(np.uint64([2 * k + 1]))
    hashes = mix(hashes)
    n_grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    for i in np.flatnonzero((count > 0) & (count < n)):
        hashes[bounds[i]] = xxhash.xxh3_64_intdigest(words[bounds[i] : bounds[i + 1]].tobytes(), seed=n)
    offset = np.arange(len(words)) - np.repeat(bounds[:-1], count)
    hashes = hashes[offset < np.repeat(n_grams, count)]
    return distinct_sorted(hashes, np.concatenate(([0], np.cumsum(n_grams))))


def distinct_sorted(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part sorted, without repeats."""
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[starts[:-1][starts[:-1] < len(values)]] = True
    return values[new], np.concatenate(([0], np.cumsum(new)))[starts]


def class_of(keys: np.ndarray) -> int:
    """A number for equal sets."""
    return xxhash.xxh3_64_intdigest(keys.tobytes()) - (1 << 63)


def common_ngrams(docs: DataFrame, n: int, scratch: Scratch) -> np.ndarray:
    """The common n-grams over all texts, rarest first: at most ``COMMON``."""

    def counts(batches: Iterator[pa.RecordBatch]):
        hasher, held, size = SpanHasher(), [], 0
        for chunk in text_chunks(batches):
            held.append(shingle_sets(chunk["text"], n, hasher)[0])
            size += len(held[-1])
            if size >= _COUNT_AT_ONCE:
                yield from flush(held)
                held, size = [], 0
        yield from flush(held)

    def flush(held: list[np.ndarray]):
        grams = np.sort(np.concatenate([np.empty(0, np.uint64), *held]))
        edges = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1], [True]))) if len(grams) else np.zeros(1, np.int64)
        times = np.diff(edges)
        many = times >= max(2, len(grams) / COMMON)
        rows = [*grams[edges[:-1]][many].view(np.int64).tolist(), None], [*times[many].tolist(), len(grams)]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64())], ["gram", "times"])

    found = (
        docs.select("text").mapInArrow(counts, "gram bigint, times bigint")  # a null gram carries the number of all
        .groupBy("gram").agg(F.sum("times").alias("times"))
    )
    found = scratch.keep(found, "counts")
    total = found.where("gram is null").agg(F.sum("times")).first()[0] or 0
    least = max(3, -(-total // COMMON))
    pairs = found.where(F.col("gram").isNotNull() & (F.col("times") >= least)).select("gram", "times").toArrow()
    scratch.drop(found)
    grams, times = pairs["gram"].to_numpy().view(np.uint64), pairs["times"].to_numpy()
    return grams[np.lexsort((grams, times))]


class GlobalOrder:
    """Order keys of n-grams: those not common by hash, then the common ones, rarest first."""

    def __init__(self, common: np.ndarray):
        self.rank = np.argsort(common, kind="stable").astype(np.uint64)
        self.common = common[self.rank.astype(np.int64)]

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        keys = grams >> np.uint64(1)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, grams), len(self.common) - 1)
            hit = self.common[at] == grams
            keys[hit] = self.rank[at[hit]] | _HIGH
        return keys


def ordered_sets(texts: pa.ChunkedArray, n: int, order: GlobalOrder, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    grams, starts = shingle_sets(texts, n, hasher)
    return distinct_sorted(order(grams), starts)


def bitmap(keys: np.ndarray) -> np.ndarray:
    """Parity of the number of keys in each of 2**k >= size places, as 64-bit words: where two maps differ, the sets differ."""
    size = max(64, 1 << max(0, int(len(keys) - 1).bit_length()))
    odd = np.bincount((mix(keys) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def maps_allow(one: str, two: str, percent: int) -> Column:
    """Whether the bitmaps, a lower bound of the difference, leave the similarity in reach. The larger map is folded once:
    by their sizes, sets that could be similar have maps of one size or of a size and its double."""

    def folded(own: str, other: str) -> Column:
        half = (F.size(own) / 2).cast("int")
        halves = F.zip_with(F.slice(own, 1, half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > F.size(other), halves).otherwise(F.col(own))

    a, b = f"{one}map", f"{two}map"
    differ = F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, x: n + F.bit_count(x))
    both = F.col(f"{one}n") + F.col(f"{two}n")
    least = F.floor((percent * both + (99 + percent)) / F.lit(100 + percent))
    return F.coalesce(differ <= both - 2 * least, F.lit(False))


def needed(x: int, y: int, percent: int) -> int:
    """Least intersection of sets of x and y elements with the similarity."""
    return -(-percent * (x + y) // (100 + percent))


def trie_overlaps(probe: np.ndarray, sets: list[np.ndarray], percent: int, step: int = 64) -> list[int]:
    """Intersection sizes of ``probe`` with each set, or -1 where the similarity is out of reach.

    The sets in lexicographic order are a depth-first walk of their trie: a set's branch point is the length of
    the beginning it has in common with the one before. Overlaps along the current path are kept, so a common
    beginning is counted once, and a path that was cut also cuts what follows below the cut.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    result = [-1] * len(sets)
    path = np.empty(0, np.uint64)
    overlap = np.zeros(1, np.int64)  # overlap[d]: of the first d elements of the path; known up to its length
    for i in order:
        own = sets[i]
        size = min(len(path), len(own))
        differ = np.flatnonzero(path[:size] != own[:size])
        depth = min(int(differ[0]) if len(differ) else size, len(overlap) - 1)
        overlap = overlap[: depth + 1]
        least = needed(len(probe), len(own), percent)
        while depth < len(own):
            here = int(np.searchsorted(probe, own[depth]))
            if overlap[-1] + min(len(own) - depth, len(probe) - here) < least:
                break
            part = own[depth : depth + step]
            at = np.minimum(np.searchsorted(probe, part), len(probe) - 1)
            overlap = np.concatenate((overlap, overlap[-1] + np.cumsum(probe[at] == part)))
            depth += len(part)
        else:
            result[i] = int(overlap[-1]) if overlap[-1] >= least else -1
        path = own
    return result


def near_duplicates(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) of every row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select("doc_id", "text")
    order = spark.sparkContext.broadcast(GlobalOrder(common_ngrams(docs, n, scratch)))

    def index(batches: Iterator[pa.RecordBatch]):
        hasher = SpanHasher()
        for chunk in text_chunks(batches):
            keys, starts = ordered_sets(chunk["text"], n, order.value, hasher)
            sizes = np.diff(starts)
            lead = np.where(sizes > 0, sizes + (-percent * sizes // 100) + 1, 0)  # n - ceil(t * n) + 1
            parts = [keys[a:b] for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    chunk["doc_id"].combine_chunks().cast(pa.int64()),
                    pa.array(sizes),
                    pa.array([class_of(x) for x in parts], pa.int64()),
                    pa.array([bitmap(x) for x in parts], pa.list_(pa.int64())),
                    pa.array([x[:k].tobytes() for x, k in zip(parts, lead)]),
                ],
                ["doc_id", "n_shingles", "class", "map", "lead"],
            )

    sets = scratch.keep(
        docs.mapInArrow(index, "doc_id bigint, n_shingles bigint, class bigint, map array<bigint>, lead binary"), "sets"
    )
    # Equal sets are one class; classes are indexed, met and verified, and doc_ids are tied to them at the end.
    some = sets.where("n_shingles > 0 and doc_id is not null")
    reps = some.groupBy("class", "doc_id").agg(F.lit(1)).groupBy("class").agg(F.min("doc_id").alias("rep"))
    reps = scratch.keep(reps, "classes")
    own = reps.withColumnsRenamed({"class": "__class", "rep": "__rep"})
    chosen = some.join(own, (F.col("class") == F.col("__class")) & (F.col("doc_id") == F.col("__rep")), "left_semi").dropDuplicates(["class"])

    def keys(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            count = np.array([len(x) // 8 for x in batch["lead"].to_pylist()], np.int64)
            for first in range(0, len(count), 512):
                some = slice(first, first + 512)
                flat = np.frombuffer(b"".join(batch["lead"].slice(first, 512).to_pylist()), np.uint64)
                flat = (flat ^ _HIGH).view(np.int64)  # as signed numbers in the global order
                rows = [np.repeat(batch[c].to_numpy()[some], count[some]) for c in ("class", "n_shingles")]
                place = np.arange(len(flat)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
                yield pa.RecordBatch.from_arrays([pa.array(flat), *map(pa.array, rows), pa.array(place.astype(np.int32))], ["key", "id", "n", "place"])

    postings = chosen.select("class", "n_shingles", "lead").mapInArrow(keys, "key bigint, id bigint, n bigint, place int")

    def fits(one: str, two: str):
        a, b = F.col(f"{one}n"), F.col(f"{two}n")
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    def close(one: str, two: str):
        """The bitmaps allow it; and what stands before the first key of both is in one set only, so there is not more of it than may differ."""
        both = F.col(f"{one}n") + F.col(f"{two}n")
        may_differ = both - 2 * F.floor((percent * both + (99 + percent)) / F.lit(100 + percent))
        return (F.col(f"{one}place") + F.col(f"{two}place") <= may_differ) & maps_allow(one, two, percent)

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(pairs, docs, chosen, reps, n, percent, order, scratch)

    maps = chosen.select(F.col("class").alias("id"), "map")
    labels = linked(postings, ["n", "place"], fits, verify, scratch, maps, close)
    ties = some.select("doc_id", "class").distinct().join(reps, "class").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    for side in ("id", "label"):
        labels = labels.join(reps.toDF(side, f"{side}_rep"), side)
    joined = labels.select(F.col("id_rep").alias("a"), F.col("label_rep").alias("b"))
    final = components(ties.unionAll(joined), scratch)
    return (
        sets.select("doc_id", "n_shingles")
        .join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))
    )


def verified(pairs, docs, chosen, reps, n, percent, order, scratch) -> DataFrame:
    """The pairs (a, b) of classes whose sets have the similarity."""

    maps = chosen.select("class", "n_shingles", "map")
    for side in ("a", "b"):
        pairs = pairs.join(maps.toDF(side, f"{side}_n", f"{side}_map"), side)
    pairs = scratch.keep(pairs.where(maps_allow("a_", "b_", percent)).select("a", "b"), "bounded")

    def sets_of(batches: Iterator[pa.RecordBatch]):
        hasher = SpanHasher()
        for chunk in text_chunks(batches):
            keys, starts = ordered_sets(chunk["text"], n, order.value, hasher)
            parts = [keys[a:b] for a, b in zip(starts[:-1], starts[1:])]
            ids = pa.array([class_of(x) for x in parts], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes() for x in parts], pa.binary())], ["id", "keys"])

    ends = pairs.select(F.col("a").alias("class")).unionAll(pairs.select(F.col("b").alias("class"))).distinct()
    holders = reps.join(ends, "class", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    # All texts of a doc_id come; those of other classes go again.
    texts = docs.join(holders, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(sets_of, "id bigint, keys binary")
    full = scratch.keep(texts.join(ends.withColumnRenamed("class", "id"), "id", "left_semi").dropDuplicates(["id"]), "full")
    # A probe with many partners is spread over blocks of about _BLOCK of them, so no trie is unbounded.
    blocks = scratch.keep(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks")), "blocks")
    members = pairs.join(blocks, "b").select("b", F.expr("pmod(xxhash64(a), blocks)").cast("int").alias("block"), F.col("a").alias("id"))
    probes = blocks.select("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("b").alias("id"))
    groups = members.unionAll(probes).join(full, "id")

    def traverse(table: pa.Table) -> pa.Table:
        centre = table["b"][0].as_py()
        ids = table["id"].to_pylist()
        arrays = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
        probe = arrays[ids.index(centre)]
        others = [k for k, i in enumerate(ids) if i != centre]
        overlaps = trie_overlaps(probe, [arrays[k] for k in others], percent)
        hits = [ids[k] for k, o in zip(others, overlaps) if o >= 0]
        return pa.table({"a": pa.array(hits, pa.int64()), "b": pa.array([centre] * len(hits), pa.int64())})

    links = scratch.keep(groups.groupBy("b", "block").applyInArrow(traverse, "a bigint, b bigint"), "links")
    scratch.drop(pairs, full, blocks)
    return links


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document: five-word n-grams, similarity 0.8 or more."""
    return near_duplicates(read(spark, sf_dir, "documents"))
