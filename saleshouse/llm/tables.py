"""Tables of the corpus, intermediate tables, and the text helpers that several operators share."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import CODEC, _filesystem, fresh_path, make_folder, shuffles_go

CHUNK_BYTES = 2 << 20  # of text that a task turns into arrays at once; these take about 60 times as much
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables of one run in the shared folder; those that no result reads are dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        with shuffles_go(self.spark):
            df.write.option("compression", CODEC).parquet(path)
        return self._table(self.spark.read.schema(df.schema).parquet(path), path)

    def keep_dealt(self, df: DataFrame, label: str, column: str, codec: str | None = None) -> DataFrame:
        """Like `keep`, in buckets by a column's hash: joins on the column read the table where it lies, without a shuffle."""
        path = fresh_path(self.spark, label)
        name = f"saleshouse_{label}_{path[-12:]}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.write.format("parquet").bucketBy(buckets, column).option("path", path)
        with shuffles_go(self.spark):
            (writer.option("compression", codec) if codec else writer).saveAsTable(name)
        table = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the name only: files at a path of their own stay
        return self._table(table, path)

    def keep_parts(self, df: DataFrame, label: str, column: str, values: Iterable[int]) -> list[DataFrame]:
        """Like `keep`, a table for each value of a column, so that each can be dropped when it is no longer read."""
        path = fresh_path(self.spark, label)
        with shuffles_go(self.spark):
            df.write.option("compression", CODEC).partitionBy(column).parquet(path)
        schema = df.drop(column).schema
        folders = [f"{path}/{column}={value}" for value in values]
        for folder in folders:
            make_folder(self.spark, folder)
        return [self._table(self.spark.read.schema(schema).parquet(folder), folder) for folder in folders]

    def union(self, tables: list[DataFrame]) -> DataFrame:
        """Kept tables as one, which are dropped as one."""
        return self._table(reduce(DataFrame.unionAll, tables), *[self.paths.pop(id(table))[1] for table in tables])

    def _table(self, table: DataFrame, *paths: str) -> DataFrame:
        self.paths[id(table)] = (table, paths[0] if len(paths) == 1 else paths)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            found = self.paths.pop(id(table), None)
            for path in [] if not found else [found[1]] if isinstance(found[1], str) else found[1]:
                fs, target = _filesystem(self.spark, path)
                fs.delete(target, True)


def crc(text: str) -> int:
    """crc32 of a text, as Spark's crc32 gives it."""
    return zlib.crc32(text.encode())


def in_fold(column: str, divisor: int):
    """Remainder of crc32 of an id as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)


def hash_share(column: str, rows: int, count: int) -> Column:
    """Whether a row is among about ``2 * rows`` of ``count``, by the hash of a column: what a bounded sample is then taken from."""
    return F.shiftrightunsigned(F.xxhash64(column), 11) < F.lit(int(min(1.0, 2 * rows / max(count, 1)) * 2**53))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES):
    """Tables of about ``limit`` bytes of text; a longer single text makes a chunk of its own."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(column)
        offsets = np.frombuffer(texts.buffers()[1], _offset_type(texts))[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + limit - size, "right")) - 1
            last = min(len(texts), max(last, first + (not held)))
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(offsets[last] - offsets[first])
                first = last
            if first < len(texts) or size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _offset_type(texts: pa.Array):
    return np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32


def text_bytes(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, a line end after each, and where each starts (one more at the end). Null: empty."""
    joined = [x.encode("utf-8", "surrogatepass") if x else b"" for x in texts.to_pylist()]
    starts = np.zeros(len(joined) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in joined], out=starts[1:])
    return np.frombuffer(b"\n".join([*joined, b""]), np.uint8), starts


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class SpanHasher:
    """64-bit hashes of byte ranges by one running polynomial sum, so that no range is copied."""

    def __init__(self):
        self.power, self.inverse = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.power) <= len(data):
            size = len(data) + 1
            self.power = np.multiply.accumulate(np.full(size, _MULTIPLIER, np.uint64))
            self.inverse = np.multiply.accumulate(np.full(size, pow(_MULTIPLIER, -1, 1 << 64), np.uint64))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
