"""Language identification by compression: the language whose dictionary compresses a text best.

For each language a bounded sample of training texts (the ``DICTIONARY_ROWS`` with the least hash of their id) becomes a raw-content
dictionary of at most ``DICTIONARY_BYTES``: short texts whole, of longer ones equally many bytes, in parts from all over the text. Only the
``LANGUAGES`` languages with the most rows are learnt. All of a text is compressed with each
dictionary, in independent pieces of ``PIECE_BYTES``, so that the dictionary helps as much at the end of a long text as at its start and the
margin means the same at every length. The sums of the pieces' sizes are compared. A text is rejected where the best and the second best size are closer than ``MARGIN`` of the best, and where
it has no letter.

Texts are brought to lower case and signs and digits are taken as spaces, in dictionaries and in texts alike.

Defined results: null text, empty text and text without a letter: ``und``, score 0, rejected. Without any language to
learn from, every text is ``und``. With one language there is no second size, and nothing is rejected for its margin. Equal sizes go to
the lesser language name. Repeated rows are judged alike; a null doc_id is judged and not held out.
An empty table gives an empty result. Only doc_id, text and, for training, lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import hash_share, in_fold, read

LANGUAGES = 256
DICTIONARY_ROWS = 400
DICTIONARY_BYTES = 112_640
EXCERPT_BYTES = 256
LEVEL = 3
MARGIN = 0.002
PIECE_BYTES = 32_768
UNKNOWN = "und"

_SIGNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain(text: str) -> bytes:
    """Lower case, letters and single spaces."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split())


def excerpt(content: bytes, size: int) -> bytes:
    """All of a short content; else ``size`` bytes of it, in parts of about ``EXCERPT_BYTES`` from its beginning to its end."""
    if len(content) <= size:
        return content
    count = -(-size // EXCERPT_BYTES)
    ends = [size * k // count for k in range(count + 1)]
    # Of what is left out, equal shares stand before, between and after the parts.
    skipped = [(len(content) - size) * (k + 1) // (count + 1) for k in range(count)]
    return b"".join(content[a + s : b + s] for a, b, s in zip(ends[:-1], ends[1:], skipped))


def level(sizes: list[int], room: int) -> int:
    """The most bytes of a text that may be taken so that all texts together fit the room."""
    left = room
    for k, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - k)
        if size > share:
            return share
        left -= size
    return max(sizes, default=0)


def dictionaries(docs: DataFrame, allowed: Column) -> dict[str, bytes]:
    """A dictionary for each of the ``LANGUAGES`` languages with the most rows; only these dictionaries come to the driver."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & allowed).select("lang", "doc_id", "text")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    few = F.lit(False)
    for row in counts:  # one condition for each language: a handful of rows of each go on
        few = few | ((F.col("lang") == row["lang"]) & hash_share("doc_id", DICTIONARY_ROWS, row["n"]))

    def excerpts(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            content = [excerpt(plain(t), DICTIONARY_BYTES) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["doc_id"], pa.array(content, pa.binary())], ["lang", "doc_id", "content"])

    def joined(batch: pa.Table) -> pa.Table:
        content = batch["content"].to_pylist()
        most = level([len(x) + 1 for x in content], DICTIONARY_BYTES)
        return pa.table({"lang": batch["lang"][:1], "content": pa.array([b" ".join(excerpt(x, most - 1) for x in content if most > 1)], pa.binary())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    short = rows.where(few).mapInArrow(excerpts, f"lang string, doc_id {kind}, content binary")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "content")
    some = short.withColumn("k", F.row_number().over(first)).where(F.col("k") <= DICTIONARY_ROWS)
    found = some.select("lang", "k", "content").groupBy("lang").applyInArrow(lambda t: joined(t.sort_by("k")), "lang string, content binary")
    # Eight bytes are the least that zstandard takes.
    return {row["lang"]: bytes(row["content"]) for row in found.collect() if len(row["content"]) >= 8}


class Judge:
    """Compresses with every dictionary; made anew in each Python worker."""

    def __init__(self, contents: dict[str, bytes]):
        self.languages = sorted(contents)
        self.compressors = []
        for lang in self.languages:
            own = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=own, level=LEVEL, write_content_size=False))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score (0 to 1: how far ahead the best size is) and whether the text is rejected."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        content = plain(text)
        # Pieces of one length, so that none is too short to tell.
        count = -(-len(content) // PIECE_BYTES) or 1
        ends = [len(content) * k // count for k in range(count + 1)]
        pieces = [content[a:b] for a, b in zip(ends[:-1], ends[1:])]
        sizes = [sum(len(c.compress(x)) for x in pieces) for c in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.languages[0], 1.0, False
        lead = min(s for k, s in enumerate(sizes) if k != best) - sizes[best]
        # Each byte that another language needs more halves its weight.
        score = 1 / sum(2.0 ** -min(s - sizes[best], 60) for s in sizes)
        return self.languages[best], score, lead < MARGIN * sizes[best]


def identified(docs: DataFrame, contents: dict[str, bytes], prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score and rejected, from the text alone; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    added = [f"{prefix}{c}" for c in ("lang_pred", "score", "rejected")]
    docs = docs.drop(*added)
    names = [*docs.columns, *added]

    def judge(batches: Iterator[pa.RecordBatch]):
        judged = Judge(shared.value)
        for batch in batches:
            found = [judged(t) for t in batch["text"].to_pylist()]
            langs, scores, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names
            )

    schema = docs.select("*", *[F.lit(v).alias(c) for c, v in zip(added, ("", 0.0, True))]).schema
    return docs.mapInArrow(judge, schema)


def op7_language_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a fifth of the ids is held out from the dictionaries."""
    docs, fold = read(spark, sf_dir, "documents"), in_fold("doc_id", 5)
    found = identified(docs.select("doc_id", "text"), dictionaries(docs, fold != 0))
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
