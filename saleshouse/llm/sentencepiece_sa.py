"""SentencePiece encoding with a suffix array of the batch, and decoding.

The pieces of a model of the BPE kind are looked for in a whole batch of text at once. The text is cut where no piece can cross
(before white space that follows something else, and around characters that no longer piece holds); equal cuts are
encoded once. The different cuts, one after the other, get a suffix array; a binary search of every piece gives the range of
its occurrences, which are the edges of a graph over places. The edges are sorted by the place of their cut, and in a cut by score
and place. They are then relaxed: while a cut has an edge that spans exactly two current symbols, its first one makes them one
symbol, which is the order in which a BPE model merges. Characters without a piece become byte pieces.

Decoding puts the pieces' bytes together, without the space that encoding puts in front.

Models must be of the BPE kind with byte fallback, without normalisation, with a space put in front and white space kept;
others are refused. Defined results: null and empty text have no pieces and decode to an empty text. The sign U+2581, which stands
for a space in models, decodes to a space. Null ids and repeated rows are encoded as any other row. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from sentencepiece import sentencepiece_model_pb2

from .tables import SpanHasher, read, text_bytes, text_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = "▁"
_CHUNK = 1 << 20  # bytes of text; larger batches hold fewer different cuts but take about 130 times as much
_TOGETHER = 64  # symbols in a cut whose merges are made side by side with other cuts'


class Vocabulary(NamedTuple):
    """Pieces as bytes, with a space for the mark, in order of id; byte pieces hold their byte."""

    content: np.ndarray  # all pieces' bytes, one after the other
    starts: np.ndarray
    words: np.ndarray  # the bytes of the pieces that can be merged, as big-endian words of eight
    lengths: np.ndarray
    ids: np.ndarray
    rank: np.ndarray  # by id: 0 is the best score
    byte_ids: np.ndarray
    whole: np.ndarray  # by byte: whether a longer piece holds it


def vocabulary(path: str) -> Vocabulary:
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm, trained = model.normalizer_spec, model.trainer_spec
    if trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback and white space in front are supported")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("only models without normalisation, with a space in front, are supported")
    normal, byte, kinds = 1, 6, {p.type for p in model.pieces}
    if kinds - {1, 2, 3, byte}:
        raise ValueError("user-defined and unused pieces are not supported")
    contents, ids, byte_ids = [], [], np.zeros(256, np.int32)
    whole = np.zeros(256, bool)
    for k, piece in enumerate(model.pieces):
        text = piece.piece.replace(_MARK, " ").encode()
        if piece.type == byte:
            text = bytes([int(piece.piece[3:5], 16)])
            byte_ids[text[0]] = k
        elif piece.type == normal:
            if " " in piece.piece.lstrip(_MARK).replace(_MARK, " "):
                raise ValueError("pieces with white space inside are not supported")
            ids.append(k)
            if len(piece.piece) > 1:
                whole[list(text)] = True
        else:
            text = b""
        contents.append(text)
    own = [contents[k] for k in ids]
    width = -(-max(map(len, own)) // 8) * 8
    words = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in own), ">u8").reshape(len(own), -1).astype(np.uint64)
    _, rank = np.unique(-np.array([p.score for p in model.pieces]), return_inverse=True)
    return Vocabulary(
        np.frombuffer(b"".join(contents), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in contents]))), words,
        np.array([len(x) for x in own]), np.array(ids), rank, byte_ids, whole,
    )


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lengths[i] - 1, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; zeros after the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    result = np.zeros(len(data), np.uint64)
    for k in range(8):
        result = (result << np.uint64(8)) | padded[k : k + len(data)]
    return result


def suffix_array(first: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the text from there on, compared over ``depth`` bytes at least. ``first``: `windows` of the text."""
    order = np.argsort(first, kind="stable")
    new = np.concatenate(([True], first[order][1:] != first[order][:-1])) if len(order) else np.zeros(0, bool)
    rank = np.empty(len(order) + 1, np.int64)
    known = 8
    while known < depth:
        group = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)
        rank[order], rank[-1] = group + 1, 0
        tied = np.flatnonzero(~new | ~np.append(new[1:], True)) if len(new) else np.zeros(0, np.int64)
        if not len(tied):
            break
        places = order[tied]
        after = rank[np.minimum(places + known, len(order))]
        key = group[tied] * np.int64(len(order) + 2) + after
        turn = np.argsort(key, kind="stable")
        order[tied] = places[turn]
        key = key[turn]
        new[tied] = np.concatenate(([True], key[1:] != key[:-1]))
        known *= 2
    return order


def occurrences(order: np.ndarray, first: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every piece the range of the suffix array whose texts begin with it, by binary search of all pieces at once."""
    n = len(order)
    first = np.concatenate((first, np.zeros(1, np.uint64)))
    masks = np.zeros(words.shape, np.uint64)
    for k in range(words.shape[1]):
        bits = 64 - 8 * np.clip(lengths - 8 * k, 0, 8)
        masks[:, k] = np.where(bits == 64, 0, np.uint64(2**64 - 1) << np.minimum(bits, 63).astype(np.uint64))

    def search(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(words), np.int64), np.full(len(words), n)
        while True:
            active = np.flatnonzero(low < high)
            if not len(active):
                return low
            middle = (low[active] + high[active]) // 2
            below = np.zeros(len(active), bool)
            open_ = np.ones(len(active), bool)
            for k in range(words.shape[1]):
                if not open_.any():
                    break
                text = first[np.minimum(order[middle] + 8 * k, n)] & masks[active, k]
                below |= open_ & (text < words[active, k])
                open_ &= text == words[active, k]
            goes = below | open_ if upper else below
            low[active] = np.where(goes, middle + 1, low[active])
            high[active] = np.where(goes, high[active], middle)

    return search(False), search(True)


def ordered(*columns: np.ndarray) -> np.ndarray:
    """The order of rows by the columns (of numbers from 0 on), the first one first: as one number a row where that fits."""
    sizes = [int(x.max(initial=0)) + 1 for x in columns]
    if math.prod(sizes) >= 1 << 63:
        return np.lexsort(columns[::-1])
    key = np.zeros(len(columns[0]), np.int64)
    for column, size in zip(columns, sizes):
        key *= size
        key += column
    return np.argsort(key)


def merged_alone(begin: int, end: int, starts: list[int], stops: list[int], ranks: list[int], boundary: np.ndarray) -> None:
    """The same merges for one long cut, with a heap: edges wait at the symbol pairs that could make them."""
    by_span = {(s, e): (r, s, e) for s, e, r in zip(starts, stops, ranks)}
    symbols = (np.flatnonzero(boundary[begin:end]) + begin).tolist()
    after = dict(zip(symbols, [*symbols[1:], end]))
    before = {b: a for a, b in after.items()}
    heap = [by_span[s, after[m]] for s, m in after.items() if m != end and (s, after[m]) in by_span]
    heapq.heapify(heap)
    while heap:
        _, s, e = heapq.heappop(heap)
        middle = after.get(s)
        if middle is None or middle == end or after.get(middle) != e:
            continue
        boundary[middle] = False
        del after[middle]
        after[s], before[e] = e, s
        if e != end and (s, after[e]) in by_span:
            heapq.heappush(heap, by_span[s, after[e]])
        if s != begin and (before[s], e) in by_span:
            heapq.heappush(heap, by_span[before[s], e])


def encode_cuts(data: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the cuts of ``data``, one cut after the other, and where each begins."""
    first = windows(data)
    order = suffix_array(first, v.words.shape[1] * 8)
    low, high = occurrences(order, first, v.words, v.lengths)
    count = high - low
    begin = order[ranges(low, count)]
    piece = np.repeat(np.arange(len(count)), count)
    stop = begin + v.lengths[piece]
    cut_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = stop <= bounds[cut_of[begin] + 1]
    begin, stop, piece = begin[inside], stop[inside], piece[inside]

    boundary = np.append((data & 0xC0) != 0x80, True)  # places where a symbol begins: characters at first
    symbol = np.full(len(data), -1, np.int64)  # id of the piece that begins here
    before = np.concatenate(([0], np.cumsum(boundary)))
    size = before[stop] - before[begin]
    symbol[begin[size == 1]] = v.ids[piece[size == 1]]
    begin, stop, piece = begin[size > 1], stop[size > 1], piece[size > 1]
    cut, rank = cut_of[begin], v.rank[v.ids[piece]]
    turn = ordered(cut, rank, begin - bounds[cut])
    begin, stop, cut, rank, ids = begin[turn], stop[turn], cut[turn], rank[turn], v.ids[piece[turn]]
    every = begin, stop, ids

    symbols = before[bounds[1:]] - before[bounds[:-1]]
    long_cut = symbols > _TOGETHER
    if long_cut.any():
        edges = np.searchsorted(cut, np.arange(len(bounds)))
        for c in np.flatnonzero(long_cut):
            some = slice(edges[c], edges[c + 1])
            merged_alone(int(bounds[c]), int(bounds[c + 1]), begin[some].tolist(), stop[some].tolist(), rank[some].tolist(), boundary)
        short = ~long_cut[cut]
        begin, stop, cut = begin[short], stop[short], cut[short]
    # Where the symbol that begins at a place ends; after the end, and where none begins any more, a place beyond all.
    size = len(data)
    after = np.full(size + 2, size + 1, np.int32 if size < 1 << 30 else np.int64)
    places = np.flatnonzero(boundary)
    after[places[:-1]] = places[1:]
    begin, stop, cut = (x.astype(after.dtype) for x in (begin, stop, cut))
    going = np.zeros(len(bounds) - 1, bool)
    while len(begin):
        at = np.flatnonzero(after[after[begin]] == stop)  # edges that span two symbols
        at = at[np.concatenate(([True], cut[at][1:] != cut[at][:-1]))] if len(at) else at
        if not len(at):
            break
        middle = after[begin[at]]
        boundary[middle] = False
        after[begin[at]], after[middle] = stop[at], size + 1
        going[:] = False
        going[cut[at]] = True
        alive = going[cut] & boundary[begin] & boundary[stop]
        alive[at] = False
        begin, stop, cut = begin[alive], stop[alive], cut[alive]

    # Names of the symbols: a span of more than one character is the piece with that span.
    begin, stop, ids = every
    np.cumsum(boundary, out=before[1:])
    made = boundary[begin] & boundary[stop] & (before[stop] - before[begin] == 1)
    symbol[begin[made]] = ids[made]
    places = np.flatnonzero(boundary[:-1])
    names = symbol[places]
    lengths = np.diff(np.append(places, len(data)))
    unknown = names < 0
    out = np.where(unknown, lengths, 1)
    flat = np.repeat(names, out)
    flat[flat < 0] = v.byte_ids[data[ranges(places[unknown], lengths[unknown])]]
    offsets = np.concatenate(([0], np.cumsum(out)))
    return flat.astype(np.int32), offsets[np.searchsorted(places, bounds)]


def encode_batch(texts: pa.ChunkedArray, v: Vocabulary, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one text after the other, and where each begins."""
    marked = pa.chunked_array([pa.array([" " + t.replace(_MARK, " ") if t else None for t in texts.to_pylist()], pa.string())])
    data, starts = text_bytes(marked)
    real = np.ones(len(data), bool)
    real[starts[1:] - 1] = False  # the ends that text_bytes adds
    cut = np.zeros(len(data) + 1, bool)
    space = data == 32
    cut[1:-1] = space[1:] & ~space[:-1]
    apart = ~v.whole[data] & (data < 128)  # one-byte characters in no longer piece
    cut[:-1] |= apart
    cut[1:] |= apart
    cut[starts] = True
    cut[starts[1:] - 1] = True
    begin = np.flatnonzero(cut[:-1])
    end = np.append(begin[1:], len(data))
    keep = real[begin]
    begin, end = begin[keep], end[keep]
    hashes = hasher(data, begin, end)
    _, one, same = np.unique(hashes, return_index=True, return_inverse=True)
    sizes = end[one] - begin[one]
    ids, offsets = encode_cuts(data[ranges(begin[one], sizes)], np.concatenate(([0], np.cumsum(sizes))), v)
    counts = np.diff(offsets)[same]
    before = np.concatenate(([0], np.cumsum(counts)))
    return ids[ranges(offsets[:-1][same], counts)], before[np.searchsorted(begin, starts)]


def decode_batch(ids: np.ndarray, starts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, one after the other, and where each begins."""
    sizes = v.starts[ids + 1] - v.starts[ids]
    data = v.content[ranges(v.starts[ids], sizes)]
    bounds = np.concatenate(([0], np.cumsum(sizes)))[starts]
    front = np.zeros(len(data) + 1, bool)
    filled = bounds[:-1][np.diff(bounds) > 0]
    front[filled] = data[filled] == 32
    return data[~front[:-1]], bounds - np.concatenate(([0], np.cumsum(front)))[bounds]


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids array<int>, n_pieces, round_trip (whether the ids decode to the text) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model))

    def encode(batches: Iterator[pa.RecordBatch]):
        hasher, v = SpanHasher(), shared.value
        for chunk in text_chunks(batches, limit=_CHUNK):
            ids, starts = encode_batch(chunk["text"], v, hasher)
            text, ends = decode_batch(ids, starts, v)
            source, source_starts = text_bytes(chunk["text"])
            same = [
                bool(np.array_equal(text[a:b], source[c : d - 1]))
                for a, b, c, d in zip(ends[:-1].tolist(), ends[1:].tolist(), source_starts[:-1].tolist(), source_starts[1:].tolist())
            ]
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [chunk["doc_id"].combine_chunks(), lists, pa.array(np.diff(starts)), pa.array(same, pa.bool_())], ["doc_id", "ids", "n_pieces", "round_trip"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, ids array<int>, n_pieces bigint, round_trip boolean")


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of (doc_id, ids); null ids decode to an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary(model))

    def decode(batches: Iterator[pa.RecordBatch]):
        v = shared.value
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch["ids"].to_pylist()]
            starts = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
            data, ends = decode_batch(np.concatenate([np.empty(0, np.int64), *lists]), starts, v)
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, text string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, decoded again as a check."""
    return encoded(read(spark, sf_dir, "documents"))
