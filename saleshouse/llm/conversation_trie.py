"""Prefix trie of conversations by vertical bitmaps.

Conversations are rebuilt on top of the first turns of another one (``rebuilt``). Each place of a turn gets a 128-bit hash of
(position, role, text); a prefix is named by the XOR of the hashes of its places, so a prefix has one name wherever it is found,
and what comes before a part of a conversation is one XOR.

Rows are range-partitioned by conversation and cut into shards of about ``SHARD`` turns. A shard indexes (position, turn) to a bitset of its
conversations, then goes depth first: a parent's bitset, intersected with the posting of the next turn of its lowest conversation, is a child;
what is left goes on. Popcounts and lists of ends come with it. Shards meet again in aggregates by the prefix's name, so a first turn that a third of all conversations
share is one row from each shard. Sums over subtrees are differences of running sums in depth-first order in each shard, of weights that the
shard of a node's smallest member alone holds, and are added over shards the same way.

A conversation longer than ``BAND`` turns is cut into bands; each is a conversation of its own below the prefix before it, and what the later bands weigh is
hung on the last node of the earlier one. So neither a shared turn nor a conversation with a third of all rows lands in one task. SHA-256 of
a list has to be read in order: its parts, one from each shard, are streamed, never held.

Defined results: rows with a null conv_id are left out. A null role or text is empty. Turns go by turn (null first), then role, then text; repeated rows are
repeated turns. A conversation without rebuilt turns is a member of the root. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_row_number
from .tables import Scratch, read

SHARD = 16_384
BAND = 4_096
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODES = (
    "shard bigint, pre int, size int, a bigint, b bigint, depth bigint, up_a bigint, up_b bigint, n bigint, least bigint, chars bigint, first_end bigint, ends string"
)


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, h1, h2, chars): turns in order, from 1, each named by two hashes."""
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    known = conversations.where("conv_id is not null").select(F.col("conv_id").alias("conv"), "turn", *text)
    short = known.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("__tie"))
    numbered = with_row_number(short, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("__tie")], "__row")
    first = numbered.groupBy("conv").agg(F.min("__row").alias("__first"))
    hashes = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2")]
    return numbered.join(first, "conv").select("conv", (F.col("__row") - F.col("__first") + 1).alias("pos"), *hashes, F.length("text").cast("bigint").alias("chars"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv, pos, a, b, chars), a and b naming position and turn; and (conv, length) of every conversation.

    With h = crc32(conv as text) % 6: the first h turns of conversation conv - conv % 100, then one's own after the first h.
    """
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    convs = sizes.select("conv", "own", h.alias("h"), (F.col("conv") - F.col("conv") % 100).alias("base"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_own", F.lit(0))))
    heads = turns.where("pos <= 5").withColumnRenamed("conv", "base")
    head = convs.where("head > 0").join(heads, "base").where("pos <= h").select("conv", "pos", "h1", "h2", "chars")
    tail = turns.join(convs.select("conv", "h", "head"), "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "h1", "h2", "chars")
    rows = head.unionAll(tail).select("conv", "pos", F.xxhash64("pos", "h1").alias("a"), F.xxhash64("pos", "h2").alias("b"), "chars")
    return rows, convs.select("conv", (F.col("head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length"))


class Shard:
    """Parts of conversations that are taken together: (depth before it, conv, prefix, whether it ends here, turns)."""

    def __init__(self):
        self.parts, self.turns = [], 0

    def add(self, start, conv, prefix, ends, a, b, chars) -> None:
        self.parts.append((start, conv, prefix, ends, a, b, chars))
        self.turns += len(a)

    def nodes(self) -> list[tuple]:
        """(pre, size, a, b, depth, up_a, up_b, n, least, chars, first_end, ends) of every node, depth first."""
        postings: dict = defaultdict(int)
        longer: dict = defaultdict(int)  # parts with more turns than so many
        roots: dict = defaultdict(int)
        for k, (start, _, prefix, _, a, b, _) in enumerate(self.parts):
            bit = 1 << k
            roots[start, prefix] |= bit
            for j, turn in enumerate(zip(a, b)):
                longer[j] |= bit
                postings[j, turn] |= bit
        out, parents = [], []
        for (start, prefix), members in roots.items():
            stack = [(members, 0, prefix, -1, None, 0)]  # bitset, turns so far, name, node above, name above, last turn's length
            while stack:
                held, j, name, above, up, chars = stack.pop()
                if j:
                    gone = held & ~longer[j]
                    ids = [self.parts[k][1] for k in bits(gone) if self.parts[k][3]] if gone else []
                    least = self.parts[(held & -held).bit_length() - 1][1]
                    node = len(out)
                    out.append([node, 1, *name, start + j, *up, held.bit_count(), least, chars, ids[0] if ids else None, ",".join(map(str, ids)) if ids else None])
                    parents.append(above)
                    above = node
                children, left = [], held & longer[j]
                while left:
                    part = self.parts[(left & -left).bit_length() - 1]
                    turn = part[4][j], part[5][j]
                    child = left & postings[j, turn]
                    children.append((child, j + 1, (name[0] ^ turn[0], name[1] ^ turn[1]), above, name, part[6][j]))
                    left ^= child
                stack.extend(reversed(children))
        for node in range(len(out) - 1, -1, -1):
            if parents[node] >= 0:
                out[parents[node]][1] += out[node][1]
        return out


def bits(x: int) -> list[int]:
    """Numbers of the bits of x, ascending."""
    raw = np.frombuffer(x.to_bytes((x.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()


def sharded_nodes(rows: DataFrame, size: int) -> DataFrame:
    """The nodes of each shard of about ``size`` turns; ``rows``: start (depth before the band), conv, pos, pa, pb (name of the prefix before the band), ends, a, b, chars."""
    order = [F.col("start"), F.col("conv")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order, "pos")

    def table(shard: Shard, number: int) -> pa.RecordBatch:
        found = shard.nodes()
        names = [x.split()[0] for x in _NODES.split(", ")]
        kinds = [pa.int32() if x.endswith(" int") else pa.string() if x.endswith("string") else pa.int64() for x in _NODES.split(", ")]
        columns = [[number] * len(found), *(list(zip(*found)) if found else [[]] * (len(names) - 1))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def walk(batches: Iterator[pa.RecordBatch]):
        number, shard, held = TaskContext.get().partitionId() << 32, Shard(), None
        for batch in batches:
            cols = {c: batch[c].to_pylist() for c in batch.schema.names}
            for start, conv, pa_, pb_, ends, a, b, chars in zip(*(cols[c] for c in ("start", "conv", "pa", "pb", "ends", "a", "b", "chars"))):
                if held is None or held[:2] != (start, conv):
                    if held:
                        shard.add(*held)
                        if shard.turns >= size:
                            yield table(shard, number)
                            shard, number = Shard(), number + 1
                    held = (start, conv, (pa_, pb_), ends, [], [], [])
                held[4].append(a)
                held[5].append(b)
                held[6].append(chars)
        if held:
            shard.add(*held)
            yield table(shard, number)

    return placed.mapInArrow(walk, _NODES)


def subtree_sums(weighted: DataFrame) -> DataFrame:
    """(a, b, leaves, saved) of every node of every shard: its subtree's weights; ``weighted``: shard, pre, size, a, b, leaves, saved."""

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("pre")
        pre, size = table["pre"].to_numpy(), table["size"].to_numpy()
        sums = {c: np.concatenate(([0], np.cumsum(table[c].to_numpy()))) for c in ("leaves", "saved")}
        return pa.table({"a": table["a"], "b": table["b"], **{c: pa.array(s[pre + size] - s[pre]) for c, s in sums.items()}})

    return weighted.groupBy("shard").applyInArrow(add, "a bigint, b bigint, leaves bigint, saved bigint")


def end_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256); ``ends``: a, b, first_end, ends, parts whose ids do not interleave."""
    placed = ends.repartition("a", "b").sortWithinPartitions("a", "b", "first_end")

    def stream(batches: Iterator[pa.RecordBatch]):
        now, state = None, None
        for batch in batches:
            done = []
            for a, b, text in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["ends"].to_pylist()):
                if (a, b) != now:
                    if now:
                        done.append((*now, state.hexdigest()))
                    now, state = (a, b), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield result(done)
        if now:
            yield result([(*now, state.hexdigest())])

    def result(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["a", "b", "ends_sha256"])

    return placed.select("a", "b", "ends").mapInArrow(stream, "a bigint, b bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard: int = SHARD, band_size: int = BAND) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the rebuilt conversations' trie."""
    scratch = Scratch(conversations.sparkSession)
    turns = scratch.keep(hashed_turns(conversations), "turns")
    rows, convs = rebuilt(turns)
    rows, convs = scratch.keep(rows.withColumn("band", F.floor((F.col("pos") - 1) / band_size).cast("int")), "rebuilt"), scratch.keep(convs, "convs")
    bands = rows.groupBy("conv", "band").agg(F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))
    # Names of what is before each band; a conversation of n turns has n / BAND rows here.
    later = rows.where("band > 0").select("conv").distinct()
    before = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    starts = bands.join(later, "conv", "left_semi").select("conv", "band", F.bit_xor("xa").over(before).alias("pa"), F.bit_xor("xb").over(before).alias("pb"))
    starts = scratch.keep(starts.where("band > 0"), "starts")
    zero = F.lit(0).cast("bigint")
    parts = rows.join(starts, ["conv", "band"], "left").join(convs, "conv").select(
        (F.col("band") * F.lit(band_size).cast("bigint")).alias("start"), "conv", "pos", F.coalesce("pa", zero).alias("pa"), F.coalesce("pb", zero).alias("pb"), (F.col("length") <= (F.col("band") + 1) * F.lit(band_size).cast("bigint")).alias("ends"), "a", "b", "chars"
    )
    local = scratch.keep(sharded_nodes(parts, shard), "shards")

    nodes = local.groupBy("a", "b").agg(
        F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), *[F.first(c).alias(c) for c in ("depth", "up_a", "up_b", "chars")]
    )
    nodes = scratch.keep(nodes, "nodes")
    children = nodes.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    known = scratch.keep(
        nodes.join(children, ["a", "b"], "left").select(
            "*", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("save")
        ),
        "known",
    )
    # What a conversation's own nodes in later bands weigh hangs on its last node of the band before.
    band = F.floor((F.col("depth") - 1) / band_size).cast("int")
    own = known.select(F.col("conv_id").alias("conv"), band.alias("band"), "leaf", "save").groupBy("conv", "band").agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    onward = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    after = starts.join(own, ["conv", "band"], "left").select("pa", "pb", F.sum("leaf").over(onward).alias("leaf"), F.sum("save").over(onward).alias("save"))
    hung = after.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.sum("leaf").alias("more_leaves"), F.sum("save").alias("more_saved"))
    weights = known.join(hung, ["a", "b"], "left").select(
        "a", "b", "conv_id", *[(F.col(x) + F.coalesce(y, zero)).alias(z) for x, y, z in (("leaf", "more_leaves", "leaves"), ("save", "more_saved", "saved"))]
    )
    weighted = local.select("shard", "pre", "size", "a", "b", "least").join(weights, ["a", "b"]).select(
        "shard", "pre", "size", "a", "b", *[F.when(F.col("least") == F.col("conv_id"), F.col(c)).otherwise(zero).alias(c) for c in ("leaves", "saved")]
    )
    sums = subtree_sums(weighted).groupBy("a", "b").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    shas = end_hashes(local.where("ends is not null").select("a", "b", "first_end", "ends"))
    above = known.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent"))
    smallest = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    inner = (
        known.join(sums, ["a", "b"]).join(shas, ["a", "b"], "left").join(above, ["up_a", "up_b"], "left")
        .select(
            "conv_id", "depth", F.when(F.col("depth") == 1, F.lit(smallest.conv_id)).otherwise(F.col("parent")).cast("bigint").alias("parent_conv_id"), "n_convs",
            F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )
    empty = convs.where("length = 0").select(zero.alias("a"), zero.alias("b"), F.col("conv").alias("first_end"), F.col("conv").cast("string").alias("ends"))
    total = known.agg(
        F.coalesce(F.sum((F.col("depth") == 1).cast("bigint")), zero).alias("n_children"), F.coalesce(F.sum("leaf"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("save"), zero).alias("saved_tokens")
    )
    root = total.where(F.lit(bool(smallest.n_convs))).join(end_hashes(empty).select("ends_sha256"), F.lit(True), "left").select(
        F.lit(smallest.conv_id).cast("bigint").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(smallest.n_convs).cast("bigint").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    return inner.unionAll(root)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie(read(spark, sf_dir, "conversations"))


SQL = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (  -- h: crc32 of the id's digits, a byte at a time, eight steps for each bit
  SELECT c, max(pos) AS n, c - c % 100 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM t GROUP BY c),
rebuilt AS (
  SELECT s.c, t.pos, t.r, t.x FROM s JOIN t ON t.c = s.base AND t.pos <= s.h
  UNION ALL
  SELECT s.c, t.pos - s.h + least(s.h, coalesce(b.n, 0)), t.r, t.x FROM s LEFT JOIN s AS b ON b.c = s.base JOIN t ON t.c = s.c AND t.pos > s.h),
member AS (
  SELECT c, pos AS depth, length(x) AS chars, string_agg(to_json([r, x])::VARCHAR, ',') OVER (PARTITION BY c ORDER BY pos) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM s),
total AS (SELECT c, max(depth) AS depth FROM member GROUP BY c),
node AS (
  SELECT m.path, m.depth, min(m.c) AS conv_id, count(*) AS n_convs, any_value(m.chars) AS chars,
         coalesce(string_agg(m.c::VARCHAR, ',' ORDER BY m.c) FILTER (WHERE l.depth = m.depth), '') AS ends
  FROM member m JOIN total l ON l.c = m.c GROUP BY m.path, m.depth),
up AS (SELECT n.path, p.path AS parent, q.conv_id AS parent_conv_id FROM node n JOIN member p ON p.c = n.conv_id AND p.depth = n.depth - 1 JOIN node q ON q.path = p.path AND q.depth = p.depth),
kids AS (SELECT parent AS path, count(*) AS n_children FROM up GROUP BY parent),
below AS (
  SELECT a.path, sum((k.path IS NULL)::BIGINT) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM node n JOIN member a ON a.c = n.conv_id AND a.depth <= n.depth LEFT JOIN kids k ON k.path = n.path GROUP BY a.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n LEFT JOIN up ON up.path = n.path LEFT JOIN kids k ON k.path = n.path JOIN below b ON b.path = n.path
"""
