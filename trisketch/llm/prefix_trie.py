"""Trie of the prefixes that conversations share, by vertical bitmaps.

A turn is kept as a 128-bit digest of its role and text. Conversations are dealt to shards of about
SHARD, and turns to segments of SEGMENT depths, so that what meets in a task is bounded for hot
texts and for long conversations alike. A shard indexes (position, turn) to a bitset of its
conversations; from the root on, the bitset of a node is intersected with the postings of the next
position, which gives children, popcounts and the ends of conversations. Nodes of all shards are
added up by a 128-bit digest of their path.

Sums over subtrees need no rounds by depth: a node belongs to its smallest member, so every
conversation owns a chain of nodes from some depth down. A chain counts in the suffixes of itself
and in each node above it, which are the nodes that hold its owner and belong to others.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisketch.session import materialize

SHARD = 1024
SEGMENT = 256
WORD = r"[^\x20\x09-\x0D]+"
HOT_CHILDREN = 10_000
"""A parent with more children than this, and than one in so many of all nodes, is broadcast: at
most so many parents can be."""
NODE, PARENT = ["hi", "lo"], ["parent_hi", "parent_lo"]
ROOT = bytes(16)
_PAIR = struct.Struct(">qq")


def _children_of(node: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(node + turn).digest()[:16]


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, n_words), places from 0 by turn, null first, equal ones by digest.

    Null roles and texts are empty; rows without conv_id belong to no conversation and are left
    out; repeated rows are turns of their own. Texts go no further than this.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("number"),
        F.substring(digest, 1, 16).alias("turn"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"),
    )
    place = F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY number ASC NULLS FIRST, turn) - 1")
    return rows.select("conv_id", place.cast("bigint").alias("place"), "turn", "n_words")


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turn, n_words, ends) from (conv_id, place, turn, n_words).

    Depth 0 is the root: a conversation is given there by a row without a turn, whose place
    precedes all others. The row of a conversation's greatest depth ends it.
    """
    over = "OVER (PARTITION BY conv_id ORDER BY place)"
    return turns.select(
        "conv_id",
        F.expr(f"CAST(row_number() {over} - 1 AS BIGINT)").alias("depth"),
        "turn",
        "n_words",
        F.expr(f"lead(place) {over} IS NULL").alias("ends"),
    )


def rebuilt(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Paths of all conversations after each took over the beginning of the first of its family.

    Conversation c begins with the first h turns of c - c % family and goes on with its own after
    its first h, where h is crc32(c) % most.
    """
    own = materialize(turns_in_order(conversations), "turns")
    h = F.crc32(F.col("conv_id").cast("string")) % most
    head = F.struct("place", "turn", "n_words")
    heads = (
        own.where((F.col("conv_id") % family == 0) & (F.col("place") < most - 1))
        .groupBy(F.col("conv_id").alias("first"))
        .agg(F.sort_array(F.collect_list(head)).alias("heads"))
    )
    convs = own.select("conv_id").distinct()
    taken = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("first"), h.alias("h"))
    taken = taken.where("h > 0").join(heads, "first").select("conv_id", F.inline(F.slice("heads", F.lit(1), F.col("h").cast("int"))))
    roots = convs.selectExpr("conv_id", "-1L AS place", "CAST(null AS BINARY) AS turn", "0L AS n_words")
    return paths(roots.unionByName(taken).unionByName(own.where(F.col("place") >= h)))


def _starts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (conv_id, depth): the node before each segment of `size` depths but the first."""
    conv, node = None, ROOT
    for batch in batches:
        out = []
        for c, depth, turn in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if c != conv:
                conv, node = c, ROOT
            if depth and depth % size == 0:
                out.append((c, depth // size, node))
            if depth:
                node = _children_of(node, turn)
        columns = zip(*out, strict=True) if out else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["conv_id", "segment", "start"])


def _segments(paths: DataFrame, size: int) -> DataFrame:
    """The paths with their segment and the node before it; conversations of one segment have the root."""
    rows = paths.withColumn("segment", F.expr(f"depth div {size}"))
    long = rows.where("segment > 0")
    of_long = rows.join(long.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "depth", "turn")
    ordered = of_long.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    starts = ordered.mapInArrow(lambda s: _starts(s, size), "conv_id long, segment long, start binary")
    first = rows.where("segment = 0").withColumn("start", F.lit(bytearray(ROOT)))
    return first.unionByName(long.join(starts, ["conv_id", "segment"]))


class _Index:
    """Bitsets of a shard's conversations, one bit for each in ascending order of conv_id."""

    def __init__(self, table: pa.Table):
        convs = table["conv_id"].to_numpy()
        self.ids = np.unique(convs)
        self.postings: dict[tuple[int, bytes], int] = {}
        self.alive: dict[int, int] = {}
        self.ending: dict[int, int] = {}
        self.turn_at: dict[tuple[int, int], bytes] = {}
        self.words: dict[bytes, int] = {}
        self.starts: dict[bytes, int] = {}
        places = np.searchsorted(self.ids, convs).tolist()
        columns = (table[c].to_pylist() for c in ("depth", "turn", "n_words", "ends", "start"))
        for place, depth, turn, words, ends, start in zip(places, *columns, strict=True):
            bit = 1 << place
            self.starts[start] = self.starts.get(start, 0) | bit
            if ends:
                self.ending[depth] = self.ending.get(depth, 0) | bit
            if depth:
                key = depth, turn
                self.postings[key] = self.postings.get(key, 0) | bit
                self.alive[depth] = self.alive.get(depth, 0) | bit
                self.turn_at[depth, place] = turn
                self.words[turn] = words

    def members(self, bits: int) -> list[int]:
        if bits & (bits - 1) == 0:
            return [int(self.ids[bits.bit_length() - 1])] if bits else []
        raw = np.frombuffer(bits.to_bytes(len(self.ids) // 8 + 1, "little"), np.uint8)
        return self.ids[np.flatnonzero(np.unpackbits(raw, count=len(self.ids), bitorder="little"))].tolist()

    def row(self, node: bytes, parent: bytes | None, depth: int, bits: int, words: int) -> tuple:
        above = (None, None) if parent is None else _PAIR.unpack(parent)
        members, ends = self.members(bits), self.members(bits & self.ending.get(depth, 0))
        return *_PAIR.unpack(node), *above, depth, words, members, ends

    def nodes(self, segment: int, size: int) -> Iterator[tuple]:
        first = segment * size
        if segment == 0:
            yield self.row(ROOT, None, 0, self.starts[ROOT], 0)
            first = 1
        stack = [(start, first, bits) for start, bits in self.starts.items()]
        while stack:
            parent, depth, rest = stack.pop()
            rest &= self.alive.get(depth, 0)
            while rest:
                turn = self.turn_at[depth, (rest & -rest).bit_length() - 1]
                bits = rest & self.postings[depth, turn]
                rest ^= bits
                node = _children_of(parent, turn)
                yield self.row(node, parent, depth, bits, self.words[turn])
                if depth + 1 < (segment + 1) * size:
                    stack.append((node, depth + 1, bits))


SHARD_SCHEMA = (
    "hi long, lo long, parent_hi long, parent_lo long, depth long, n_words long, members array<long>, ends array<long>"
)


def _shard_nodes(key: tuple, table: pa.Table, segment: int) -> pa.Table:
    rows = list(_Index(table).nodes(key[1].as_py(), segment))
    kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] * 2
    names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def shard_nodes(paths: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> DataFrame:
    """The nodes of every shard with their members and those that end there; a written table.

    The first family member and those who took over its beginning are likely neighbours in the id
    space, so runs of 32 ids go to a shard together.
    """
    paths = materialize(paths, "paths")
    shards = paths.where("depth = 0").count() // shard + 1
    dealt = _segments(paths, segment).withColumn("shard", F.pmod(F.xxhash64(F.shiftright("conv_id", 5)), F.lit(shards)))

    def nodes(key: tuple, table: pa.Table) -> pa.Table:
        return _shard_nodes(key, table, segment)

    return materialize(dealt.groupBy("shard", "segment").applyInArrow(nodes, SHARD_SCHEMA), "shard-nodes")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (hi, lo, conv_id): runs of one node as text, ids joined by commas."""
    for batch in batches:
        out = []
        rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
        for node, run in itertools.groupby(rows, lambda r: r[:2]):
            ids = [r[2] for r in run]
            out.append((*node, ids[0], ",".join(map(str, ids))))
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], [*NODE, "first", "piece"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted by (hi, lo, first): the digest of each node's pieces, joined by commas."""
    names, kinds = [*NODE, "ends_sha256"], (pa.int64(), pa.int64(), pa.string())
    node, digest = None, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        out = []
        for hi, lo, piece in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
            if (hi, lo) == node:
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (hi, lo), hashlib.sha256()
            digest.update(piece.encode())
        yield batch_of(out)
    if node:
        yield batch_of([(*node, digest.hexdigest())])


def ends(shards: DataFrame) -> DataFrame:
    """(hi, lo, conv_id) of every conversation and the node at which it ends."""
    return shards.select(*NODE, F.explode("ends").alias("conv_id"))


def end_digests(shards: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256) of the nodes at which conversations end.

    Ids are sorted over all nodes at once, so tasks share the list of a hot node and turn it into
    pieces of text; the digest, which is one chain, then streams over the pieces alone.
    """
    ordered = ends(shards).repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = ordered.mapInArrow(_pieces, "hi long, lo long, first long, piece string")
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return pieces.mapInArrow(_digests, "hi long, lo long, ends_sha256 string")


def _merged(shards: DataFrame) -> DataFrame:
    """One row per node: (hi, lo, parent, depth, conv_id, n_convs, n_children, leaf, saved)."""
    nodes = shards.groupBy(*NODE).agg(
        F.max("parent_hi").alias("parent_hi"),
        F.max("parent_lo").alias("parent_lo"),
        F.max("depth").alias("depth"),
        F.min(F.expr("members[0]")).alias("conv_id"),
        F.sum(F.size("members").cast("bigint")).alias("n_convs"),
        F.max("n_words").alias("n_words"),
    )
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(*PARENT).agg(F.count("*").alias("n_children"))
    children = children.withColumnsRenamed(dict(zip(PARENT, NODE, strict=True)))
    joined = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    saved = (F.col("n_convs") - 1) * F.col("n_words")
    return materialize(
        joined.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "saved": saved}), "trie-children"
    )


def _subtrees(nodes: DataFrame, shards: DataFrame) -> DataFrame:
    """(hi, lo, n_leaves, saved_tokens): sums over the subtrees of all nodes."""
    down = "OVER (PARTITION BY conv_id ORDER BY depth DESC ROWS UNBOUNDED PRECEDING)"
    own = nodes.select(*NODE, *[F.expr(f"sum({x}) {down}").alias(x) for x in ("leaf", "saved")])
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    members = shards.select(*NODE, "depth", F.explode("members").alias("conv_id"))
    above = members.join(chains.hint("merge"), "conv_id").where("depth < top").select(*NODE, "leaf", "saved")
    return own.unionByName(above).groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def _parents(nodes: DataFrame) -> DataFrame:
    """(hi, lo, parent_conv_id) of all nodes but the root."""
    limit = max(HOT_CHILDREN, nodes.count() // HOT_CHILDREN)
    names = dict(zip(NODE, PARENT, strict=True)) | {"conv_id": "parent_conv_id"}
    parents = nodes.select(*NODE, "conv_id", "n_children").withColumnsRenamed(names)
    hot = F.broadcast(parents.where(F.col("n_children") > limit).drop("n_children"))
    rest = parents.where(F.col("n_children").between(1, limit)).drop("n_children")
    below = nodes.where("depth > 0").select(*NODE, *PARENT)
    few = below.join(hot, PARENT, "left_anti").join(rest.hint("merge"), PARENT)
    return below.join(hot, PARENT).unionByName(few).select(*NODE, "parent_conv_id")


def prefix_trie(paths: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> DataFrame:
    """One row per distinct prefix of the paths, from (conv_id, depth, turn, n_words, ends).

    (conv_id, depth) tells a node: its smallest member and its length. Further (hi, lo), the digest
    of its path; parent_conv_id, null at the root; n_convs, members; n_children; n_leaves, childless
    nodes of its subtree; saved_tokens, over its subtree the words of a node's turn times its
    members but one; ends_sha256, of the sorted ids that end there, joined by commas. A repeated row
    of the paths is not allowed; no paths give no rows, not even the root.
    """
    shards = shard_nodes(paths, shard, segment)
    nodes = _merged(shards)
    rows = nodes.drop(*PARENT, "leaf", "saved", "n_words").join(_subtrees(nodes, shards).hint("merge"), NODE)
    rows = rows.join(_parents(nodes).hint("merge"), NODE, "left").join(end_digests(shards).hint("merge"), NODE, "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    return rows.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        *NODE,
    )
