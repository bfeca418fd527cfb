"""Jaccard self-join of documents on their five-word shingles, by several global token orders.

Two documents link if their sets A, B of distinct shingles have 100 |A & B| >= 75 |A | B|. In any
one order of all shingles, such sets share a shingle among the first n - ceil(0.75 n) + 1 of each.
Every order used here puts shingles that only one document has first, then the repeated ones, rare
ones before common ones, with a hash of its own among equals; so a document whose prefix holds unique shingles only can link with none, and
is out before any pair is made. A candidate must share prefix shingles under each of the orders,
then it is verified on the sets.

Steps: equal sets become one class; repeated shingles are found through packed, hash-partitioned
shingles; of the surviving classes, those that share enough shingles with other survivors post their
prefixes and fall into groups that share lists. A small
group is compared within one task. The classes of a large one are first compared with a leader,
one comparison per member; what that connects is not compared again. Then all of them are posted
under every order. Short lists emit pairs, which must come from each order to be verified; only
classes that meet in a long list are compared block by block. So groups that grow by chains of
short lists cost in proportion to their postings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisketch.llm import words as w
from trisketch.llm.components import components
from trisketch.llm.keys import with_keys
from trisketch.llm.substring_dedup import bucket_count
from trisketch.session import materialize

SHINGLE = 5
ORDERS = 3
RUN_BYTES = 4 << 20
BROADCAST_ROWS = 1_000_000
HOT = 1000
BLOCK = 256
"""Sets of a group that are compared within one task, and of each block of a larger group."""
COLUMNS = 16_384
LIST = 64
"""Classes of a list that emits pairs; a posting meets fewer than this many others."""

PACKED = "place int, docs boolean, keys binary, sizes binary, counts binary, tokens binary"


def _sets(words: w.Words) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted within the text, and their numbers."""
    counts = words.counts

    def shingles(n: int, some: slice = slice(None)) -> np.ndarray:
        """64 bits made of both lanes of the words, which only together tell words apart."""
        return w.mixed(w.grams(words.hash[some], n) ^ w.mixed(w.grams(words.second[some], n), n), n)

    five = shingles(SHINGLE)
    parts = []
    for a, n in zip(words.bounds[:-1].tolist(), counts.tolist(), strict=True):
        if n >= SHINGLE:
            x = np.sort(five[a : a + n - SHINGLE + 1])
            parts.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif n:
            parts.append(shingles(n, slice(a, a + n)))
        else:
            parts.append(np.zeros(0, np.uint64))
    return np.concatenate(parts), np.array([len(p) for p in parts])


def _set_runs(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in stream:
        for keys, data, offsets in w.chunks(batch.column(0), batch.column(1), RUN_BYTES):
            yield keys, *_sets(w.words_of(data, offsets, lower=True, two=True))


def _signatures(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, tokens, sizes in _set_runs(stream):
        ends = np.cumsum(sizes)
        sums = []
        for seed in (1, 2):
            running = np.concatenate([[np.uint64(0)], np.cumsum(w.mixed(tokens, seed))])
            sums.append((running[ends] - running[ends - sizes]).view(np.int64))
        columns = [pa.array(c, pa.int64()) for c in (keys, sizes, *sums)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "n", "s1", "s2"])


def signatures(keyed: DataFrame) -> DataFrame:
    """(key, n, s1, s2): size and a 128-bit sum of each document's shingle set."""
    return keyed.mapInArrow(_signatures, "key long, n long, s1 long, s2 long")


# ---- repeated shingles -------------------------------------------------------


def _row(place: int, docs: bool, keys, sizes, counts, tokens) -> tuple:
    press = zstandard.ZstdCompressor(level=1).compress
    return (
        int(place),
        docs,
        press(keys.astype(np.int64).tobytes()),
        press(sizes.astype(np.int32).tobytes()),
        press(counts.astype(np.int32).tobytes()),
        tokens.astype(np.uint64).tobytes(),
    )


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress
    return (
        np.frombuffer(plain(row["keys"]), np.int64),
        np.frombuffer(plain(row["sizes"]), np.int32),
        np.frombuffer(plain(row["counts"]), np.int32),
        np.frombuffer(row["tokens"], np.uint64),
    )


PACKED_TYPES = [pa.int32(), pa.bool_(), *[pa.binary()] * 4]
PACKED_NAMES = ["place", "docs", "keys", "sizes", "counts", "tokens"]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(PACKED_TYPES)]


def _cut(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of equal values in a sorted array."""
    if not len(values):
        return iter(())
    bounds = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])).tolist()
    return zip(bounds[:-1], bounds[1:], strict=True)


def _place(x: np.ndarray, buckets: int) -> np.ndarray:
    return (w.mixed(x.astype(np.uint64), 11) % np.uint64(buckets)).astype(np.int64)


def _spread(stream: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """One entry per distinct shingle of a run of texts goes to the shingle's bucket, with one
    text that has it. What several texts of the run have is known as repeated already.
    """
    for keys, tokens, sizes in _set_runs(stream):
        if not len(tokens):
            continue
        owner = np.repeat(np.arange(len(keys)), sizes)
        order = np.argsort(tokens, kind="stable")
        sorted_tokens = tokens[order]
        new = np.concatenate([[True], sorted_tokens[1:] != sorted_tokens[:-1]])
        more = np.concatenate([~new[1:], [False]]) | ~new
        known = np.zeros(len(tokens), bool)
        known[order[more]] = True
        own = np.add.reduceat(known.astype(np.int32), (np.cumsum(sizes) - sizes)[sizes > 0])
        counts = np.zeros(len(keys), np.int32)
        counts[sizes > 0] = own
        rows = [_row(int(_place(keys[:1], buckets)[0]), True, keys, sizes, counts, tokens[known])]
        sent = np.sort(order[new])
        place = _place(tokens[sent], buckets)
        sent = sent[np.argsort(place, kind="stable")]
        place = np.sort(place)
        for a, b in _cut(place):
            holder = owner[sent[a:b]]
            starts = np.array([i for i, _ in _cut(holder)])
            counts = np.diff(np.append(starts, b - a))
            rows.append(_row(place[a], False, keys[holder[starts]], counts, counts, tokens[sent[a:b]]))
        yield pa.RecordBatch.from_arrays(_columns(rows), PACKED_NAMES)


def _matched(bucket: pa.Table, buckets: int) -> pa.Table:
    """Sends each repeated shingle of a bucket back towards the texts that have it."""
    owners, tokens, docs = [], [], []
    for row in bucket.to_pylist():
        keys, sizes, counts, t = _unpacked(row)
        if row["docs"]:
            docs.append((keys, sizes, counts, t))
        else:
            owners.append(np.repeat(keys, counts))
            tokens.append(t)
    rows = []
    if tokens:
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(token, kind="stable")
        same = token[order][1:] == token[order][:-1]
        repeated = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        owner, token = owner[repeated], token[repeated]
        docs.append((owner, np.zeros(len(owner), np.int32), np.ones(len(owner), np.int32), token))
    for keys, sizes, counts, token in docs:
        place = _place(keys, buckets)
        order = np.lexsort((keys, place))
        starts = np.cumsum(counts) - counts
        for a, b in _cut(place[order]):
            some = order[a:b]
            inside = w.places(counts[some], starts[some])
            rows.append(_row(place[some[0]], True, keys[some], sizes[some], counts[some], token[inside]))
    return pa.table(_columns(rows), PACKED_NAMES)


def prefix_length(n: int) -> int:
    """n - ceil(0.75 n) + 1."""
    return n - -(-3 * n // 4) + 1


def _survivors(place: pa.Table) -> pa.Table:
    """Documents whose prefix reaches into their repeated shingles, with these, sorted."""
    keys, sizes, tokens, owners = [], [], [], []
    for row in place.to_pylist():
        k, n, counts, t = _unpacked(row)
        keys.append(k[n > 0])
        sizes.append(n[n > 0])
        owners.append(np.repeat(k, counts))
        tokens.append(t)
    out = []
    size_of = dict(zip(np.concatenate(keys).tolist(), np.concatenate(sizes).tolist(), strict=True))
    owner, token = np.concatenate(owners), np.concatenate(tokens)
    order = np.lexsort((token, owner))
    owner, token = owner[order], token[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])])[: len(owner)]
    owner, token = owner[new], token[new]
    if len(owner):
        for a, b in _cut(owner):
            n = size_of[int(owner[a])]
            if n - (b - a) < prefix_length(n):
                out.append((int(owner[a]), n, b - a, token[a:b].tobytes()))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["key", "n", "r", "tokens"])


def survivors(keyed: DataFrame, buckets: int) -> DataFrame:
    """(key, n, r, tokens): documents that can link, with their r repeated shingles."""
    sent = keyed.mapInArrow(lambda stream: _spread(stream, buckets), PACKED)
    matched = sent.groupBy("place").applyInArrow(lambda t: _matched(t, buckets), PACKED)
    return matched.groupBy("place").applyInArrow(_survivors, "key long, n long, r long, tokens binary")


# ---- ranks -------------------------------------------------------------------


def hot_shingles(classes: DataFrame) -> np.ndarray:
    """Shingles in at least one of HOT classes (and in 64), sorted: HOT times the mean set size at most."""
    least = max(64, classes.count() // HOT)
    counts = classes.mapInArrow(_token_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= least).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().view(np.uint64))


def _token_counts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each shingle, summed over a batch."""
    for batch in stream:
        if batch.num_rows:
            tokens = np.frombuffer(b"".join(t.as_py() for t in batch.column(3)), np.int64)
            values, n = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], ["token", "n"])


def _among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(tokens), bool)
    return known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens


def _asked(stream: Iterator[pa.RecordBatch], buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sends each shingle of a surviving class, but for the hot ones, to the shingle's bucket."""
    for batch in stream:
        if not batch.num_rows:
            continue
        keys, sizes, counts = (batch.column(i).to_numpy() for i in range(3))
        tokens = np.frombuffer(b"".join(t.as_py() for t in batch.column(3)), np.uint64)
        owner = np.repeat(np.arange(len(keys)), counts)
        known = _among(tokens, hot)
        own = np.bincount(owner[known], minlength=len(keys))
        rows = [_row(int(_place(keys[:1], buckets)[0]), True, keys, sizes, own, tokens[known])]
        owner, tokens = owner[~known], tokens[~known]
        place = _place(tokens, buckets)
        order = np.argsort(place, kind="stable")
        owner, tokens, place = owner[order], tokens[order], place[order]
        for a, b in _cut(place):
            starts = np.array([i for i, _ in _cut(owner[a:b])])
            n = np.diff(np.append(starts, b - a))
            rows.append(_row(place[a], False, keys[owner[a:b][starts]], n, n, tokens[a:b]))
        yield pa.RecordBatch.from_arrays(_columns(rows), PACKED_NAMES)


RANKED = PACKED + ", ranks binary"


def _ranked(bucket: pa.Table, buckets: int) -> pa.Table:
    """Sends each shingle back with its rank: eight times the logarithm of the classes that have it."""
    docs, owners, tokens = [], [], []
    for row in bucket.to_pylist():
        keys, sizes, counts, t = _unpacked(row)
        if row["docs"]:
            docs.append((keys, sizes, counts, t, np.full(len(t), 255, np.uint8)))
        else:
            owners.append(np.repeat(keys, counts))
            tokens.append(t)
    if tokens:
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        _, inverse, n = np.unique(token, return_inverse=True, return_counts=True)
        rank = np.minimum(np.floor(8 * np.log2(n)), 254).astype(np.uint8)[inverse]
        docs.append((owner, np.zeros(len(owner), np.int32), np.ones(len(owner), np.int32), token, rank))
    rows, ranks = [], []
    for keys, sizes, counts, token, rank in docs:
        place = _place(keys, buckets)
        order = np.lexsort((keys, place))
        starts = np.cumsum(counts) - counts
        for a, b in _cut(place[order]):
            some = order[a:b]
            inside = w.places(counts[some], starts[some])
            rows.append(_row(place[some[0]], True, keys[some], sizes[some], counts[some], token[inside]))
            ranks.append(rank[inside].tobytes())
    return pa.table([*_columns(rows), pa.array(ranks, pa.binary())], [*PACKED_NAMES, "ranks"])


def _assembled(place: pa.Table) -> pa.Table:
    """The classes of one place with the shingles that another class has too, sorted, and the ranks of these.

    Rank 0 is a single class; the others of such a shingle are copies or did not survive. So it counts as
    unique from here on, and a class whose prefix holds unique shingles only can link with none.
    """
    owners, tokens, ranks, size_of = [], [], [], {}
    for row in place.to_pylist():
        keys, sizes, counts, t = _unpacked(row)
        size_of.update(zip(keys[sizes > 0].tolist(), sizes[sizes > 0].tolist(), strict=True))
        owners.append(np.repeat(keys, counts))
        tokens.append(t)
        ranks.append(np.frombuffer(row["ranks"], np.uint8))
    owner, token, rank = (np.concatenate(x) for x in (owners, tokens, ranks))
    order = np.lexsort((token, owner))
    order = order[rank[order] > 0]
    owner, token, rank = owner[order], token[order], rank[order]
    out = []
    for a, b in _cut(owner):
        n = size_of[int(owner[a])]
        if n - (b - a) < prefix_length(n):
            out.append((int(owner[a]), n, b - a, token[a:b].tobytes(), rank[a:b].tobytes()))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["key", "n", "r", "tokens", "ranks"])


def ranked_classes(classes: DataFrame, buckets: int) -> DataFrame:
    """(key, n, r, tokens, ranks): the classes that can link, with a rank for each of their r shared shingles.

    Hot shingles, a bounded set, have the last rank and are not sent to be counted.
    """
    hot = classes.sparkSession.sparkContext.broadcast(hot_shingles(classes))
    asked = classes.mapInArrow(lambda s: _asked(s, buckets, hot.value), PACKED)
    ranked = asked.groupBy("place").applyInArrow(lambda t: _ranked(t, buckets), RANKED)
    schema = "key long, n long, r long, tokens binary, ranks binary"
    return ranked.groupBy("place").applyInArrow(_assembled, schema)


# ---- candidates --------------------------------------------------------------


def _prefix(tokens: np.ndarray, ranks: np.ndarray, n: int, order: int) -> np.ndarray:
    """The repeated shingles in the prefix under one order. Unique ones come before them; among
    the repeated ones those of fewer classes come first, and equal ranks are ordered by hash.
    """
    size = prefix_length(n) - (n - len(tokens))
    if size >= len(tokens):
        return tokens
    rank = (ranks.astype(np.uint64) << np.uint64(56)) | (w.mixed(tokens, 100 + order) >> np.uint64(8))
    return tokens[np.argpartition(rank, size - 1)[:size]]


def _set_of(n: int, tokens: pa.Scalar, ranks: pa.Scalar) -> tuple[int, np.ndarray, np.ndarray]:
    return int(n), np.frombuffer(tokens.as_py(), np.uint64), np.frombuffer(ranks.as_py(), np.uint8)


def _postings(stream: Iterator[pa.RecordBatch], orders: int = 1) -> Iterator[pa.RecordBatch]:
    """The repeated shingles of each class's prefix under each order; other columns go along."""
    for batch in stream:
        names = [x for x in batch.schema.names if x not in ("tokens", "ranks")]
        n = batch.column("n").to_pylist()
        sets = [_set_of(*x) for x in zip(n, batch.column("tokens"), batch.column("ranks"), strict=True)]
        for order in range(orders if sets else 0):
            lists = [_prefix(tokens, ranks, m, order) for m, tokens, ranks in sets]
            each = np.array([len(x) for x in lists])
            columns = [pa.array(np.full(each.sum(), order, np.int32)), pa.array(np.concatenate(lists).view(np.int64))]
            columns += [pa.array(np.repeat(batch.column(x).to_numpy(), each), pa.int64()) for x in names]
            yield pa.RecordBatch.from_arrays(columns, ["ordering", "token", *names])


def _shared(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Numbers of common tokens of each set of `one` with each of `two`, from 0/1 matrices."""
    tokens = np.concatenate([*one, *two])
    values, inverse, n = np.unique(tokens, return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    column[n == 1] = -1
    column = column[inverse]
    sizes = [len(x) for x in (*one, *two)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    row, column = row[column >= 0], column[column >= 0]
    total = np.zeros((len(one), len(two)), np.float32)
    width = int((n > 1).sum())
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sizes), min(COLUMNS, width - low)), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        total += part[: len(one)] @ part[len(one) :].T
    return total.astype(np.int64)


def _links_between(one: list[tuple], two: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the linked pairs of sets (n, tokens, ranks): candidates under every order, verified."""
    na, nb = (np.array([x[0] for x in side], np.int64) for side in (one, two))
    candidate = 4 * np.minimum(na[:, None], nb) >= 3 * np.maximum(na[:, None], nb)
    for order in range(ORDERS):
        if candidate.any():
            prefixes = [[_prefix(t, ranks, n, order) for n, t, ranks in side] for side in (one, two)]
            candidate &= _shared(*prefixes) > 0
    if not candidate.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = _shared([x[1] for x in one], [x[1] for x in two])
    return np.nonzero(candidate & (100 * both >= 75 * (na[:, None] + nb - both)))


def _compared(task: pa.Table) -> pa.Table:
    """Links among the groups of one task: of all sets of a group, or of two blocks of it.

    Only links that connect something new here are returned, so at most one per set.
    """
    group = task.column("group").to_numpy()
    keys, n, tokens = task.column("key").to_numpy(), task.column("n").to_numpy(), task.column("tokens")
    ranks = task.column("ranks")
    sides = task.column("side").to_numpy()
    order = np.argsort(group, kind="stable")
    links = []
    for a, b in _cut(group[order]):
        rows = order[a:b]
        left, right = rows[sides[rows] == 0], rows[sides[rows] == 1]
        right = right if len(right) else left
        sets = [[_set_of(n[i], tokens[int(i)], ranks[int(i)]) for i in side] for side in (left, right)]
        parent: dict[int, int] = {}

        def find(x: int, parent=parent) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i, j in zip(*(x.tolist() for x in _links_between(*sets)), strict=True):
            u, v = int(keys[left[i]]), int(keys[right[j]])
            x, y = find(u), find(v)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((u, v))
    return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})


def _can_link(na: Column, ra: Column, nb: Column, rb: Column) -> Column:
    """Only repeated shingles can be shared: 100 m >= 75 (na + nb - m) for m = min(ra, rb)."""
    return 7 * F.least(ra, rb) >= 3 * (na + nb)


POSTING = "ordering int, token long, key long, n long, r long"


def _listed(classes: DataFrame, placed: DataFrame) -> DataFrame:
    """Postings of the placed classes under every order, with the length m of their list, if over one."""
    chosen = classes.join(placed.select("key", "component"), "key")
    posted = materialize(
        chosen.mapInArrow(lambda s: _postings(s, ORDERS), f"{POSTING}, component long"), "all-postings"
    )
    lengths = posted.groupBy("ordering", "token").agg(F.count("*").alias("m")).where("m > 1")
    return materialize(posted.join(lengths, ["ordering", "token"]), "lists")


def _candidates(listed: DataFrame) -> DataFrame:
    """(key, lead): unconnected pairs that meet in a short list of the first order, and under each
    other one in a short list too, unless both are in long lists there.
    """
    bit = F.expr("shiftleft(1, ordering)")
    long_lists = listed.where(F.col("m") > LIST).groupBy("key").agg(F.bit_or(bit).alias("long_in"))
    short = listed.where(F.col("m") <= LIST).drop("m").join(long_lists, "key", "left").fillna(0, ["long_in"])
    one, two = (short.select("ordering", "token", *[F.col(c).alias(c + x) for c in SIDE]) for x in "12")
    sizes_allow = 4 * F.least("n1", "n2") >= 3 * F.greatest("n1", "n2")
    unconnected = (F.col("key1") < F.col("key2")) & (F.col("component1") != F.col("component2"))
    met = one.join(two, ["ordering", "token"]).where(
        unconnected & sizes_allow & _can_link(F.col("n1"), F.col("r1"), F.col("n2"), F.col("r2"))
    )
    both = F.col("long_in1").bitwiseAND(F.col("long_in2"))
    masks = met.groupBy("key1", "key2").agg(F.bit_or(bit).alias("short_in"), F.max(both).alias("long_in"))
    every = F.col("short_in").bitwiseOR(F.col("long_in")) == (1 << ORDERS) - 1
    found = masks.where((F.col("short_in") % 2 == 1) & every)
    return found.select(F.col("key2").alias("key"), F.col("key1").alias("lead"))


SIDE = ["key", "n", "r", "component", "long_in"]


def _long_groups(listed: DataFrame) -> DataFrame:
    """(key, group): classes that meet in long lists of the first order, directly or by others."""
    long_lists = listed.where((F.col("ordering") == 0) & (F.col("m") > LIST)).select("token", "key")
    heads = long_lists.groupBy("token").agg(F.min("key").alias("v"))
    edges = long_lists.join(heads, "token").select(F.col("key").alias("u"), "v")
    return components(edges).select(F.col("node").alias("key"), F.col("component").alias("group"))


def class_links(classes: DataFrame, buckets: int) -> DataFrame:
    """Enough links (u, v) between classes to connect all that are linked.

    Classes that share prefix lists, directly or by others, form a group; no link leaves it. A
    small group is compared inside one task. In a large one, each class is first compared with
    the leader that it shares most lists with. Unconnected classes that meet in short lists are
    verified pair by pair once all orders agree; those that meet in a long list are compared
    block by block, but for those that are connected already.
    """
    classes = materialize(ranked_classes(classes, buckets), "ranked")
    posted = materialize(classes.mapInArrow(_postings, POSTING), "postings")
    leaders = posted.groupBy("token").agg(F.min(F.struct("n", "key", "r")).alias("lead"), F.count("*").alias("m"))
    starred = posted.join(leaders.where("m > 1"), "token").where(F.col("key") != F.col("lead.key"))
    stars = starred.groupBy("key", "n", "r", "lead").agg(F.count("*").alias("m"))
    stars = materialize(stars, "stars")
    grouped = components(stars.select(F.col("key").alias("u"), F.col("lead.key").alias("v")))
    grouped = grouped.select(F.col("node").alias("key"), F.col("component").alias("group"))
    sizes = grouped.groupBy("group").agg(F.count("*").alias("size"))
    grouped = materialize(grouped.join(sizes, "group"), "groups")
    sets = classes.select("key", "n", "tokens", "ranks")

    small = grouped.where(F.col("size") <= BLOCK).join(sets, "key").select(
        "group", "key", "n", "tokens", "ranks", F.lit(0).alias("side"), F.pmod(F.xxhash64("group"), F.lit(buckets)).alias("task")
    )
    links = small.groupBy("task").applyInArrow(_compared, "u long, v long")

    large = grouped.where(F.col("size") > BLOCK).select("key", "group")
    if large.isEmpty():
        return links
    lead = F.struct("m", F.col("lead.key").alias("k"))
    best = (
        stars.where(_can_link(F.col("n"), F.col("r"), F.col("lead.n"), F.col("lead.r")))
        .join(large, "key", "left_semi")
        .groupBy("key")
        .agg(F.max(lead).alias("best"))
    )
    first = materialize(_led(best.select("key", F.col("best.k").alias("lead")), sets), "links")
    joined = components(first).withColumnRenamed("node", "key")
    placed = large.join(joined, "key", "left").withColumn("component", F.coalesce("component", "key"))
    listed = _listed(classes, placed)
    links = links.unionByName(first).unionByName(_led(materialize(_candidates(listed), "candidates"), sets))
    placed = materialize(placed.drop("group").join(_long_groups(listed), "key"), "long-groups")
    if placed.isEmpty():
        return links
    counts = placed.groupBy("group", "component").agg(F.count("*").alias("s"))
    pool = counts.where(F.col("s") < BLOCK).groupBy("group").agg(F.ceil(F.sum("s") / BLOCK).alias("pools"))
    where = counts.join(pool, "group", "left").select(
        "group",
        "component",
        F.when(F.col("s") >= BLOCK, F.col("component")).alias("owner"),
        F.when(F.col("s") >= BLOCK, F.ceil(F.col("s") / BLOCK)).otherwise(F.col("pools")).alias("parts"),
    )
    spread = F.when(F.col("owner").isNull(), F.col("component")).otherwise(F.col("key"))
    placed = placed.join(where, ["group", "component"]).select(
        "group", "key", "owner", F.pmod(F.xxhash64(spread), "parts").alias("part")
    )
    placed = materialize(placed, "blocks")
    blocks = placed.select("group", "owner", "part").distinct()
    other = blocks.select("group", F.col("owner").alias("owner_b"), F.col("part").alias("part_b"))
    one, two = F.struct(F.coalesce("owner", F.lit(-1)), "part"), F.struct(F.coalesce("owner_b", F.lit(-1)), "part_b")
    block_pairs = blocks.join(other, "group").where((one <= two) & (F.col("owner").isNull() | ~F.col("owner").eqNullSafe(F.col("owner_b"))))
    block_pairs = materialize(block_pairs.withColumn("task", F.monotonically_increasing_id()), "block-pairs")
    left = block_pairs.select("task", "group", "owner", "part", F.lit(0).alias("side"))
    right = block_pairs.where(one != two).select(
        "task", "group", F.col("owner_b").alias("owner"), F.col("part_b").alias("part"), F.lit(1).alias("side")
    )
    wanted = left.unionByName(right)
    same = (placed["group"] == wanted["group"]) & (placed["part"] == wanted["part"]) & placed["owner"].eqNullSafe(wanted["owner"])
    rows = placed.join(wanted, same).select("task", wanted["group"], "key", "side").join(sets, "key")
    crossed = rows.groupBy("task").applyInArrow(_compared, "u long, v long")
    return links.unionByName(crossed)


def _led(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among the pairs (key, lead); a lead's followers spread over several tasks."""
    leads = stars.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    followed = stars.join(leads, "lead").withColumn("part", F.pmod(F.xxhash64("key"), "parts"))
    rows = followed.select("lead", "part", "key", F.lit(1).alias("side"))
    heads = followed.select("lead", "part", F.col("lead").alias("key"), F.lit(0).alias("side")).distinct()
    full = rows.unionByName(heads).join(sets, "key").withColumn("group", F.col("lead"))
    return full.groupBy("lead", "part").applyInArrow(_compared, "u long, v long")


def _classes(keyed: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, n, rep) of the rows with shingles, (key, n) of those without, (rep, component).

    `rep` is the least key with an equal set; a rep without links has no component.
    """
    signed = materialize(signatures(keyed), "signatures")
    same = ["n", "s1", "s2"]
    classes = signed.where("n > 0").groupBy(*same).agg(F.min("key").alias("rep"))
    members = materialize(signed.where("n > 0").join(classes, same).select("key", "n", "rep"), "members")
    copies = members.where("key != rep").select("key")
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    kept = materialize(survivors(keyed.join(copies, "key", "left_anti"), buckets), "survivors")
    connected = components(class_links(kept, buckets)).withColumnRenamed("node", "rep")
    return members, signed.where("n = 0").select("key", "n"), connected


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Words are runs without space or 0x09-0x0D, A-Z lower-cased; component_id is the smallest
    doc_id reachable by links. A text of one to four words is one shingle; null, empty and blank
    texts have none, link with nothing and are their own component. If a doc_id is null or
    repeated, each row counts as a document, in the order of (doc_id, text), nulls last. Other
    columns are ignored; an empty table gives an empty result.
    """
    whole = with_keys(documents, "__key", doc_id, text)
    keyed = whole.select(F.col("__key").alias("key"), F.col(text).alias("text"))
    ids = whole.select(F.col("__key").alias("key"), F.col(doc_id).alias("doc_id"))
    members, blank, connected = _classes(keyed, bucket_count(documents, text))
    reached = members.join(connected, "rep", "left").select("key", "n", F.coalesce("component", "rep").alias("component"))
    roots = ids.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
    return (
        reached.unionByName(blank.withColumn("component", F.col("key")))
        .join(ids, "key")
        .join(roots, "component")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    )


def first_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that a smaller one of their component stands for.

    Rows without shingles all stay. Columns, values and repeated clean rows are as they were.
    """
    whole = with_keys(documents, "__key", doc_id, text)
    keyed = whole.select(F.col("__key").alias("key"), F.col(text).alias("text"))
    members, _, connected = _classes(keyed, bucket_count(documents, text))
    placed = members.join(connected, "rep", "left")
    gone = placed.where(F.col("key") != F.coalesce("component", "rep")).select(F.col("key").alias("__key"))
    gone = materialize(gone, "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return whole.join(gone, "__key", "left_anti").select(*documents.columns)
