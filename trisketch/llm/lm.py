"""Scores of a Brown class-based bigram model.

Words are assigned to classes by exchange clustering: a word moves to the class with the highest
likelihood of the class bigrams. The most frequent words are exchanged one after the other; then, in
each sweep, all words of the vocabulary choose at once, from the classes of the sweep before (as in
Uszkoreit and Brants, Distributed word clustering, 2008): the neighbour classes of a word meet by a
shuffle, and the classes of words outside the broadcast table come into their texts by a join. A
word unseen in training is in a class of its own. The model gives a token w after class d the probability

    a * P(class(w) | d) * (c(w) + 0.1) / Z(class(w)) + (1 - a) * (c(w) + 0.1) / Z

with counts c over all training texts, Z(k) the sum of (c + 0.1) over the words of class k, and Z
that over all words and one unknown word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisketch.llm import words as w
from trisketch.llm.keys import with_keys
from trisketch.session import forget, materialize

FREQUENT = 1 << 18
"""Words in the broadcast table at most: 32 bytes each, 8 MB."""
RARE = (1 << 24) - 1
"""Id of the words outside the table in an encoded text, three bytes."""
CLUSTERED = 4096
"""Most frequent words of the core, with which the exchange starts; the driver holds 2 x CLASSES numbers for each."""
CLASSES = 64
OTHER, EDGE = CLASSES, CLASSES + 1
ROUNDS = 4
SWEEPS = 2
"""Sweeps of all words after those of the core."""
SHARE = 0.9
RUN_BYTES = 4 << 20
FLUSH = 4_000_000
RUN_WORDS = 1 << 18
BLOCK_CELLS = 1 << 15
SMALL = 9
"""Counts below have their gains in a table."""


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 10, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def _hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, w.Words]]:
    for batch in stream:
        for keys, data, offsets in w.chunks(batch.column(0), batch.column(1), RUN_BYTES):
            yield keys, w.words_of(data, offsets, lower=True, two=True)


def _summed(parts: Iterator[np.ndarray], name: str) -> Iterator[pa.RecordBatch]:
    """Occurrences of each value, summed over runs of the task before they are sent."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], [name, "n"]
        )

    for part in parts:
        held.append(part)
        size += len(part)
        if size >= FLUSH:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _words_summed(runs: Iterator[w.Words]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each word, by both lanes of its hash, summed over runs of the task."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        h, s = (np.concatenate(x).view(np.int64) for x in zip(*held, strict=True))
        order = np.argsort(h, kind="stable")
        h, s = h[order], s[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])])[: len(h)])
        n = np.diff(np.append(new, len(h)))
        return pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(s[new]), pa.array(n)], ["h", "s", "n"])

    for words in runs:
        held.append((words.hash, words.second))
        size += len(words.hash)
        if size >= FLUSH:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def word_counts(training: DataFrame) -> DataFrame:
    """(h, s, c): occurrences of each word, by 128 bits of hash, in all texts of (key, text)."""
    sent = training.mapInArrow(lambda s: _words_summed(x for _, x in _hashed(s)), "h long, s long, n long")
    return sent.groupBy("h", "s").agg(F.sum("n").alias("c"))


@dataclass
class Table:
    """Frequent words by hash, sorted, with their counts and their rank among all."""

    hashes: np.ndarray
    seconds: np.ndarray
    counts: np.ndarray
    rank: np.ndarray

    def find(self, words: w.Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words in the table and whether they are in it."""
        if not len(self.hashes):
            return np.zeros(len(words.hash), np.int64), np.zeros(len(words.hash), bool)
        at = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
        return at, (self.hashes[at] == words.hash) & (self.seconds[at] == words.second)


def frequent_table(counts: DataFrame, size: int = FREQUENT) -> Table:
    """The `size` most frequent words, by steps of their counts and by hash within the last step."""
    level = F.floor(F.ln("c") * 64)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()  # some thousand rows
    kept, last, share = 0, 1 << 30, 0.0
    for row in sorted(levels, key=lambda r: -r["level"]):
        last, share = row["level"], min(1.0, (size - kept) / row["n"])
        kept += row["n"]
        if kept >= size:
            break
    part = F.shiftright(F.xxhash64("h", "s"), 32) / float(1 << 32) + 0.5  # even over [0, 1)
    rows = counts.where((level > last) | ((level == last) & (part < share))).toArrow()
    hashes, seconds = (rows.column(x).to_numpy().view(np.uint64) for x in ("h", "s"))
    count = rows.column("c").to_numpy()
    top = np.lexsort((seconds, hashes, -count))[:size]
    hashes, seconds, count = hashes[top], seconds[top], count[top]
    order = np.lexsort((seconds, hashes, -count))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by_hash = np.argsort(hashes)
    return Table(hashes[by_hash], seconds[by_hash], count[by_hash], rank[by_hash])


def _packed_bytes(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).cast(pa.binary())


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    return np.array([values[a:b].sum() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], values.dtype)


def _packed(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Per text three bytes of each id: first all the low ones, then the next, which compress."""
    counts = np.diff(bounds)
    first = np.repeat(bounds[:-1], counts)
    size, place = np.repeat(counts, counts), 2 * first + np.arange(len(ids))
    data = np.empty(3 * len(ids), np.uint8)
    for k in range(3):
        data[place + k * size] = ids >> 8 * k & 255
    return _packed_bytes(data, 3 * bounds)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and the bounds of its rows."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of `_packed` and the bounds of the texts."""
    data, offsets = _bytes(column)
    bounds = offsets // 3
    counts = np.diff(bounds)
    first = np.repeat(bounds[:-1], counts)
    size, place = np.repeat(counts, counts), 2 * first + np.arange(len(first))
    ids = np.zeros(len(first), np.int64)
    for k in range(3):
        ids |= data[place + k * size].astype(np.int64) << 8 * k
    return ids, bounds


ENCODED = "key long, train boolean, ids binary, rare array<struct<at: int, h: long, s: long, c: long, k: byte>>"


def encoded(rows: DataFrame, table: Table) -> DataFrame:
    """Texts of (key, text, train) as ids: the rank of a word of the table, RARE for any other.

    `rare` lists the other words: place in the text, hash, count in training (0) and class (OTHER).
    """
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in stream:
            done, train = 0, batch.column(2)
            for keys, data, offsets in w.chunks(batch.column(0), batch.column(1), RUN_BYTES):
                words = w.words_of(data, offsets, lower=True, two=True)
                at, there = known.find(words)
                ids = np.full(len(at), RARE, np.int64)
                ids[there] = known.rank[at[there]]
                place = np.arange(len(at)) - np.repeat(words.bounds[:-1], words.counts)
                n = int((~there).sum())
                columns = [place[~there].astype(np.int32), *(x[~there].view(np.int64) for x in (words.hash, words.second))]
                columns += [np.zeros(n, np.int64), np.full(n, OTHER, np.int8)]
                rare = pa.StructArray.from_arrays([pa.array(x) for x in columns], ["at", "h", "s", "c", "k"])
                cuts = np.concatenate([[0], np.cumsum(~there)])[words.bounds].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        train.slice(done, len(keys)),
                        _packed(ids, words.bounds),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rare),
                    ],
                    ["key", "train", "ids", "rare"],
                )
                done += len(keys)

    return rows.select("key", "text", "train").mapInArrow(encode, ENCODED)


@dataclass
class Run:
    """Encoded texts: text `d` has the words bounds[d] to bounds[d + 1]; `at` are those outside the table."""

    keys: pa.Array
    train: pa.Array
    bounds: np.ndarray
    ids: np.ndarray
    at: np.ndarray
    rare: pa.StructArray

    def column(self, name: str) -> np.ndarray:
        return self.rare.field(name).to_numpy(zero_copy_only=False)

    def kinds(self, by_rank: np.ndarray) -> np.ndarray:
        """Class of each word, from the classes of the table's ranks and the row's own of the others."""
        kinds = np.append(by_rank, OTHER)[np.minimum(self.ids, len(by_rank))]
        kinds[self.at] = self.column("k")
        return kinds


def _parts(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about RUN_WORDS words, of `size` bytes each in the column."""
    ends, begin = _bytes(batch.column(column))[1], 0
    while begin < len(batch):
        stop = int(np.searchsorted(ends, ends[begin] + size * RUN_WORDS, "right")) - 1
        stop = max(stop, begin + 1)
        yield batch.slice(begin, stop - begin)
        begin = stop


def _runs(stream: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    for batch in stream:
        for part in _parts(batch, "ids", 3):
            ids, bounds = _unpacked(part.column("ids"))
            rare = part.column("rare")
            flat, counts = rare.flatten(), rare.value_lengths().to_numpy(zero_copy_only=False)
            at = np.repeat(bounds[:-1], counts) + flat.field("at").to_numpy(zero_copy_only=False)
            yield Run(part.column("key"), part.column("train"), bounds, ids, at, flat)


def _classes(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of classified texts with the bounds and classes of their words."""
    for batch in stream:
        for part in _parts(batch, "kinds", 1):
            kinds, bounds = _bytes(part.column("kinds"))
            yield part, bounds, kinds.astype(np.int64)


def _sequences(bounds: np.ndarray, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(before, token) of every word and of one end per text; a text starts after an end."""
    full = np.insert(ids, bounds[1:], end)
    return np.concatenate([[end], full[:-1]])[: len(full)], full


def word_bigrams(texts: DataFrame, clustered: int) -> DataFrame:
    """(code, n): counts of the pairs of ids below `clustered`, with one id more for all other
    words and one for the end of a text; code = before * (clustered + 2) + id.
    """

    def codes(stream: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for run in _runs(stream):
            before, full = _sequences(run.bounds, np.minimum(run.ids, clustered), clustered + 1)
            yield before * (clustered + 2) + full

    sent = texts.mapInArrow(lambda s: _summed(codes(s), "code"), "code long, n long")
    return sent.groupBy("code").agg(F.sum("n").alias("n"))


def _neighbour_classes(bigrams: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L[id, class before] and R[id, class after] of all ids; bounded by ids x classes, not by texts."""
    ids, kinds = len(classes), CLASSES + 2

    def sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, ids, kinds), np.int64)
        for batch in stream:
            code, n = batch.column("code").to_numpy(), batch.column("n").to_numpy()
            before, after = code // ids, code % ids
            np.add.at(total[0], (after, classes[before]), n)
            np.add.at(total[1], (before, classes[after]), n)
        flat = total.ravel()
        cells = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(flat[cells])], ["cell", "n"])

    rows = bigrams.mapInArrow(sums, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 * ids * kinds)
    total[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    left, right = total.reshape(2, ids, kinds)
    return left, right


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _class_bigrams(right: np.ndarray, classes: np.ndarray) -> np.ndarray:
    n = np.zeros((CLASSES + 2, CLASSES + 2))
    np.add.at(n, classes, right)
    return n


def _exchange(left: np.ndarray, right: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """One sweep: each clustered word, most frequent first, goes to its best class."""
    classes = classes.copy()
    n = _class_bigrams(right, classes)
    for word in range(len(classes) - 2):
        l, r, a = left[word], right[word], classes[word]
        n[:, a] -= l
        n[a, :] -= r
        np.maximum(n, 0, out=n)
        into, out = n[:, :CLASSES], n[:CLASSES, :].T
        gain = (_xlogx(into + l[:, None]) - _xlogx(into)).sum(0) + (_xlogx(out + r[:, None]) - _xlogx(out)).sum(0)
        for side, vector in ((into.sum(0), l), (out.sum(0), r)):
            gain -= _xlogx(side + vector.sum()) - _xlogx(side)
        b = int(np.argmax(gain))
        n[:, b] += l
        n[b, :] += r
        classes[word] = b
    return classes


def exchange_classes(bigrams: DataFrame, clustered: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the clustered ids, and the class bigram counts under them.

    The most frequent words begin as a class each; then every sweep works on the neighbour
    classes of the whole corpus under the classes of the sweep before.
    """
    classes = np.full(clustered + 2, OTHER)
    first = min(CLASSES, clustered)
    classes[:first] = np.arange(first)
    classes[-1] = EDGE
    for _ in range(rounds):
        left, right = _neighbour_classes(bigrams, classes)
        classes = _exchange(left, right, classes)
    _, right = _neighbour_classes(bigrams, classes)
    return classes, _class_bigrams(right, classes)


CELLS = "id int, h long, s long, k byte, cells binary, counts binary"


def _cells(stream: Iterator[pa.RecordBatch], by_rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per word of the task, by id or hash: its class, and how often it has each class before (cell
    d) and after it (cell CLASSES + 2 + e).
    """
    size, kinds_n = len(by_rank), CLASSES + 2
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> pa.RecordBatch:
        ids, left, right, h, s, k = (np.concatenate(x) for x in zip(*held, strict=True))
        other = np.flatnonzero(ids == RARE)
        order = np.argsort(h, kind="stable")
        h, s, k = h[order], s[order], k[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])])[: len(h)]
        ids[other[order]] = size + np.cumsum(new) - 1
        codes = np.concatenate([ids * 2 * kinds_n + left, ids * 2 * kinds_n + kinds_n + right])
        codes, counts = np.unique(codes, return_counts=True)
        words = codes // (2 * kinds_n)
        starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        words, cuts = words[starts], np.append(starts, len(codes)).astype(np.int64)
        mask, place = words >= size, np.maximum(words - size, 0)
        known = np.append(by_rank, OTHER)[np.minimum(words, size)]
        rare = [np.append(x[new], 0)[place] for x in (h, s, k)]
        data = (codes % (2 * kinds_n)).astype(np.uint8), counts.astype(np.uint32)
        packed = [_packed_bytes(x.view(np.uint8), cuts * x.itemsize) for x in data]
        columns = [
            pa.array(words.astype(np.int32), mask=mask),
            *(pa.array(x, pa.int64(), mask=~mask) for x in rare[:2]),
            pa.array(np.where(mask, rare[2], known).astype(np.int8)),
            *packed,
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "h", "s", "k", "cells", "counts"])

    total = 0
    for run in _runs(stream):
        kinds, some = run.kinds(by_rank), np.diff(run.bounds) > 0
        left, right = np.append(EDGE, kinds[:-1])[: len(kinds)], np.append(kinds[1:], EDGE)[: len(kinds)]
        left[run.bounds[:-1][some]], right[run.bounds[1:][some] - 1] = EDGE, EDGE
        order = np.argsort(run.at, kind="stable")
        ids = run.ids.copy()
        held.append((ids, left, right, *(run.column(x)[order] for x in ("h", "s", "k"))))
        total += len(ids)
        if total >= FLUSH // 2:
            yield flush()
            held.clear()
            total = 0
    if total:
        yield flush()


def _best(
    owner: np.ndarray, cells: np.ndarray, counts: np.ndarray, own: np.ndarray, n: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(occurrences, best class) of words 0, 1, ..., by the gain of `_exchange` with the class
    bigrams n of the sweep before. Word owner[i] has counts[i] of cells[i], sorted; own: its class.

    Classes without tokens are no choice: each word alone would take them, and so would all at once.
    """
    base = np.concatenate([n[:, :CLASSES], n[:CLASSES].T])
    before, after = base[: CLASSES + 2].sum(0), base[CLASSES + 2 :].sum(0)
    small = np.stack([_xlogx(base + i) - _xlogx(base) for i in range(SMALL)])
    starts = np.searchsorted(owner, np.arange(len(own) + 1))
    total = np.add.reduceat(np.where(cells < CLASSES + 2, counts, 0), starts[:-1]) if len(own) else own
    chosen = np.empty(len(own), np.int64)
    begin = 0
    while begin < len(own):
        stop = max(int(np.searchsorted(starts, starts[begin] + BLOCK_CELLS, "right")) - 1, begin + 1)
        part, a, c = slice(starts[begin], starts[stop]), own[begin:stop], total[begin:stop]
        cell, count, at = cells[part], counts[part], starts[begin:stop] - starts[begin]
        gain = small[np.minimum(count, SMALL - 1), cell]
        big = count >= SMALL
        gain[big] = _xlogx(base[cell[big]] + count[big, None]) - _xlogx(base[cell[big]])
        gain = np.add.reduceat(gain, at)
        sizes, place = np.unique(c, return_inverse=True)
        for side in (before, after):
            gain -= (_xlogx(side + sizes[:, None]) - _xlogx(side))[place]
        inside = np.flatnonzero(a < CLASSES)  # a word in a class is taken out of it first
        if len(inside):
            now = np.minimum(a, CLASSES - 1)
            mine = np.repeat(now, np.diff(np.append(at, len(cell))))
            held = base[cell, mine]
            stay = np.add.reduceat(_xlogx(held) - _xlogx(np.maximum(held - count, 0)), at)
            for side in (before, after):
                stay -= _xlogx(side[now]) - _xlogx(np.maximum(side[now] - c, 0))
            gain[inside, a[inside]] = stay[inside]
        gain[:, before + after <= 0] = -np.inf
        chosen[begin:stop] = gain.argmax(1)
        begin = stop
    return total, chosen


def _chosen(stream: Iterator[pa.RecordBatch], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, h, s, c, k) of each word of the sorted rows of `_cells`: its count and its best class."""

    def choose(rows: pa.RecordBatch, group: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        cells, bounds = _bytes(rows.column("cells"))
        counts = _bytes(rows.column("counts"))[0].copy().view(np.uint32)
        code = np.repeat(group, np.diff(bounds)) * 2 * (CLASSES + 2) + cells
        order = np.argsort(code, kind="stable")
        code = code[order]
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        sums, code = np.add.reduceat(counts[order].astype(np.int64), starts), code[starts]
        own = rows.column("k").to_numpy()[first].astype(np.int64)
        c, k = _best(code // (2 * (CLASSES + 2)), code % (2 * (CLASSES + 2)), sums, own, n)
        words = [rows.column(x).take(pa.array(first)) for x in ("id", "h", "s")]
        return pa.RecordBatch.from_arrays([*words, pa.array(c), pa.array(k.astype(np.int8))], ["id", "h", "s", "c", "k"])

    held = None
    for batch in stream:
        rows = batch if held is None else pa.concat_batches([held, batch])
        if not len(rows):
            continue
        parts = [rows.column(x).fill_null(-1).to_numpy() for x in ("id", "h", "s")]
        new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in parts], axis=0)])
        first = np.flatnonzero(new)
        last = int(first[-1])  # its rows may go on in the next batch
        if last:
            yield choose(rows.slice(0, last), (np.cumsum(new) - 1)[:last], first[:-1])
        held = rows.slice(last)
    if held is not None:
        yield choose(held, np.zeros(len(held), np.int64), np.zeros(1, np.int64))


def choices(texts: DataFrame, by_rank: np.ndarray, n: np.ndarray) -> DataFrame:
    """(id, h, s, c, k): count and best class of every word of encoded texts, each word for itself
    against the classes of the sweep before; id of a word of the table, hash of any other.
    """
    sent = texts.mapInArrow(lambda s: _cells(s, by_rank), CELLS)
    ordered = sent.repartition("id", "h", "s").sortWithinPartitions("id", "h", "s")
    return ordered.mapInArrow(lambda s: _chosen(s, n), "id int, h long, s long, c long, k byte")


def _found(texts: DataFrame, words: DataFrame, fields: list[str]) -> DataFrame:
    """(key, found): per encoded text its words outside the table with the counts and classes of `choices`."""
    others = words.where("id IS NULL").select("h", "s", "c", "k")
    rare = texts.select("key", F.inline("rare")).select("key", "at", "h", "s").join(others, ["h", "s"], "left")
    known = rare.fillna(0, ["c"]).withColumn("k", F.coalesce("k", F.lit(OTHER).cast("byte")))
    return known.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("found"))


def with_choices(texts: DataFrame, words: DataFrame) -> DataFrame:
    """Encoded texts with the counts and classes of `choices` in their lists of other words."""
    lists = _found(texts, words, ["at", "h", "s", "c", "k"])
    none = F.array().cast("array<struct<at: int, h: long, s: long, c: long, k: byte>>")
    return texts.join(lists, "key", "left").select("key", "train", "ids", F.coalesce("found", none).alias("rare"))


def classified(texts: DataFrame, words: DataFrame, by_rank: np.ndarray, table: Table) -> DataFrame:
    """(key, train, kinds, n_known, logs): encoded texts as classes, a byte for each word, the number
    of words known from training, and the sum of the log10 of (count + 0.1). Ids do not travel.
    """
    kinds_of, logs_of = np.append(by_rank, OTHER).astype(np.uint8), np.zeros(len(by_rank) + 1)
    logs_of[table.rank] = np.log10(table.counts + 0.1)
    known = "key long, train boolean, kinds binary, n_known long, logs double"

    def start(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(stream):
            at = np.minimum(run.ids, len(kinds_of) - 1)
            inside = (at < len(kinds_of) - 1).astype(np.int64)
            columns = [run.keys, run.train, _packed_bytes(kinds_of[at], run.bounds)]
            columns += [pa.array(_sums(inside, run.bounds)), pa.array(_sums(logs_of[at], run.bounds))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "train", "kinds", "n_known", "logs"])

    def fill(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            kinds, bounds = _bytes(batch.column("kinds"))
            found = batch.column("found")
            sizes = found.value_lengths().fill_null(0).to_numpy()
            at, c, k = (found.flatten().field(x).to_numpy(zero_copy_only=False) for x in ("at", "c", "k"))
            place, cuts = np.repeat(bounds[:-1], sizes) + at, np.append(0, np.cumsum(sizes))
            kinds = kinds.copy()
            kinds[place] = k
            order = np.argsort(place)  # the order of the text, in which the sum is always the same
            seen = pa.array(batch.column("n_known").to_numpy() + _sums((c > 0).astype(np.int64), cuts))
            logs = pa.array(batch.column("logs").to_numpy() + _sums(np.log10(c + 0.1)[order], cuts))
            columns = [batch.column("key"), batch.column("train"), _packed_bytes(kinds, bounds), seen, logs]
            yield pa.RecordBatch.from_arrays(columns, ["key", "train", "kinds", "n_known", "logs"])

    started = texts.mapInArrow(start, known)
    return started.join(_found(texts, words, ["at", "c", "k"]), "key", "left").mapInArrow(fill, known)


def class_bigrams(texts: DataFrame, by_rank: np.ndarray | None = None) -> np.ndarray:
    """Counts of the pairs of classes, each text between two ends: of encoded texts by the classes
    of the table's ranks, or of classified ones.
    """
    kinds_n = CLASSES + 2

    def sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kinds_n * kinds_n, np.int64)
        if by_rank is None:
            runs = ((bounds, kinds) for _, bounds, kinds in _classes(stream))
        else:
            runs = ((run.bounds, run.kinds(by_rank)) for run in _runs(stream))
        for bounds, kinds in runs:
            before, full = _sequences(bounds, kinds, EDGE)
            total += np.bincount(before * kinds_n + full, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "n"])

    rows = texts.mapInArrow(sums, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(kinds_n * kinds_n)
    n[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return n.reshape(kinds_n, kinds_n)


@dataclass
class Model:
    table: Table
    classes: np.ndarray
    """Class of each word of the table, in its order."""
    terms: np.ndarray
    """log10 of a * P(k | d) * Z / Z(k) + 1 - a, by class before and class."""
    train_texts: int
    train_tokens: int
    distinct: int

    @property
    def mass(self) -> float:
        return self.train_tokens + 0.1 * (self.distinct + 1)


def clustered_texts(
    texts: DataFrame, table: Table, sweeps: int = SWEEPS
) -> tuple[DataFrame, np.ndarray, np.ndarray, DataFrame]:
    """Texts as classes of all their words, the classes by rank of the table's words, the class
    bigrams of training, and the words of `choices`. The folder of the encoded texts is removed.

    The core of CLUSTERED words is exchanged first; then every word of the vocabulary, those of the
    core too, chooses its class in each of `sweeps` sweeps.
    """
    core = min(CLUSTERED, len(table.hashes))
    bigrams = materialize(word_bigrams(texts.where("train"), core), "bigrams")
    classes, n = exchange_classes(bigrams, core)
    forget(bigrams)
    by_rank = np.full(len(table.hashes), OTHER)
    by_rank[:core] = classes[:core]
    for sweep in range(1, sweeps + 1):
        words = materialize(choices(texts.where("train"), by_rank, n), "words")
        rows = words.where("id IS NOT NULL").select("id", "k").toArrow()  # at most FREQUENT
        by_rank = by_rank.copy()
        by_rank[rows.column("id").to_numpy()] = rows.column("k").to_numpy()
        before = texts
        if sweep < sweeps:
            texts = materialize(with_choices(before, words), "classes")
            n = class_bigrams(texts.where("train"), by_rank)
            forget(words)
        else:
            texts = materialize(classified(before, words, by_rank, table), "classified")
            n = class_bigrams(texts.where("train"))
        forget(before)
    return texts, by_rank, n, words


def fit(texts: DataFrame, counts: DataFrame, table: Table, share: float = SHARE) -> tuple[Model, DataFrame]:
    """The model of the encoded texts in training, and all texts as classes; the folder of the encoded ones is removed."""
    sums = counts.agg(F.sum("c").alias("c"), F.count("*").alias("v")).first()
    trained = texts.where("train").count()
    tokens, distinct = (sums["c"] or 0) + trained, sums["v"] + (1 if trained else 0)
    texts, by_rank, n, words = clustered_texts(texts, table)
    model = Model(table, by_rank[table.rank], np.zeros_like(n), trained, tokens, distinct)
    mass = np.bincount(model.classes, weights=table.counts + 0.1, minlength=CLASSES + 2)
    for row in words.where("id IS NULL").groupBy("k").agg(F.sum(F.col("c") + F.lit(0.1)).alias("c")).collect():
        mass[row["k"]] += row["c"]
    mass[EDGE] = trained + 0.1 if trained else 0.0
    mass[OTHER] = 0.1  # the unknown word
    n[OTHER] = n.sum(0)  # after an unknown word, the classes of all tokens
    follows = (n + 0.5) / (n.sum(1, keepdims=True) + 0.5 * len(n))
    with np.errstate(divide="ignore"):
        ratio = np.where(mass > 0, model.mass / np.maximum(mass, 1e-300), 0.0)
    model.terms = np.log10(share * follows * ratio + (1 - share))
    return model, texts


def learn(training: DataFrame, counts: DataFrame, share: float = SHARE) -> Model:
    """The model of the texts of (key, text), whose word counts are given."""
    table = frequent_table(counts)
    texts = materialize(encoded(training.withColumn("train", F.lit(True)), table), "encoded")
    return fit(texts, counts, table, share)[0]


def _scored(stream: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per text: tokens, known ones, sum of the logarithms of their counts and of the class terms."""
    end = np.log10(model.train_texts + 0.1)
    for rows, bounds, kinds in _classes(stream):
        before, full = _sequences(bounds, kinds, EDGE)
        columns = [
            rows.column("key"),
            pa.array(np.diff(bounds) + 1, pa.int64()),
            pa.array(rows.column("n_known").to_numpy() + (1 if model.train_texts else 0)),
            pa.array(rows.column("logs").to_numpy() + end),
            pa.array(_sums(model.terms[before, full], bounds + np.arange(len(bounds)))),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["key", "n_tokens", "n_known", "logs", "classes"])


def log_probabilities(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    Tokens are the words, runs without space or 0x09-0x0D with A-Z lower-cased, and one end per
    text. A null or empty text is one end. Each row has its own score, whether its doc_id is
    unique or not; a null doc_id is in training. Without training texts all words are unknown
    and have probability one. Other columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    keyed = with_keys(documents, "__key", doc_id, text)
    train = (~held_out(F.col(doc_id))).alias("train")
    rows = keyed.select(F.col("__key").alias("key"), F.col(text).alias("text"), train)
    counts = materialize(word_counts(rows.where("train").select("key", "text")), "word-counts")
    table = frequent_table(counts)
    model, texts = fit(materialize(encoded(rows, table), "encoded"), counts, table)
    shared = spark.sparkContext.broadcast(model)
    forget(counts)
    parts = texts.mapInArrow(
        lambda s: _scored(s, shared.value), "key long, n_tokens long, n_known long, logs double, classes double"
    )
    ids = keyed.select(F.col("__key").alias("key"), F.col(doc_id).alias("doc_id"))
    base = F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(model.mass)))
    score = base + F.col("classes")
    return parts.join(ids, "key").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
