"""Words of many texts at once as hashes of 64 or 128 bits, with NumPy over the bytes of an Arrow array.

A word is a run of bytes other than space and 0x09-0x0D.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Odd multipliers of the n-gram hashes and of the second lane.
GRAM, LANE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
LONG_WORD = 1024
"""Longer words are hashed one by one."""
BLOCK_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one integer; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _block(blocks: np.ndarray, start: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Block k of words that have more than 8 k bytes, without the bytes behind the word."""
    return blocks[start + 8 * k] & BLOCK_MASK[np.minimum(size - 8 * k, 8)]


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, two: bool) -> list[np.ndarray | None]:
    """Two lanes of hashes, each mixed anew after every eight bytes of a word.

    The lanes take up a block in different ways, so that what makes one agree leaves the other apart.
    """
    one = mixed(size.astype(np.uint64))
    lanes = [one, mixed(one, 1)] if two else [one]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[start[i] : start[i] + size[i]], digest_size=16).digest()
        for lane, value in zip(lanes, struct.unpack("<QQ", digest), strict=False):
            lane[i] = value
    blocks, live, k = blocks_at(data), np.flatnonzero(size <= LONG_WORD), 0
    while len(live):
        block = _block(blocks, start[live], size[live], k)
        lanes[0][live] = mixed(lanes[0][live] ^ block)
        if two:
            lanes[1][live] = mixed((lanes[1][live] + block) * LANE, 2)
        k += 1
        live = live[size[live] > 8 * k]
    return lanes if two else [one, None]


@dataclass
class Words:
    """The words of a run of texts: text `d` has the words bounds[d] to bounds[d + 1]."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    second: np.ndarray | None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False, two: bool = False) -> Words:
    """Words of the texts data[offsets[d] : offsets[d + 1]]; `two` adds a second, independent hash."""
    if lower:
        data = LOWER[data]
    inside = ~IS_SPACE[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < len(data)]] = False
    after[edges[edges > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, np.searchsorted(start, offsets), start, end, *_hashes(data, start, end - start, two))


def exact_ids(words: Words) -> np.ndarray:
    """Numbers of the words that are equal if and only if the words' bytes are.

    Words with equal hashes are compared byte by byte with the first of them.
    """
    n = len(words.hash)
    order = np.lexsort((words.second, words.hash))
    a, b = words.hash[order], words.second[order]
    new = np.ones(n, bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    ids = np.empty(n, np.int64)
    ids[order] = np.cumsum(new) - 1
    first = order[new][ids]
    size, blocks = words.end - words.start, blocks_at(words.data)
    same, live, k = size == size[first], np.flatnonzero(first != np.arange(n)), 0
    live = live[same[live]]
    for i in live[size[live] > LONG_WORD].tolist():
        one, other = (words.data[words.start[j] : words.end[j]] for j in (i, first[i]))
        same[i] = np.array_equal(one, other)
    live = live[size[live] <= LONG_WORD]
    while len(live):
        ours, theirs = (_block(blocks, words.start[x], size[x], k) for x in (live, first[live]))
        same[live[ours != theirs]] = False
        k += 1
        live = live[(size[live] > 8 * k) & (ours == theirs)]
    known: dict[bytes, int] = {}
    for i in np.flatnonzero(~same).tolist():
        ids[i] = known.setdefault(words.data[words.start[i] : words.end[i]].tobytes(), n + len(known))
    return ids


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, by doubling; runs over text ends, which callers mask out.

    A polynomial, so for some dozens of words and not for long sequences.
    """
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    power, out, done = GRAM, None, 0
    block, size = hashes, 1
    while n:
        if n & 1:
            if out is None:
                out, done = block, size
            else:
                m = min(len(out) - size, len(block))
                out, done = block[:m] * np.uint64(pow(int(GRAM), done, 1 << 64)) + out[size : size + m], done + size
        n >>= 1
        if n:
            block = block[: len(block) - size] * power + block[size:]
            power, size = np.uint64(pow(int(power), 2, 1 << 64)), size * 2
    return mixed(out)


def places(counts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions bounds[d], bounds[d] + 1, ... (counts[d] of them) of every text, in order."""
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(first, counts) + np.repeat(bounds[: len(counts)], counts)


def chunks(keys: pa.Array, texts: pa.Array, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, bytes, offsets) of runs of rows with about `limit` bytes; a longer text is a run alone.

    A null text is an empty one.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    key = keys.to_numpy(zero_copy_only=False)
    begin = 0
    while begin < n:
        stop = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        stop = min(max(stop, begin + 1), n)
        yield key[begin:stop], data[offsets[begin] : offsets[stop]], offsets[begin : stop + 1] - offsets[begin]
        begin = stop
