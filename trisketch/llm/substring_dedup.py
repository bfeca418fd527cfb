"""Removal of word windows that occur earlier, by super-k-mer partitioning.

The minimiser of a window of 20 words is the smallest hash among its 4-word grams. Consecutive
windows with one minimiser travel as one packed string to the bucket of that minimiser, so equal
windows meet although no window is sent by itself; there, sorting finds all but the first.

A minimiser that very many windows share, such as that of a phrase in all texts, would fill one bucket.
So windows are counted by minimiser first, and those of a hot one travel one by one to buckets of
their own hash.

A task sends a window once, however often it occurs in the texts at hand: the repetitions among
them are settled on the spot. A passage that is in a third of all texts is thus as many packed
strings as there are runs of texts, not as there are texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisketch.llm import words as w
from trisketch.llm.keys import with_keys
from trisketch.session import materialize

WINDOW, GRAM = 20, 4
RUN_BYTES = 4 << 20
"""Bytes of text that a task hashes at once, and that a bucket holds on average."""
BROADCAST_ROWS, BROADCAST_SPANS = 500_000, 4_000_000
"""Up to so many documents with so many spans (8 bytes each) in all, counted before, are broadcast."""
SLOTS = 4
"""Slots of minimisers in a bucket."""
HOT_WINDOWS = 1_000_000
"""Windows of one slot, before repetitions are settled, from which each travels by itself: 28 bytes, for
some 24 bytes of text in a packed string."""
SENT = "bucket int, keys binary, starts binary, sizes binary, text binary"


def _minima(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    size = 1
    while size * 2 <= n:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def _later(words: w.Words, at: np.ndarray) -> np.ndarray:
    """Whether the window of words at each place equals one that is listed before it.

    Windows are sorted by 128 bits of hash; those that agree are compared word for word with the
    first of them, and should any differ, all are sorted by their words instead.
    """
    first, second = (w.grams(x, WINDOW)[at] for x in (words.hash, words.second))
    ids = w.exact_ids(words)
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):
        order = np.lexsort((np.arange(len(first)), second, first))
        a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = np.zeros(len(first), bool)
    later[order] = ~new
    ours, theirs = at[order[~new]], at[leader[~new]]
    if any(np.any(ids[ours + k] != ids[theirs + k]) for k in range(WINDOW)):
        rows = ids[at[:, None] + np.arange(WINDOW)]
        later[:] = True
        later[np.unique(rows, axis=0, return_index=True)[1]] = False
    return later


def _runs(*changes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the runs between positions where any of `changes` is set."""
    new = np.concatenate([[True], np.logical_or.reduce(changes)])
    begin = np.flatnonzero(new)
    return begin, np.concatenate([begin[1:], [len(new)]]) - 1


def _spans(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word spans [start, end) of the windows, merged where windows follow each other."""
    if not len(keys):
        return keys, starts, ends
    begin, last = _runs((keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1] + 1))
    return keys[begin], starts[begin], ends[last]


def _slots(least: np.ndarray, slots: int) -> np.ndarray:
    return (w.mixed(least, 7) % np.uint64(slots)).astype(np.int64)


def _loads(stream: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """Windows by the slot of their minimiser, summed over runs of texts."""
    for batch in stream:
        for keys, data, offsets in w.chunks(batch.column(0), batch.column(1), RUN_BYTES):
            words = w.words_of(data, offsets)
            at = w.places(np.maximum(words.counts - WINDOW + 1, 0), words.bounds)
            if len(at):
                slot, n = np.unique(_slots(_minima(w.grams(words.hash, GRAM), WINDOW - GRAM + 1)[at], slots), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n)], ["slot", "n"])


@dataclass
class Deal:
    """Where windows go: a bucket by the minimiser's slot; those of hot slots by their own hash."""

    buckets: int
    hot: np.ndarray
    hot_buckets: int

    @property
    def slots(self) -> int:
        return self.buckets * SLOTS


def deal(keyed: DataFrame, buckets: int, limit: int = HOT_WINDOWS) -> Deal:
    """Counts the windows of all slots; one with more than `limit` is hot, so at most windows / limit are."""
    slots = buckets * SLOTS
    loads = keyed.mapInArrow(lambda stream: _loads(stream, slots), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    hot = loads.where(F.col("n") > limit).toArrow()
    windows = int(hot["n"].to_numpy().sum()) if hot.num_rows else 0
    return Deal(buckets, np.sort(hot["slot"].to_numpy()), windows // limit + 1)


def _packed(stream: Iterator[pa.RecordBatch], to: Deal) -> Iterator[pa.RecordBatch]:
    buckets, press = to.buckets, zstandard.ZstdCompressor(level=1)
    for batch in stream:
        for keys, data, offsets in w.chunks(batch.column(0), batch.column(1), RUN_BYTES):
            rows = []
            order = np.argsort(keys, kind="stable")
            if np.any(order[1:] < order[:-1]):
                pieces = [data[offsets[i] : offsets[i + 1]] for i in order]
                keys, data = keys[order], np.concatenate(pieces)
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
            words = w.words_of(data, offsets, two=True)
            windows = np.maximum(words.counts - WINDOW + 1, 0)
            at = w.places(windows, words.bounds)
            if not len(at):
                continue
            owner = np.repeat(keys, windows)
            start = (at - np.repeat(words.bounds[:-1], windows)).astype(np.int32)
            later = _later(words, at)
            least = _minima(w.grams(words.hash, GRAM), WINDOW - GRAM + 1)[at]
            hot = np.isin(_slots(least, to.slots), to.hot) & ~later if len(to.hot) else np.zeros(len(at), bool)
            if later.any():
                k, s, e = _spans(owner[later], start[later], start[later] + np.int32(WINDOW))
                rows.append((int(k[0] % buckets), k.tobytes(), s.tobytes(), (e - s).tobytes(), None))
            if hot.any():
                first, second = (w.grams(x, WINDOW)[at[hot]] for x in (words.hash, words.second))
                bucket = (first % np.uint64(to.hot_buckets)).astype(np.int64) + buckets
                order = np.argsort(bucket, kind="stable")
                columns = [x[order] for x in (owner[hot].astype(np.int64), start[hot], first, second)]
                bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)).tolist()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    rows.append((int(bucket[order[a]]), *(x[a:b].tobytes() for x in columns)))
            sent = np.flatnonzero(~later & ~hot)
            if len(sent):
                begin, last = _runs(
                    np.diff(sent) != 1, owner[sent][1:] != owner[sent][:-1], least[sent][1:] != least[sent][:-1]
                )
                begin, last = sent[begin], sent[last]
                bucket = _slots(least[begin], to.slots) % buckets
                order = np.argsort(bucket, kind="stable")
                begin, last, bucket = begin[order], last[order], bucket[order]
                low, high = words.start[at[begin]], words.end[at[last] + WINDOW - 1]
                whole = memoryview(data)
                bounds = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    text = b"".join([whole[i:j] for i, j in zip(low[a:b].tolist(), high[a:b].tolist(), strict=True)])
                    rows.append(
                        (
                            int(bucket[a]),
                            press.compress(owner[begin[a:b]].astype(np.int64).tobytes()),
                            press.compress(start[begin[a:b]].tobytes()),
                            press.compress((high[a:b] - low[a:b]).astype(np.int32).tobytes()),
                            press.compress(text),
                        )
                    )
            types = [pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "keys", "starts", "sizes", "text"])


def _table(*columns: np.ndarray) -> pa.Table:
    types = zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)
    return pa.table([pa.array(c, t) for c, t in types], ["key", "first", "stop"])


def _repeated_hot(bucket: pa.Table) -> pa.Table:
    """The same where each window came by itself, as 128 bits of hash: the others of its minimiser are elsewhere."""
    kinds = zip(("keys", "starts", "sizes", "text"), (np.int64, np.int32, np.uint64, np.uint64), strict=True)
    keys, starts, first, second = (np.frombuffer(b"".join(bucket[c].to_pylist()), kind) for c, kind in kinds)
    order = np.lexsort((starts, keys, second, first))
    later = np.zeros(len(order), bool)
    a, b = first[order], second[order]
    later[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    order = np.lexsort((starts, keys))
    order = order[later[order]]
    return _table(*_spans(keys[order], starts[order], starts[order] + np.int32(WINDOW)))


def _repeated(bucket: pa.Table) -> pa.Table:
    """Spans of the windows of one bucket that stand in it before, and the spans settled by tasks."""
    plain = zstandard.ZstdDecompressor().decompress
    settled, owners, starts, sizes, texts = [], [], [], [], []
    for row in bucket.to_pylist():
        if row["text"] is None:
            s = np.frombuffer(row["starts"], np.int32)
            settled.append((np.frombuffer(row["keys"], np.int64), s, s + np.frombuffer(row["sizes"], np.int32)))
        else:
            owners.append(np.frombuffer(plain(row["keys"]), np.int64))
            starts.append(np.frombuffer(plain(row["starts"]), np.int32))
            sizes.append(np.frombuffer(plain(row["sizes"]), np.int32))
            texts.append(plain(row["text"]))
    if texts:
        owner, start = np.concatenate(owners), np.concatenate(starts)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes).astype(np.int64))])
        words = w.words_of(np.frombuffer(b"".join(texts), np.uint8), offsets, two=True)
        windows = words.counts - WINDOW + 1
        at = w.places(windows, words.bounds)
        keys = np.repeat(owner, windows)
        begins = (at - np.repeat(words.bounds[:-1], windows) + np.repeat(start, windows)).astype(np.int32)
        order = np.lexsort((begins, keys))
        keys, begins, at = keys[order], begins[order], at[order]
        later = _later(words, at)
        settled.append(_spans(keys[later], begins[later], begins[later] + np.int32(WINDOW)))
    columns = [np.concatenate(c) for c in zip(*settled, strict=True)] if settled else [[], [], []]
    return _table(*columns)


def repeated_spans(keyed: DataFrame, buckets: int) -> DataFrame:
    """(key, first, stop): spans of words covered by windows that start earlier elsewhere.

    `keyed` has (key BIGINT unique, text). Spans of one key may overlap.
    """
    to = deal(keyed, buckets)
    shared = keyed.sparkSession.sparkContext.broadcast(to)
    sent = keyed.mapInArrow(lambda stream: _packed(stream, shared.value), SENT)

    def repeated(key: tuple, bucket: pa.Table) -> pa.Table:
        return _repeated_hot(bucket) if key[0].as_py() >= buckets else _repeated(bucket)

    return sent.groupBy("bucket").applyInArrow(repeated, "key long, first int, stop int")


def bucket_count(documents: DataFrame, text: str) -> int:
    """One bucket for each RUN_BYTES of text, and at least one for each shuffle partition."""
    size = documents.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    return max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RUN_BYTES + 1)


def _kept(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts with their spans to the kept words."""
    for batch in stream:
        texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        kept, n_words, n_removed = [], [], []
        for text, first, stop in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words = text.as_py().split()
            n_words.append(len(words))
            if first:
                # Spans of consecutive windows cover words from `first` up to `stop`.
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, first, 1)
                np.add.at(change, stop, -1)
                stays = (np.cumsum(change[:-1]) == 0).tolist()
                words = [x for x, keep in zip(words, stays, strict=True) if keep]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_text"],
        )


def remove_repeated(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every document.

    A window of 20 words is repeated if its words also start earlier: in a smaller doc_id, or in
    the same text. All words of repeated windows go; kept words are joined by single spaces. Null
    and empty texts have no words and the kept text ''. If a doc_id is null or repeated, each row
    counts as a document, in the order of (doc_id, text) with nulls last. Other columns are
    ignored; an empty table gives an empty result.
    """
    keyed = with_keys(documents, "__key", doc_id, text)
    rows = keyed.select(F.col("__key").alias("key"), F.col(text).alias("text"))
    spans = repeated_spans(rows, bucket_count(documents, text))
    lists = spans.groupBy("key").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    lists = materialize(lists.select("key", "spans.first", "spans.stop"), "spans")
    n_lists, n_spans = lists.agg(F.count("*"), F.coalesce(F.sum(F.size("first")), F.lit(0))).first()
    if n_lists <= BROADCAST_ROWS and n_spans <= BROADCAST_SPANS:
        lists = F.broadcast(lists)
    whole = keyed.select(F.col("__key").alias("key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    joined = whole.join(lists, "key", "left").select("doc_id", "text", "first", "stop")
    id_type = dict(joined.dtypes)["doc_id"]
    return joined.mapInArrow(_kept, f"doc_id {id_type}, n_words long, n_removed long, kept_text string")
