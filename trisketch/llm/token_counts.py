"""Token counts by a two-tier map-side lookup.

Tier one is a broadcast hash table from frequent pre-tokens to their number of tokens; tier two
is a bounded cache in each Python worker, filled by encoding what the table lacks. A pre-token
is never shuffled: the counts behind the table travel as one bounded summary per task.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# The pre-tokenizer pattern of byte-level BPE, and white space as its regex engine knows it. Fixed values.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"|\x20?\p{L}+|\x20?\p{N}+"
    rf"|\x20?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

# Code points whose class is the same in all Unicode versions in use: Latin to Armenian, Hebrew,
# Arabic, Indic up to Kannada's gap, punctuation, symbols, kana, Han, Hangul, emoji.
SETTLED = "\x00-\u0557\u05d0-\u05ea\u0600-\u06ff\u0900-\u0c5b\u1e00-\u206f\u20a0-\u20bf\u2100-\u2bff\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\ufe00-\ufe0f\U0001f300-\U0001f6d2"

TABLE_SIZE = 65_536
"""Entries of the broadcast table at most; at about 20 bytes each it stays below 2 MB."""
RARE = 20_000
"""A word below this fraction (1 / RARE) of a task's words is left out of the task's summary."""
CACHE_SIZE = 400_000
LONGEST_KEPT = 64


def _batches_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words that are frequent in this task: lossy counting, so at most a few
    times RARE counters are held, and at most RARE rows come out.
    """
    counts: Counter = Counter()
    seen = pruned_at = 0
    for batch in stream:
        for text in batch.column(0).to_pylist():
            if text:
                words = text.split(" ")
                counts.update(words)
                seen += len(words)
                if seen - pruned_at > 100 * RARE:
                    least = max(1, (seen - pruned_at) // (20 * RARE))
                    counts = Counter({w: c for w, c in counts.items() if c > least})
                    pruned_at = seen
    kept = [(w, c) for w, c in counts.items() if c * RARE >= seen and len(w) <= LONGEST_KEPT]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in kept], pa.string()), pa.array([c for _, c in kept], pa.int64())], ["word", "n"]
    )


def frequent_words(documents: DataFrame, text: str = "text", size: int = TABLE_SIZE) -> DataFrame:
    """(word, n): at most `size` space-separated words that are frequent over all documents.

    Every text is read whole. A count may be short by what a task's summary left out; it only
    decides what the table holds, never a result.
    """
    summaries = documents.select(text).mapInArrow(_batches_of, "word string, n long")
    totals = summaries.groupBy("word").agg(F.sum("n").alias("n"))
    return totals.orderBy(F.col("n").desc(), "word").limit(size)


class _Lengths(dict):
    """Pre-token to token count. A miss goes to the worker's cache, then to the tokenizer."""

    def __init__(self, table: dict, tokenizer: Tokenizer):
        super().__init__(table)
        self.tokenizer, self.cache = tokenizer, {}

    def __missing__(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
            if len(piece) <= LONGEST_KEPT:
                if len(self.cache) >= CACHE_SIZE:
                    self.cache.clear()
                self.cache[piece] = n
        return n


class Counting:
    """Counts the tokens of texts as the tokenizer library does, without added special tokens.

    A text that holds the string of an added token, or a character that not all versions of
    Unicode class alike, goes to the library as a whole.
    """

    def __init__(self, tokenizer: Tokenizer, table: dict):
        self.tokenizer = tokenizer
        self.split = regex.compile(PRE_TOKENS).findall
        self.unsettled = regex.compile(f"[^{SETTLED}]").search
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.length = _Lengths(table, tokenizer).__getitem__

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if any(a in text for a in self.added) or not text.isascii() and self.unsettled(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.length, self.split(text)))


def length_table(tokenizer: Tokenizer, words: list[str]) -> dict[str, int]:
    """Token counts of the pre-tokens of these words, each alone and after a space."""
    split = regex.compile(PRE_TOKENS).findall
    pieces = sorted({p for w in words for p in itertools.chain(split(w), split(" " + w))})
    encoded = tokenizer.encode_batch(pieces, add_special_tokens=False)
    return {p: len(e.ids) for p, e in zip(pieces, encoded, strict=True)}


_COUNTING: dict[str, Counting] = {}


def counting_of(name: str, content: str, table: dict[str, int]) -> Counting:
    """The counter of this worker process, by the digest of its file and table; it outlives the task."""
    if name not in _COUNTING:
        _COUNTING.clear()
        _COUNTING[name] = Counting(Tokenizer.from_str(content), table)
    return _COUNTING[name]


def token_counts(
    documents: DataFrame, tokenizer_file: str, text: str = "text", table_size: int = TABLE_SIZE
) -> DataFrame:
    """The documents with n_bytes (UTF-8) and n_tokens of each whole text.

    `tokenizer_file` is a byte-level BPE file of the tokenizers library on the driver; its
    content is broadcast. A null text counts as empty: 0 bytes, 0 tokens. Every row keeps its
    own count, repeated or not; an empty table gives an empty result; other columns pass through
    (a column named n_bytes or n_tokens is replaced).
    """
    spark = documents.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        content = file.read()
    words = [r["word"] for r in frequent_words(documents, text, table_size).collect()]
    table = length_table(Tokenizer.from_str(content), words)
    name = hashlib.sha256(repr((content, sorted(table.items()))).encode()).hexdigest()
    shared = spark.sparkContext.broadcast((name, content, table))

    @F.arrow_udf("long")
    def n_tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counting_of(*shared.value)
        for array in texts:
            yield pa.array([count(t.as_py()) for t in array], pa.int64())

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return documents.withColumns({"n_bytes": size, "n_tokens": n_tokens(text)})
