"""Toxicity by a weighted lexicon: Aho-Corasick over folded text, exception phrases, length norm.

Folding maps look-alike letters of other scripts and digits put for letters to plain letters,
so that a term is found however it is spelt. The lexicon, its weights and the exception phrases
are learned from labelled documents.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that look like a Latin one, and digits put for letters. Fixed values.
LOOK_ALIKES = {
    "а": "a", "α": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ε": "e", "һ": "h", "і": "i", "ι": "i",
    "ј": "j", "к": "k", "κ": "k", "ӏ": "l", "м": "m", "п": "n", "η": "n", "о": "o", "ο": "o", "р": "p",
    "ρ": "p", "ԛ": "q", "ѕ": "s", "т": "t", "τ": "t", "υ": "u", "ν": "v", "ԝ": "w", "х": "x", "χ": "x",
    "у": "y", "γ": "y", "ı": "i", "ɡ": "g",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "l": "i"}

TRAIN_ROWS = 20_000
"""Labelled documents that the lexicon is learned from at most, taken by a hash of their ids."""
LEXICON_SIZE = 5_000
LEAST_DOCUMENTS = 4
LEAST_WEIGHT = 2.5
PREFIXES = (4, 5, 6, 7)


class _Fold(dict):
    """Translation table of str.translate, filled as characters turn up (one entry per character)."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = "".join(LOOK_ALIKES.get(c, c) for c in unicodedata.normalize("NFKC", char).lower())
        if len(plain) == 1:
            plain = DIGITS.get(plain, plain)
        if unicodedata.category(char) in ("Cf", "Mn"):  # invisible marks inside a word
            plain = ""
        elif not plain.isalnum():
            plain = " "
        self[code] = plain
        return plain


FOLD = _Fold()


def folded(text: str | None) -> str:
    """The text with one space before and after each word, look-alikes and digits folded."""
    return " " + " ".join((text or "").translate(FOLD).split()) + " "


@dataclass
class Lexicon:
    """Terms begin with a space (they match where a word begins); one that also ends with a
    space is a whole word. `score` is a logistic function of the normalised sum of weights.
    """

    terms: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    slope: float = 1.0
    offset: float = -4.0


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.terms.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, text: str) -> dict[int, tuple[float, int]]:
        """Begin of each matched word to its best weight and term length, exceptions taken out."""
        best: dict[int, tuple[float, int]] = {}
        spared: list[tuple[int, int]] = []
        if not self.empty:
            for end, (size, weight) in self.automaton.iter(text):
                begin = end - size + 1
                if weight is None:
                    spared.append((begin, end))
                elif begin not in best or best[begin][0] < weight:
                    best[begin] = (weight, size)
        for low, high in spared:
            for begin in [b for b in best if low <= b < high]:
                del best[begin]
        return best

    def strength(self, text: str) -> float:
        """Sum of the weights of the matched words over the logarithm of the length in words."""
        total = sum(w for w, _ in self.hits(text).values())
        return total / math.log2(4 + text.count(" ") / 256)


def _word_features(text: str) -> set[str]:
    features = set()
    for word in set(text.split()):
        features.add(f" {word} ")
        features.update(f" {word[:n]}" for n in PREFIXES if len(word) >= n)
    return features


def _counted(features: Callable[[str], set[str]]):
    """Documents with each feature, by label, summed over a task before anything is shuffled."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update(features(folded(text)))
            # A feature that no toxic document of the batch has still counts against others' batches.
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(terms, pa.string()),
                    pa.array([counts[1][t] for t in terms], pa.int64()),
                    pa.array([counts[0][t] for t in terms], pa.int64()),
                ],
                ["term", "toxic", "clean"],
            )

    return count


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most `rows` labelled documents; the labels are broadcast, not the texts.

    Null ids and labels are left out; a document that is labelled twice is toxic if either says so.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    bounded = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return documents.select("doc_id", "text").join(F.broadcast(bounded), "doc_id").select("text", F.col("toxic").cast("int"))


def _kept_terms(rows: list) -> dict[str, float]:
    """Terms by weight, without those that a shorter kept prefix already stands for."""
    kept: dict[str, float] = {}
    for row in sorted(rows, key=lambda r: (len(r["term"].rstrip()), r["term"])):
        word = row["term"].rstrip()
        stems = (word[:n] for n in range(2, len(word) + 1))
        if not any(kept.get(stem, -math.inf) >= row["weight"] - 0.7 for stem in stems):
            kept[row["term"]] = row["weight"]
    return kept


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a weak prior, so separable data stay finite."""
    if len(x) == 0:
        return 1.0, -4.0
    design = np.stack([x, np.ones_like(x)], axis=1)
    weights = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (y - p) - 0.05 * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2)
        weights = weights + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(weights[0]), float(weights[1])


def learn(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Lexicon:
    """The lexicon of these labelled documents. Without any label it is empty and every score low."""
    spark = documents.sparkSession
    sample = labelled_sample(documents, labels, rows)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def rate(column: str, n: int) -> Column:
        return (F.col(column) + 0.5) / (n + 1)

    error = 1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)  # a term that few documents hold weighs less
    totals = F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    counts = sample.mapInArrow(_counted(_word_features), "term string, toxic long, clean long")
    weighted = (
        counts.groupBy("term")
        .agg(*totals)
        .where(F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumn("weight", F.log(rate("toxic", n_toxic) / rate("clean", n_clean)) - F.sqrt(error))
        .where(F.col("weight") >= LEAST_WEIGHT)
    )
    terms = _kept_terms(weighted.orderBy(F.col("weight").desc(), "term").limit(LEXICON_SIZE).collect())

    shared = spark.sparkContext.broadcast(Lexicon(terms))
    matchers: dict[str, Matcher] = {}

    def matcher() -> Matcher:
        if "one" not in matchers:
            matchers["one"] = Matcher(shared.value)
        return matchers["one"]

    def phrases(text: str) -> set[str]:
        """Each matched word with the word before it, and with the word after it."""
        found = set()
        for begin in matcher().hits(text):
            end = text.index(" ", begin + 1)
            before = text.rfind(" ", 0, begin)
            after = text.find(" ", end + 1)
            if before >= 0:
                found.add(text[before : end + 1])
            if after >= 0:
                found.add(text[begin : after + 1])
        return found

    harmless = (
        sample.mapInArrow(_counted(phrases), "term string, toxic long, clean long")
        .groupBy("term")
        .agg(*totals)
        .where((F.col("clean") >= LEAST_DOCUMENTS) & (rate("clean", n_clean) > 2 * rate("toxic", n_toxic)))
    )
    exceptions = [r["term"] for r in harmless.orderBy(F.col("clean").desc(), "term").limit(LEXICON_SIZE).collect()]

    with_exceptions = spark.sparkContext.broadcast(Lexicon(terms, exceptions))

    def strengths(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(with_exceptions.value)
        for batch in stream:
            x = [match.strength(folded(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], ["x", "toxic"])

    points = sample.mapInArrow(strengths, "x double, toxic int").collect()  # two numbers for each of `rows`
    slope, offset = _logistic(np.array([p["x"] for p in points]), np.array([p["toxic"] for p in points], float))
    return Lexicon(terms, exceptions, slope, offset)


def toxicity(documents: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The documents with `score` (0 to 1) of each whole text.

    Null and empty texts get the score of a text without any term. Repeated rows get equal
    scores; other columns pass through (one named score is replaced). A map without a shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        match = Matcher(shared.value)
        for array in texts:
            x = np.array([match.strength(folded(t.as_py())) for t in array])
            z = np.clip(shared.value.slope * x + shared.value.offset, -30, 30)
            yield pa.array(1 / (1 + np.exp(-z)), pa.float64())

    return documents.withColumn("score", score(text))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train_on(documents: DataFrame, labels: DataFrame) -> Lexicon:
    return learn(documents, labels.where(~held_out(F.col("doc_id"))))
