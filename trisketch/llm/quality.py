"""Document quality: a text classifier combined with hierarchical empirical Bayes over sites.

The classifier gives each document's own evidence. Documents are also grouped by host and, within
it, by path; what is known of a group's documents gives its posterior rate of good ones, shrunk
towards the host's, and the host's towards the global rate, the more the fewer documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisketch.llm.words import IS_SPACE
from trisketch.session import materialize

TRAIN_ROWS = 20_000
"""Labelled documents that the classifier is fitted on at most, taken by a hash of their ids."""
FEATURES = 10
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1e6

_LETTER, _UPPER, _DIGIT, _PLAIN = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT[48:58] = True
_PLAIN[[ord(c) for c in ".,;:'\"-()?"]] = True


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text: length, classes of characters, repetition of words and lines."""
    data = (text or "").encode()
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(len(data), 1)
    words, lines = data.split(), data.split(b"\n")
    distinct = len(set(words))
    letters = count[_LETTER].sum()
    odd = len(data) - letters - count[_DIGIT | _PLAIN | IS_SPACE].sum()
    return np.array(
        [
            np.log1p(len(words)),
            letters / size,
            count[_UPPER].sum() / max(letters, 1),
            count[_DIGIT].sum() / size,
            count[_PLAIN].sum() / size,
            odd / size,
            min(len(data) / max(len(words), 1), 30.0),
            np.log1p(distinct) / np.log1p(max(len(words), 1)),
            1 - len(set(lines)) / len(lines),
            min(len(words) / len(lines), 200.0) / 200,
        ]
    )


@dataclass
class Classifier:
    """Logistic regression on standardised features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z, np.ones((len(z), 1))], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -20, 20)))


def fit(x: np.ndarray, y: np.ndarray) -> Classifier:
    """Newton steps with a weak prior. Without rows every probability is one half."""
    if not len(x):
        return Classifier(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(2 * FEATURES + 1))
    model = Classifier(x.mean(0), x.std(0) + 1e-6, np.zeros(2 * FEATURES + 1))
    design = model.design(x)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ model.weights, -20, 20)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.eye(design.shape[1])
        step = np.linalg.solve(hessian, design.T @ (y - p) - model.weights)
        model.weights = model.weights + np.clip(step, -3, 3)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """The classifier from at most `rows` rows of (doc_id, good); texts are not shuffled."""
    bounded = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = documents.select("doc_id", "text").join(F.broadcast(bounded), "doc_id").select("text", "good")

    def shaped(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            x = [features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "good"])

    points = sample.mapInArrow(shaped, "x array<double>, good int").toArrow()  # FEATURES numbers for each of `rows`
    x = np.array(points.column("x").to_pylist(), float).reshape(-1, FEATURES)
    return fit(x, points.column("good").to_numpy().astype(float))


def _strength(groups: DataFrame, prior: str) -> Column:
    """Pseudo-count k of a Beta prior by moments: between groups the rate varies by q (1 - q) / (k + 1)."""
    rate = F.col("s") / F.col("n")
    inner = F.col(prior) * (1 - F.col(prior))
    # The squared distance from the prior, less what chance within a group of n makes of it.
    spread = F.sum(F.col("n") * F.pow(rate - F.col(prior), 2) - inner) / F.sum(F.col("n") - 1)
    row = groups.where("n > 1").agg(
        F.greatest(F.lit(LEAST_STRENGTH), F.least(F.lit(MOST_STRENGTH), F.try_divide(F.avg(inner), F.greatest(spread, F.lit(1e-9))) - 1)).alias("k")
    )
    return F.coalesce(row.scalar(), F.lit(MOST_STRENGTH))


def _logit(p: Column) -> Column:
    inside = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.ln(inside / (1 - inside))


def quality(documents: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """(doc_id, evidence, host_rate, path_rate, score) of every document; score is P(good).

    `labels` has (doc_id, quality); rows with a null id or a label other than 0 and 1 are left
    out, the lowest of repeated labels counts. Labelled documents enter their groups by the
    label, others by their evidence. Null hosts and paths are groups of their own. A null text is
    an empty one. Every row has a score of its own; repeated rows count as often as they are
    there. Other columns are ignored; an empty table gives an empty result.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    shared = documents.sparkSession.sparkContext.broadcast(learn(documents, known))

    @F.arrow_udf("double")
    def evidence(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            x = np.array([features(t.as_py()) for t in array]).reshape(-1, FEATURES)
            yield pa.array(shared.value.probability(x), pa.float64())

    rows = documents.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), evidence("text").alias("evidence"))
    rows = materialize(rows, "evidence")
    held = rows.join(known, "doc_id", "left").withColumn("mass", F.coalesce(F.col("good").cast("double"), "evidence"))
    paths = materialize(held.groupBy("host", "path").agg(F.sum("mass").alias("s"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    rate = F.coalesce(hosts.agg(F.sum("s") / F.sum("n")).scalar(), F.lit(0.5))
    hosts = materialize(hosts.withColumn("rate", rate), "hosts")
    k = _strength(hosts, "rate")
    hosts = hosts.select(
        F.col("host").alias("h"), "rate", ((F.col("s") + k * F.col("rate")) / (F.col("n") + k)).alias("host_rate")
    )
    paths = materialize(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "path-rates")
    k = _strength(paths, "host_rate")
    paths = paths.select(
        F.col("host").alias("h"),
        F.col("path").alias("p"),
        "rate",
        "host_rate",
        ((F.col("s") + k * F.col("host_rate")) / (F.col("n") + k)).alias("path_rate"),
    )
    same = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))
    odds = _logit(F.col("evidence")) + _logit(F.col("path_rate")) - _logit(F.col("rate"))
    return rows.join(paths, same).select(
        "doc_id", "evidence", "host_rate", "path_rate", (1 / (1 + F.exp(-odds))).alias("score")
    )
