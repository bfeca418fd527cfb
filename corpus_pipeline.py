"""A training-data pipeline in stages, each made of one operator of trisketch.llm.

Each stage works on all rows that the one before it kept and returns rows of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trisketch.llm import decontamination, mixing, ngram_join, pii, toxicity
from trisketch.llm.queries import PII_KEY
from trisketch.llm.shipping import ship
from trisketch.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of TOXIC_FROM or more go; a row without text stays."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.toxicity(docs, toxicity.train_on(docs, labels))
    return scored.where(F.col("score") < TOXIC_FROM).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, the first in the order of (doc_id, text)."""
    ship(spark)
    return ngram_join.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    items = ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminated(docs, items).select(*docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values in the texts become pseudonyms; n_chars follows the text."""
    return pii.pseudonymize(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
]

ORACLE_SQL = None
"""Learned scores, keyed pseudonyms and random rounding are no SQL; the tests use brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each one's rows written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
