"""A unique integer key for the rows of a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisketch.session import materialize


def with_keys(documents: DataFrame, key: str = "__key", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with a unique, non-null BIGINT `key` that is ordered like (doc_id, text).

    Unique ids are their own keys. Where an id is null or repeated, every row is a document of
    its own: rows are sorted by (doc_id, text), nulls last, and numbered; the numbered table is
    written once, so that a lost task reads the same numbers again.
    """
    ids = documents.select(F.col(doc_id).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 OR id IS NULL").isEmpty():
        return documents.withColumn(key, F.col(doc_id).cast("bigint"))
    order = [F.col(c).asc_nulls_last() for c in (doc_id, text)]
    ordered = documents.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.withColumn(key, F.monotonically_increasing_id()), "keyed")
