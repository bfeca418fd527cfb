"""Edge sources: comma-separated text and integer columns of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _field(name: str, index: int, strict: bool) -> Column:
    part = F.get(F.split(F.col("value"), ","), index)
    if not strict:
        return part.try_cast("bigint").alias(name)
    # A null would slip through the cast, so a missing field has to raise by itself.
    checked = F.when(part.isNull(), F.raise_error(F.concat(F.lit("bad edge line: "), F.col("value")))).otherwise(part)
    return checked.cast("bigint").alias(name)


def parse_edges(lines: DataFrame, strict: bool = True) -> DataFrame:
    """lines(value) to (u, v): fields 0 and 1, further fields ignored.

    A bad line raises when strict, else its unreadable endpoints become null.
    """
    return lines.select(_field("u", 0, strict), _field("v", 1, strict))


def read_edge_text(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Scan a text edge list, one `u,v` per line."""
    return parse_edges(spark.read.text(path), strict)


def edges_from_columns(table: DataFrame, u: str, v: str) -> DataFrame:
    """Every row of a table as one edge between two integer columns."""
    return table.select(F.col(u).cast("bigint").alias("u"), F.col(v).cast("bigint").alias("v"))


def edges_from_transitions(table: DataFrame, order: str, vertex: str) -> DataFrame:
    """Edges between the vertices of rows whose unique, gap-free order key is n and n+1.

    One row gives at most one edge, so the result never outgrows the table.
    """
    now = table.select(F.col(order).alias("at"), F.col(vertex).cast("bigint").alias("u"))
    following = table.select((F.col(order) - 1).alias("at"), F.col(vertex).cast("bigint").alias("v"))
    return now.join(following, "at").select("u", "v")


def edge_lines(edges: DataFrame, *extra: str) -> DataFrame:
    """Edges written as text lines `u,v[,extra...]`."""
    return edges.select(F.concat_ws(",", *[F.col(c).cast("string") for c in ("u", "v", *extra)]).alias("value"))
