"""Item sources: one integer per text line, or an integer column of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_items(lines: DataFrame, strict: bool = True) -> DataFrame:
    """lines(value, ...) to (..., item): the line read as one BIGINT.

    A bad line raises when strict, else its item is null.
    """
    value = F.col("value")
    item = value.cast("bigint") if strict else value.try_cast("bigint")
    return lines.withColumn("item", item).drop("value")


def items_from_column(table: DataFrame, item: str, *keep: str) -> DataFrame:
    return table.select(*keep, F.col(item).cast("bigint").alias("item"))


def equal_batches(table: DataFrame, order: str, batches: int) -> Column:
    """Batch number of a row when a dense 0-based order key is cut into `batches` runs of rows.

    Run sizes differ by one row at most; a table with fewer rows gets one run per row.
    """
    n = table.agg(F.count("*").alias("n"))
    runs = F.least(F.lit(batches).cast("bigint"), n.scalar())
    return F.call_function("div", F.col(order) * runs, n.scalar())


def batch_bounds(rows: int, batches: int) -> list[tuple[int, int]]:
    """The runs of `equal_batches` as ranges [low, high) of the order key."""
    runs = min(batches, rows)
    cuts = [-(-i * rows // runs) for i in range(runs + 1)] if runs else [0]
    return list(zip(cuts[:-1], cuts[1:]))
