"""Exact statistics of an integer item stream: counts, frequencies, top-K, second moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def items_in_range(items: DataFrame, left: int, right: int) -> DataFrame:
    """Items with left <= item <= right; the predicate reaches a Parquet scan."""
    return items.where(F.col("item").between(left, right))


def stream_length(items: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("n_items"))


def frequencies(items: DataFrame) -> DataFrame:
    """(item, f); a hot item is pre-counted before the shuffle."""
    return items.groupBy("item").agg(F.count("*").alias("f"))


def batch_item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("batch_id", "item").agg(F.count("*").alias("f"))


def merge_batch_counts(counts: DataFrame) -> DataFrame:
    """Frequencies over all batches from per-batch counts."""
    return counts.groupBy("item").agg(F.sum("f").alias("f"))


def batch_sizes(items: DataFrame) -> DataFrame:
    """Ledger of the non-empty batches, (batch_id, n)."""
    return items.groupBy("batch_id").agg(F.count("*").alias("n"))


def threshold_batches(ledger: DataFrame, threshold: int | object, block: int = 10_000) -> DataFrame:
    """Batches read before the stream stops: those that started below `threshold` rows.

    Result: batch_id, n, total_before. The running total goes through blocks of batch ids, so
    only one row per `block` batches meets in a single task.
    """
    ledger = ledger.withColumn("block", F.floor(F.col("batch_id") / block)).where("block IS NOT NULL")
    totals = ledger.groupBy("block").agg(F.sum("n").alias("block_n"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    over_blocks = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("block").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("block", F.coalesce(F.sum("block_n").over(over_blocks), F.lit(0)).alias("start"))
    before = F.col("start") + F.coalesce(F.sum("n").over(in_block), F.lit(0))
    return (
        ledger.join(starts, "block")
        .select("batch_id", "n", before.alias("total_before"))
        .where(F.col("total_before") < threshold)
    )


def range_totals(freq: DataFrame) -> DataFrame:
    """Items and distinct items behind a frequency table, exact."""
    return freq.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n_in_range"), F.count("*").alias("n_distinct"))


def items_by_frequency(freq: DataFrame) -> DataFrame:
    return freq.orderBy(F.col("f").desc(), "item")


def phi_k(freq: DataFrame, k: int) -> DataFrame:
    """The k-th largest frequency, repeats counted; the smallest one if there are fewer than k.

    Items are counted per frequency first. Frequencies add up to the stream's length n, so at most
    sqrt(2n) distinct ones go through the running sum, whatever k is.
    """
    per_frequency = freq.where("f IS NOT NULL").groupBy("f").agg(F.count("*").alias("items"))
    above = F.coalesce(F.sum("items").over(Window.orderBy(F.col("f").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per_frequency.select("f", above.alias("above")).where(F.col("above") < max(k, 0)).agg(F.min("f").alias("phi"))


def top_k_with_ties(freq: DataFrame, k: int) -> DataFrame:
    """The k most frequent items and every further item as frequent as the k-th.

    phi(k) enters the filter as a scalar subquery: neither a join nor a window.
    """
    return freq.where(F.col("f") >= phi_k(freq, k).scalar())


def second_moment(freq: DataFrame) -> DataFrame:
    """F2 = sum of f^2 as DECIMAL(38,0), and F2 / n^2 (null for no items)."""
    f = F.col("f").cast("decimal(19,0)")
    n = F.sum("f").cast("double")
    f2 = F.coalesce(F.sum((f * f).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
    return freq.agg(f2.alias("f2"), F.try_divide(f2.cast("double"), n * n).alias("f2_norm"))
