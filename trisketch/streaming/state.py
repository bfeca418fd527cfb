"""Cross-batch state: stateful aggregates, read back from the state store of their checkpoint.

The store commits a version per micro-batch and a replayed batch starts from the version before
it, so results are exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trisketch.operators.frequency import frequencies, items_in_range
from trisketch.operators.sketch import Rows, count_sketch_of_frequencies, residue


def tag_in_range(items: DataFrame, left: int, right: int) -> DataFrame:
    """Items outside the interval become null: one row of counts then tells their number."""
    return items.select(F.when(F.col("item").between(left, right), F.col("item")).alias("item"))


def frequency_state(items: DataFrame, left: int, right: int) -> DataFrame:
    """(item, f) over the whole stream; the null item counts the lines out of range."""
    return frequencies(tag_in_range(items, left, right))


def residue_state(items: DataFrame, left: int, right: int) -> DataFrame:
    """(item, f) over the whole stream with items reduced mod p, all that a sketch's hashes see of them.

    The first of two levels: a task counts its lines by residue, and a batch updates at most as many
    keys as it has lines, and never more than p, for any depth and width of a sketch.
    """
    return items_in_range(items, left, right).select(residue()).groupBy("item").agg(F.count("*").alias("f"))


def sketch_of_state(counts: DataFrame, rows: Rows, width: int) -> DataFrame:
    """(j, c, val): the second level, from the counts by residue; one state serves any sketch."""
    return count_sketch_of_frequencies(counts, rows, width)


def start_updates(state: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run a stateful aggregate; its result is the state below the checkpoint and nothing else.

    The session names the state store; RocksDB keeps state out of executor heaps.
    """
    return (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "100 milliseconds"}))
        .format("noop")
        .start()
    )


def current_state(spark: SparkSession, checkpoint: str, value: str) -> DataFrame:
    """(keys..., value) as of the last committed micro-batch, read from the state store.

    What is read is the state, however many micro-batches made it.
    """
    rows = spark.read.format("statestore").load(checkpoint)
    buffer = rows.schema["value"].dataType.names[0]
    return rows.select("key.*", F.col("value").getField(buffer).alias(value))
