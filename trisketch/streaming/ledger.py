"""Per-batch ledger with a stop threshold on the number of lines read.

A span is a folder with the counts of a run of batches and a small file that says how many lines
each of them had, which is written last and makes the span valid. Every batch writes its own span;
each FAN batches become one, each FAN of these one more, so a day of batches at 100 ms leaves some
dozens of folders. Where spans overlap, which a crash between writing and removing can leave, the
widest one counts.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trisketch.operators.frequency import frequencies
from trisketch.session import exists, names_in, remove_folder, write_small
from trisketch.streaming.state import tag_in_range

FAN = 16
LINES = "lines.json"
COUNTS = "batch_id long, item long, f long"


@dataclass
class LedgerRun:
    query: StreamingQuery
    reached: threading.Event

    def wait(self) -> None:
        """Return when the source is exhausted or the threshold is reached."""
        while not self.query.awaitTermination(0.05):
            if self.reached.is_set():
                self.query.stop()
        if self.query.exception() is not None:
            raise self.query.exception()


def _name(first: int, last: int) -> str:
    return f"{first:012d}-{last:012d}"


def _valid_spans(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """First and last batch of the spans that together hold every batch once."""
    named = (tuple(map(int, name.split("-"))) for name in names_in(spark, f"{path}/spans"))
    done = [span for span in named if exists(spark, f"{path}/spans/{_name(*span)}/{LINES}")]
    out = []
    for first, last in sorted(done, key=lambda s: (s[0], -s[1])):
        if not out or first > out[-1][1]:
            out.append((first, last))
    return out


def _lines_of(spark: SparkSession, path: str, spans: list[tuple[int, int]]) -> DataFrame:
    """(batch_id, n, total_before) of the batches in the spans."""
    schema = "batch_id long, n long, total_before long"
    files = [f"{path}/spans/{_name(*span)}/{LINES}" for span in spans]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)


def _counts_of(spark: SparkSession, path: str, spans: list[tuple[int, int]]) -> DataFrame:
    folders = [f"{path}/spans/{_name(*span)}/counts" for span in spans]
    return spark.read.schema(COUNTS).parquet(*folders) if folders else spark.createDataFrame([], COUNTS)


def _write_span(spark: SparkSession, path: str, span: tuple[int, int], counts: DataFrame, lines: Callable[[], list[dict]]) -> None:
    """`lines` is asked once the counts are written."""
    folder = f"{path}/spans/{_name(*span)}"
    counts.write.mode("overwrite").parquet(f"{folder}/counts")
    write_small(spark, f"{folder}/{LINES}", "".join(json.dumps(row) + "\n" for row in lines()))


def merge_spans(spark: SparkSession, path: str, first: int, last: int) -> None:
    """Make one span of those in [first, last], then remove them. Twice does no harm."""
    parts = [s for s in _valid_spans(spark, path) if first <= s[0] and s[1] <= last]
    if len(parts) > 1:
        lines = [r.asDict() for r in _lines_of(spark, path, parts).orderBy("batch_id").collect()]  # a row per batch
        _write_span(spark, path, (first, last), _counts_of(spark, path, parts).coalesce(1), lambda: lines)
    for name in names_in(spark, f"{path}/spans"):
        span = tuple(map(int, name.split("-")))
        if first <= span[0] and span[1] <= last and span != (first, last) and exists(spark, f"{path}/spans/{_name(first, last)}/{LINES}"):
            remove_folder(spark, f"{path}/spans/{name}")


def start_ledger(
    items: DataFrame,
    path: str,
    checkpoint: str,
    left: int,
    right: int,
    threshold: int,
    trigger: dict | None = None,
    fan: int = FAN,
) -> LedgerRun:
    """Fold micro-batches until the lines read, in range or not, reach `threshold`.

    A batch is folded if and only if the total before it is below the threshold, so the cut does
    not depend on when the query is stopped. A batch is one job: its counts are written, and the
    number of its lines is observed on the way. A replayed batch writes the same span again; one
    that a wider span already holds is left alone, and so is one without a line.
    """
    spark = items.sparkSession
    reached = threading.Event()
    state = {"next": -1, "total": 0}

    def total_before(batch_id: int, spans: list[tuple[int, int]]) -> int:
        """From the spans, where this process has not folded the batch before."""
        below = _lines_of(spark, path, spans).where(F.col("batch_id") < batch_id)
        return below.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def fold(batch: DataFrame, batch_id: int) -> None:
        spans = _valid_spans(spark, path)
        if state["next"] != batch_id:
            state["total"] = total_before(batch_id, spans) if batch_id else 0
        held = any(first <= batch_id <= last and first != last for first, last in spans)
        n = 0
        if state["total"] < threshold and not held:
            seen = Observation()
            counts = frequencies(tag_in_range(batch.observe(seen, F.count(F.lit(1)).alias("n")), left, right))
            span, row = (batch_id, batch_id), {"batch_id": batch_id, "total_before": state["total"]}
            named = counts.select(F.lit(batch_id).cast("long").alias("batch_id"), "item", "f")
            _write_span(spark, path, span, named, lambda: [row | {"n": seen.get["n"]}])
            n = seen.get["n"]
        elif held:
            n = _lines_of(spark, path, spans).where(F.col("batch_id") == batch_id).first()["n"]
        state["next"], state["total"] = batch_id + 1, state["total"] + n
        size = fan
        while batch_id and batch_id % size == 0 and not held:
            merge_spans(spark, path, batch_id - size, batch_id - 1)
            size *= fan
        if state["total"] >= threshold:
            reached.set()

    query = (
        items.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "100 milliseconds"}))
        .foreachBatch(fold)
        .start()
    )
    return LedgerRun(query, reached)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The non-empty folded batches, (batch_id, n, total_before)."""
    return _lines_of(spark, path, _valid_spans(spark, path)).where("n > 0")


def folded_counts(spark: SparkSession, path: str) -> DataFrame:
    """Item counts of the folded batches, (batch_id, item, f); a null item is out of range."""
    return _counts_of(spark, path, _valid_spans(spark, path))
