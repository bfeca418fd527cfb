"""What a running query did, batch by batch: number, time and metrics, without a job of its own."""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

METRIC = "lines"


def counted(lines: DataFrame) -> DataFrame:
    """The same rows; every micro-batch reports their number as it passes them on."""
    return lines.observe(METRIC, F.count(F.lit(1)).alias("n"))


@dataclass
class Batch:
    batch_id: int
    started: str
    milliseconds: int
    n: int


class Progress(StreamingQueryListener):
    """The non-empty batches of the session's queries, by query.

    A batch that is replayed after a restart reports once more and takes the place of the first.
    """

    def __init__(self) -> None:
        self.batches: dict[str, dict[int, Batch]] = defaultdict(dict)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRIC)
        if seen is not None and seen["n"]:
            batch = Batch(progress.batchId, progress.timestamp, progress.batchDuration, int(seen["n"]))
            self.batches[str(progress.id)][batch.batch_id] = batch

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass


def run_until(spark: SparkSession, start: Callable[[], StreamingQuery], lines: int, seconds: float = 600) -> list[Batch]:
    """Start a query over `counted` lines, stop it once it has read so many, and return its batches.

    An error of the query is raised, and so is one if it neither reads enough nor ends in time.
    """
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        query, deadline = start(), time.monotonic() + seconds
        seen = progress.batches[str(query.id)]
        while query.isActive and sum(b.n for b in list(seen.values())) < lines:
            if time.monotonic() > deadline:
                query.stop()
                raise TimeoutError(f"{len(seen)} batches in {seconds} s")
            time.sleep(0.02)
        query.stop()
        if query.exception() is not None:
            raise query.exception()
        return sorted(seen.values(), key=lambda b: b.batch_id)
    finally:
        spark.streams.removeListener(progress)


def batch_times(spark: SparkSession, batches: list[Batch]) -> DataFrame:
    """(batch_id, started, milliseconds, n) of the batches that were seen."""
    rows = [(b.batch_id, b.started, b.milliseconds, b.n) for b in batches]
    frame = spark.createDataFrame(rows, "batch_id long, started string, milliseconds long, n long")
    return frame.withColumn("started", F.col("started").cast("timestamp"))
