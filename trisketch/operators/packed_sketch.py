"""Count sketches as one array value of depth x width cells, merged element by element in a tree.

A task adds its items up in such arrays and passes on one for each sketch that it saw, so what is
shuffled are arrays, however many items and cells there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisketch.functions.hashing import P, require_positive
from trisketch.operators.sketch import Rows

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 32
"""Arrays that a task of the merge tree adds up."""
HELD = 64
"""Sketches that a task holds at a time; rows of one sketch are best neighbours."""


def _rows_of(sketches: dict, names: list[str]) -> pa.RecordBatch:
    keys = pa.array(list(sketches), pa.int64())
    cells = pa.array(list(sketches.values()), pa.list_(pa.int64()))
    return pa.record_batch([keys, cells], names)


def packed_sketch(items: DataFrame, rows: Rows, width: int, by: str) -> DataFrame:
    """(by, cells) from (by BIGINT, item): cell c of row j is cells[j * width + c].

    Each task gives its own sum for each `by` it sees, at times more than one; `merge_packed` adds
    them up. Null items and items without `by` are left out.
    """
    require_positive(width=width)
    rows = tuple(rows)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            keys, residues = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for key in np.unique(keys).tolist():
                if key not in held and len(held) == HELD:
                    yield _rows_of(held, [by, "cells"])
                    held = {}
                counts = np.bincount(residues[keys == key], minlength=P)
                seen = np.flatnonzero(counts)
                cells = held.setdefault(key, np.zeros(len(rows) * width, np.int64))
                for j, (ah, bh, ag, bg) in enumerate(rows):
                    place = j * width + (ah * seen + bh) % P % width
                    np.add.at(cells, place, counts[seen] * ((ag * seen + bg) % P % 2 * 2 - 1))
        if held:
            yield _rows_of(held, [by, "cells"])

    residues = items.where(f"item IS NOT NULL AND {by} IS NOT NULL").select(
        F.col(by).cast("bigint").alias(by), F.pmod("item", F.lit(P).cast("bigint")).alias("item")
    )
    return residues.mapInArrow(added, f"{by} bigint, cells array<bigint>")


def merge_packed(packed: DataFrame, depth: int, width: int, fan: int = FAN) -> DataFrame:
    """One row (cells): the sum of all arrays; zeros if there is none.

    Every level adds up within its tasks and leaves one array for each; the next has one task for
    each `fan` of them. What is shuffled is that many arrays, and a task holds one.
    """
    require_positive(depth=depth, width=width, fan=fan - 1)
    size = depth * width

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += batch.column(0).flatten().to_numpy().reshape(-1, size).sum(axis=0)
        yield pa.record_batch([pa.array([total], pa.list_(pa.int64()))], ["cells"])

    sums = packed.select("cells").mapInArrow(added, "cells array<bigint>")
    tasks = packed.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // fan)
        sums = sums.repartition(tasks).mapInArrow(added, "cells array<bigint>")
    return sums


def unpacked(sketch: DataFrame, width: int) -> DataFrame:
    """(j, c, val) of all cells of a packed sketch."""
    cells = sketch.select(F.posexplode("cells").alias("at", "val"))
    return cells.select(F.expr(f"CAST(at div {width} AS INT)").alias("j"), (F.col("at") % width).cast("int").alias("c"), "val")
