"""Count sketch in long form (j, c, val): build, merge, look up, second moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisketch.functions.hashing import P, affine_hash, require_positive, row_table, sign_hash
from trisketch.functions.medians import truncated_decimal_median, truncated_median

Rows = Sequence[tuple[int, int, int, int]]

# A sketch has at most depth * min(width, p) rows; up to here a lookup broadcasts it.
BROADCAST_CELLS = 1_000_000


def cell_updates(items: DataFrame, rows: Rows, width: int) -> DataFrame:
    """Every row of `items` once per sketch row j, with its column c and sign s. Narrow."""
    require_positive(width=width)
    item = F.col("item")
    fanned = items.select("*", F.inline(row_table(rows)))
    return fanned.select(
        *items.columns,
        "j",
        affine_hash(item, F.col("ah"), F.col("bh"), width).alias("c"),
        sign_hash(item, F.col("ag"), F.col("bg")).alias("s"),
    )


def residue() -> Column:
    return F.pmod(F.col("item"), F.lit(P).cast("bigint")).alias("item")


def _fold(residues: DataFrame, rows: Rows, width: int, by: Sequence[str]) -> DataFrame:
    """Cells from (by..., item, f) with item already reduced mod p."""
    updates = cell_updates(residues, rows, width).where("c IS NOT NULL AND j IS NOT NULL")
    return updates.groupBy(*by, "j", "c").agg(F.sum(F.col("f") * F.col("s")).alias("val"))


def count_sketch(items: DataFrame, rows: Rows, width: int, by: Sequence[str] = ()) -> DataFrame:
    """Sketch straight from raw items, (by..., j, c, val).

    Both hashes see an item only mod p. So the items are counted by residue first: at most p
    map-side counters per task however many distinct items there are, and only those fan
    out over the sketch rows.
    """
    residues = items.select(*by, residue()).groupBy(*by, "item").agg(F.count("*").alias("f"))
    return _fold(residues, rows, width, by)


def count_sketch_of_frequencies(freq: DataFrame, rows: Rows, width: int) -> DataFrame:
    """The same sketch from a frequency table, where that is needed anyway: no second scan."""
    residues = freq.select(residue(), "f").groupBy("item").agg(F.sum("f").alias("f"))
    return _fold(residues, rows, width, ())


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Sketches add cell by cell."""
    return sketches.groupBy("j", "c").agg(F.sum("val").alias("val"))


def dense_sketch(sketch: DataFrame, depth: int, width: int) -> DataFrame:
    """All depth * width cells, untouched ones 0."""
    require_positive(depth=depth, width=width)
    zeros = sketch.sparkSession.range(depth * width).select(
        F.expr(f"cast(id div {width} as int)").alias("j"),
        F.expr(f"cast(id % {width} as int)").alias("c"),
        F.lit(0).cast("bigint").alias("val"),
    )
    return merge_sketches(sketch.unionByName(zeros))


def row_estimates(freq: DataFrame, sketch: DataFrame, rows: Rows, width: int) -> DataFrame:
    """Per item and sketch row the estimate val * s: (item, f, j, est)."""
    cells = F.broadcast(sketch) if len(rows) * min(width, P) <= BROADCAST_CELLS else sketch
    looked_up = cell_updates(freq, rows, width).join(cells, ["j", "c"], "left")
    return looked_up.select("item", "f", "j", (F.coalesce("val", F.lit(0)) * F.col("s")).alias("est"))


def estimate_frequencies(freq: DataFrame, sketch: DataFrame, rows: Rows, width: int) -> DataFrame:
    """Median of the row estimates of every item: (item, f, f_est)."""
    per_row = row_estimates(freq, sketch, rows, width)
    return per_row.groupBy("item").agg(
        F.max("f").alias("f"), truncated_median(F.collect_list("est")).alias("f_est")
    )


def avg_relative_error(estimates: DataFrame) -> DataFrame:
    """Mean of |f - f_est| / f over the given items with f > 0; null for none."""
    error = F.try_divide(F.abs(F.col("f") - F.col("f_est")).cast("double"), F.col("f").cast("double"))
    return estimates.agg(F.avg(error).alias("avg_rel_error"))


def second_moment_rows(sketch: DataFrame) -> DataFrame:
    """Sum of squared cells of each sketch row, DECIMAL(38,0)."""
    val = F.col("val").cast("decimal(19,0)")
    return sketch.groupBy("j").agg(F.sum((val * val).cast("decimal(38,0)")).cast("decimal(38,0)").alias("f2_row"))


def second_moment_estimate(sketch: DataFrame, depth: int) -> DataFrame:
    """Median over all sketch rows; a row without items counts as 0."""
    zeros = sketch.sparkSession.range(depth).select(
        F.col("id").cast("int").alias("j"), F.lit(0).cast("int").alias("c"), F.lit(0).cast("bigint").alias("val")
    )
    per_row = second_moment_rows(sketch.select("j", "c", "val").unionByName(zeros))
    return per_row.agg(truncated_decimal_median(F.collect_list("f2_row")).alias("f2_est"))
