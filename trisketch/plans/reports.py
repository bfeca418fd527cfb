"""The one-row reports a run ends with.

Every figure enters as a scalar subquery, so the rows need no join and the branches share
their exchanges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisketch.operators import colors as co
from trisketch.operators import frequency as fr
from trisketch.operators import sketch as sk
from trisketch.operators.graph import edge_count
from trisketch.operators.triangles import triangle_count


def triangle_report(
    edges: DataFrame, colors: int, runs: Sequence[tuple[int, int]], mode: str = "approx", seed: int = 7
) -> DataFrame:
    """Approximate mode: median node-colour estimate over all runs and the estimate by a random
    partition of the edges. Exact mode: the number of triangles, which is the same in every run.
    """
    head = [
        F.col("n_edges"),
        F.lit(colors).cast("int").alias("colors"),
        F.lit(len(runs)).cast("int").alias("runs"),
    ]
    if mode == "approx":
        median = co.median_over_runs(co.node_color_runs(edges, colors, runs))
        parted = co.approx_by_partition(co.partition_edges_randomly(edges, colors, seed), colors)
        figures = [
            median.scalar().alias("node_color_median"),
            parted.scalar().alias("partition_estimate"),
        ]
    elif mode == "exact":
        figures = [triangle_count(edges).scalar().alias("triangles")]
    else:
        raise ValueError(f"mode must be 'approx' or 'exact', got {mode!r}")
    return edge_count(edges).select(*head, *figures)


def heavy_hitters(freq: DataFrame, sketch: DataFrame, rows: sk.Rows, width: int, k: int) -> DataFrame:
    """Exact and estimated frequency of the top-k items with ties, (item, f, f_est)."""
    return sk.estimate_frequencies(fr.top_k_with_ties(freq, k), sketch, rows, width)


def second_moments(freq: DataFrame, sketch: DataFrame, depth: int) -> DataFrame:
    """True and estimated F2, both normalised by the squared number of in-range items."""
    n = freq.agg(F.sum("f").cast("double").alias("n"))
    estimate = sk.second_moment_estimate(sketch, depth).select("f2_est", n.scalar().alias("n"))
    return estimate.select("f2_est", F.try_divide(F.col("f2_est").cast("double"), F.col("n") * F.col("n")).alias("f2_est_norm"))


def stream_report(
    length: DataFrame, freq: DataFrame, sketch: DataFrame, rows: sk.Rows, width: int, left: int, right: int, k: int
) -> DataFrame:
    """All statistics of a stream from its length (n_items), frequencies and sketch."""
    heavy = heavy_hitters(freq, sketch, rows, width, k)
    size = heavy.agg(F.count("*").alias("n"))
    parameters = {"depth": len(rows), "width": width, "range_left": left, "range_right": right, "k": k}
    return fr.range_totals(freq).select(
        *[F.lit(v).cast("bigint").alias(name) for name, v in parameters.items()],
        length.select("n_items").scalar().alias("n_items"),
        "n_in_range",
        "n_distinct",
        fr.phi_k(freq, k).scalar().alias("phi"),
        size.scalar().alias("n_top"),
        sk.avg_relative_error(heavy).scalar().alias("avg_rel_error"),
        fr.second_moment(freq).select("f2_norm").scalar().alias("f2_norm"),
        second_moments(freq, sketch, len(rows)).select("f2_est_norm").scalar().alias("f2_est_norm"),
    )
