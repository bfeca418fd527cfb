"""Exact triangle enumeration and counting, over a whole graph or inside groups of edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisketch.operators.graph import orient, out_neighbours

# A vertex gets one more salt for as many ids as it can receive: its degree bounds the lists, and
# the degree of a sender, which is no larger, bounds a list.
IDS_PER_SALT = 10_000_000
# No list is longer than sqrt(2m); this holds up to 2 * 10^12 edges.
LONGEST_LIST = 2_000_000
# A vertex with more out-neighbours than this sends its lists from several tasks.
RECEIVERS_PER_BLOCK = 1024


def _salts(degree: str) -> str:
    return f"CAST({degree} AS BIGINT) * least({degree}, {LONGEST_LIST}) div {IDS_PER_SALT}"


def closed_wedges(oriented: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per oriented edge (src, mid), inside each group of `by`, the third vertices that close a triangle.

    Every vertex sends, along each out-edge, the part of its out-neighbour list that ranks
    above the receiver; the receiver intersects it with its own list. No pair of neighbours
    becomes a row of its own. Long lists are cut into blocks of receivers, which spread over
    tasks before they fan out; short ones fan out where they are. Receivers are salted by what they can receive, so the lists for a hub
    spread as well; its own list is copied once per salt.
    Result: by..., src, mid, closing (array).
    """
    adj = out_neighbours(oriented, by)
    short = adj.where(f"size(nbrs) > 1 AND size(nbrs) <= {RECEIVERS_PER_BLOCK} + 1").selectExpr(
        *by, "src", "0 AS block", "slice(nbrs.deg, 1, size(nbrs)) AS degs", "nbrs.id AS ids"
    )
    long = (
        adj.where(f"size(nbrs) > {RECEIVERS_PER_BLOCK} + 1")
        .selectExpr(
            *by, "src", "nbrs", f"explode(sequence(0, (size(nbrs) - 2) div {RECEIVERS_PER_BLOCK})) AS block"
        )
        .selectExpr(
            *by,
            "src",
            "block",
            f"slice(nbrs.deg, block * {RECEIVERS_PER_BLOCK} + 1, {RECEIVERS_PER_BLOCK}) AS degs",
            f"slice(nbrs.id, block * {RECEIVERS_PER_BLOCK} + 1, size(nbrs)) AS ids",
        )
        .repartition(*by, "src", "block")
    )
    sent = (
        short.unionByName(long)
        .selectExpr(*by, "src", "ids", "posexplode(degs) AS (pos, deg)")
        .where("pos < size(ids) - 1")
        .selectExpr(
            *by,
            "src",
            "ids[pos] AS mid",
            f"pmod(xxhash64(src), 1 + {_salts('deg')}) AS salt",
            "slice(ids, pos + 2, size(ids)) AS above",
        )
    )
    own = adj.selectExpr(
        *by,
        "src AS mid",
        f"explode(sequence(0L, {_salts('src_deg')})) AS salt",
        "nbrs.id AS own",
    )
    # Array sizes escape the planner's estimates, so it must not broadcast the lists.
    return sent.join(own.hint("merge"), [*by, "mid", "salt"]).selectExpr(
        *by, "src", "mid", "array_intersect(above, own) AS closing"
    )


def closed_triangles(oriented: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every triangle of oriented edges once, as (by..., a, b, c) with a < b < c."""
    corners = closed_wedges(oriented, by).select(*by, "src", "mid", F.explode("closing").alias("far"))
    low, high = F.least("src", "mid", "far"), F.greatest("src", "mid", "far")
    between = F.greatest(F.least("src", "mid"), F.least(F.greatest("src", "mid"), F.col("far")))
    return corners.select(*by, low.alias("a"), between.alias("b"), high.alias("c"))


def triangle_list(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same for canonical edges."""
    return closed_triangles(orient(edges, by), by)


def triangle_count(edges: DataFrame) -> DataFrame:
    """One row: the exact number of triangles."""
    found = F.sum(F.size("closing").cast("bigint"))
    return closed_wedges(orient(edges)).agg(F.coalesce(found, F.lit(0)).alias("triangles"))


def triangles_by_group(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Triangles formed by the edges of each group, (by..., t); groups without one are absent."""
    found = closed_wedges(orient(edges, by), by).where(F.size("closing") > 0)
    return found.groupBy(*by).agg(F.sum(F.size("closing").cast("bigint")).alias("t"))
