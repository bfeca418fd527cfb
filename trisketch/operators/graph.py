"""Edge-set operators: canonical form, vertices, degrees, degree orientation, adjacency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Degrees add up to 2m, so at most this many vertices can have a degree above
# 2m / HOT_VERTICES. That is the size bound of the one table broadcast here (16 bytes each).
HOT_VERTICES = 1_000_000


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Undirected simple edges: u < v, copies, reversed copies and self-loops removed."""
    return (
        edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .where("u < v AND u IS NOT NULL AND v IS NOT NULL")
        .distinct()
    )


def edge_count(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count("*").alias("n_edges"))


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("u", "v")).alias("id")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("u", "v")).alias("id")).where("id IS NOT NULL")
    return ends.groupBy("id").agg(F.count("*").alias("deg"))


def _attach_degree(edges: DataFrame, deg: DataFrame, hot: DataFrame, end: str, other: str) -> DataFrame:
    """Add deg_<end>. Hot vertices come from the bounded broadcast; in the shuffle that looks
    up the rest their edges go by a hash of both ends, so none gathers in one task. What
    such a key may match by chance is ignored, and as ids are unique it adds no row.
    """
    hot = hot.selectExpr(f"id AS {end}", "deg AS hot_deg")
    rest = deg.selectExpr("id AS lookup", "deg AS cold_deg")
    return (
        edges.join(F.broadcast(hot), end, "left")
        .withColumn("lookup", F.expr(f"if(hot_deg IS NULL, {end}, xxhash64({end}, {other}))"))
        .join(rest, "lookup", "left")
        .withColumn(f"deg_{end}", F.coalesce("hot_deg", "cold_deg"))
        .drop("lookup", "hot_deg", "cold_deg")
    )


def orient(edges: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Point every canonical edge from its lower to its higher (degree, id) end.

    Out-degrees are then at most sqrt(2m), whatever the degree of a hub is. That also holds
    inside every group of edges, so one orientation serves any later split of the edges.
    Result: keep..., src, src_deg, dst, dst_deg.
    """
    # Said once here, the planner need not infer it per branch, and the branches stay equal
    # and share their exchanges.
    edges = edges.where(" AND ".join(f"{c} IS NOT NULL" for c in (*keep, "u", "v")))
    deg = degrees(edges)
    ends = deg.agg(F.sum("deg").alias("ends"))
    hot = deg.where(F.col("deg") * HOT_VERTICES > ends.scalar())
    known = _attach_degree(edges, deg, hot, "u", "v")
    known = _attach_degree(known, deg, hot, "v", "u")
    return (
        known.withColumn("forward", F.expr("struct(deg_u, u) < struct(deg_v, v)"))
        .selectExpr(
            *keep,
            "if(forward, u, v) AS src",
            "if(forward, deg_u, deg_v) AS src_deg",
            "if(forward, v, u) AS dst",
            "if(forward, deg_v, deg_u) AS dst_deg",
        )
        .where("src IS NOT NULL")
    )


SIGNATURE = ["bit", "low_bits", "high_bits"]
"""Columns of an edge: the bit that stands for dst, and 128 bits that stand for dst's out-neighbours."""


def with_signatures(oriented: DataFrame) -> DataFrame:
    """Oriented edges with SIGNATURE; the bits are null where no edge leaves dst.

    A vertex whose bit is not set there is no out-neighbour of dst. Vertices of a degree that at most
    HOT_VERTICES can have are looked up in a broadcast, so that no hub gathers its edges in one task.
    """
    edges = oriented.withColumn("bit", F.expr("CAST(pmod(xxhash64(dst), 128) AS INT)"))
    bits = edges.groupBy("src", "src_deg").agg(
        F.expr("bit_or(if(bit < 64, shiftleft(1L, bit), 0L))").alias("low_bits"),
        F.expr("bit_or(if(bit < 64, 0L, shiftleft(1L, bit - 64)))").alias("high_bits"),
    )
    ends = edges.agg((2 * F.count("*")).alias("ends")).scalar()
    hot = lambda deg: F.col(deg) * HOT_VERTICES > ends
    of = lambda rows: rows.select(F.col("src").alias("dst"), "low_bits", "high_bits")
    looked_up = edges.where(hot("dst_deg")).join(F.broadcast(of(bits.where(hot("src_deg")))), "dst", "left")
    return looked_up.unionByName(edges.where(~hot("dst_deg")).join(of(bits), "dst", "left"))


def may_hold(x: str, y: str) -> str:
    """SQL: y may be an out-neighbour of x, both entries of a list with SIGNATURE; never false if it is one."""
    return f"if({y}.bit < 64, getbit({x}.low_bits, {y}.bit), getbit({x}.high_bits, {y}.bit - 64)) = 1"


def out_neighbours(oriented: DataFrame, by: Sequence[str] = (), more: Sequence[str] = ()) -> DataFrame:
    """Per vertex, inside each group of `by`, its out-neighbours ascending by (deg, id).

    A list holds at most sqrt(2m) entries, which carry the columns `more`. Result: by..., src, src_deg, nbrs.
    """
    neighbour = F.expr(f"struct({', '.join(['dst_deg AS deg', 'dst AS id', *more])})")
    return oriented.groupBy(*by, "src", "src_deg").agg(F.sort_array(F.collect_list(neighbour)).alias("nbrs"))
