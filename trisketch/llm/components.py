"""Connected components by alternating large and small stars, one shuffle-bound round at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trisketch.session import materialize


BROADCAST_EDGES = 500_000
"""Up to so many edges, counted before, the least neighbours are broadcast (16 bytes each)."""


EDGES_A_TASK = 50_000
"""Fewer edges than this are not worth a task, once each core has one."""


def _few_tasks(spark: SparkSession, edges: int) -> int:
    return max(spark.sparkContext.defaultParallelism, edges // EDGES_A_TASK + 1)


def _towards_least(edges: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    """(v, least) for each edge (u, v), where `least` is the smallest id at or beside u.

    A vertex with very many edges is pre-aggregated for its least neighbour, and its edges meet
    that one row in a join whose large partitions can be split.
    """
    least = F.broadcast(least) if small else least
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _large_star(edges: DataFrame, small: bool, tasks: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least")).coalesce(tasks)
    return _towards_least(both.where("v > u"), least, small).where("u != v")


def _small_star(edges: DataFrame, small: bool, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least")).coalesce(tasks)
    own = least.select("u", F.col("least").alias("v"))
    return _towards_least(down, least, small).where("u != v").unionByName(own).distinct().coalesce(tasks)


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) of every node of the edges (u, v): the smallest id it can reach.

    Loops and repeated edges do no harm; an edge with a null end is left out. Rounds go on until
    the edges stay the same, about log(n) of them; each is written to the shared folder. The
    tasks of a round follow the counted edges and not the session's number of partitions alone.
    """
    state = materialize(
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u != v").select("u", "v").distinct(), purpose
    )
    mark = None
    while True:
        new = state.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if new == mark:
            break
        mark = new
        if new[0] == 0:
            break
        small = new[0] <= BROADCAST_EDGES
        tasks = _few_tasks(edges.sparkSession, new[0])
        state = materialize(_small_star(_large_star(state, small, tasks), small, tasks), purpose)
    leaf = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    root = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaf.unionByName(root)
