"""Registered graph queries, each next to the SQL that must give the same rows.

Graph 1, parts and suppliers: one edge per line item between its part id and its supplier id,
read as integers of one id space. Low ids become hubs.
Graph 2, users: an edge between the users of consecutive events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trisketch.functions.hashing import EDGE_HASH, RUNS
from trisketch.operators import colors as co
from trisketch.operators import graph as gr
from trisketch.operators import triangles as tr
from trisketch.plans.reports import triangle_report
from trisketch.session import materialize, shared_folder
from trisketch.sources import edges as src

COLORS = 4
A, B = RUNS[0]
SEED = 7

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def raw_part_edges(spark: SparkSession, sf: str) -> DataFrame:
    return src.edges_from_columns(spark.read.parquet(f"{sf}/lineitem.parquet"), "l_partkey", "l_suppkey")


def part_edges(spark: SparkSession, sf: str) -> DataFrame:
    return gr.canonical_edges(raw_part_edges(spark, sf))


def kept_part_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges written once for several jobs over them."""
    return materialize(part_edges(spark, sf), "edges")


def user_edges(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    return gr.canonical_edges(src.edges_from_transitions(events, "event_id", "user_id"))


def part_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Edge lines with a third field, which the parser has to ignore."""
    table = spark.read.parquet(f"{sf}/lineitem.parquet")
    edges = table.selectExpr("l_partkey AS u", "l_suppkey AS v", "l_linenumber")
    return src.edge_lines(edges, "l_linenumber")


def scanned_part_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Write the edge lines to the shared folder and scan them back."""
    path = shared_folder(spark, "edge-text")
    part_lines(spark, sf).write.text(path)
    return src.read_edge_text(spark, path)


# ---- SQL pieces ------------------------------------------------------------

PARTS = """e AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS u, greatest(l_partkey, l_suppkey) AS v
  FROM lineitem WHERE l_partkey <> l_suppkey)"""
USERS = """e AS (SELECT DISTINCT least(x.user_id, y.user_id) AS u, greatest(x.user_id, y.user_id) AS v
  FROM events x JOIN events y ON y.event_id = x.event_id + 1 WHERE x.user_id <> y.user_id)"""
TRIANGLES = """tri AS (SELECT x.u AS a, x.v AS b, y.v AS c
  FROM e x JOIN e y ON x.v = y.u JOIN e z ON z.u = x.u AND z.v = y.v)"""


def sql_hash(x: str, a: int | str, b: int | str, buckets: int = COLORS) -> str:
    return f"CAST((({a} * {x} + {b}) % 8191) % {buckets} AS INTEGER)"


def grouped_triangles(group: str) -> str:
    """Triangles inside groups of an edge table g(u, v, <group>)."""
    return f"""tri AS (SELECT x.{group}, x.u AS a, x.v AS b, y.v AS c FROM g x
  JOIN g y ON x.{group} = y.{group} AND x.v = y.u
  JOIN g z ON z.{group} = x.{group} AND z.u = x.u AND z.v = y.v)"""


def all_groups(group: str, n: int = COLORS) -> str:
    return f"""SELECT CAST(i AS INTEGER) AS "{group}", count(tri."{group}") AS t
FROM range({n}) r(i) LEFT JOIN tri ON tri."{group}" = i GROUP BY i"""


MONO = f'g AS (SELECT {sql_hash("u", A, B)} AS color, u, v FROM e WHERE {sql_hash("u", A, B)} = {sql_hash("v", A, B)})'
PART_ID = f"CAST((({EDGE_HASH[0]} * u + {EDGE_HASH[1]} * v + {EDGE_HASH[2]}) % 8191) % {COLORS} AS INTEGER)"
PARTED = f"g AS (SELECT {PART_ID} AS part, u, v FROM e)"
DIGEST = f"CAST('0x' || substr(md5('{SEED},' || u || ',' || v), 1, 15) AS BIGINT)"
SHUFFLED = f"g AS (SELECT CAST({DIGEST} % {COLORS} AS INTEGER) AS part, u, v FROM e)"
RUN_ROWS = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(RUNS))
MONO_RUNS = f"""runs(run, a, b) AS (VALUES {RUN_ROWS}),
g AS (SELECT run * {COLORS} + {sql_hash("u", "a", "b")} AS rc, u, v FROM e CROSS JOIN runs
  WHERE {sql_hash("u", "a", "b")} = {sql_hash("v", "a", "b")}),
{grouped_triangles("rc")},
est AS (SELECT CAST(r.run AS INTEGER) AS run, CAST({COLORS * COLORS} * count(tri.rc) AS BIGINT) AS estimate
  FROM runs r LEFT JOIN tri ON tri.rc // {COLORS} = r.run GROUP BY r.run)"""
REPLICATED = f"""h AS (SELECT u, v, {sql_hash("u", A, B)} AS hu, {sql_hash("v", A, B)} AS hv FROM e),
g AS (SELECT list_sort([hu, hv, CAST(i AS INTEGER)]) AS k, u, v FROM h CROSS JOIN range({COLORS}) r(i))"""
CORNER_KEY = f'list_sort([{sql_hash("a", A, B)}, {sql_hash("b", A, B)}, {sql_hash("c", A, B)}])'


def triplet_counts(rows: str, count: str) -> str:
    return f"SELECT k[1] AS c0, k[2] AS c1, k[3] AS c2, count(*) AS {count} FROM {rows} GROUP BY k"


T_K = triplet_counts(f"(SELECT {CORNER_KEY} AS k FROM tri)", "t")
EXACT_RUNS = f"""runs(run, a0, b0) AS (VALUES {RUN_ROWS}),
keyed AS (SELECT run, list_sort([{sql_hash("a", "a0", "b0")}, {sql_hash("b", "a0", "b0")}, {sql_hash("c", "a0", "b0")}]) AS k
  FROM tri CROSS JOIN runs),
per_run AS (SELECT CAST(r.run AS INTEGER) AS run, count(DISTINCT k) AS n_triplets, count(k) AS triangles
  FROM runs r LEFT JOIN keyed USING (run) GROUP BY r.run)"""

# ---- sources ---------------------------------------------------------------

PART_ROWS = "SELECT l_partkey AS u, l_suppkey AS v FROM lineitem"
register("edge_text_parse", lambda s, d: src.parse_edges(part_lines(s, d)), PART_ROWS)
register("edge_text_scan", scanned_part_edges, PART_ROWS)

# ---- both graphs -----------------------------------------------------------

for suffix, edges_of, E in (("", part_edges, PARTS), ("_users", user_edges, USERS)):
    register(f"canonical_edges{suffix}", edges_of, f"WITH {E} SELECT u, v FROM e")
    register(
        f"edge_count{suffix}",
        lambda s, d, g=edges_of: gr.edge_count(g(s, d)),
        f"WITH {E} SELECT count(*) AS n_edges FROM e",
    )
    register(
        f"vertices{suffix}",
        lambda s, d, g=edges_of: gr.vertices(g(s, d)),
        f"WITH {E} SELECT u AS id FROM e UNION SELECT v FROM e",
    )
    register(
        f"triangle_list{suffix}",
        lambda s, d, g=edges_of: tr.triangle_list(g(s, d)),
        f"WITH {E}, {TRIANGLES} SELECT a, b, c FROM tri",
    )
    register(
        f"triangle_count_exact{suffix}",
        lambda s, d, g=edges_of: tr.triangle_count(g(s, d)),
        f"WITH {E}, {TRIANGLES} SELECT count(*) AS triangles FROM tri",
    )
    register(
        f"triangles_by_color{suffix}",
        lambda s, d, g=edges_of: co.triangles_by_color(g(s, d), COLORS, A, B),
        f"WITH {E}, {MONO}, {grouped_triangles('color')} {all_groups('color')}",
    )
    register(
        f"triangles_by_partition{suffix}",
        lambda s, d, g=edges_of: co.triangles_by_partition(co.partition_edges(g(s, d), COLORS), COLORS),
        f"WITH {E}, {PARTED}, {grouped_triangles('part')} {all_groups('part')}",
    )
    register(
        f"triangles_by_triplet{suffix}",
        lambda s, d, g=edges_of: co.unpack_triplets(co.triangles_by_triplet(g(s, d), COLORS, A, B), COLORS),
        f"WITH {E}, {TRIANGLES} {T_K}",
    )
    register(
        f"node_color_median{suffix}",
        lambda s, d, g=edges_of: co.median_over_runs(co.node_color_runs(g(s, d), COLORS, RUNS)),
        f"WITH {E}, {MONO_RUNS} SELECT list_sort(list(estimate))[3] AS median_estimate FROM est",
    )
    register(
        f"triangle_report{suffix}",
        lambda s, d, g=edges_of: triangle_report(g(s, d), COLORS, RUNS, seed=SEED),
        f"""WITH {E}, {MONO_RUNS}, p AS (WITH {SHUFFLED}, {grouped_triangles("part")} SELECT count(*) AS t FROM tri)
SELECT (SELECT count(*) FROM e) AS n_edges, {COLORS} AS colors, {len(RUNS)} AS runs,
  (SELECT list_sort(list(estimate))[3] FROM est) AS node_color_median,
  (SELECT {COLORS * COLORS} * t FROM p) AS partition_estimate""",
    )

register(
    "triangle_report_kept_edges",
    lambda s, d: triangle_report(kept_part_edges(s, d), COLORS, RUNS, seed=SEED),
    ORACLES["triangle_report"],
)

# ---- node colours ----------------------------------------------------------

register(
    "vertex_color",
    lambda s, d: co.vertex_color(part_edges(s, d), COLORS, A, B),
    f"WITH {PARTS} SELECT id, {sql_hash('id', A, B)} AS color FROM (SELECT u AS id FROM e UNION SELECT v FROM e)",
)
register(
    "monochromatic_edges",
    lambda s, d: co.monochromatic_edges(part_edges(s, d), COLORS, A, B),
    f"WITH {PARTS}, {MONO} SELECT color, u, v FROM g",
)
register(
    "edges_per_color",
    lambda s, d: co.edges_per_color(co.monochromatic_edges(part_edges(s, d), COLORS, A, B)),
    f"WITH {PARTS}, {MONO} SELECT color, count(*) AS n_edges FROM g GROUP BY color",
)
register(
    "triangle_approx_node_color",
    lambda s, d: co.approx_by_node_color(part_edges(s, d), COLORS, A, B),
    f"WITH {PARTS}, {MONO}, {grouped_triangles('color')} SELECT {COLORS * COLORS} * count(*) AS estimate FROM tri",
)
register(
    "node_color_runs",
    lambda s, d: co.node_color_runs(part_edges(s, d), COLORS, RUNS),
    f"WITH {PARTS}, {MONO_RUNS} SELECT run, estimate FROM est",
)
register(
    "node_color_median_even",
    lambda s, d: co.median_over_runs(co.node_color_runs(part_edges(s, d), COLORS, RUNS[:4])),
    f"""WITH {PARTS}, {MONO_RUNS}, l AS (SELECT list_sort(list(estimate)) AS x FROM est WHERE run < 4)
SELECT (x[2] + x[3]) // 2 AS median_estimate FROM l""",
)

# ---- edge partitions -------------------------------------------------------

register(
    "edge_partition_sizes",
    lambda s, d: co.edge_partition_sizes(co.partition_edges(part_edges(s, d), COLORS)),
    f"WITH {PARTS}, {PARTED} SELECT part, count(*) AS n_edges FROM g GROUP BY part",
)
register(
    "triangle_approx_partition",
    lambda s, d: co.approx_by_partition(co.partition_edges(part_edges(s, d), COLORS), COLORS),
    f"WITH {PARTS}, {PARTED}, {grouped_triangles('part')} SELECT {COLORS * COLORS} * count(*) AS estimate FROM tri",
)
register(
    "triangle_approx_random_partition",
    lambda s, d: co.approx_by_partition(co.partition_edges_randomly(part_edges(s, d), COLORS, SEED), COLORS),
    f"WITH {PARTS}, {SHUFFLED}, {grouped_triangles('part')} SELECT {COLORS * COLORS} * count(*) AS estimate FROM tri",
)

EVEN = f"""g AS (SELECT u, v,
  CAST((row_number() OVER (ORDER BY md5('{SEED},' || u || ',' || v), u, v) - 1) % {COLORS} AS INTEGER) AS part FROM e)"""
register(
    "edge_partition_sizes_even",
    lambda s, d: co.edge_partition_sizes(co.write_even_parts(part_edges(s, d), COLORS, SEED)),
    f"WITH {PARTS}, {EVEN} SELECT part, count(*) AS n_edges FROM g GROUP BY part",
)
register(
    "triangle_approx_even_partition",
    lambda s, d: co.approx_by_partition(co.write_even_parts(part_edges(s, d), COLORS, SEED), COLORS),
    f"WITH {PARTS}, {EVEN}, {grouped_triangles('part')} SELECT {COLORS * COLORS} * count(*) AS estimate FROM tri",
)

# ---- colour triplets -------------------------------------------------------

register(
    "edge_color_triplets",
    lambda s, d: co.unpack_triplets(co.edge_color_triplets(part_edges(s, d), COLORS, A, B), COLORS),
    f"WITH {PARTS}, {REPLICATED} SELECT k[1] AS c0, k[2] AS c1, k[3] AS c2, u, v FROM g",
)
register(
    "edges_per_triplet",
    lambda s, d: co.unpack_triplets(
        co.edges_per_triplet(co.edge_color_triplets(part_edges(s, d), COLORS, A, B)), COLORS
    ),
    f"WITH {PARTS}, {REPLICATED} {triplet_counts('g', 'n_edges')}",
)
register(
    "triangles_by_triplet_replicated",
    lambda s, d: co.unpack_triplets(co.triangles_by_triplet_replicated(part_edges(s, d), COLORS, A, B), COLORS),
    f"""WITH {PARTS}, {REPLICATED}, {grouped_triangles('k')}
{triplet_counts(f"(SELECT k FROM tri WHERE k = {CORNER_KEY})", "t")}""",
)
register(
    "triplet_key_sizes",
    lambda s, d: co.unpack_triplets(co.key_sizes(part_edges(s, d), COLORS, A, B), COLORS),
    f"WITH {PARTS}, {REPLICATED} {triplet_counts('g', 'n_edges')}",
)
register(
    "triangle_count_by_keys",
    lambda s, d: co.exact_by_keys(part_edges(s, d), A, B),
    f"WITH {PARTS}, {TRIANGLES} SELECT count(*) AS triangles FROM tri",
)
register(
    "triangle_count_color_exact",
    lambda s, d: co.exact_by_triplets(part_edges(s, d), COLORS, A, B),
    f"WITH {PARTS}, {TRIANGLES} SELECT CAST(sum(t) AS BIGINT) AS triangles FROM ({T_K})",
)
register(
    "exact_runs",
    lambda s, d: co.exact_runs(part_edges(s, d), COLORS, RUNS),
    f"WITH {PARTS}, {TRIANGLES}, {EXACT_RUNS} SELECT run, n_triplets, triangles FROM per_run",
)
register(
    "triangle_report_exact",
    lambda s, d: triangle_report(part_edges(s, d), COLORS, RUNS, mode="exact"),
    f"""WITH {PARTS}, {TRIANGLES}, {EXACT_RUNS}
SELECT (SELECT count(*) FROM e) AS n_edges, {COLORS} AS colors, {len(RUNS)} AS runs,
  (SELECT arg_max(triangles, run) FROM per_run) AS triangles""",
)
