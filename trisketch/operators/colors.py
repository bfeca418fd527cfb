"""Estimators and decompositions that split a graph by vertex colours or edge partitions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisketch.functions.hashing import EDGE_HASH, P, affine_hash, edge_hash, require_positive, run_table
from trisketch.functions.medians import truncated_median
from trisketch.operators.graph import SIGNATURE, may_hold, orient, out_neighbours, vertices, with_signatures
from trisketch.operators.triangles import triangle_list, triangles_by_group
from trisketch.session import materialize, shared_folder

EDGES_PER_KEY = 4_000_000
"""Edges of a key whose lists one task sorts and joins at a time."""
BROADCAST_KEYS = 100_000
SECOND_COLOR = (6151, 2909)

# ---- node colours ----------------------------------------------------------


def vertex_color(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    require_positive(colors=colors)
    return vertices(edges).select("id", affine_hash(F.col("id"), a, b, colors).alias("color"))


def monochromatic_edges(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    """Edges whose two ends share a colour, tagged with it. Narrow: no shuffle."""
    require_positive(colors=colors)
    h = lambda end: affine_hash(F.col(end), a, b, colors)
    return edges.where(h("u") == h("v")).select(h("u").alias("color"), "u", "v")


def monochromatic_edges_by_run(edges: DataFrame, colors: int, runs: Sequence[tuple[int, int]]) -> DataFrame:
    """The same for many (a, b) at once: fan out over a literal table, filter before any shuffle."""
    require_positive(colors=colors)
    h = lambda end: affine_hash(F.col(end), F.col("a"), F.col("b"), colors)
    fanned = edges.select("u", "v", F.inline(run_table(runs)))
    return fanned.where(h("u") == h("v")).select("run", h("u").alias("color"), "u", "v")


def edges_per_color(mono: DataFrame) -> DataFrame:
    return mono.groupBy("color").agg(F.count("*").alias("n_edges"))


def _with_empty_groups(counts: DataFrame, group: str, groups: int) -> DataFrame:
    """t for each group id in [0, groups), 0 where nothing was found."""
    empty = counts.sparkSession.range(groups).select(
        F.col("id").cast("int").alias(group), F.lit(0).cast("bigint").alias("t")
    )
    return counts.unionByName(empty).groupBy(group).agg(F.sum("t").alias("t"))


def triangles_by_color(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    """t(i) for every colour i."""
    mono = monochromatic_edges(edges, colors, a, b)
    return _with_empty_groups(triangles_by_group(mono, ["color"]), "color", colors)


def scaled_total(counts: DataFrame, groups: int) -> DataFrame:
    """groups^2 times the sum of t; 0 for no groups at all."""
    total = F.coalesce(F.sum("t"), F.lit(0)) * F.lit(groups).cast("bigint") * F.lit(groups).cast("bigint")
    return counts.agg(total.alias("estimate"))


def approx_by_node_color(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    """Node-colour estimate of the number of triangles, one row."""
    return scaled_total(triangles_by_group(monochromatic_edges(edges, colors, a, b), ["color"]), colors)


def node_color_runs(edges: DataFrame, colors: int, runs: Sequence[tuple[int, int]]) -> DataFrame:
    """The node-colour estimate of every run, computed in one job: (run, estimate)."""
    mono = monochromatic_edges_by_run(edges, colors, runs)
    counts = triangles_by_group(mono, ["run", "color"]).select("run", "t")
    per_run = _with_empty_groups(counts, "run", len(runs))
    return per_run.select("run", (F.col("t") * F.lit(colors).cast("bigint") * F.lit(colors).cast("bigint")).alias("estimate"))


def median_over_runs(per_run: DataFrame) -> DataFrame:
    """Median of the runs' estimates; an even number of runs averages the middle two."""
    return per_run.agg(truncated_median(F.collect_list("estimate")).alias("median_estimate"))


# ---- edge partitions -------------------------------------------------------


def partition_edges(
    edges: DataFrame, partitions: int, a1: int = EDGE_HASH[0], a2: int = EDGE_HASH[1], b: int = EDGE_HASH[2]
) -> DataFrame:
    """Give every edge one of `partitions` parts by a hash of the edge.

    The part is a column and not a Spark partition: any number of parts runs over any
    number of tasks, and a recomputed task puts an edge into the same part again.
    """
    require_positive(partitions=partitions)
    # Never null, so no null check on it separates this scan of the edges from others.
    part = F.coalesce(edge_hash(F.col("u"), F.col("v"), partitions, a1, a2, b), F.lit(0))
    return edges.select(part.alias("part"), "u", "v")


def partition_edges_randomly(edges: DataFrame, partitions: int, seed: int) -> DataFrame:
    """The same with a seeded 60-bit digest, evenly random also for consecutive ids."""
    require_positive(partitions=partitions)
    digest = F.substring(F.md5(F.concat_ws(",", F.lit(seed).cast("string"), "u", "v")), 1, 15)
    part = F.coalesce((F.conv(digest, 16, 10).cast("bigint") % partitions).cast("int"), F.lit(0))
    return edges.select(part.alias("part"), "u", "v")


def write_even_parts(edges: DataFrame, partitions: int, seed: int) -> DataFrame:
    """(part, u, v) of `partitions` written parts whose sizes differ by one edge at most.

    Edges are sorted by a seeded digest over all tasks and dealt in turn; a row for each task says
    how many edges precede it. The order is written before numbers are taken from it, and a part is
    a folder, so neither a lost task nor a second run changes what an edge belongs to.
    """
    require_positive(partitions=partitions)
    order = ["digest", "u", "v"]
    digest = F.md5(F.concat_ws(",", F.lit(seed).cast("string"), "u", "v"))
    ordered = edges.where("u IS NOT NULL AND v IS NOT NULL").select(digest.alias("digest"), "u", "v")
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = materialize(ordered.select("u", "v", F.monotonically_increasing_id().alias("at")), "ordered-edges")
    ordered = ordered.withColumn("task", F.shiftright("at", 33))
    sizes = ordered.groupBy("task").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = "coalesce(sum(n) OVER (ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    shifts = F.broadcast(sizes.select("task", F.expr(f"{before} - first").alias("shift")))  # a row per task
    part = F.pmod(F.col("at") + F.col("shift"), F.lit(partitions)).cast("int")
    path = shared_folder(edges.sparkSession, "edge-parts")
    ordered.join(shifts, "task").select("u", "v", part.alias("part")).write.partitionBy("part").parquet(path)
    return edges.sparkSession.read.schema("u bigint, v bigint, part int").parquet(path).select("part", "u", "v")


def edge_partition_sizes(parted: DataFrame) -> DataFrame:
    return parted.groupBy("part").agg(F.count("*").alias("n_edges"))


def triangles_by_partition(parted: DataFrame, partitions: int) -> DataFrame:
    """t(i) for every part i."""
    return _with_empty_groups(triangles_by_group(parted, ["part"]), "part", partitions)


def approx_by_partition(parted: DataFrame, partitions: int) -> DataFrame:
    """Edge-partition estimate of the number of triangles, one row."""
    return scaled_total(triangles_by_group(parted, ["part"]), partitions)


# ---- colour triplets -------------------------------------------------------


def _packed(x: Column, y: Column, z: Column, base: int) -> Column:
    """Three colours, sorted ascending, as the digits of one BIGINT."""
    low, high = F.least(x, y, z), F.greatest(x, y, z)
    return (low.cast("bigint") * base + (x + y + z - low - high)) * base + high


def _unpacked(base: int) -> list[Column]:
    key = F.col("triplet")
    square = F.lit(base * base).cast("bigint")
    width = F.lit(base).cast("bigint")
    return [
        F.call_function("div", key, square).cast("int").alias("c0"),
        F.call_function("div", key % square, width).cast("int").alias("c1"),
        (key % width).cast("int").alias("c2"),
    ]


def _copies(edges: DataFrame, colors: int, a: int, b: int, ends: tuple[str, str]) -> DataFrame:
    """(triplet, third, edge...): every edge once per colour `third` that a triangle's third corner may have."""
    require_positive(colors=colors)
    hu, hv = (affine_hash(F.col(end), a, b, colors) for end in ends)
    copies = edges.select(
        "*", hu.alias("hu"), hv.alias("hv"), F.explode(F.sequence(F.lit(0), F.lit(colors - 1))).alias("third")
    )
    key = _packed(F.col("hu"), F.col("hv"), F.col("third"), colors)
    return copies.select(key.alias("triplet"), "third", *edges.columns)


def edge_color_triplets(
    edges: DataFrame, colors: int, a: int, b: int, ends: tuple[str, str] = ("u", "v")
) -> DataFrame:
    """Every edge once per colour i under the sorted colours of (u, v, i), packed as one BIGINT."""
    return _copies(edges, colors, a, b, ends).drop("third")


def unpack_triplets(keyed: DataFrame, colors: int) -> DataFrame:
    """Replace `triplet` by its three colours c0 <= c1 <= c2."""
    return keyed.select(*_unpacked(colors), *[c for c in keyed.columns if c != "triplet"])


def edges_per_triplet(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("triplet").agg(F.count("*").alias("n_edges"))


def _corner_triplet(colors: int, a: Column | int, b: Column | int) -> Column:
    return _packed(*[affine_hash(F.col(v), a, b, colors) for v in ("a", "b", "c")], colors)


def triangles_by_triplet(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    """t_k per colour triplet, (triplet, t).

    A triangle belongs to the one key that equals its own sorted colours, and all its edges
    lie under that key, so no edge has to be copied. Keys without a triangle are absent.
    """
    require_positive(colors=colors)
    keyed = triangle_list(edges).select(_corner_triplet(colors, a, b).alias("triplet"))
    return keyed.groupBy("triplet").agg(F.count("*").alias("t"))


def colors_for(n_edges: int, edges_per_key: int = EDGES_PER_KEY) -> int:
    """Fewest colours with at most `edges_per_key` edges, on average, under three different colours.

    Such a key holds the edges between three of the colours^2 / 2 pairs of colours.
    """
    require_positive(edges_per_key=edges_per_key)
    return min(P, max(1, math.isqrt(6 * n_edges // edges_per_key) + 1))


def key_sizes(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    """(triplet, n_edges) as `edges_per_triplet` counts them, without a copy: from counts by pair of colours."""
    require_positive(colors=colors)
    hu, hv = (affine_hash(F.col(end), a, b, colors) for end in ("u", "v"))
    pairs = edges.groupBy(F.least(hu, hv).alias("x"), F.greatest(hu, hv).alias("y")).agg(F.count("*").alias("n"))
    thirds = pairs.select("x", "y", "n", F.explode(F.sequence(F.lit(0), F.lit(colors - 1))).alias("z"))
    key = _packed(F.col("x"), F.col("y"), F.col("z"), colors)
    return thirds.groupBy(key.alias("triplet")).agg(F.sum("n").alias("n_edges"))


def oversized_keys(edges: DataFrame, colors: int, a: int, b: int, edges_per_key: int = EDGES_PER_KEY) -> DataFrame:
    """(triplet, splits) of the keys with more edges: second colours that bring each part below the limit."""
    sizes = key_sizes(edges, colors, a, b).where(F.col("n_edges") > edges_per_key)
    splits = F.ceil(F.sqrt(6 * F.col("n_edges") / edges_per_key))
    return sizes.select("triplet", F.least(splits, F.lit(P)).cast("int").alias("splits"))


def _color_sql(x: str, a: int, b: int, colors: int | str) -> str:
    """`affine_hash` as SQL, for use inside lambdas over arrays."""
    return f"CAST(pmod(pmod({a}L * pmod({x}, {P}L) + {b}L, {P}L), {colors}) AS INT)"


def _per_color(lists: DataFrame, name: str, a: int, b: int, colors: int | str) -> DataFrame:
    """The arrays `own` and `above`, one of which is null, cut by the colour `name` of their ids."""
    hue = _color_sql("y", a, b, colors)
    cut = lists.withColumn(name, F.explode(F.expr(f"array_distinct(transform(coalesce(above, own), y -> {hue}))")))
    return cut.withColumns({x: F.expr(f"filter({x}, y -> {hue} = {name})") for x in ("own", "above")})


def copied_lists(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    """(triplet, far, src, mid, own, above): edges copied to keys as lists of ids of the colour `far`.

    As closing edges (own), the out-neighbours of mid go to every key that its colour, theirs and a
    third one make, unless no edge enters mid. As wedges (above), the neighbours of src that rank above
    mid go to the one key of their three colours, but for those that mid's signature rules out.
    """
    require_positive(colors=colors)
    adj = out_neighbours(with_signatures(materialize(orient(edges), "oriented")), (), SIGNATURE)
    closing = (
        f"if(src_deg = size(nbrs), array(), transform(sequence(0, {colors - 1}), c -> "
        "struct(src AS mid, nbrs.id AS own, CAST(null AS array<bigint>) AS above, c AS third)))"
    )
    wedges = (
        "filter(transform(slice(nbrs, 1, size(nbrs) - 1), (x, i) -> struct(x.id AS mid, CAST(null AS array<bigint>) AS own, "
        "if(x.low_bits IS NULL, array(), "
        f"filter(slice(nbrs, i + 2, size(nbrs)), y -> {may_hold('x', 'y')}).id) AS above, {_color_sql('src', a, b, colors)} AS third)), "
        "r -> size(r.above) > 0)"
    )
    sent = adj.select("src", F.explode(F.expr(f"concat({closing}, {wedges})")).alias("r")).selectExpr("src", "r.*")
    sent = _per_color(sent, "far", a, b, colors)
    key = _packed(F.expr(_color_sql("mid", a, b, colors)), F.col("third"), F.col("far"), colors)
    return sent.select(key.alias("triplet"), "far", "src", "mid", "own", "above")


def triangles_by_triplet_replicated(
    edges: DataFrame, colors: int, a: int, b: int, oversized: DataFrame | None = None
) -> DataFrame:
    """t_k from copied edges: enumerate inside every key, keep triangles whose sorted colours equal it.

    Copies are lists, and those that can close no triangle of the key are left out (`copied_lists`).
    They are shuffled once, by key. Inside that distribution lists meet the receiver's own by a
    window. Keys in `oversized` (triplet, splits) are dealt once more by a second colour of the three
    corners.
    """
    copies = copied_lists(edges, colors, a, b)
    by, far = ["triplet"], ["far"]
    if oversized is not None:
        copies = copies.join(oversized, "triplet", "left").withColumn("splits", F.coalesce("splits", F.lit(1)))
        second = lambda x: _color_sql(x, *SECOND_COLOR, "splits")
        others = f"if(above IS NULL, sequence(0, splits - 1), array({second('src')}))"
        copies = _per_color(copies.withColumn("other", F.explode(F.expr(others))), "far2", *SECOND_COLOR, "splits")
        part = _packed(F.expr(second("mid")), F.col("other"), F.col("far2"), P)
        copies = copies.withColumn("part", part)
        by, far = ["triplet", "part"], ["far", "far2"]
    copies = copies.select(*by, *far, "mid", "own", "above").repartition(*by)
    own = F.first("own", ignorenulls=True).over(Window.partitionBy(*by, *far, "mid"))
    met = copies.withColumn("own", own).where("above IS NOT NULL AND own IS NOT NULL")
    found = F.size(F.array_intersect("above", "own")).cast("bigint")
    return met.groupBy("triplet").agg(F.sum(found).alias("t")).where("t > 0")


def exact_by_keys(edges: DataFrame, a: int, b: int, edges_per_key: int = EDGES_PER_KEY) -> DataFrame:
    """Exact count over keys of a bounded number of edges, one row.

    The edges are written once and counted, which gives the colours, and then the keys that are still
    larger: two small jobs before the plan. Larger keys are broadcast up to BROADCAST_KEYS of them.
    """
    edges = materialize(edges, "edges")
    colors = colors_for(edges.count(), edges_per_key)
    oversized = oversized_keys(edges, colors, a, b, edges_per_key)
    n = oversized.count()
    split = None if n == 0 else F.broadcast(oversized) if n <= BROADCAST_KEYS else oversized
    return exact_total(triangles_by_triplet_replicated(edges, colors, a, b, split))


def exact_total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("triangles"))


def exact_by_triplets(edges: DataFrame, colors: int, a: int, b: int) -> DataFrame:
    """Exact count as the sum of t_k over all triplets, one row."""
    return exact_total(triangles_by_triplet(edges, colors, a, b))


def exact_runs(edges: DataFrame, colors: int, runs: Sequence[tuple[int, int]]) -> DataFrame:
    """The exact count of every run, (run, n_triplets, triangles), enumerating only once.

    n_triplets counts the keys that hold a triangle.
    """
    require_positive(colors=colors)
    corners = triangle_list(edges).select("a", "b", "c", F.inline(run_table(runs).alias("r")).alias("run", "ra", "rb"))
    keyed = corners.select("run", _corner_triplet(colors, F.col("ra"), F.col("rb")).alias("triplet"))
    counts = keyed.groupBy("run", "triplet").agg(F.count("*").alias("t"))
    empty = edges.sparkSession.range(len(runs)).select(
        F.col("id").cast("int").alias("run"), F.lit(None).cast("bigint").alias("triplet"), F.lit(0).cast("bigint").alias("t")
    )
    return (
        counts.unionByName(empty)
        .groupBy("run")
        .agg(F.count("triplet").alias("n_triplets"), F.sum("t").alias("triangles"))
    )


def last_run(per_run: DataFrame) -> DataFrame:
    """The answer of an exact repetition is the last run's count."""
    return per_run.agg(F.max_by("triangles", "run").alias("triangles"))
