"""Near-duplicate vectors by sorted projection passes.

Each pass orders all vectors lexicographically by the signs of its own random projections, one
bit after the other, and compares every vector with a bounded window of neighbours in that order.
Pairs with a cosine of at least 0.95 are united across passes. Links that a window was too short
to see are completed inside the components found, so that the number of links of a vector in a
large group is exact. A component of more than one block is cut into balls, blocks of vectors of
like signs with a middle and a radius. Angles obey the triangle inequality, so the middles and radii of
two balls tell for most of them that all or none of their vectors link; only the vectors of the other
ball pairs are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisketch.llm.components import components
from trisketch.llm.keys import with_keys
from trisketch.session import materialize

LEAST = 0.95
PASSES, BITS, WINDOW = 20, 48, 64
BLOCK = 512
TILE = 512
"""Vectors a ball holds on average at most, and balls that meet as many others in one task."""
SALTS = 64
"""Copies of the size of a large group, so that its rows find it in as many tasks."""
ANGLE, SLACK = float(np.arccos(LEAST)), 1e-6
"""Angle of a link. What is nearer to it than the slack, far above all rounding, is compared."""


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Unit vectors in double precision of single values as given, or of double unit vectors."""
    raw = b"".join(x.as_py() for x in column)
    if len(raw) != len(column) * dim * 4:
        return np.frombuffer(raw, np.float64).reshape(-1, dim)
    x = np.frombuffer(raw, np.float32).reshape(-1, dim).astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _unit(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can link: floats as they are, at half the bytes, all others as unit vectors in
    double precision. Null, zero and non-finite vectors are left out.
    """
    for batch in stream:
        out = []
        for key, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if values.is_valid and len(values) and values.values.null_count == 0:
                given = values.values.to_numpy()
                x = given.astype(np.float64)
                length = np.linalg.norm(x / np.abs(x).max()) * np.abs(x).max() if np.isfinite(x).all() and x.any() else 0.0
                if length > 0 and np.isfinite(length):
                    out.append((key, len(x), (given if given.dtype == np.float32 else x / length).tobytes()))
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["key", "dim", "vector"])


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), np.flatnonzero(dims == dim)


def _ordered(stream: Iterator[pa.RecordBatch], passes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Each row once per pass, with the concatenated signs of the pass's projections."""
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in stream:
        for dim, rows in _by_dimension(batch):
            part = batch.take(pa.array(rows))
            x = _matrix(part.column("vector"), dim)
            planes = np.random.default_rng((seed, dim)).standard_normal((passes, dim, BITS))
            for number in range(passes):
                order = (x @ planes[number] > 0) @ weights
                columns = [pa.array(np.full(len(x), number, np.int32)), pa.array(order, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *part.columns], ["pass", "order", *part.schema.names])


def _find(parent: dict, x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _neighbours(stream: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Compares each vector with `window` neighbours before it; gives each linked vector and the
    least one that it is united with here, a row per linked vector and batch at most.
    """
    last_group, tail_keys, tail = None, np.zeros(0, np.int64), None
    for batch in stream:
        parent: dict[int, int] = {}
        numbers, dims = batch.column("pass").to_numpy(), batch.column("dim").to_numpy()
        keys = batch.column("key").to_numpy()
        cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (dims[1:] != dims[:-1])) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if a == b:
                continue
            group = (numbers[a], dims[a])
            x, k = _matrix(batch.column("vector").slice(a, b - a), int(dims[a])), keys[a:b]
            if group == last_group:
                x, k = np.concatenate([tail, x]), np.concatenate([tail_keys, k])
            fresh = len(k) - (b - a)
            for step in range(1, min(window, len(k) - 1) + 1):
                low = max(fresh - step, 0)
                cosine = np.einsum("ij,ij->i", x[low + step :], x[low : len(x) - step])
                for i in (np.flatnonzero(cosine >= LEAST) + low).tolist():
                    u, v = _find(parent, int(k[i])), _find(parent, int(k[i + step]))
                    if u != v:
                        parent[max(u, v)] = min(u, v)
            last_group, tail, tail_keys = group, x[-window:], k[-window:]
        links = [(n, _find(parent, n)) for n in list(parent)]
        links = [(n, r) for n, r in links if n != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in links], pa.int64()), pa.array([r for _, r in links], pa.int64())], ["u", "v"]
        )


def _sides(group: pa.Table, place: str, value: str) -> list[tuple[pa.Table, np.ndarray]]:
    """The rows of the two places that meet in a group (one, two), with the vectors of each."""
    dim, places = group.column("dim")[0].as_py(), group.column(place).to_numpy()
    parts = [
        group.take(pa.array(np.flatnonzero(places == group.column(name)[0].as_py()))) for name in ("one", "two")
    ]
    return [(part, _matrix(part.column(value), dim)) for part in parts]


def _block_links(group: pa.Table) -> pa.Table:
    """(key, n): links of the vectors of two blocks of a component with each other."""
    (a, xa), (b, xb) = _sides(group, "block", "vector")
    (ka, ma), (kb, mb) = ((side.column("key").to_numpy(), side.column("m").to_numpy()) for side in (a, b))
    linked = xa @ xb.T >= LEAST
    if group.column("one")[0] == group.column("two")[0]:
        np.fill_diagonal(linked, False)
        keys, counts = ka, linked @ ma
    else:
        keys, counts = np.concatenate([ka, kb]), np.concatenate([linked @ mb, linked.T @ ma])
    return pa.table({"key": pa.array(keys, pa.int64()), "n": pa.array(counts, pa.int64())})


def _ball(group: pa.Table) -> pa.Table:
    """One block as a ball: its middle, the largest angle to it, and its vectors, copies counted."""
    x = _matrix(group.column("vector"), group.column("dim")[0].as_py())
    middle = x.sum(axis=0)
    length = np.linalg.norm(middle)
    middle = middle / length if length > 1e-3 else x[0]
    radius = float(np.arccos(np.clip(x @ middle, -1, 1)).max())
    values = [middle.tobytes(), radius, int(group.column("m").to_numpy().sum())]
    columns = {"middle": pa.binary(), "radius": pa.float64(), "mass": pa.int64()}
    return pa.table(
        {name: group.column(name).slice(0, 1) for name in ("component", "dim", "block")}
        | {name: pa.array([v], t) for (name, t), v in zip(columns.items(), values, strict=True)}
    )


def _meet(group: pa.Table) -> pa.Table:
    """Balls of two tiles of a component: (block, null, vectors that all its own link with, whether
    its own are among them) and (block, other, 0, false) where the vectors have to be compared.
    """
    (a, xa), (b, xb) = _sides(group, "tile", "middle")
    (ka, ra, ma), (kb, rb, mb) = (
        [side.column(name).to_numpy() for name in ("block", "radius", "mass")] for side in (a, b)
    )
    apart, reach = np.arccos(np.clip(xa @ xb.T, -1, 1)), ra[:, None] + rb[None, :]
    linked = apart + reach <= ANGLE - SLACK
    open_pairs = ~linked & (apart - reach <= ANGLE + SLACK)
    if group.column("one")[0] == group.column("two")[0]:
        open_pairs, own = np.triu(open_pairs), np.diag(linked)
        blocks, mass = ka, linked @ ma
    else:
        blocks, mass = np.concatenate([ka, kb]), np.concatenate([linked @ mb, linked.T @ ma])
        own = np.zeros(len(blocks), bool)
    i, j = np.nonzero(open_pairs)
    n = len(blocks) + len(i)
    return pa.table(
        {
            "component": pa.array(np.full(n, group.column("component")[0].as_py()), pa.int64()),
            "block": pa.array(np.concatenate([blocks, ka[i]]), pa.int64()),
            "other": pa.array([None] * len(blocks) + kb[j].tolist(), pa.int64()),
            "mass": pa.array(np.concatenate([mass, np.zeros(len(i), np.int64)]), pa.int64()),
            "own": pa.array(np.concatenate([own, np.zeros(len(i), bool)]), pa.bool_()),
        }
    )


def _with_size(rows: DataFrame, counted: DataFrame, place: list[str], key: str, name: str, unit: int) -> DataFrame:
    """The rows and `name`: how many times `unit` rows, rounded up, `counted` has in their place.

    Only places of more than `unit` rows are looked up, so the salted copies of their sizes are
    at most SALTS / unit of the rows.
    """
    sizes = counted.groupBy(*place).agg(F.ceil(F.count("*") / unit).alias(name)).where(F.col(name) > 1)
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS).cast("bigint")))
    found = rows.join(salted, [*place, "salt"], "left")
    return found.withColumn(name, F.coalesce(name, F.lit(1).cast("bigint"))).drop("salt")


def in_balls(linked: DataFrame, seed: int = 0) -> DataFrame:
    """Rows (key, dim, m, vector, component) with the block that each belongs to, and `blocks`, the
    number of blocks that its component needs at least.

    The leading signs of a component's vectors, as many as it needs blocks, make its cells, and a
    cell with too many vectors is cut by a hash; so there are at most twice as many blocks as needed.
    """
    fields = "key long, dim int, m long, vector binary, component long"
    ordered = linked.select("key", "dim", "m", "vector", "component").mapInArrow(
        lambda stream: _ordered(stream, 1, seed), f"pass int, order long, {fields}"
    )
    celled = _with_size(ordered, linked, ["component"], "key", "blocks", BLOCK).withColumn(
        "cell", F.expr(f"shiftright(order, {BITS} - least({BITS}, cast(ceil(log2(blocks)) AS int)))")
    )
    cut = _with_size(celled, celled, ["component", "cell"], "key", "cuts", BLOCK)
    # two blocks of equal hash are one larger block
    block = F.xxhash64("cell", F.pmod(F.xxhash64("key"), "cuts"))
    return cut.withColumn("block", block).select("key", "dim", "m", "vector", "component", "blocks", "block")


def ball_meetings(placed: DataFrame) -> DataFrame:
    """(component, block, other, mass, own) as `_meet` gives them, of all balls of the components."""
    shape = "component long, dim int, block long, middle binary, radius double, mass long"
    balls = materialize(placed.groupBy("component", "block").applyInArrow(_ball, shape), "balls")
    tiled = _with_size(balls, balls, ["component"], "block", "tiles", TILE).withColumn("tile", F.pmod("block", "tiles"))
    tiled = tiled.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    tiled = tiled.withColumns({"one": F.least("tile", "with"), "two": F.greatest("tile", "with")})
    return tiled.groupBy("component", "one", "two").applyInArrow(
        _meet, "component long, block long, other long, mass long, own boolean"
    )


def link_counts(linked: DataFrame, seed: int = 0) -> DataFrame:
    """(key, n): the links of each row (key, dim, m, vector, component) with others of its component."""
    placed = materialize(in_balls(linked, seed), "blocks")
    met = materialize(ball_meetings(placed.where("blocks > 1")), "meetings")
    certain = met.where("other IS NULL").groupBy("component", "block").agg(
        F.sum("mass").alias("mass"), F.max("own").alias("own")
    )
    surely = placed.join(certain, ["component", "block"]).select(
        "key", (F.col("mass") - F.when(F.col("own"), F.col("m")).otherwise(0)).alias("n")
    )
    rows = ["key", "dim", "m", "vector", "component", "block", "one", "two"]
    pairs = met.where("other IS NOT NULL").select("component", F.col("block").alias("one"), F.col("other").alias("two"))
    sides = [
        placed.join(some.withColumn("block", F.col(name)), ["component", "block"]).select(rows)
        for name, some in (("one", pairs), ("two", pairs.where("one != two")))
    ]
    alone = placed.where("blocks = 1").withColumns({"one": F.col("block"), "two": F.col("block")}).select(rows)
    compared = alone.unionByName(sides[0]).unionByName(sides[1])
    exact = compared.groupBy("component", "one", "two").applyInArrow(_block_links, "key long, n long")
    return surely.unionByName(exact).groupBy("key").agg(F.sum("n").alias("n"))


def near_duplicate_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    passes: int = PASSES,
    window: int = WINDOW,
    seed: int = 0,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing, as do vectors of different lengths. Equal vectors are one class for the passes and
    count as links of each other. If a vec_id is null or repeated, each row is a vector of its
    own, in the order of (vec_id, embedding), nulls last. Other columns are ignored; an empty
    table gives an empty result.
    """
    keyed = with_keys(vectors, "__key", vec_id, embedding)
    ids = keyed.select(F.col("__key").alias("key"), F.col(vec_id).alias("vec_id"))
    units = keyed.select("__key", embedding).mapInArrow(_unit, "key long, dim int, vector binary")
    units = materialize(units.withColumn("mark", F.sha2("vector", 256)), "units")
    same = units.groupBy("mark").agg(F.min("key").alias("rep"), F.count("*").alias("m"))
    members = materialize(units.select("key", "mark").join(same, "mark").select("key", "rep", "m"), "classes")
    classes = units.join(members.where("key = rep").select("key", "m"), "key").select("key", "dim", "m", "vector")

    passed = classes.select("key", "dim", "vector").mapInArrow(
        lambda stream: _ordered(stream, passes, seed), "pass int, order long, key long, dim int, vector binary"
    )
    place = ["pass", "dim", "order", "key"]
    in_order = passed.repartitionByRange(*place).sortWithinPartitions(*place)
    united = in_order.mapInArrow(lambda stream: _neighbours(stream, window), "u long, v long")
    connected = materialize(components(united.distinct()), "connected")

    linked = classes.join(connected.withColumnRenamed("node", "key"), "key")
    totals = link_counts(linked, seed)

    found = (
        members.join(totals.withColumnRenamed("key", "rep"), "rep", "left")
        .join(connected.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    every = ids.join(found, "key", "left").withColumns(
        {"n_links": F.coalesce("n_links", F.lit(0)).cast("bigint"), "component": F.coalesce("component", "key")}
    )
    roots = ids.select(F.col("key").alias("component"), F.col("vec_id").alias("component_id"))
    return every.join(roots, "component").select(
        "vec_id", "n_links", "component_id", (F.col("key") == F.col("component")).alias("kept")
    )
