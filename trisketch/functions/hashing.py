"""The ((a*x + b) mod p) mod m hash family as column expressions."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prime of the family and the parameters the registered queries use.
P = 8191
RUNS = ((1955, 4010), (6184, 5939), (2362, 102), (5491, 5203), (5721, 5382))
ROWS = (
    (3756, 7980, 1029, 1225),
    (3885, 4608, 2448, 6089),
    (7584, 6103, 2797, 899),
    (269, 7440, 5818, 4656),
    (7351, 5646, 999, 6313),
)
EDGE_HASH = (1955, 6184, 4010)


def require_positive(**values: int) -> None:
    for name, value in values.items():
        if value < 1:
            raise ValueError(f"{name} must be at least 1, got {value}")


def draw_runs(count: int, seed: int) -> tuple[tuple[int, int], ...]:
    """Seeded (a, b) pairs, a in [1, p-1] and b in [0, p-1]."""
    require_positive(count=count)
    rng = random.Random(seed)
    return tuple((rng.randint(1, P - 1), rng.randint(0, P - 1)) for _ in range(count))


def draw_rows(depth: int, seed: int) -> tuple[tuple[int, int, int, int], ...]:
    """Seeded (ah, bh, ag, bg) per sketch row."""
    pairs = draw_runs(2 * depth, seed)
    return tuple(pairs[2 * j] + pairs[2 * j + 1] for j in range(depth))


def affine_hash(x: Column, a: Column | int, b: Column | int, buckets: int) -> Column:
    """((a*x + b) mod p) mod buckets in [0, buckets), also for negative x.

    x is reduced mod p first, so the product stays below p*p for any BIGINT.
    """
    a = a if isinstance(a, Column) else F.lit(a)
    b = b if isinstance(b, Column) else F.lit(b)
    p = F.lit(P).cast("bigint")
    inner = F.pmod(a.cast("bigint") * F.pmod(x.cast("bigint"), p) + b.cast("bigint"), p)
    return F.pmod(inner, F.lit(buckets).cast("bigint")).cast("int")


def sign_hash(x: Column, a: Column | int, b: Column | int) -> Column:
    """The family with two buckets, mapped to -1 and +1."""
    return affine_hash(x, a, b, 2) * 2 - 1


def edge_hash(u: Column, v: Column, buckets: int, a1: int, a2: int, b: int) -> Column:
    """((a1*u + a2*v + b) mod p) mod buckets for an edge u < v."""
    p = F.lit(P).cast("bigint")
    mixed = F.pmod(u, p) * a1 + F.pmod(v, p) * a2 + b
    return F.pmod(F.pmod(mixed, p), F.lit(buckets).cast("bigint")).cast("int")


def run_table(runs: Sequence[tuple[int, int]]) -> Column:
    """Literal array of (run, a, b) structs; F.inline fans rows out over it without a join."""
    require_positive(runs=len(runs))
    return F.array(*[
        F.struct(
            F.lit(i).cast("int").alias("run"),
            F.lit(a).cast("bigint").alias("a"),
            F.lit(b).cast("bigint").alias("b"),
        )
        for i, (a, b) in enumerate(runs)
    ])


def row_table(rows: Sequence[tuple[int, int, int, int]]) -> Column:
    """Literal array of (j, ah, bh, ag, bg) structs, one per sketch row."""
    require_positive(depth=len(rows))
    return F.array(*[
        F.struct(
            F.lit(j).cast("int").alias("j"),
            *[F.lit(x).cast("bigint").alias(n) for n, x in zip(("ah", "bh", "ag", "bg"), r)],
        )
        for j, r in enumerate(rows)
    ])
