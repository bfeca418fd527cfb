"""Small plain-Python counterparts the operators are tested against."""

import itertools
import random
from collections import Counter

P = 8191


def simple(pairs):
    return {(min(u, v), max(u, v)) for u, v in pairs if u != v}


def triangles(edges):
    ids = sorted({x for e in edges for x in e})
    return {t for t in itertools.combinations(ids, 3) if {t[:2], t[1:], (t[0], t[2])} <= edges}


def color(x, a, b, buckets):
    return ((a * x + b) % P) % buckets


def sketch(freq, rows, width):
    cells = Counter()
    for item, f in freq.items():
        for j, (ah, bh, ag, bg) in enumerate(rows):
            cells[j, color(item, ah, bh, width)] += f * (color(item, ag, bg, 2) * 2 - 1)
    return dict(cells)


def median(values):
    values = sorted(values)
    n = len(values)
    if n % 2:
        return values[n // 2]
    total = values[n // 2 - 1] + values[n // 2]
    return abs(total) // 2 * (1 if total >= 0 else -1)


def estimate(item, cells, rows, width):
    return median(
        cells.get((j, color(item, ah, bh, width)), 0) * (color(item, ag, bg, 2) * 2 - 1)
        for j, (ah, bh, ag, bg) in enumerate(rows)
    )


def random_graph(n, m, seed, low=-20, hubs=0):
    """m random pairs over n ids, plus `hubs` ids in the middle joined to every other id."""
    rng = random.Random(seed)
    ids = list(range(low, low + n))
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(m)]
    middle = ids[n // 2 : n // 2 + hubs]
    return pairs + [(h, x) for h in middle for x in ids]
