from collections import Counter

import pytest
from brute import random_graph, simple, triangles
from pyspark.sql import functions as F

from trisketch.operators import graph, triangles as tri

HAND = {
    "empty": ([], 0),
    "dirty triangle": ([(1, 2), (2, 1), (2, 3), (3, 1), (2, 2)], 1),
    "k4": ([(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)], 4),
    "star": ([(0, 1), (0, 2), (0, 3), (0, 4)], 0),
    "two triangles": ([(1, 2), (2, 3), (1, 3), (10, 11), (11, 12), (10, 12)], 2),
    "bipartite": ([(1, 11), (1, 12), (2, 11), (2, 12)], 0),
    "negative ids": ([(-5, 1), (1, 7), (-5, 7)], 1),
    "large ids": ([(300000, 300001), (300001, 300002), (300000, 300002)], 1),
    "huge ids": ([(2**62, -(2**62)), (-(2**62), 5), (5, 2**62)], 1),
}


def listed(df):
    rows = [(r.a, r.b, r.c) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("name", HAND)
def test_hand_graphs(edges_of, name):
    pairs, expected = HAND[name]
    edges = graph.canonical_edges(edges_of(pairs))
    assert tri.triangle_count(edges).collect()[0].triangles == expected
    assert listed(tri.triangle_list(edges)) == triangles(simple(pairs))


def test_edges_vertices_degrees(edges_of):
    pairs = random_graph(30, 120, seed=1, hubs=1) + [(None, 3), (3, None)]
    clean = simple([p for p in pairs if None not in p])
    edges = graph.canonical_edges(edges_of(pairs))
    assert {(r.u, r.v) for r in edges.collect()} == clean
    assert graph.edge_count(edges).first().n_edges == len(clean)
    ids = [r.id for r in graph.vertices(edges).collect()]
    assert sorted(ids) == sorted({x for e in clean for x in e})
    assert {r.id: r.deg for r in graph.degrees(edges).collect()} == Counter(x for e in clean for x in e)


@pytest.mark.parametrize("hot", [1_000_000, 8, 1])
def test_orientation_bounds_out_degrees_with_and_without_hot_vertices(edges_of, monkeypatch, hot):
    monkeypatch.setattr(graph, "HOT_VERTICES", hot)
    clean = simple(random_graph(60, 150, seed=2, hubs=3))
    degree = Counter(x for e in clean for x in e)
    rows = graph.orient(graph.canonical_edges(edges_of(clean))).collect()
    assert {(min(r.src, r.dst), max(r.src, r.dst)) for r in rows} == clean and len(rows) == len(clean)
    for r in rows:
        assert (r.src_deg, r.dst_deg) == (degree[r.src], degree[r.dst])
        assert (r.src_deg, r.src) < (r.dst_deg, r.dst)
    assert max(Counter(r.src for r in rows).values()) <= (2 * len(clean)) ** 0.5


@pytest.mark.parametrize("hot,salt,block", [(1_000_000, 10_000_000, 1024), (8, 3, 2), (2, 1, 1)])
@pytest.mark.parametrize("seed,hubs", [(3, 0), (4, 2), (5, 5)])
def test_random_graphs_however_hot_vertices_are_split(edges_of, monkeypatch, hot, salt, block, seed, hubs):
    monkeypatch.setattr(graph, "HOT_VERTICES", hot)
    monkeypatch.setattr(tri, "IDS_PER_SALT", salt)
    monkeypatch.setattr(tri, "RECEIVERS_PER_BLOCK", block)
    pairs = random_graph(40, 220, seed=seed, hubs=hubs)
    edges = graph.canonical_edges(edges_of(pairs))
    expected = triangles(simple(pairs))
    assert listed(tri.triangle_list(edges)) == expected
    assert tri.triangle_count(edges).first().triangles == len(expected)


def test_groups_do_not_mix(spark, monkeypatch):
    monkeypatch.setattr(tri, "RECEIVERS_PER_BLOCK", 2)
    groups = {g: simple(random_graph(25, 120, seed=g, hubs=g % 3)) for g in range(4)}
    rows = [(g, u, v) for g, es in groups.items() for u, v in es]
    edges = spark.createDataFrame(rows, "g int, u bigint, v bigint")
    got = {r.g: r.t for r in tri.triangles_by_group(edges, ["g"]).collect()}
    assert got == {g: len(triangles(es)) for g, es in groups.items() if triangles(es)}


def test_a_hub_with_a_third_of_all_edges(edges_of):
    pairs = [(0, i) for i in range(1, 4001)] + [(i, i + 1) for i in range(1, 4001)] + [(i, i + 2) for i in range(1, 4000)]
    clean = simple(pairs)
    adjacency = {}
    for u, v in clean:
        adjacency.setdefault(u, set()).add(v)
        adjacency.setdefault(v, set()).add(u)
    expected = sum(len(adjacency[u] & adjacency[v]) for u, v in clean) // 3
    assert tri.triangle_count(graph.canonical_edges(edges_of(pairs))).first().triangles == expected


@pytest.fixture
def fixed_partitions(spark):
    """Plan without runtime help: what spreads here spreads by its keys."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def rows_per_partition(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("hub", [-1, 1000, 10_000])
def test_the_edges_of_a_hub_spread_over_tasks(edges_of, fixed_partitions, hub):
    pairs = [(hub, i) for i in range(4000)] + [(i, i + 1) for i in range(4000)]
    sizes = rows_per_partition(graph.orient(graph.canonical_edges(edges_of(pairs))))
    assert len(sizes) == 8 and max(sizes) < 1.5 * sum(sizes) / 8


def test_the_lists_a_hub_receives_spread_over_tasks(edges_of, fixed_partitions, monkeypatch):
    monkeypatch.setattr(tri, "IDS_PER_SALT", 200_000)
    pairs = [(hub, i) for hub in (-1, -2) for i in range(-2, 4000)]
    closed = tri.closed_wedges(graph.orient(graph.canonical_edges(edges_of(pairs))))
    sizes = rows_per_partition(closed)
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
