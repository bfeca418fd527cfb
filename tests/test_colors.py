import random
from collections import Counter

import pytest
from brute import color, median, random_graph, simple, triangles

from trisketch.functions.hashing import RUNS
from trisketch.operators import colors as co
from trisketch.operators.graph import canonical_edges
from trisketch.operators.triangles import triangle_count
from trisketch.plans.reports import triangle_report
from trisketch.session import materialize

PAIRS = random_graph(45, 400, seed=11, hubs=2)
CLEAN = simple(PAIRS)
TRIANGLES = triangles(CLEAN)
A, B = RUNS[0]


@pytest.fixture
def edges(edges_of):
    return canonical_edges(edges_of(PAIRS))


def mono_counts(colors, a, b):
    mono = {e for e in CLEAN if color(e[0], a, b, colors) == color(e[1], a, b, colors)}
    return Counter(color(t[0], a, b, colors) for t in triangles(mono))


def test_vertex_colors_and_monochromatic_edges(edges):
    got = {r.id: r.color for r in co.vertex_color(edges, 4, A, B).collect()}
    assert got == {x: color(x, A, B, 4) for e in CLEAN for x in e}
    mono = co.monochromatic_edges(edges, 4, A, B)
    expected = {(got[u], u, v) for u, v in CLEAN if got[u] == got[v]}
    assert {tuple(r) for r in mono.collect()} == expected
    sizes = {r.color: r.n_edges for r in co.edges_per_color(mono).collect()}
    assert sizes == Counter(c for c, _, _ in expected)


@pytest.mark.parametrize("colors", [1, 2, 4, 50])
def test_node_color_estimates(edges, colors):
    expected = [colors**2 * sum(mono_counts(colors, a, b).values()) for a, b in RUNS]
    runs = co.node_color_runs(edges, colors, RUNS)
    assert {r.run: r.estimate for r in runs.collect()} == dict(enumerate(expected))
    assert co.median_over_runs(runs).first().median_estimate == median(expected)
    assert co.approx_by_node_color(edges, colors, A, B).first().estimate == expected[0]
    per_color = {r.color: r.t for r in co.triangles_by_color(edges, colors, A, B).collect()}
    assert per_color == {c: mono_counts(colors, A, B).get(c, 0) for c in range(colors)}


def test_one_color_is_exact(edges):
    assert co.approx_by_node_color(edges, 1, A, B).first().estimate == len(TRIANGLES)
    assert co.approx_by_partition(co.partition_edges(edges, 1), 1).first().estimate == len(TRIANGLES)


def test_even_number_of_runs_averages_the_middle_two(edges):
    estimates = [16 * sum(mono_counts(4, a, b).values()) for a, b in RUNS[:4]]
    got = co.median_over_runs(co.node_color_runs(edges, 4, RUNS[:4])).first().median_estimate
    assert got == median(estimates)


@pytest.mark.parametrize("split", ["affine", "random"])
def test_partitions(edges, split):
    parted = co.partition_edges(edges, 3) if split == "affine" else co.partition_edges_randomly(edges, 3, seed=5)
    rows = [tuple(r) for r in parted.collect()]
    assert {(u, v) for _, u, v in rows} == CLEAN and {p for p, _, _ in rows} <= set(range(3))
    expected = {p: len(triangles({(u, v) for q, u, v in rows if q == p})) for p in range(3)}
    assert {r.part: r.t for r in co.triangles_by_partition(parted, 3).collect()} == expected
    assert co.approx_by_partition(parted, 3).first().estimate == 9 * sum(expected.values())
    assert {r.part: r.n_edges for r in co.edge_partition_sizes(parted).collect()} == Counter(p for p, _, _ in rows)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_even_parts(edges, edges_of, parts):
    written = co.write_even_parts(edges, parts, seed=9)
    rows = sorted(tuple(r) for r in written.collect())
    assert {(u, v) for _, u, v in rows} == CLEAN and len(rows) == len(CLEAN)
    sizes = Counter(p for p, _, _ in rows)
    assert set(sizes) == set(range(parts)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert rows == sorted(tuple(r) for r in co.write_even_parts(edges.repartition(5), parts, seed=9).collect())
    if parts == 1:
        assert co.approx_by_partition(written, 1).first().estimate == len(TRIANGLES)
        assert co.write_even_parts(edges_of([]), 1, seed=9).count() == 0


@pytest.mark.parametrize("colors", [1, 2, 5])
@pytest.mark.parametrize("a,b", RUNS[:2])
def test_triplets(edges, colors, a, b):
    expected = Counter(tuple(sorted(color(x, a, b, colors) for x in t)) for t in TRIANGLES)

    def read(df):
        return {(r.c0, r.c1, r.c2): r.t for r in co.unpack_triplets(df, colors).collect()}

    assert read(co.triangles_by_triplet(edges, colors, a, b)) == expected
    assert read(co.triangles_by_triplet_replicated(edges, colors, a, b)) == expected
    assert co.exact_by_triplets(edges, colors, a, b).first().triangles == len(TRIANGLES)


@pytest.mark.parametrize("limit", [1, 60, 200, 10**6])
def test_keys_of_bounded_size(edges, limit):
    colors = min(6, co.colors_for(len(CLEAN), limit))
    sizes = {r.triplet: r.n_edges for r in co.key_sizes(edges, colors, A, B).collect()}
    assert sizes == {r.triplet: r.n_edges for r in co.edges_per_triplet(co.edge_color_triplets(edges, colors, A, B)).collect()}
    split = co.oversized_keys(edges, colors, A, B, limit)
    assert {r.triplet for r in split.collect()} == {k for k, n in sizes.items() if n > limit}
    expected = {r.triplet: r.t for r in co.triangles_by_triplet(edges, colors, A, B).collect()}
    assert {r.triplet: r.t for r in co.triangles_by_triplet_replicated(edges, colors, A, B, split).collect()} == expected


@pytest.mark.parametrize("limit", [40, 10**6])
def test_exact_count_by_keys(edges, edges_of, limit):
    assert co.exact_by_keys(edges, A, B, limit).first().triangles == len(TRIANGLES)
    assert co.exact_by_keys(edges_of([]), A, B, limit).first().triangles == 0


def test_copies_are_exchanged_once(edges):
    plan = co.triangles_by_triplet_replicated(edges, 4, A, B)._jdf.queryExecution().executedPlan().toString()
    above_copies = plan[: plan.index("Generate explode(")]
    assert above_copies.count("Exchange") == 1 and "Join" not in above_copies and "Window" in above_copies


def test_copies_that_can_close_nothing_stay_away(edges_of):
    """Buyers with 20 sellers each: no buyer is entered by an edge, few sellers are linked."""
    rng = random.Random(5)
    pairs = [(1000 + i, x) for i in range(100) for x in rng.sample(range(60), 20)] + [(x, x + 1) for x in range(59)]
    edges, colors = canonical_edges(edges_of(pairs)), 30
    rows = co.copied_lists(edges, colors, A, B).collect()
    assert sum(len(r.own or r.above) for r in rows) < colors * len(pairs) / 10
    assert {(r.mid, x) for r in rows if r.own for x in r.own} <= simple(pairs) | {(v, u) for u, v in simple(pairs)}
    counts = co.triangles_by_triplet_replicated(edges, colors, A, B).collect()
    assert sum(r.t for r in counts) == len(triangles(simple(pairs)))


@pytest.mark.parametrize("limit", [15_000, 10**6])
def test_dense_neighbours_fill_their_signatures(edges_of, limit):
    """Every vertex has more out-neighbours than a signature has bits, and hubs are looked up apart."""
    pairs = random_graph(300, 30_000, seed=3, low=-(10**15))
    edges = canonical_edges(edges_of(pairs))
    expected = triangle_count(edges).first().triangles
    assert co.exact_by_keys(edges, A, B, limit).first().triangles == expected
    assert sum(r.t for r in co.triangles_by_triplet_replicated(edges, 3, A, B).collect()) == expected


def test_edges_by_keys_are_made_once(edges, edges_of, monkeypatch):
    written = []
    monkeypatch.setattr(co, "materialize", lambda df, purpose: written.append(purpose) or materialize(df, purpose))
    assert co.exact_by_keys(edges, A, B, 40).first().triangles == len(TRIANGLES)
    assert written == ["edges", "oriented"]


def test_every_edge_gets_one_key_per_color(edges):
    keyed = co.edge_color_triplets(edges, 4, A, B)
    rows = [tuple(r) for r in keyed.collect()]
    assert Counter((u, v) for _, u, v in rows) == {e: 4 for e in CLEAN} and len(set(rows)) == len(rows)
    counts = {r.triplet: r.n_edges for r in co.edges_per_triplet(keyed).collect()}
    assert counts == Counter(k for k, _, _ in rows)


def test_exact_runs_agree(edges):
    rows = co.exact_runs(edges, 4, RUNS).collect()
    assert {r.run: r.triangles for r in rows} == {i: len(TRIANGLES) for i in range(len(RUNS))}
    assert co.last_run(co.exact_runs(edges, 4, RUNS)).first().triangles == len(TRIANGLES)


def test_reports(edges):
    row = triangle_report(edges, 4, RUNS).first()
    assert row.n_edges == len(CLEAN)
    assert row.node_color_median == median([16 * sum(mono_counts(4, a, b).values()) for a, b in RUNS])
    assert triangle_report(edges, 4, RUNS, "exact").first().triangles == len(TRIANGLES)
    with pytest.raises(ValueError):
        triangle_report(edges, 4, RUNS, "other")


def test_nothing_found_is_zero(edges_of):
    for pairs in ([], [(0, 1), (1, 2)]):
        edges = canonical_edges(edges_of(pairs))
        assert triangle_count(edges).first().triangles == 0
        assert co.approx_by_node_color(edges, 4, A, B).first().estimate == 0
        assert co.approx_by_partition(co.partition_edges(edges, 4), 4).first().estimate == 0
        assert co.exact_by_triplets(edges, 4, A, B).first().triangles == 0
        assert [r.triangles for r in co.exact_runs(edges, 4, RUNS[:2]).collect()] == [0, 0]
        report = triangle_report(edges, 4, RUNS).first()
        assert (report.node_color_median, report.partition_estimate) == (0, 0)


def test_parameters_are_validated(edges):
    for bad in (
        lambda: co.vertex_color(edges, 0, A, B),
        lambda: co.partition_edges(edges, 0),
        lambda: co.node_color_runs(edges, 4, []),
        lambda: co.edge_color_triplets(edges, 0, A, B),
    ):
        with pytest.raises(ValueError):
            bad()
