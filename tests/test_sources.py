from types import SimpleNamespace

import pytest

from trisketch.operators.graph import canonical_edges
from trisketch.session import materialize, shared_folder
from trisketch.sources.edges import edge_lines, edges_from_transitions, parse_edges, read_edge_text
from trisketch.sources.items import batch_bounds, equal_batches, parse_items


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def pairs(df):
    return sorted((r.u, r.v) for r in df.collect())


def test_further_fields_and_blanks_are_ignored(spark):
    assert pairs(parse_edges(lines(spark, "1,2", "3,4,9", " 5,6"))) == [(1, 2), (3, 4), (5, 6)]


@pytest.mark.parametrize("bad", ["", "7", "a,b", "1,x"])
def test_a_bad_line_raises(spark, bad):
    with pytest.raises(Exception):
        parse_edges(lines(spark, "1,2", bad)).collect()


def test_lenient_parsing_keeps_good_lines(spark):
    parsed = parse_edges(lines(spark, "1,2", "", "7", "a,b"), strict=False)
    assert parsed.count() == 4 and pairs(canonical_edges(parsed)) == [(1, 2)]


def test_text_round_trip(spark, edges_of, tmp_path):
    edges = edges_of([(1, 2), (-3, 2**40)])
    edge_lines(edges).write.text(str(tmp_path / "e"))
    assert pairs(read_edge_text(spark, str(tmp_path / "e"))) == pairs(edges)


def test_transitions_link_consecutive_rows_only(spark):
    table = spark.createDataFrame([(0, 5), (1, 7), (2, 7), (4, 9)], "n bigint, x bigint")
    assert pairs(edges_from_transitions(table, "n", "x")) == [(5, 7), (7, 7)]


def test_items(spark):
    assert [r.item for r in parse_items(lines(spark, "12", "-3")).collect()] == [12, -3]
    assert [r.item for r in parse_items(lines(spark, "12", "x"), strict=False).collect()] == [12, None]
    with pytest.raises(Exception):
        parse_items(lines(spark, "x")).collect()


def test_equal_batches(spark):
    table = spark.range(25)
    got = table.select(equal_batches(table, "id", 5).alias("b")).groupBy("b").count().collect()
    assert sorted((r.b, r["count"]) for r in got) == [(i, 5) for i in range(5)]


@pytest.mark.parametrize("n", [0, 1, 7, 10, 19, 1005])
def test_batches_lose_no_row(spark, n):
    table = spark.range(n)
    got = {r.id: r.b for r in table.select("id", equal_batches(table, "id", 10).alias("b")).collect()}
    bounds = batch_bounds(n, 10)
    assert got == {i: b for b, (low, high) in enumerate(bounds) for i in range(low, high)}
    assert len(bounds) == min(n, 10) and set(got) == set(range(n))


def test_materialized_frames_read_a_table_of_the_shared_folder(spark, edges_of):
    edges = canonical_edges(edges_of([(1, 2), (2, 1), (2, 3)]))
    stored = materialize(edges, "edges")
    assert pairs(stored) == pairs(edges)
    base = shared_folder(spark, "x").rpartition("/")[0]
    assert all(base in f for f in stored.inputFiles())


def session_on(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_follows_the_session():
    assert shared_folder(session_on("yarn", "hdfs://n/ckpt/"), "x").startswith("hdfs://n/ckpt/x-")
    assert shared_folder(session_on("local[2]"), "x") != shared_folder(session_on("local[2]"), "x")
    with pytest.raises(ValueError):
        shared_folder(session_on("yarn"), "x")
