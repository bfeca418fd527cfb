"""Every registered query against its SQL, fixed results, and the shape of the plans."""

import os
import re

import duckdb
import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from trisketch.functions.hashing import RUNS
from trisketch.operators import colors as co
from trisketch.operators.graph import canonical_edges, edge_count, vertices
from trisketch.operators.triangles import triangle_count
from trisketch.plans import graph_queries, stream_queries

DATA = "/root/testdata"
SF = f"{DATA}/sf0.001"
QUERIES = {**graph_queries.QUERIES, **stream_queries.QUERIES}
ORACLES = {**graph_queries.ORACLES, **stream_queries.ORACLES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), ORACLES[name], con) is None


def test_registry(spark):
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() == 1


# Fixed results of a denser graph, the pairs of parts that share an order. The pairs are made
# outside: the library itself never emits all pairs of a group.
FIXED = {
    "0.001": (8899, 200, 125968, [119232, 125664, 113408, 123952, 113664], [317, 4237, 3013, 61]),
    "0.01": (115729, 2000, 413718, [415360, 412816, 409808, 416976, 411744], [6740, 6227, 6191, 6489]),
}


@pytest.mark.parametrize("sf", FIXED)
def test_fixed_results(spark, tmp_path, sf):
    n_edges, n_vertices, n_triangles, estimates, parts = FIXED[sf]
    line = f"'{DATA}/sf{sf}/lineitem.parquet'"
    duckdb.sql(
        f"""COPY (SELECT DISTINCT a.l_partkey AS u, b.l_partkey AS v FROM {line} a JOIN {line} b
        ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey) TO '{tmp_path}/e.parquet'"""
    )
    edges = canonical_edges(spark.read.parquet(f"{tmp_path}/e.parquet"))
    assert edge_count(edges).first().n_edges == n_edges
    assert vertices(edges).count() == n_vertices
    assert triangle_count(edges).first().triangles == n_triangles
    assert [r.estimate for r in co.node_color_runs(edges, 4, RUNS).orderBy("run").collect()] == estimates
    by_part = co.triangles_by_partition(co.partition_edges(edges, 4), 4)
    assert [r.t for r in by_part.orderBy("part").collect()] == parts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in ("edge_text_scan", "triangle_report_kept_edges"))


@pytest.mark.parametrize("name", BATCH)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", text)


def test_range_predicate_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["items_in_range"](spark, SF))
    assert "GreaterThanOrEqual(user_id,10)" in text and "LessThanOrEqual(user_id,120)" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text
    text = plan(QUERIES["triangle_count_exact"](spark, SF))
    assert set(re.findall("ReadSchema: (.*)", text)) == {"struct<l_partkey:bigint,l_suppkey:bigint>"}


def test_neighbour_lists_are_never_broadcast(spark):
    df = QUERIES["triangle_count_exact"](spark, SF)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "SortMergeJoin" in final
    assert len(re.findall("^.*Scan parquet", final, re.M)) == 1
