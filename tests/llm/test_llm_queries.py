"""The registered queries against their SQL, the pipeline stage by stage, and the native plans."""

import os
import re

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
import corpus_pipeline
from trisketch.llm import queries as llm_queries
from trisketch.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


def test_registry():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(i) for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), ORACLES[name], connect(SF)) is None


@pytest.mark.parametrize("name", ["op2_decontamination", "op7_pii", "op8_mixing"])
def test_native_plans_have_no_python(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|Arrow", text)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    items = [set(zip(*[r.text.lower().split()[i:] for i in range(5)], strict=False)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        docs = llm_queries.ship(spark) and stage(spark, docs, SF)
        docs = corpus_pipeline.materialize(docs, name)
        assert docs.columns == columns
        before, kept = kept, {r.doc_id: r for r in docs.collect()}
        assert before is None or set(kept) <= set(before)
        if name in ("toxicity", "ngram_jaccard_join", "benchmark_decontamination"):
            assert all(kept[d] == rows[d] for d in kept) and docs.count() == len(kept)
        if name == "benchmark_decontamination":
            for r in kept.values():
                ws = r.text.lower().split()
                own = set(zip(*[ws[i:] for i in range(5)], strict=False))
                assert not any(s and len(s & own) >= 0.75 * len(s) for s in items)
        if name == "pii":
            assert set(kept) == set(before)
    assert docs.count() >= len(kept) > 0
