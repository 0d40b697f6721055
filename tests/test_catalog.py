"""Every registered query against its SQL at the smallest scale, and the shape of plans."""

import pytest

import __spark_entry__ as registered
from compare import connect, differences
from sievegate.catalog import storage_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"lr_choose_c"}))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_flagship(spark):
    rows = registered.entry(spark).collect()
    assert {r.user for r in rows} == {"alice", "bob", "carol", "admin"}
    seen = {(r.user, r.label): (r.n_visible, r.n_docs) for r in rows}
    assert seen["carol", "public"][0] == seen["carol", "public"][1]
    assert seen["carol", "confidential"][0] == 0 if ("carol", "confidential") in seen else True


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_in_any_lazy_plan(spark):
    eager = ("lr_", "lsh", "incremental", "text_retrieval", "pipeline")
    for name, run in QUERIES.items():
        # Storage queries write before they return; what they return only reads files.
        if not any(part in name for part in eager) and name not in storage_queries.QUERIES:
            text = plan(run(spark, FOLDER))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_corpus_plan_shuffles_once_and_walks_windows_once(spark):
    from sievegate.catalog import tables

    raw = spark.read.parquet(f"{FOLDER}/documents.parquet")
    from sievegate.plans.prep import build_corpus

    text = plan(build_corpus(tables.as_messages(raw)))
    assert text.count("Exchange") == 1
    assert text.count("ArrowEvalPython") == 1
    assert text.count("sent") == 0 and text.count("[Ss][Ee][Nn][Tt]") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_permission_filter_stays_below_the_ranking(spark):
    text = plan(QUERIES["knn_permission"](spark, FOLDER))
    assert "MapInArrow" in text
    assert text.index("WindowGroupLimit") < text.index("MapInArrow") < text.rindex("LeftSemi")
