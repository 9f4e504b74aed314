"""Every registered query against its SQL on the supplied tables."""

import pytest

import __spark_entry__ as entry
import check

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    own = {n for n in QUERIES if n == "pipeline" or n.startswith("op")}
    without_sql = {"topic_clusters", "topic_density", "topic_model", "topic_model_density"} | (own - set(ORACLES))
    assert set(QUERIES) - set(ORACLES) == without_sql


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "article_count" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    if name == "pipeline" or name.startswith("op"):
        pytest.skip("tested in tests/llm")
    if name in ORACLES:
        assert check.compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


@pytest.mark.parametrize(
    "name, column, absent",
    [
        ("article_id", "page_id:bigint,url:string", "html"),
        ("top_source_per_nation_orders", "o_custkey:bigint,o_orderpriority:string", "o_totalprice"),
        ("quality_by_source", "doc_id:bigint,source:string", "text"),
    ],
)
def test_scans_read_only_what_they_need(spark, sf, name, column, absent):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{column}>" in plan and f"{absent}:" not in plan


def test_filters_reach_the_files(spark, sf):
    plan = QUERIES["article_explorer"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(langue,en)" in plan
