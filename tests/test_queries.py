"""Each registered query against its SQL, and the shape of its plan."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from corpuslens.plans import oracle, registry

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()
IN_ARROW = {"approximate_recall", "cosine_pairs", "pairs_above", "similarity_pair_count", "top_pairs"}
WITHOUT_SQL = {"approximate_similar"}  # see test_near_search.py
# What must not stand in a filter or a join condition, where it would be evaluated again.
SEARCHES = re.compile(r"regexp|rlike| RLIKE |split\(|instr\(", re.I)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{DIRECTORY}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(frame):
    columns = sorted(frame.columns)
    return frame[columns].sort_values(columns).reset_index(drop=True)


def test_every_exact_query_has_sql():
    assert set(QUERIES) == set(ORACLE) | WITHOUT_SQL


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, database, name):
    result = QUERIES[name](spark, DIRECTORY)
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan
    assert ("InArrow" in plan) == (name in IN_ARROW)
    found = sorted_rows(result.toPandas())
    expected = sorted_rows(database.sql(ORACLE[name]).df())
    assert list(found.columns) == list(expected.columns)
    assert len(found) == len(expected) > 0
    for column in found.columns:
        left, right = found[column], expected[column]
        assert ((left == right) | (left.isna() & right.isna())).all(), column


def _conditions(plan):
    """Conditions of the filters and joins of an optimised plan, and of the plans within."""
    found = []
    stack = [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name in ("Filter", "Join"):
            found.append(node.simpleString(100_000))
        if name == "InMemoryRelation":
            stack.append(node.cacheBuilder().logicalPlan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        inner = node.subqueries()
        stack += [inner.apply(i) for i in range(inner.size())]
    return found


@pytest.mark.parametrize("name", QUERIES)
def test_no_text_is_searched_in_a_filter(spark, name):
    result = QUERIES[name](spark, DIRECTORY)
    conditions = _conditions(result._jdf.queryExecution().optimizedPlan())
    assert not [c for c in conditions if SEARCHES.search(c)]


def test_term_counts_need_no_shuffle(spark):
    plan = QUERIES["term_counts"](spark, DIRECTORY)._jdf.queryExecution().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") > 0  # the session's own


def test_llm_queries_are_added_where_they_can_be_imported():
    assert set(contract.queries()) >= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["similar", "cosine"]


def test_scans_read_only_the_columns_in_use(spark):
    plan = QUERIES["word_count"](spark, DIRECTORY)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<text:string>" in plan
    for name in ("n_chars", "source", "lang"):
        assert f"{name}:" not in plan
