"""The registered queries against their SQL, and the shape of their plans."""

import glob
import os

import duckdb
import pytest

from corpuslens.llm import registry

DIRECTORY = "/root/testdata/sf0.001"
NATIVE = ("op1_", "op5_", "op6_")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{DIRECTORY}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_against_sql(spark, database, name):
    found = registry.queries()[name](spark, DIRECTORY).toPandas()
    expected = database.sql(registry.oracle_sql()[name]).df()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    left, right = (f[columns].sort_values(columns).reset_index(drop=True) for f in (found, expected))
    assert len(left) == len(right) > 0
    for column in columns:
        a, b = left[column], right[column]
        assert ((a == b) | (a.isna() & b.isna())).all(), column


@pytest.mark.parametrize("name", registry.queries())
def test_plans(spark, name):
    result = registry.queries()[name](spark, DIRECTORY)
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name.startswith(NATIVE):
        for word in ("Python", "Pandas", "Arrow"):
            assert word not in plan
    assert result.count() > 0
