"""Every registered query against its SQL, on the smallest tables."""
import math
import os

import pytest

import contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


@pytest.mark.parametrize("name", list(contract.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = contract.QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert costly not in plan
    columns = sorted(frame.columns)
    found = sorted(tuple(cell(r[c]) for c in columns) for r in frame.collect())
    answer = duck.sql(contract.ORACLES[name])
    assert sorted(answer.columns) == columns
    kinds = dict(zip(answer.columns, map(str, answer.types)))
    assert {f.name: TYPES.get(f.dataType.simpleString(), kinds[f.name]) for f in frame.schema} == kinds
    places = [answer.columns.index(c) for c in columns]
    assert found == sorted(tuple(cell(r[i]) for i in places) for r in answer.fetchall())


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.ORACLES)
