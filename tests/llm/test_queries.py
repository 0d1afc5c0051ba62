"""Registered queries: twins in SQL where there are any, and plans of the native ones."""

import duckdb
import pytest

import __spark_entry__ as driver
from starlane.llm import queries

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op2_exact_dedup", "op8_pii_surrogates", "op10_license_scan")


def test_all_are_registered():
    assert queries.QUERIES.keys() | {"pipeline"} <= driver.queries().keys()
    assert queries.ORACLE.keys() <= driver.oracle_sql().keys()
    assert [name for name in queries.QUERIES if not name.startswith("op")] == []


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    frame = driver.queries()[name](spark, SF_DIR)
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    answer = connection.execute(driver.oracle_sql()[name])
    columns = sorted(d[0] for d in answer.description)
    order = [[d[0] for d in answer.description].index(c) for c in columns]
    assert sorted(frame.columns) == columns
    want = sorted(tuple(repr(row[i]) for i in order) for row in answer.fetchall())
    assert sorted(tuple(map(repr, r)) for r in frame.select(*columns).collect()) == want


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    plan = driver.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if word in plan]
