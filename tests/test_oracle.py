"""Every query against its SQL twin in DuckDB, whole tables, and a look at its plan."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from starlane.session import fresh_path, shared_folder
from starlane.workload.oracle import ORACLE
from starlane.workload.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
# Joins that compare all pairs, and work outside the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit")
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert driver.queries().keys() >= QUERIES.keys() and driver.oracle_sql().keys() >= ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_names_and_types(spark, duck, name):
    frame = driver.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = sorted((tuple(map(repr, row)) for row in frame.select(*columns).collect()))
    answer = duck.execute(driver.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in answer.description}
    assert sorted(described) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema} == described
    order = [list(described).index(c) for c in columns]
    want = sorted(tuple(repr(row[i]) for i in order) for row in answer.fetchall())
    assert got and got == want
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


def test_entry_is_the_fact(spark):
    fact = driver.entry(spark)
    assert len(fact.columns) == 13 and fact.count() > 0


def test_fact_reads_only_what_it_needs(spark):
    plan = driver.queries()["fact_rentals"](spark, SF_DIR)._jdf.queryExecution().toString()
    for unused in ("l_tax", "l_shipdate", "o_totalprice", "c_acctbal", "p_retailprice"):
        assert f"{unused}:" not in plan.split("== Physical Plan ==")[1]
    assert "IsNotNull(l_orderkey)" in plan


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == (configured.rstrip("/") if configured else spark.sparkContext.getCheckpointDir())
    assert fresh_path(spark, "t") != fresh_path(spark, "t")
    assert fresh_path(spark, "t").startswith(f"{folder}/t-")
