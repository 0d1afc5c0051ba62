import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starlane.operators.keys import assign_keys, natural_key

relaxed = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def expected(names, start=0):
    ordered = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest(), n))
    return {n: start + i for i, n in enumerate(ordered, 1)}


@relaxed
@given(names=st.sets(st.text(alphabet="ab cé", max_size=6), max_size=40))
def test_keys_are_the_global_row_number(spark, names):
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.key for r in assign_keys(frame, F.col("n"), "key").collect()}
    assert got == expected(names)


def test_numbering_goes_on_behind_the_greatest_key(spark):
    names = [f"common-prefix-{i}" for i in range(3000)]
    used = spark.createDataFrame([(7,), (41,), (None,)], "key long")
    frame = spark.createDataFrame([(n,) for n in names], "n string").repartition(3)
    got = {r.n: r.key for r in assign_keys(frame, F.col("n"), "key", after=used).collect()}
    assert got == expected(names, 41)


def test_numbering_after_an_empty_table_starts_at_one(spark):
    frame = spark.createDataFrame([("x", 1)], "n string, y int")
    empty = spark.createDataFrame([], "key long")
    assert assign_keys(frame, natural_key("n", "y"), "key", after=empty).first().key == 1


def test_a_missing_natural_key_is_still_numbered(spark):
    frame = spark.createDataFrame([("x",), (None,)], "n string")
    assert sorted(r.key for r in assign_keys(frame, F.col("n"), "key").collect()) == [1, 2]
