import json

import pytest
from pyspark.sql import types as T

from starlane.sources.evolution import EvolvingTable, SchemaError, merged, narrowed


def schema(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize("a, b, both", [
    ("a int", "a bigint", "a bigint"), ("a bigint", "a int", "a bigint"), ("a int", "a double", "a double"),
    ("a int", "a decimal(5,2)", "a decimal(12,2)"), ("a decimal(38,2)", "a decimal(10,9)", "a double"),
    ("a date", "a timestamp_ntz", "a timestamp_ntz"), ("a void", "a string", "a string"), ("a int", "b int", "a int, b int"),
    ("a struct<x:int>", "a struct<x:bigint,y:string>", "a struct<x:bigint,y:string>"),
    ("a array<int>", "a array<double>", "a array<double>"),
    ("a array<struct<x:int>>", "a array<struct<y:int>>", "a array<struct<x:int,y:int>>"),
])
def test_both_types_fit(spark, a, b, both):
    assert merged(schema(a), schema(b)).simpleString() == schema(both).simpleString()


@pytest.mark.parametrize("a, b, field", [
    ("a int", "a string", "a:"), ("s struct<x:array<int>>", "s struct<x:array<date>>", "s.x[]:"), ("a boolean", "a int", "a:"),
    ("a struct<x:int>", "a int", "a:"),
])
def test_no_common_type_names_the_field(spark, a, b, field):
    with pytest.raises(SchemaError, match=field.replace("[", r"\[").replace("]", r"\]")):
        merged(schema(a), schema(b))


def test_narrowing_is_an_error_that_names_the_fields(spark, tmp_path):
    assert narrowed(schema("a bigint, s struct<x:double,y:int>, z int"), schema("a int, s struct<x:bigint,y:int>")) == [
        "a narrows from bigint to int", "s.x narrows from double to bigint", "z is missing",
    ]
    table = EvolvingTable(spark, str(tmp_path / "t"))
    table.declare(schema("a bigint, s struct<x:double>"))
    table.declare(schema("a decimal(20,1), s struct<x:double,y:string>, n int"))
    with pytest.raises(SchemaError, match="s.x narrows from double to int"):
        table.declare(schema("a decimal(20,1), s struct<x:int,y:string>, n int"))
    assert table.schema().simpleString() == schema("a decimal(20,1), s struct<x:double,y:string>, n int").simpleString()


def test_old_and_new_files_are_one_table(spark, tmp_path):
    table = EvolvingTable(spark, str(tmp_path / "t"))
    assert table.read().count() == 0
    generations = [
        [{"id": 1, "car": {"year": 3}, "tags": [1]}, {"id": 2, "car": None, "tags": None}],
        [{"id": 2**40, "car": {"year": 2.5, "make": "é"}, "tags": [0.5, 2]}],
        [{"id": 4, "car": {"year": 7}, "tags": [], "extra": {"deep": [{"x": "y"}]}}],
        [{"id": 5, "car": {"year": None}, "tags": [3], "extra": None}],
    ]
    for n, rows in enumerate(generations):
        path = tmp_path / f"g{n}.json"
        path.write_text("\n".join(map(json.dumps, rows)))
        table.append_json(str(path))
    # Rows come back as the reader has them when it sees all files at once.
    whole = spark.read.json([str(tmp_path / f"g{n}.json") for n in range(4)])
    fields = sorted(whole.columns)
    found = table.read().select(*fields)
    assert sorted(json.dumps(r.asDict(True), sort_keys=True) for r in found.collect()) == sorted(
        json.dumps(r.asDict(True), sort_keys=True) for r in whole.select(*fields).collect()
    )
    assert [n for n, _ in table.versions()] == [1, 2, 3, 4]
    table.append_json(str(tmp_path / "g1.json"))
    assert len(table.versions()) == 4  # a known schema is no new version
    with pytest.raises(SchemaError, match="id:"):
        table.append(spark.createDataFrame([("x",)], "id string"))
    assert table.read().count() == 6
