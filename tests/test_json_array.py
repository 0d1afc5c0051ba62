"""Arrays read in parts against Spark's reader of whole files."""

import bz2
import gzip
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starlane.operators.rentals import rejected
from starlane.schemas import RENTAL
from starlane.sources.json_array import read_array_objects
from starlane.sources.rentals import parse_rentals, read_objects, read_rentals
from starlane.workload import tables

STRINGS = ["", "}{", '"}', "\\", '\\"}', "plain", "{[", "é漢}😀", "\n", "[]", "\\\\", "],["]


def value(rng, depth=0):
    kind = rng.random()
    if kind < 0.6 or depth > 3:
        return rng.choice([rng.choice(STRINGS), rng.randrange(99), None, True, -1.5])
    if kind < 0.8:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(STRINGS) + str(i): value(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.fixture
def split_at(spark):
    """Sets the bytes of a split, and puts back what was."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_to
    for name, old in before.items():
        spark.conf.set(name, old)


@pytest.mark.parametrize("size", [7, 61, 400, 10_000])
def test_objects_at_any_split(spark, tmp_path, split_at, size):
    rng = random.Random(size)
    want = []
    for n, count in enumerate((0, 1, 3, 120)):
        rows = [{"id": f"{n}-{i}", "v": value(rng)} for i in range(count)]
        want += rows
        text = json.dumps(rows, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{n}.json").write_text(rng.choice(["", " \r\n", "﻿"]) + text + rng.choice(["", "\n\n"]))
    split_at(size)
    found = read_array_objects(spark, str(tmp_path))
    if size < 100:
        parts = spark.read.option("lineSep", "}").text(str(tmp_path)).select(F.spark_partition_id()).distinct().count()
        assert parts > 20
    got = [json.loads(r.raw) for r in found.collect()]
    assert sorted(map(repr, got), key=str) == sorted(map(repr, want), key=str)


def test_texts_are_kept_byte_for_byte(spark, tmp_path, split_at):
    texts = ['{"a" :1.50,  "b":"\\u00e9}"}', '{}', '{"c": {"d": [{"e": "\\\\"}, {}]}}', "{\n\t\"f\" : null }"]
    (tmp_path / "a.json").write_text("[ " + " ,\n".join(texts) + "]")
    for size in (3, 10, 1000):
        split_at(size)
        assert sorted(r.raw for r in read_array_objects(spark, str(tmp_path)).collect()) == sorted(texts)


def test_what_is_no_object_and_what_is_cut_off_is_not_lost(spark, tmp_path, split_at):
    split_at(1 << 20)
    (tmp_path / "a.json").write_text('[{"a": 1}, 5, "x{", {"a": 2}, {"a": "cut} ')
    found = sorted(r.raw for r in read_array_objects(spark, str(tmp_path)).collect())
    assert found == ['5, "x{", {"a": 2}', '{"a": "cut} ', '{"a": 1}']
    (tmp_path / "a.json").write_text('{"a": 1}{"a": 2}')  # no array, and no byte behind the last brace
    assert sorted(r.raw for r in read_array_objects(spark, str(tmp_path)).collect()) == ['{"a": 1}', '{"a": 2}']


def test_a_large_array_is_parsed_by_many_tasks(spark, tmp_path, split_at, rows):
    rng = random.Random(1)
    with open(tmp_path / "day.json", "w") as out:
        for i in range(60_000):
            record = {
                "rental_id": f"r{i}", "customer_id": rng.choice(STRINGS) or None, "car": {"make": rng.choice(STRINGS), "model": "m", "year": 2020},
                "rental_period": {"start_date": "2025-09-01", "end_date": "2025-09-02"},
                "rental_location": {"pickup_location": "a", "dropoff_location": "}"}, "amount": i / 4, "quantity": i % 5,
            }
            out.write("[,"[i > 0] + json.dumps(record))
        out.write("]")
    split_at(1 << 20)
    objects = read_objects(spark, str(tmp_path / "day.json"), multi_line=True)
    tasks = spark.read.option("lineSep", "}").text(str(tmp_path / "day.json")).rdd.getNumPartitions()
    assert tasks > 10
    names = RENTAL.fieldNames()
    parsed = parse_rentals(objects).select(*names)
    whole = read_rentals(spark, str(tmp_path / "day.json"), multi_line=True).select(*names)
    assert parsed.exceptAll(whole).count() == 0 and whole.count() == parsed.count() == 60_000


def test_parts_are_cut_where_they_are_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    plan = read_array_objects(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Only counts of splits and rests at their borders are brought together, by file.
    assert exchanges and all("split" not in line for line in exchanges)


def test_a_text_is_parsed_once_whatever_is_asked_of_its_fields(spark):
    objects = spark.createDataFrame([('{"rental_id": "r"}',), ("[", )], "raw string")
    kept = rejected(parse_rentals(objects)).select("rental_id", "missing_fields", "raw")
    assert kept._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert sorted((r.rental_id or "", r.raw) for r in kept.collect()) == [("", "["), ("r", '{"rental_id": "r"}')]


@pytest.mark.parametrize("pack, ending", [(gzip.compress, ".json.gz"), (bz2.compress, ".json.bz2")])
def test_compressed_arrays(spark, tmp_path, pack, ending):
    rng = random.Random(5)
    texts = ["[]", '[{"a": 1}, 5, "x{", {"a": 2}, {"a": "cut} ', '{"a": 1}{"a": 2}', '{"a": 1}{"a": 2}\n', '[{"a": "}', '[{"a": {', "﻿[{}]"]
    texts += [json.dumps([{"id": i, "v": value(rng)} for i in range(40)], indent=1, ensure_ascii=False) + " " * n for n in range(6)]
    for folder in ("plain", "packed"):
        (tmp_path / folder).mkdir()
    for i, text in enumerate(texts):
        (tmp_path / "plain" / f"{i}.json").write_text(text)
        packed = i % 4 != 1  # some plain files stand among packed ones
        (tmp_path / "packed" / f"{i}{ending if packed else '.json'}").write_bytes(pack(text.encode()) if packed else text.encode())
    plain, packed = (sorted(r.raw for r in read_array_objects(spark, str(tmp_path / f)).collect()) for f in ("plain", "packed"))
    assert packed == plain and {'{"a": 2}', '{"a": "cut} ', '{"a": "}', '{"a": {', "{}"} <= set(plain)


def test_only_some_array_files_are_plain_and_each_is_an_array(spark, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_ARRAY", 250)
    monkeypatch.setattr(tables, "PLAIN", 5)
    monkeypatch.setattr(tables, "_paths", {})
    path = tables.array_files(spark, "/root/testdata/sf0.001")
    files = {f.parent.name: f for f in Path(path).glob("file=*/part-*")}
    assert len(files) == len(list(Path(path).glob("file=*/part-*"))) > 20
    ids = []
    for name, file in files.items():
        plain = int(name.split("=")[1]) % 5 == 0
        assert (file.suffix == ".gz") == (not plain)
        ids += [r["rental_id"] for r in json.loads(file.read_bytes() if plain else gzip.decompress(file.read_bytes()))]
    assert sorted(ids) == sorted(r.rental_id for r in tables.rentals(spark, "/root/testdata/sf0.001").select("rental_id").collect())
    read = read_objects(spark, path, multi_line=True)
    assert sorted(json.loads(r.raw)["rental_id"] for r in read.collect()) == sorted(ids)
