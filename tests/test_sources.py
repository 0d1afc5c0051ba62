import json
import os
import time

from pyspark.sql import types as T

from samples import GOLDEN, RENTALS, rental
from starlane.operators import rentals as R
from starlane.plans.fact import build_fact
from starlane.schemas import CUSTOMER_DIM, RENTAL
from starlane.sinks.fact import replace_days
from starlane.sinks.tables import create_table, create_table_like, truncate_table
from starlane.sources.customers import read_customers
from starlane.sources.drift import drift_report, infer_schema
from starlane.sources.rentals import read_rentals, write_rentals
from starlane.sources.slices import batch_slice, dated_path
from starlane.streaming.load_once import load_once
from starlane.workload import queries, tables

import pytest


def test_multi_line_array(spark, tmp_path):
    file = tmp_path / "rentals_20250903.json"
    file.write_text(json.dumps(RENTALS["20250903"], indent=4))
    found = {r.rental_id: r for r in R.measured(read_rentals(spark, str(file), multi_line=True)).collect()}
    assert set(found) == {"RNTL001", "RNTL002", "RNTL003"}
    for key, row in found.items():
        got = (row.rental_duration_days, row.total_rental_amount, row.average_daily_rental_amount)
        assert got == GOLDEN[key][:3]


def test_absent_field_is_null_and_rejected(spark, tmp_path):
    row = dict(RENTALS["20250903"][0])
    del row["quantity"]
    file = tmp_path / "r.json"
    file.write_text(json.dumps(row))
    raw = read_rentals(spark, str(file))
    assert raw.schema == RENTAL
    assert R.rejected(raw).first().missing_fields == "quantity"


def test_slice_reads_one_folder(spark, tmp_path):
    for ds, day in (("20250903", "2025-09-03"), ("20250904", "2025-09-04")):
        folder = tmp_path / f"batch_date={day}"
        folder.mkdir()
        (folder / "part.json").write_text("\n".join(map(json.dumps, RENTALS[ds])))
    rows = batch_slice(read_rentals(spark, str(tmp_path)), "20250904")
    assert sorted(r.rental_id for r in rows.collect()) == ["RNTL051", "RNTL052", "RNTL053"]
    assert "PartitionFilters: [isnotnull(batch_date" in rows._jdf.queryExecution().toString()
    assert len(rows.select("_metadata.file_path").distinct().collect()) == 1


def test_run_date_in_paths():
    assert dated_path("x/rentals_{ds}.json", "20250903") == "x/rentals_20250903.json"
    with pytest.raises(ValueError):
        dated_path("x/{ds}", "2025-09-03")


def test_customer_csv_dialects(spark, tmp_path):
    file = tmp_path / "c.csv"
    file.write_text('C1,"Doe, John",,555\nC2,"Ann",a@b.c,"556"\n')
    standard = sorted(map(tuple, read_customers(spark, str(file)).collect()))
    assert standard == [("C1", "Doe, John", None, "555"), ("C2", "Ann", "a@b.c", "556")]
    plain = sorted(map(tuple, read_customers(spark, str(file), quoted=False).collect()))
    assert plain[0] == ("C1", '"Doe', ' John"', None)
    assert plain[1] == ("C2", '"Ann"', "a@b.c", '"556"')


def test_drift_and_table_from_files(spark, tmp_path):
    changed = rental("R", "C", ("a", "b", 2020), "2025-09-01", "2025-09-02", "x", "y", "12.5", 1)
    changed["channel"] = "web"
    del changed["quantity"]
    files = tmp_path / "in"
    files.mkdir()
    (files / "a.json").write_text(json.dumps(changed) + "\n" + json.dumps({"rental_id": "S"}))
    lines = {r.field: r for r in drift_report(spark, str(files), RENTAL).collect()}
    assert {f: r.status for f, r in lines.items() if r.status != "same"} == {
        "amount": "retyped", "channel": "added", "quantity": "missing"
    }
    assert (lines["rental_id"].present_rows, lines["channel"].present_rows) == (2, 1)
    assert (lines["quantity"].found_type, lines["quantity"].present_rows) == (None, 0)
    table = str(tmp_path / "table")
    create_table_like(spark, table, str(files))
    made = spark.read.parquet(table)
    assert made.count() == 0 and made.schema == infer_schema(spark, str(files))


def test_create_and_truncate(spark, tmp_path):
    path = str(tmp_path / "t")
    create_table(spark, path, CUSTOMER_DIM)
    empty = spark.read.parquet(path)
    assert empty.count() == 0
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in CUSTOMER_DIM]
    spark.range(5).write.mode("overwrite").parquet(path)
    truncate_table(spark, path)
    assert spark.read.parquet(path).count() == 0
    assert spark.read.parquet(path).schema == T.StructType([T.StructField("id", T.LongType())])


def test_each_file_is_loaded_once(spark, tmp_path):
    files, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))

    def arrive(name, rows, days_ago=0):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(rows))
        stamp = time.time() - 24 * 3600 * days_ago
        os.utime(path, (stamp, stamp))

    def load():
        load_once(spark, files, target, log, RENTAL, multi_line=True)
        found = spark.read.parquet(target).collect()
        return sorted((r.rental_id, r.source_file.split("/in/")[1]) for r in found)

    first, second = RENTALS["20250903"], RENTALS["20250904"]
    arrive("a/d.json", first)
    loaded = [(r["rental_id"], "a/d.json") for r in first]
    assert load() == loaded and load() == loaded
    # A file far older than the newest one, one of an equal name, and a new one.
    arrive("old.json", [{**second[0], "rental_id": "old"}], days_ago=400)
    arrive("b/d.json", second)
    loaded = sorted([*loaded, *((r["rental_id"], "b/d.json") for r in second), ("old", "old.json")])
    assert load() == loaded and load() == loaded


def test_enclosed_customers(spark, tmp_path):
    (tmp_path / "c.csv").write_text('C1,"Ann ""Al"" Lee",a@x,"1,2"\nC2,"line\nbreak",b@x,3\n')
    read = read_customers(spark, str(tmp_path / "c.csv"), line_breaks=True).orderBy("customer_id").collect()
    assert [tuple(r) for r in read] == [("C1", 'Ann "Al" Lee', "a@x", "1,2"), ("C2", "line\nbreak", "b@x", "3")]


def test_written_rentals_are_compressed(spark, tmp_path):
    many = spark.range(20_000).selectExpr(
        "cast(id AS string) AS rental_id", "'c' AS customer_id", "named_struct('make', 'A', 'model', 'B', 'year', 1) AS car",
        "date'2024-01-01' + cast(id % 2 AS int) AS batch_date",
    )
    write_rentals(many, str(tmp_path / "files"))
    written = sum(f.stat().st_size for f in tmp_path.glob("files/*/part-*"))
    assert written < many.count() * 20
    back = read_rentals(spark, str(tmp_path / "files"))
    assert back.select(*many.columns).exceptAll(many).count() == 0 and back.count() == 20_000


@pytest.mark.parametrize("name, folder", [("src_schema_drift", "drifted"), ("flt_rejected_raw", "raw-rentals")])
def test_files_that_a_query_makes_are_compressed(spark, tmp_path, monkeypatch, name, folder):
    monkeypatch.setattr(queries, "fresh_path", lambda spark, name: str(tmp_path / name))
    queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    files = list((tmp_path / folder).glob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)


def test_days_are_written_where_their_rows_are(spark, tmp_path):
    rows = spark.range(0, 60, 1, 3).selectExpr("id", "date'2024-01-01' + cast(id % 2 AS int) AS batch_date")
    replace_days(rows, str(tmp_path / "fact"), together=False)
    assert all(len(list((tmp_path / f"fact/batch_date=2024-01-0{d}").glob("part-*"))) == 3 for d in (1, 2))
    assert spark.read.parquet(str(tmp_path / "fact")).exceptAll(rows).count() == 0


def test_no_measure_is_shuffled_for_the_fact(spark):
    sf = "/root/testdata/sf0.001"
    plan = build_fact(tables.rentals(spark, sf), tables.dimensions(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    made = next(i for i, line in enumerate(lines) if "AS average_daily_rental_amount" in line)
    assert made < next(i for i, line in enumerate(lines) if "Join LeftOuter, (customer_id" in line)


def test_hot_customers_are_counted_without_the_tables_they_do_not_need(spark, monkeypatch):
    counted = []
    spread = queries.lookups.spread_customers
    monkeypatch.setattr(queries.lookups, "spread_customers", lambda rows, *a: counted.append(rows) or spread(rows, *a))
    queries.QUERIES["fact_customer_as_of_hot"](spark, "/root/testdata/sf0.001")
    plan = counted[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "o_custkey" in plan and "s_suppkey" not in plan and "p_partkey" not in plan
