import copy

import pytest

from pyspark.sql import functions as F

from samples import JFK, LAX, rental
from starlane.functions.dates import batch_day, iso_date, resolve_run_date, run_date
from starlane.operators import checks, kpis
from starlane.operators import rentals as R
from starlane.schemas import RENTAL

CAMRY = ("Toyota", "Camry", 2020)


def one(rental_id="R", start="2025-09-01", end="2025-09-05", amount=10.0, quantity=2):
    return rental(rental_id, "C", CAMRY, start, end, JFK, LAX, amount, quantity)


def without(path):
    row = copy.deepcopy(one(path))
    *parents, leaf = path.split(".")
    inner = row
    for p in parents:
        inner = inner[p]
    inner[leaf] = None
    return row


def test_each_required_field_is_required(spark):
    frame = spark.createDataFrame([one(), *[without(f) for f in R.REQUIRED]], RENTAL)
    assert [r.rental_id for r in R.valid(frame).collect()] == ["R"]
    missing = sorted(r.missing_fields for r in R.rejected(frame).collect())
    assert missing == sorted(R.REQUIRED)


def test_missing_parent_rejects_with_all_its_fields(spark):
    row = one()
    row["car"] = None
    frame = spark.createDataFrame([row], RENTAL)
    assert R.valid(frame).count() == 0
    assert R.rejected(frame).first().missing_fields == "car.make,car.model,car.year"


def test_measures_at_the_edges(spark):
    frame = spark.createDataFrame([
        one("zero", end="2025-09-01"),
        one("negative", end="2025-08-30"),
        one("seven", end="2025-09-08"),
        one("eight", end="2025-09-09"),
        one("malformed", end="soon"),
        one("third", end="2025-09-04", amount=100.0, quantity=1),
    ], RENTAL)
    found = {r.rental_id: r for r in R.measured(frame).collect()}
    assert len(found) == 6
    assert (found["zero"].rental_duration_days, found["zero"].average_daily_rental_amount) == (0, None)
    assert (found["negative"].rental_duration_days, found["negative"].average_daily_rental_amount) == (-2, -10.0)
    assert [found[k].is_long_rental for k in ("seven", "eight")] == [False, True]
    assert found["malformed"].rental_duration_days is None
    assert found["malformed"].is_long_rental is False
    assert found["third"].average_daily_rental_amount == 33.33
    assert found["zero"].total_rental_amount == 20.0


def test_half_cents_round_up(spark):
    rows = [one(str(i), end="2025-09-03", amount=a, quantity=1) for i, a in enumerate((0.01, 0.03, 2.01, -0.01))]
    found = {r.rental_id: r.average_daily_rental_amount
             for r in R.measured(spark.createDataFrame(rows, RENTAL)).collect()}
    assert found == {"0": 0.01, "1": 0.02, "2": 1.01, "3": -0.01}


def test_amounts_beyond_decimals_do_not_fail_the_job(spark):
    rows = [one("huge", amount=1e300, quantity=1), one("nan", amount=float("nan"), quantity=1)]
    found = {r.rental_id: r.average_daily_rental_amount
             for r in R.measured(spark.createDataFrame(rows, RENTAL)).collect()}
    assert found["huge"] == 1e300 / 4 and found["nan"] != found["nan"]


def test_run_date_rule(spark):
    assert resolve_run_date("NA", "2025-09-03") == "20250903"
    assert resolve_run_date("20250101", "2025-09-03") == "20250101"
    frame = spark.createDataFrame([("NA",), ("20250101",), (None,)], "param string")
    got = frame.select(run_date(F.col("param"), F.lit("2025-09-03").cast("date"))).collect()
    assert [r[0] for r in got] == ["20250903", "20250101", "20250903"]


def test_dates_never_fail_the_job(spark):
    frame = spark.createDataFrame([("2025-02-30",), ("",), ("2025-09-01",)], "d string")
    assert [str(r[0]) for r in frame.select(iso_date(F.col("d"))).collect()] == ["None", "None", "2025-09-01"]


def test_great_amounts_fail_nothing(spark):
    rows = [("a", 1, 1, 1e17), ("b", 1, 1, 0.25), ("c", 1, 1, 1e30), ("d", 2, 1, None)]
    fact = spark.createDataFrame(rows, "rental_id string, car_key long, customer_key long, total_rental_amount double")
    cars = spark.createDataFrame([(1, "A", "B", 1), (2, "C", "D", 2)], "car_key long, make string, model string, year int")
    by_car = {r.make: r for r in kpis.revenue_by_car(fact, cars).collect()}
    assert (by_car["A"].revenue, by_car["A"].rentals, by_car["A"].amounts_left_out) == (1e17 + 0.25, 3, 1)
    assert (by_car["C"].revenue, by_car["C"].amounts_left_out) == (None, 0)
    segments = spark.createDataFrame([(9, "X")], "customer_key long, segment string")
    unknown = kpis.tickets_by_segment(fact, segments).collect()
    assert [(r.segment, r.tickets, r.amounts_left_out) for r in unknown] == [("UNKNOWN", 4, 1)]
    profile = {r.column_name: r for r in checks.table_profile({"f": fact}).collect()}
    assert (profile["total_rental_amount"].min_value, profile["total_rental_amount"].max_value) == ("0.25", "1.0E30")


def test_keys_are_compared_by_type(spark):
    cars = spark.createDataFrame([("A", "B|C", 1)], "make string, model string, year int")
    flat = spark.createDataFrame(
        [("A|B", "C", 1, "1", "x", "y", "2025-13-01", "2025-09-03")],
        "make string, model string, year int, customer_id string, pickup_location string, dropoff_location string, "
        "start_date string, end_date string",
    )
    dims = {
        "car_dim": cars,
        "customer_dim": spark.createDataFrame([("1", True)], "customer_id string, is_current boolean"),
        "location_dim": spark.createDataFrame([("x",), ("y",)], "location_name string"),
        "date_dim": spark.createDataFrame([("2025-09-03",)], "d string").selectExpr("cast(d as date) as date"),
    }
    found = {r.role: r.natural_value for r in checks.unresolved_lookups(flat, dims).collect()}
    assert found == {"car": "A|B|C|1", "start_date": "2025-13-01"}
    keys = spark.createDataFrame([("a", None, 1), ("a", None, 1), ("a|", "1", 1)], "a string, b string, c int")
    assert [tuple(r)[2:] for r in checks.duplicate_keys([("t", keys, ("a", "b", "c"))]).collect()] == [("a|NULL|1", 2)]


@pytest.mark.parametrize("ds", ["20251399", "20250230", "2025-9-3", "abc"])
def test_run_date_is_a_day(ds):
    with pytest.raises(ValueError):
        batch_day(ds)
