import json

import pytest
from pyspark.sql import functions as F

from samples import CUSTOMERS, GOLDEN, RENTALS
from starlane.operators import checks, kpis
from starlane.plans.daily import bootstrap, new_run, run_customers, run_day, run_fact, vacuum
from starlane.plans.fact import build_fact
from starlane.schemas import RENTAL, RENTALS_FACT


@pytest.fixture
def house(spark, tmp_path):
    for ds, rows in RENTALS.items():
        (tmp_path / f"rentals_{ds}.json").write_text(json.dumps(rows, indent=4))
    for ds, rows in CUSTOMERS.items():
        (tmp_path / f"customers_{ds}.csv").write_text("\n".join(map(",".join, rows)) + "\n")
    house = bootstrap(spark, str(tmp_path / "warehouse"))

    def run(ds):
        run_day(
            house, ds, str(tmp_path / "rentals_{ds}.json"), str(tmp_path / "customers_{ds}.csv"), multi_line=True
        )

    return house, run


def test_two_days_and_repeats(house, rows):
    house, run = house
    assert house.customer_dim().count() == 0
    run("20250903")
    assert (house.customer_dim().count(), house.fact().count()) == (5, 3)
    run("20250904")
    dim, fact = house.customer_dim(), house.fact()
    assert (dim.count(), dim.filter("is_current").count(), fact.count()) == (8, 6, 6)
    for r in fact.collect():
        assert (r.rental_duration_days, r.total_rental_amount, r.average_daily_rental_amount,
                r.car_key, r.pickup_location_key, r.dropoff_location_key) == GOLDEN[r.rental_id]
        assert r.customer_key is not None and r.is_long_rental is False
    assert all(r.violations == 0 for r in checks.scd2_invariants(dim).collect())
    assert all(r.orphan_rows == 0 for r in checks.fk_orphans(fact, house.dimensions()).collect())

    # The same day again changes nothing.
    versions, facts = rows(dim), rows(fact)
    run("20250904")
    assert rows(house.customer_dim()) == versions and rows(house.fact()) == facts

    # Back to the first day, then forward again: the same keys.
    run("20250903")
    assert house.customer_dim().count() == 5
    run("20250904")
    assert rows(house.customer_dim()) == versions and rows(house.fact()) == facts


def test_an_empty_rerun_empties_the_day(house, spark):
    house, run = house
    run("20250903")
    again = new_run("20250903")
    run_customers(house, "20250903", house.customer_dim().limit(0), again)
    run_fact(house, "20250903", spark.createDataFrame([], RENTAL), again)
    assert house.fact().count() == 3  # not yet committed
    house.commit("20250903", again)
    assert house.fact().count() == 0


def orphans(house):
    return sum(r.orphan_rows for r in checks.fk_orphans(house.fact(), house.dimensions()).collect())


def test_a_run_is_visible_with_its_commit_only(house, spark, rows, tmp_path):
    house, run = house
    run("20250903")
    seen = rows(house.customer_dim()), rows(house.fact())
    rentals = spark.createDataFrame(RENTALS["20250904"], RENTAL)
    batch = spark.createDataFrame(CUSTOMERS["20250904"], "customer_id string, name string, email string, phone string")
    for ds in ("20250903", "20250904"):
        failed = new_run(ds)
        run_customers(house, ds, batch, failed)  # fails after the customers
        assert (rows(house.customer_dim()), rows(house.fact()), orphans(house)) == (*seen, 0)
        run_fact(house, ds, rentals, failed)  # fails after the fact
        assert (rows(house.customer_dim()), rows(house.fact()), orphans(house)) == (*seen, 0)
    assert any(name.startswith("rentals_fact/20250904-") for name in vacuum(house))
    assert (rows(house.customer_dim()), rows(house.fact())) == seen and vacuum(house) == []
    run("20250904")
    assert house.fact().count() == 6 and orphans(house) == 0
    run("20250903")  # back to the first day
    assert (rows(house.customer_dim()), rows(house.fact()), orphans(house)) == (*seen, 0)


def test_bootstrap_replaces_all_tables(house, spark, tmp_path):
    house, run = house
    fresh = bootstrap(spark, str(tmp_path / "fresh"))
    assert fresh.fact().count() == 0 and fresh.customer_dim().count() == 0
    run("20250903")
    run("20250904")
    bootstrap(spark, house.root)
    assert house.fact().count() == 0 and house.customer_dim().count() == 0
    run("20250904")
    assert house.fact().count() == 3
    assert {str(r.batch_date) for r in house.fact().collect()} == {"2025-09-04"}


def test_rejects_and_checks_are_kept(spark, tmp_path):
    good = RENTALS["20250903"][0]
    lines = [
        json.dumps({**good, "rental_id": "ok"}),
        json.dumps({**good, "rental_id": "whole", "quantity": 2.0}),
        json.dumps({**good, "rental_id": "half", "quantity": 2.5}),
        json.dumps({**good, "rental_id": "nobody", "customer_id": None}),
        json.dumps({**good, "rental_id": "car?", "car": {"make": "A|B", "model": "C", "year": 1}}),
        '{"rental_id": "broken", ',
    ]
    (tmp_path / "rentals_20250903.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "customers_20250903.csv").write_text("C1,z,z@old,1\nC1,a,a@new,1\n")
    house = bootstrap(spark, str(tmp_path / "warehouse"))
    run_day(house, "20250903", str(tmp_path / "rentals_{ds}.json"), str(tmp_path / "customers_{ds}.csv"))
    assert {r.rental_id for r in house.fact().collect()} == {"ok", "whole"}
    rejects = {r.rental_id: r for r in house.rejects().collect()}
    assert set(rejects) == {"half", "nobody", None}
    assert rejects["half"].missing_fields == "quantity" and rejects["nobody"].missing_fields == "customer_id"
    assert rejects[None].raw == lines[-1]
    found = {(r.check, r.item): r.violations for r in house.checks().collect()}
    assert found["rows", "read"] == 6 and found["rows", "rejected"] == 3 and found["rows", "fact"] == 2
    assert found["unresolved", "car"] == 1 and found["batch", "conflicting customers"] == 1
    assert house.customer_dim().first().email == "a@new"  # the last line of the file


def test_indicators_add_up_to_the_fact(house):
    house, run = house
    run("20250903")
    run("20250904")
    fact, dims = house.fact(), house.dimensions()
    total = round(fact.agg(F.sum("total_rental_amount")).first()[0], 2)
    by_car = kpis.revenue_by_car(fact, dims["car_dim"]).collect()
    assert round(sum(r.revenue for r in by_car), 2) == total
    by_place = kpis.revenue_by_location(fact, dims["location_dim"]).collect()
    for role in ("pickup", "dropoff"):
        assert round(sum(r.revenue for r in by_place if r.role == role), 2) == total
    unknown = [r for r in by_place if r.location_name == kpis.UNKNOWN]
    assert [(r.role, r.rentals) for r in unknown] == [("pickup", 1)]
    overall = [r for r in kpis.average_duration(fact, dims["location_dim"]).collect() if r.scope == "overall"]
    assert [(r.rentals, r.average_duration_days) for r in overall] == [(6, 31 / 6)]
    ratio = [r for r in kpis.long_rental_ratio(fact, dims["car_dim"]).collect() if r.scope == "overall"]
    assert [(r.rentals, r.long_rental_ratio) for r in ratio] == [(6, 0.0)]


def test_fact_has_the_declared_columns(house, spark):
    house, run = house
    run("20250903")
    fact = build_fact(spark.createDataFrame(RENTALS["20250903"], RENTAL), house.dimensions())
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in RENTALS_FACT]
    with pytest.raises(ValueError):
        build_fact(spark.createDataFrame([], RENTAL), house.dimensions(), "newest")
