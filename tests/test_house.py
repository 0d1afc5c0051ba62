"""The warehouse over many days: states against full checks, late days, conflicts, bytes, indicators."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from samples import CUSTOMERS, RENTALS
from starlane.operators import checks, kpi_state, kpis, late, scd2
from starlane.plans import daily
from starlane.plans.daily import ConflictError, bootstrap, new_run, run_customers, run_day, run_late_customers, vacuum
from starlane.session import fresh_path, remove_path, scratch, shared_folder

BATCH = "customer_id string, name string, email string, phone string"


def batch(spark, rows):
    return spark.createDataFrame(rows, BATCH)


def load(house, ds, rows, is_late=False):
    run = new_run(ds)
    step = run_late_customers if is_late else run_customers
    step(house, ds, batch(house.spark, rows), run)
    house.commit(ds, run, late=is_late)
    return run


def random_day(rng, customers=9):
    """Some customers with one of few values, so that they change, return and stay away."""
    return [(f"c{i}", rng.choice("ab"), rng.choice(["x", None]), "1") for i in range(customers) if rng.random() < 0.6]


def full_checks(dim):
    found = [("versions", r.rule, r.violations) for r in checks.scd2_invariants(dim).collect()]
    nulls = checks.nulls({"customer_dim": (dim, ("customer_key", "customer_id"))}).collect()
    found += [("null", f"customer_dim.{r.column_name}", r.null_count) for r in nulls]
    for columns in checks.DECLARED_KEYS["customer_dim"]:
        n = checks.duplicate_keys([("customer_dim", dim, columns)]).count()
        found += [("duplicate", f"customer_dim.{','.join(columns)}", n)] * (n > 0)
    return sorted(found)


def test_states_equal_full_checks_over_twenty_days(spark, tmp_path, monkeypatch):
    """From the tenth day on rows are spoilt in ways that the checks must find."""
    rng = random.Random(5)
    house = bootstrap(spark, str(tmp_path / "house"), buckets=3)
    spoil = {
        "flag": lambda d: d.withColumn("is_current", ~F.col("is_current")),
        "twice": lambda d: d.unionAll(d),
        "earlier": lambda d: d.withColumn("effective_date", F.col("effective_date") - F.expr("INTERVAL 30 DAY")),
        "no key": lambda d: d.withColumn("customer_key", F.when(F.col("customer_id") != "c3", F.col("customer_key"))),
        "same key": lambda d: d.withColumn("customer_key", F.lit(1).cast("long")),
    }
    wrong = {"closed_by": None, "opened_by": None}
    for name in wrong:
        honest = getattr(scd2, name)
        monkeypatch.setattr(daily.scd2, name, lambda *a, n=name, f=honest: spoil[wrong[n]](f(*a)) if wrong[n] else f(*a))
    seen = set()
    for n in range(1, 21):
        wrong["closed_by"] = rng.choice([None, "flag", "twice", "earlier"]) if n >= 10 else None
        wrong["opened_by"] = rng.choice([None, "twice", "no key", "same key", "earlier"]) if n >= 10 else None
        load(house, f"202509{n:02}", random_day(rng))
        if n in (9, 12, 16, 20):
            found = sorted(daily._customer_checks(house, house.commits()))
            assert found == full_checks(house.customer_dim()), n
            seen |= {(check, item) for check, item, count in found if count}
            assert n >= 10 or not seen
    assert {("versions", rule) for rule in ("many_current", "overlap", "flag_mismatch", "repeated_start")} <= seen
    assert ("duplicate", "customer_dim.customer_key") in seen


@pytest.fixture
def files(spark, tmp_path):
    """Ten days of input; the house, and how to load one."""
    rng = random.Random(2)
    for n in range(1, 11):
        ds = f"202510{n:02}"
        rows = random_day(rng)
        (tmp_path / f"customers_{ds}.csv").write_text("".join(f"{','.join(v or '' for v in r)}\n" for r in rows) or "c0,a,,1\n")
        rentals = [
            {**rng.choice(RENTALS["20250903"]), "rental_id": f"r{n * (i % 2)}-{i}", "customer_id": f"c{rng.randrange(10)}"} for i in range(12)
        ]
        (tmp_path / f"rentals_{ds}.json").write_text("\n".join(map(json.dumps, rentals)) + "\n")
    house = bootstrap(spark, str(tmp_path / "house"), buckets=4)

    def run(n, root=house, **options):
        return run_day(
            root, f"202510{n:02}", str(tmp_path / "rentals_{ds}.json"), str(tmp_path / "customers_{ds}.csv"),
            segments=lambda c: c.select("customer_key", F.col("customer_id").substr(2, 1).alias("segment")), **options,
        )

    return house, run


def described(house):
    """The history without keys, and the fact with its customers' versions in their place."""
    dim = house.customer_dim()
    columns = [c for c in dim.columns if c != "customer_key"]
    history = sorted(map(repr, dim.select(*columns).collect()))
    version = dim.select("customer_key", F.struct("customer_id", "name", "email", "effective_date").alias("version"))
    rows = house.fact().join(version, "customer_key", "left").select("rental_id", "car_key", "batch_date", "version")
    return history, sorted(map(repr, rows.collect()))


def test_a_day_opens_no_ended_version_of_older_runs(files):
    house, run = files
    first = [run(1), run(2), run(3)]
    before = daily._customer_checks(house, house.commits())
    for name in ("customer_closed", "rentals_fact", "indicators", "tickets"):
        for old in first:
            remove_path(house.spark, house.path(f"{name}/{old}"))
    run(4)
    assert {r.check for r in house.checks().collect()} >= {"rows", "orphan", "versions", "null"}
    found = {(r.check, r.item): r.violations for r in house.checks().collect()}
    assert [found["versions", item] for _, item, _ in before[:4]] == [0] * 4
    assert found["orphan", "customer_key"] == 0


def test_late_days_and_ordered_days_give_one_warehouse(files, spark, tmp_path):
    house, run = files
    for n in (1, 2, 4):
        run(n)
    other = bootstrap(spark, str(tmp_path / "other"), buckets=4)
    for n, is_late in ((1, False), (4, True), (2, True)):
        run(n, root=other, is_late=is_late)
    assert [c.late for c in other.commits()] == [False, False, True]  # nothing lay behind the fourth day
    history, fact = described(house)
    late_history, late_fact = described(other)
    assert late_history == history
    # A customer unknown on its day has no key to put right.
    known = [r for r in late_fact if "version=None" not in r]
    assert set(known) <= set(fact) and len(late_fact) == len(fact)
    assert full_checks(other.customer_dim()) == sorted(daily._customer_checks(other, other.commits()))
    with pytest.raises(ValueError):
        run(2, root=other, is_late=True)
    # A day run again takes out of sight what was built on it, late days too.
    run(4, root=other)
    assert [(c.ds[-2:], c.late) for c in other.commits()] == [("01", False), ("04", False)]


@pytest.mark.parametrize("seed", range(2))
def test_merging_in_any_order_gives_the_ordered_history(spark, seed):
    rng = random.Random(seed)
    days = {n: random_day(rng, 14) for n in range(1, 7)}

    def at(n):
        return f"2025-09-{n:02} 00:00:00"

    def frame(n):
        return batch(spark, days[n])

    rows = [(r[0], *r[1:], at(n)) for n, some in days.items() for r in some]
    ordered = scd2.history(
        spark.createDataFrame(rows, f"{BATCH}, batch_date string").withColumn("batch_date", F.col("batch_date").cast("date"))
    )
    order = rng.sample(sorted(days), len(days))
    dim = scd2.initial(frame(order[0]), at(order[0]))
    done = [order[0]]
    for n in order[1:]:
        dim = spark.createDataFrame(dim.collect(), dim.schema)
        seen = spark.createDataFrame([(r[0], at(m)) for m in done for r in days[m]], "customer_id string, seen_at string")
        dim = late.merge_late(dim, frame(n), at(n), seen.withColumn("seen_at", F.col("seen_at").cast("timestamp_ntz")))
        done.append(n)
    columns = [c for c in dim.columns if c != "customer_key"]
    assert sorted(map(repr, dim.select(*columns).collect())) == sorted(map(repr, ordered.select(*columns).collect()))
    assert dim.select("customer_key").distinct().count() == dim.count()


def test_a_run_leaves_no_intermediate_table(files, spark):
    house, run = files

    def there():
        folder = shared_folder(spark).removeprefix("file:")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    run(1)
    before = there()
    run(2)
    assert there() == before and house.fact().count() > 0
    kept = fresh_path(spark, "kept")
    with scratch(spark):
        gone = fresh_path(spark, "gone")
        for path in (kept, gone):
            spark.range(1).write.parquet(path)
    assert there() == before | {os.path.basename(kept)}
    remove_path(spark, kept)


def test_of_two_runs_at_once_one_commits(spark, tmp_path):
    house = bootstrap(spark, str(tmp_path / "house"), buckets=2)
    load(house, "20250901", [("c1", "a", "x", "1")])
    base = house.last_number()
    runs = {ds: new_run(ds) for ds in ("20250902", "20250903")}
    for ds, run in runs.items():
        run_customers(house, ds, batch(spark, [("c1", "b", ds, "1")]), run)
    house.commit("20250903", runs["20250903"], base)
    with pytest.raises(ConflictError):
        house.commit("20250902", runs["20250902"], base)
    assert [c.ds for c in house.commits()] == ["20250901", "20250903"]
    assert {r.email for r in house.customer_dim().collect()} == {"x", "20250903"}
    # A line cut off while it was written is none.
    with open(f"{house.root}/commits/000000000099.json", "w") as half:
        half.write('{"number": 99, "ds": "2025')
    assert [c.ds for c in house.commits()] == ["20250901", "20250903"] and house.last_number() == 2


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_a_day_writes_the_buckets_it_touches(spark, tmp_path):
    house = bootstrap(spark, str(tmp_path / "house"), buckets=16)
    everyone = [(f"c{i}", f"name {i}", "x", "1") for i in range(4000)]
    first = load(house, "20250901", everyone)
    changed = [(c, n, "new" if c in ("c7", "c8") else e, p) for c, n, e, p in everyone]
    second = load(house, "20250902", changed)
    third = load(house, "20250903", changed)
    folders = {run: os.listdir(f"{house.root}/customer_current/run={run}") for run in (first, second, third)}
    buckets = {run: [f for f in names if f.startswith("bucket=")] for run, names in folders.items()}
    assert len(buckets[first]) == 16 and 1 <= len(buckets[second]) <= 2 and buckets[third] == []
    written = {run: size_of(f"{house.root}/customer_current/run={run}") for run in folders}
    assert written[second] < written[first] / 7
    assert house.customer_dim().count() == 4002 and house.customer_dim("20250901").count() == 4000
    assert house.current_customers(house.commits()).filter("email = 'new'").count() == 2
    assert vacuum(house) == []


def test_indicators_from_states_equal_the_full_scan(files, rows):
    house, run = files
    for n in (1, 2, 3, 2, 3):
        run(n)
    vacuum(house)
    dims, fact, states = house.dimensions(), house.fact(), house.indicators()
    customers = house.customer_dim().select("customer_key", F.col("customer_id").substr(2, 1).alias("segment"))
    for of_states, of_fact in (
        (kpi_state.revenue_by_car(states, dims["car_dim"]), kpis.revenue_by_car(fact, dims["car_dim"])),
        (kpi_state.revenue_by_location(states, dims["location_dim"]), kpis.revenue_by_location(fact, dims["location_dim"])),
        (kpi_state.long_rental_ratio(states, dims["car_dim"]), kpis.long_rental_ratio(fact, dims["car_dim"])),
        (kpi_state.average_duration(states, dims["location_dim"]), kpis.average_duration(fact, dims["location_dim"])),
        (kpi_state.tickets_by_segment(states), kpis.tickets_by_segment(fact, customers)),
    ):
        assert rows(of_states, *of_fact.columns) == rows(of_fact)
    # Some rental ids occur on all days.
    both = kpi_state.tickets_by_segment(states).agg(F.sum("rentals").alias("r"), F.sum("tickets").alias("t")).first()
    assert both.t < both.r == fact.count()


def test_states_of_nothing(spark, tmp_path):
    house = bootstrap(spark, str(tmp_path / "house"))
    states = house.indicators()
    assert kpi_state.tickets_by_segment(states).count() == 0
    assert [r.scope for r in kpi_state.long_rental_ratio(states, house.dimensions()["car_dim"]).collect()] in ([], ["overall"])
    assert daily._customer_checks(house, []) == sorted(daily._customer_checks(house, []), key=lambda x: 0)
    assert all(n == 0 for _, _, n in daily._customer_checks(house, []))


@pytest.mark.parametrize("array", [False, True])
def test_rejects_come_back_byte_for_byte(spark, tmp_path, array):
    good = RENTALS["20250903"][0]
    texts = [
        json.dumps(good),
        json.dumps({**good, "rental_id": "half", "quantity": 2.5, "channel": {"n": [1, {"}": "{"}]}}, separators=(" ,", ":")),
        '{"rental_id":"type", "amount": "12.50",  "x": 1e3, "y": 1.0}',
        json.dumps({**good, "rental_id": "é\\u00e9", "customer_id": None, "note": "a \"quoted\" \\ } text"}, ensure_ascii=False),
        json.dumps({**good, "rental_id": "year", "car": {"make": "A", "model": "B", "year": "2020"}}),
    ]
    if not array:
        texts.append('{"rental_id": "broken", ')
    (tmp_path / "rentals_20250903.json").write_text("[" + ",\n ".join(texts) + "]\n" if array else "\n\n".join(texts) + "\n")
    (tmp_path / "customers_20250903.csv").write_text("".join(",".join(r) + "\n" for r in CUSTOMERS["20250903"]))
    house = bootstrap(spark, str(tmp_path / "house"), buckets=2)
    run_day(house, "20250903", str(tmp_path / "rentals_{ds}.json"), str(tmp_path / "customers_{ds}.csv"), multi_line=array)
    assert house.fact().count() == 1
    assert sorted(r.raw for r in house.rejects().collect()) == sorted(texts[1:])
    missing = {json.loads(r.raw)["rental_id"]: r.missing_fields for r in house.rejects().collect() if "broken" not in r.raw}
    assert missing["half"] == "quantity" and missing["year"] == "car.year" and "amount" in missing["type"].split(",")
