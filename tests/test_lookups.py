import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from starlane.operators import dims, lookups

DAY = datetime.date(2025, 9, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


def customer_dim(spark, versions):
    """versions: (key, id, first day, end day or None)."""
    rows = [(k, c, str(day(a)), None if b is None else str(day(b)), b is None) for k, c, a, b in versions]
    frame = spark.createDataFrame(
        rows, "customer_key long, customer_id string, effective_date string, end_date string, is_current boolean"
    )
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("effective_date", "end_date")})


def rentals(spark, pairs):
    return spark.createDataFrame(
        [(str(i), c, None if n is None else day(n)) for i, (c, n) in enumerate(pairs)],
        "rental_id string, customer_id string, start_date date",
    )


@pytest.mark.parametrize("first_open", [False, True])
def test_as_of_against_brute_force(spark, first_open):
    rng = random.Random(7)
    versions = []
    for customer in "abcdef":
        cuts = sorted(rng.sample(range(0, 30), rng.randint(1, 6)))
        for start, end in zip(cuts, [*cuts[1:], None]):
            versions.append((len(versions) + 1, customer, start, end))
    # A customer whose history has a gap and an end.
    versions += [(90, "g", 3, 5), (91, "g", 8, 10)]
    # One customer holds a third of the rentals; some are unknown or undated.
    pairs = [("a", rng.randint(-5, 35)) for _ in range(300)]
    pairs += [(rng.choice("bcdefgx"), rng.randint(-5, 35)) for _ in range(500)]
    pairs += [("a", None), (None, 4), ("g", 3), ("g", 5), ("g", 8), ("g", 10)]

    def expected(customer, n):
        if customer is None or n is None:
            return None
        own = [v for v in versions if v[1] == customer]
        for key, _, start, end in own:
            if start <= n and (end is None or n < end):
                return key
        if first_open and own and n < min(v[2] for v in own):
            return min(own, key=lambda v: v[2])[0]
        return None

    got = lookups.customer_as_of(
        rentals(spark, pairs), customer_dim(spark, versions), first_version_open=first_open
    ).collect()
    assert len(got) == len(pairs)
    assert {int(r.rental_id): r.customer_key for r in got} == {
        i: expected(*pair) for i, pair in enumerate(pairs)
    }


def test_current_and_all_versions(spark):
    dim = customer_dim(spark, [(1, "a", 0, 5), (2, "a", 5, None), (3, "b", 0, None)])
    rows = rentals(spark, [("a", 1), ("b", 1), ("x", 1)])
    current = {r.rental_id: r.customer_key for r in lookups.customer_current(rows, dim).collect()}
    assert current == {"0": 2, "1": 3, "2": None}
    fanned = sorted((r.rental_id, r.customer_key or 0) for r in lookups.customer_all_versions(rows, dim).collect())
    assert fanned == [("0", 1), ("0", 2), ("1", 3), ("2", 0)]


def test_unknown_car_drops_and_duplicate_car_fans_out(spark):
    cars = spark.createDataFrame(
        [(1, "Audi", "A4", 2020), (2, "Audi", "A4", 2020)], "car_key long, make string, model string, year int"
    )
    rows = spark.createDataFrame(
        [("r1", "Audi", "A4", 2020), ("r2", "Audi", "A4", 2021)],
        "rental_id string, make string, model string, year int",
    )
    got = sorted((r.rental_id, r.car_key) for r in lookups.car_key(rows, cars).collect())
    assert got == [("r1", 1), ("r1", 2)]


def test_roles_keep_rows_and_give_null_keys(spark):
    rows = spark.createDataFrame(
        [("r", "Denver - DEN Airport", "Chicago - O'Hare Airport", datetime.date(2025, 9, 30),
          datetime.date(2025, 10, 1))],
        "rental_id string, pickup_location string, dropoff_location string, start_date date, end_date date",
    )
    keyed = lookups.date_keys(
        lookups.location_keys(rows, dims.seed_locations(spark)), dims.seed_dates(spark)
    ).first()
    assert (keyed.pickup_location_key, keyed.dropoff_location_key) == (10, None)
    assert (keyed.start_date_key, keyed.end_date_key) == (20250930, None)


@pytest.mark.parametrize("first_open", [False, True])
def test_hot_customers_spread_over_all_tasks(spark, tmp_path, first_open):
    """Half of the rentals on one customer, a sixth on another, a twelfth on none; versions are no stored table."""
    parts = 16
    hot = (
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 6 == 1, F.lit("warm"))
        .when(F.col("id") % 12 != 3, F.col("id").cast("string"))
    )
    path = str(tmp_path / "rentals")
    spark.range(0, 60_000, 1, 8).select(
        F.col("id").cast("string").alias("rental_id"), hot.alias("customer_id"),
        F.date_add(F.lit(DAY), (F.col("id") % 40).cast("int")).alias("start_date"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    dim = (
        rows.select("customer_id").distinct().filter("customer_id IS NOT NULL").crossJoin(spark.range(3))
        .select(
            F.xxhash64("customer_id", "id").alias("customer_key"), "customer_id",
            F.date_add(F.lit(DAY), (10 * (F.col("id") + 1)).cast("int")).cast("timestamp_ntz").alias("effective_date"),
            F.when(F.col("id") < 2, F.date_add(F.lit(DAY), (10 * (F.col("id") + 2)).cast("int"))).cast("timestamp_ntz").alias("end_date"),
        )
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        heavy = {r.customer_id: r.pieces for r in lookups.spread_customers(rows).collect()}
        assert set(heavy) == {"hot", "warm"} and heavy["hot"] == parts // 2
        joined = lookups.customer_as_of(rows, dim, first_version_open=first_open)
        got = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    sizes = [0] * parts
    for r in got:
        sizes[r.task] += 1
    # Pieces are dealt by hash, so a task may get two; without them one task holds over half.
    assert len(got) == 60_000 and max(sizes) <= 60_000 / parts * 3.5 and min(sizes) > 0
    versions = {(r.customer_id, n): r.customer_key for r in dim.collect() for n in range(40) if r.effective_date.date() <= day(n) and (r.end_date is None or day(n) < r.end_date.date())}
    if first_open:
        versions |= {(c, n): versions[c, 10] for c, _ in list(versions) for n in range(10)}
    customers = {r.rental_id: r.customer_id for r in rows.collect()}
    assert {r.rental_id: r.customer_key for r in got} == {
        i: versions.get((c, int(i) % 40)) for i, c in customers.items()
    }


def test_any_spread_gives_the_same_keys(spark, rows):
    versions = [(1, "a", 0, 5), (2, "a", 5, None), (3, "b", 2, None)]
    pairs = [("a", n) for n in range(10)] * 3 + [("b", 1), ("b", 3), ("x", 3), (None, 1)]
    want = None
    for pieces in ([], [("a", 7)], [("a", 2), ("b", 3), ("x", 4), ("nobody", 2)]):
        spread = spark.createDataFrame(pieces, "customer_id string, pieces int")
        got = rows(lookups.customer_as_of(rentals(spark, pairs), customer_dim(spark, versions), spread=spread))
        assert len(got) == len(pairs) and got == (want or got)
        want = got
    empty = rentals(spark, [])
    assert lookups.spread_customers(empty).count() == 0
    assert lookups.customer_as_of(empty, customer_dim(spark, versions)).count() == 0


def test_hot_customer_is_split_across_tasks(spark, tmp_path):
    """With a third of the rentals on one customer, the shuffled lookup splits that customer."""
    path = str(tmp_path / "rentals")
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    spark.range(0, 120_000, 1, 8).select(
        F.col("id").cast("string").alias("rental_id"), hot.alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("filler"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    stored = str(tmp_path / "customer_dim")
    rows.select("customer_id").distinct().select(
        F.xxhash64("customer_id").alias("customer_key"), "customer_id", F.lit(True).alias("is_current")
    ).write.parquet(stored)
    dim = spark.read.parquet(stored)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        joined = lookups.customer_current(rows, dim)
        assert joined.filter("customer_key IS NULL").count() == 0
        got = joined.select("rental_id", "customer_key", "filler")
        assert len(got.collect()) == 120_000
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin\(skew=true\)", plan)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
