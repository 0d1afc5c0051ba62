import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samples import CUSTOMERS
from starlane.operators import checks, scd2
from starlane.schemas import CUSTOMER_BATCH, CUSTOMER_DIM

D1, D2, D3 = "2025-09-03 00:00:00", "2025-09-04 00:00:00", "2025-09-05 00:00:00"
relaxed = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

value = st.sampled_from([None, "x", "y"])
batch_of = st.dictionaries(st.sampled_from("abcde"), st.tuples(value, value, value), max_size=5)


def batch(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER_BATCH)


def stored(spark, dim):
    """A small dimension held as rows, so that chained applies keep short plans."""
    return spark.createDataFrame([tuple(r) for r in dim.collect()], CUSTOMER_DIM)


def sample(spark, ds):
    return batch(spark, CUSTOMERS[ds])


def test_two_days_documented(spark):
    first = scd2.initial(sample(spark, "20250903"), D1)
    dim = scd2.apply(first, sample(spark, "20250904"), D2)
    assert (dim.count(), dim.filter("is_current").count()) == (8, 6)
    closed = dim.filter("NOT is_current").orderBy("customer_id").collect()
    assert [r.customer_id for r in closed] == ["CUST001", "CUST003"]
    assert {str(r.end_date) for r in closed} == {D2}
    assert sorted(r.customer_key for r in dim.collect()) == list(range(1, 9))
    classes = {r.status: r.customers for r in scd2.change_summary(first, sample(spark, "20250904")).collect()}
    assert classes == {"new": 1, "changed": 2, "unchanged": 2, "absent": 1}


def test_two_days_literal(spark):
    first = scd2.insert_all(spark.createDataFrame([], CUSTOMER_DIM), sample(spark, "20250903"), D1)
    dim = scd2.apply_literal(first, sample(spark, "20250904"), D2)
    assert (dim.count(), dim.filter("is_current").count()) == (10, 8)
    rules = {r.rule: r.violations for r in checks.scd2_invariants(dim).collect()}
    assert rules == {"many_current": 2, "overlap": 2, "flag_mismatch": 0, "repeated_start": 0}


def test_literal_insert_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(scd2, "RUN", 4)
    repeated = [("a", "n", None, None)] * 11 + [("a", "n", "e", None)] * 4 + [("b", None, None, "p")]
    first = scd2.insert_all(spark.createDataFrame([], CUSTOMER_DIM), batch(spark, repeated), D1)
    got = [tuple(r)[1:5] for r in first.collect()]
    assert sorted(got, key=repr) == sorted(repeated, key=repr)
    assert sorted(r.customer_key for r in first.collect()) == list(range(1, 17))


def test_null_transitions(spark):
    old = scd2.initial(batch(spark, [("a", "n", None, "1"), ("b", "n", "e", "1"), ("c", "n", None, None)]), D1)
    new = batch(spark, [("a", "n", "e", "1"), ("b", "n", None, "1"), ("c", "n", None, None)])
    assert [r.customer_id for r in scd2.changed_customers(old, new).orderBy("customer_id").collect()] == ["a", "b"]
    assert scd2.changed_customers(old, new, null_safe=False).count() == 0
    assert scd2.close(old, new, D2).filter("NOT is_current").count() == 2
    assert scd2.close(old, new, D2, null_safe=False).filter("NOT is_current").count() == 0


def test_duplicate_batch_rows_give_one_version(spark):
    rows = [("a", "n", "1", None), ("a", "n", "2", None), ("a", "n", "2", None)]
    picked = scd2.latest_per_key(batch(spark, rows))
    assert [tuple(r) for r in picked.collect()] == [("a", "n", "2", None)]
    ordered = batch(spark, rows).withColumn("seq", F.when(F.col("email") == "1", 9).otherwise(1))
    assert scd2.latest_per_key(ordered, ["seq"]).first().email == "1"


def test_rows_without_an_id_open_nothing(spark):
    first = scd2.initial(batch(spark, [("a", "n", None, None), (None, "n", None, None)]), D1)
    assert [r.customer_id for r in first.collect()] == ["a"]
    assert scd2.apply(first, batch(spark, [(None, "m", None, None)]), D2).count() == 1


def test_close_then_insert_changed_equals_apply(spark, rows):
    first = scd2.initial(sample(spark, "20250903"), D1)
    new = sample(spark, "20250904")
    steps = scd2.insert_changed(scd2.close(first, new, D2), new, D2)
    assert rows(steps) == rows(scd2.apply(first, new, D2))


@relaxed
@given(days=st.lists(batch_of, min_size=3, max_size=3))
def test_apply_is_idempotent_sound_and_equal_to_history(spark, rows, days):
    stamps = (D1, D2, D3)
    dim = spark.createDataFrame([], CUSTOMER_DIM)
    for at, day in zip(stamps, days):
        frame = batch(spark, [(k, *v) for k, v in day.items()])
        dim = stored(spark, scd2.apply(dim, frame, at))
        again = scd2.apply(dim, frame, "2099-01-01 00:00:00")
        assert rows(again) == rows(dim)
    assert all(r.violations == 0 for r in checks.scd2_invariants(dim).collect())

    snapshots = [(k, *v, at[:10]) for at, day in zip(stamps, days) for k, v in day.items()]
    frame = spark.createDataFrame(
        snapshots, "customer_id string, name string, email string, phone string, batch_date string"
    ).withColumn("batch_date", F.col("batch_date").cast("date"))
    names = [c for c in scd2.COLUMNS if c != "customer_key"]
    assert rows(scd2.history(frame), *names) == rows(dim, *names)
    assert brute_versions(stamps, days) == [
        tuple(r) for r in sorted((tuple(map(str, r)) for r in rows(dim, *names)))
    ]


def brute_versions(stamps, days):
    versions = []
    for customer in sorted(set(itertools.chain(*days))):
        seen = [(at, day[customer]) for at, day in zip(stamps, days) if customer in day]
        starts = [s for i, s in enumerate(seen) if i == 0 or s[1] != seen[i - 1][1]]
        for i, (at, values) in enumerate(starts):
            end = starts[i + 1][0] if i + 1 < len(starts) else None
            versions.append(tuple(map(str, (customer, *values, at, end, end is None))))
    return sorted(versions)


def test_history_with_repeats_inside_a_day(spark):
    frame = spark.createDataFrame(
        [("a", "n", "1", None, "2025-01-01", 1), ("a", "n", "2", None, "2025-01-01", 2),
         ("a", "n", "2", None, "2025-01-02", 1), ("a", "n", "1", None, "2025-01-04", 1)],
        "customer_id string, name string, email string, phone string, batch_date string, seq int",
    ).withColumn("batch_date", F.col("batch_date").cast("date"))
    got = scd2.history(frame, ["seq"]).orderBy("effective_date").collect()
    assert [(r.email, str(r.effective_date)[:10], str(r.end_date)[:10]) for r in got] == [
        ("2", "2025-01-01", "2025-01-04"), ("1", "2025-01-04", "None")
    ]


def test_broken_dimension_is_reported(spark):
    dim = spark.createDataFrame([
        (1, "a", None, None, None, "2025-01-01", "2025-01-10", False),
        (2, "a", None, None, None, "2025-01-02", "2025-01-03", False),
        (3, "a", None, None, None, "2025-01-05", "2025-01-06", False),
        (4, "b", None, None, None, "2025-01-01", None, False),
        (5, "c", None, None, None, "2025-01-01", None, True),
        (6, "c", None, None, None, "2025-01-01", None, True),
        (7, "d", None, None, None, "2025-01-01", "2025-01-02", False),
        (8, "d", None, None, None, "2025-01-02", None, True),
    ], "customer_key long, customer_id string, name string, email string, phone string, "
       "effective_date string, end_date string, is_current boolean").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("effective_date", "end_date")
    })
    rules = {r.rule: r.violations for r in checks.scd2_invariants(dim).collect()}
    assert rules == {"many_current": 1, "overlap": 2, "flag_mismatch": 1, "repeated_start": 1}
