"""One day of the warehouse: customers first, then the fact, the checks, the commit.

A day costs its files and the buckets of customers that it changes. Ended versions of older
runs are not opened: what the checks need of them is kept as a state per customer. A late day,
one before days already in sight, is merged between them and does read ended versions.
``starlane.plans.house`` has the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.dates import batch_day
from starlane.operators import checks, dims, kpi_state, late, scd2, version_state
from starlane.operators.rentals import RAW, flatten, rejected, valid
from starlane.plans.fact import build_fact
from starlane.plans.house import (
    BUCKET, BUCKETS, CHECK, COMMIT, DROPPED, FIRST, KEYS, REJECT, RUN_TABLES, SEEN,
    Commit, ConflictError, Warehouse, bucket_of, vacuum,
)
from starlane.schemas import CAR_DIM, CUSTOMER_DIM, DATE_DIM, DATED_FACT, LOCATION_DIM, RENTAL
from starlane.session import fresh_path, list_folders, make_folder, remove_path, scratch, use_adaptive
from starlane.sinks.tables import conform, replace_table
from starlane.sources.customers import read_customers
from starlane.sources.rentals import parse_rentals, read_objects
from starlane.sources.slices import dated_path

__all__ = [
    "COMMIT", "Commit", "ConflictError", "Warehouse", "bootstrap", "load_day", "new_run", "run_checks",
    "run_customers", "run_day", "run_fact", "run_indicators", "vacuum",
]

Segments = Callable[[DataFrame], DataFrame]
PARSED = [*RENTAL.fieldNames(), RAW]


def bootstrap(
    spark: SparkSession,
    root: str,
    locations: DataFrame | None = None,
    cars: DataFrame | None = None,
    dates: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> Warehouse:
    """Create all tables anew, the fixed dimensions from the seeds unless given.

    ``buckets`` parts the customers for good; a day rewrites the ones it touches, so their number
    should exceed the customers that change in a day, or else give parts of a good file's size.
    """
    house = Warehouse(use_adaptive(spark), root)
    for name in ("commits", *RUN_TABLES):
        remove_path(spark, house.path(name))
    make_folder(spark, house.path("commits"))
    _write_buckets(house, [(b, "", "", *[0] * len(version_state.VIOLATIONS)) for b in range(buckets)], FIRST)
    for name, schema, given, seed in (
        ("location_dim", LOCATION_DIM, locations, dims.seed_locations),
        ("car_dim", CAR_DIM, cars, dims.seed_cars),
        ("date_dim", DATE_DIM, dates, dims.seed_dates),
    ):
        replace_table(seed(spark) if given is None else given, house.path(name), schema)
    return house


def new_run(ds: str) -> str:
    batch_day(ds)  # an error unless it is a day
    return f"{ds}-{uuid.uuid4().hex}"


def _midnight(ds: str) -> str:
    return f"{batch_day(ds)} 00:00:00"


# Customers.


def _write_buckets(house: Warehouse, lines: Sequence, run: str) -> None:
    house.spark.createDataFrame(list(lines), BUCKET).coalesce(1).write.parquet(house.path(f"customer_buckets/{run}"))


def _touched(rows: DataFrame, buckets: int) -> set[int]:
    """The buckets of these customers: not more numbers than there are buckets."""
    return {r.b for r in rows.select(bucket_of("customer_id", buckets).alias("b")).distinct().collect()}


def _write_by_bucket(house: Warehouse, rows: DataFrame, name: str, run: str, buckets: int) -> set[int]:
    """Writes the rows and tells which buckets have any."""
    dealt = rows.withColumn("bucket", bucket_of("customer_id", buckets)).hint("rebalance", "bucket")
    path = house.path(f"{name}/run={run}")
    dealt.write.partitionBy("bucket").parquet(path)
    return {int(folder.split("=")[1]) for folder in list_folders(house.spark, path)}


def _store_customers(
    house: Warehouse, run: str, before: Sequence[Commit], touched: set[int], current: DataFrame,
    ended: DataFrame, opened: DataFrame, again: DataFrame | None = None,
) -> None:
    """Write a run's customer tables and its list of buckets.

    ``current`` fills the touched buckets, ``ended`` are the versions that the run stores as
    ended, ``opened`` those with keys of its own. What the checks count follows from the stored
    rows of the touched buckets and the state of their customers' ended versions, to which the newly
    ended ones are added; customers in ``again`` are counted anew.
    """
    old = house.buckets(before)
    n, lines = len(old), [line for line in old if line.bucket in touched]
    replace_table(ended, house.path(f"customer_closed/{run}"), CUSTOMER_DIM)
    with_current = _write_by_bucket(house, conform(current, CUSTOMER_DIM), "customer_current", run, n)
    keys = opened.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n")).agg(
        F.min("customer_key").alias("lowest"), F.max("customer_key").alias("highest"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
    replace_table(keys, house.path(f"customer_keys/{run}"), KEYS)

    def all_ended() -> DataFrame:
        return house.ended_customers([*before, Commit(0, "", run, again is not None)])

    closed = house.read_runs("customer_closed", CUSTOMER_DIM, [run])
    stored = house.read_buckets("customer_current", CUSTOMER_DIM, [(run, b) for b in with_current])
    past = version_state.settled(version_state.merged(house.read_past(lines), version_state.states(closed)), all_ended, again)
    with_past = _write_by_bucket(house, past, "customer_past", run, n)
    total = version_state.settled(
        version_state.merged(past, version_state.states(stored)), lambda: all_ended().unionByName(stored)
    )
    found = version_state.violations(total.withColumn("bucket", bucket_of("customer_id", n)), "bucket").collect()
    counts = {r.bucket: [r[v] for v in version_state.VIOLATIONS] for r in found}
    none = [0] * len(version_state.VIOLATIONS)
    _write_buckets(house, [
        tuple(line) if line.bucket not in touched else (
            line.bucket, run if line.bucket in with_current else "", run if line.bucket in with_past else "",
            *counts.get(line.bucket, none),
        ) for line in old
    ], run)


def _store_seen(house: Warehouse, batch: DataFrame, run: str) -> None:
    ids = batch.select("customer_id").filter("customer_id IS NOT NULL").distinct()
    replace_table(ids, house.path(f"customer_seen/{run}"), SEEN)


def _clean(step: Callable) -> Callable:
    """The step leaves no intermediate table: all it gives is in the house."""
    @wraps(step)
    def run(house: Warehouse, *args, **options):
        with scratch(house.spark):
            return step(house, *args, **options)

    return run


@_clean
def run_customers(house: Warehouse, ds: str, batch: DataFrame, run: str) -> None:
    """Close and insert one customer file on top of the days before.

    All current customers are read, to compare; those of the buckets with changes are written.
    """
    before = house.before(ds)
    lines, at = house.buckets(before), _midnight(ds)
    staged = fresh_path(house.spark, "changes")
    scd2.changes(house.read_current(lines), batch).write.parquet(staged)
    found = house.spark.read.parquet(staged)
    touched = _touched(found, len(lines))
    current = house.read_current([line for line in lines if line.bucket in touched])
    used = house.spark.createDataFrame([(house.highest_key(before),)], "customer_key long")
    opened = scd2.opened_by(found, used, at)
    _store_customers(
        house, run, before, touched, scd2.kept_by(found, current).unionByName(opened), scd2.closed_by(found, at), opened
    )
    _store_seen(house, batch, run)


@_clean
def run_late_customers(house: Warehouse, ds: str, batch: DataFrame, run: str) -> None:
    """Merge one customer file between the days around it, as if all had come in order."""
    spark, before, at = house.spark, house.commits(), _midnight(ds)
    _store_seen(house, batch, run)
    lines, end = house.buckets(before), F.col("end_date")
    current = house.read_current(lines)
    versions = current.unionByName(house.ended_customers(before).filter(end > F.lit(at).cast("timestamp_ntz")))
    seen = [
        house.read_runs("customer_seen", SEEN, [c.run]).withColumn("seen_at", F.lit(_midnight(c.ds)).cast("timestamp_ntz"))
        for c in before if c.ds > ds
    ]
    staged, new = fresh_path(spark, "cases"), fresh_path(spark, "versions")
    late.cases(versions, scd2.latest(batch), at, reduce(DataFrame.unionByName, seen)).write.parquet(staged)
    found = spark.read.parquet(staged)
    highest = house.highest_key(before)
    late.added(found, at, highest).write.parquet(new)
    added = spark.read.schema(CUSTOMER_DIM).parquet(new)
    replace_table(late.dropped(found), house.path(f"customer_dropped/{run}"), DROPPED)
    gone = house.read_runs("customer_dropped", DROPPED, [run])
    replace_table(late.moves(found, added, at), house.path(f"fact_moves/{run}"), late.MOVES)
    touched = _touched(found, len(lines))
    kept = house.read_current([line for line in lines if line.bucket in touched]).join(gone, "customer_key", "left_anti")
    _store_customers(
        house, run, before, touched,
        kept.select(CUSTOMER_DIM.fieldNames()).unionByName(added.filter("is_current")),
        added.filter("NOT is_current"), added.filter(F.col("customer_key") > highest), again=found.select("customer_id"),
    )


def _customers_of(house: Warehouse, ds: str, run: str, is_late: bool) -> DataFrame:
    """The versions valid after the run's day, as they will be once it is committed."""
    before = house.commits() if is_late else house.before(ds)
    commits = [*before, Commit(0, ds, run, is_late)]
    if not is_late:
        return house.current_customers(commits)
    at = F.lit(_midnight(ds)).cast("timestamp_ntz")
    ended = house.ended_customers(commits).filter(F.col("end_date") > at)
    return late.valid_at(house.current_customers(commits).unionByName(ended), _midnight(ds))


# Rentals.


def load_day(rentals: DataFrame, ds: str) -> DataFrame:
    """A day's rentals parsed once and stored for the steps that read them.

    ``rentals`` are raw objects (``sources.rentals.read_objects``). The text of an object stays
    only beside one that cannot enter the fact.
    """
    spark, path = rentals.sparkSession, fresh_path(rentals.sparkSession, f"day-{ds}")
    parse_rentals(rentals).write.parquet(path)
    return spark.read.schema(parse_rentals(rentals).schema).parquet(path)


@_clean
def run_fact(
    house: Warehouse, ds: str, rentals: DataFrame, run: str, customer: str = "current", is_late: bool = False
) -> None:
    """Build one day of the fact, and store the rentals that cannot enter it.

    The raw record is the text it was read from where ``rentals`` carry it, else it is written anew.
    """
    day = F.lit(batch_day(ds)).cast("date")
    dated = rentals.withColumn("batch_date", day)
    anew = F.to_json(F.struct(*RENTAL.fieldNames()))
    raw = F.coalesce(F.col(RAW), anew) if RAW in rentals.columns else anew
    out = rejected(dated).select("rental_id", "missing_fields", raw.alias("raw"), "batch_date")
    replace_table(out, house.path(f"rejects/{run}"), REJECT)
    customers = _customers_of(house, ds, run, is_late)
    if customer != "current":
        before = house.commits() if is_late else house.before(ds)
        customers = house.customers([*before, Commit(0, ds, run, is_late)])
    built = build_fact(dated.drop(RAW), {**house.fixed_dimensions(), "customer_dim": customers}, customer)
    replace_table(built, house.path(f"rentals_fact/{run}"), DATED_FACT)


def run_indicators(house: Warehouse, ds: str, run: str, segments: Segments | None = None, is_late: bool = False) -> None:
    """What the indicators add up from the run's day. ``segments`` maps customer rows to customer_key and segment."""
    fact = house.read_runs("rentals_fact", DATED_FACT, [run])
    customers = _customers_of(house, ds, run, is_late)
    named = segments(customers) if segments else customers.select("customer_key", F.lit(None).cast("string").alias("segment"))
    found = kpi_state.states(fact, named)
    replace_table(found.sums, house.path(f"indicators/{run}"), kpi_state.STATE)
    replace_table(found.tickets, house.path(f"tickets/{run}"), kpi_state.TICKETS)


# Checks.


def _customer_checks(house: Warehouse, commits: Sequence[Commit]) -> list[tuple[str, str, int]]:
    """What the checks count in all customer versions, from the list of buckets and the ranges of keys.

    Versions are read only to count keys that are not unique.
    """
    lines = house.buckets(commits)
    total = {v: sum(line[v] for line in lines) for v in version_state.VIOLATIONS}
    ranges = sorted(r for r in house.read_runs("customer_keys", KEYS, [c.run for c in commits]).collect() if r.highest is not None)
    common = any(a.highest >= b.lowest for a, b in zip(ranges, ranges[1:], strict=False))
    repeated = 0
    if common or total["repeated_keys"] or any(r.repeated for r in ranges):
        # Runs have common keys, or a run or a customer has one twice: count them.
        repeated = checks.duplicate_keys([("customer_dim", house.customers(commits), ("customer_key",))]).count()
    out = [("versions", rule, total[rule]) for rule in ("many_current", "overlap", "flag_mismatch", "repeated_start")]
    out += [("null", "customer_dim.customer_key", total["null_keys"]), ("null", "customer_dim.customer_id", total["null_ids"])]
    for item, n in (("customer_key", repeated), ("customer_id,effective_date", total["duplicate_starts"])):
        out += [("duplicate", f"customer_dim.{item}", n)] * (n > 0)
    return out


def run_checks(
    house: Warehouse, ds: str, rentals: DataFrame, batch: DataFrame, run: str, customer: str = "current", is_late: bool = False
) -> None:
    """Counts of what the checks find after a run, stored beside its tables."""
    before = house.commits() if is_late else house.before(ds)
    commits = [*before, Commit(0, ds, run, is_late)]
    fact = house.read_runs("rentals_fact", DATED_FACT, [run])
    valid_now = {**house.fixed_dimensions(), "customer_dim": _customers_of(house, ds, run, is_late)}
    known = valid_now if customer == "current" else {**valid_now, "customer_dim": house.customers(commits)}

    def lines(check: str, found: DataFrame, item: str, violations: str) -> DataFrame:
        return found.select(
            F.lit(check).alias("check"), F.col(item).cast("string").alias("item"), F.col(violations).cast("long").alias("violations")
        )

    def counted(check: str, item: str, found: DataFrame) -> DataFrame:
        total = found.agg(F.count(F.lit(1)).alias("n")).withColumn("item", F.lit(item))
        return lines(check, total, "item", "n")

    unresolved = checks.unresolved_lookups(flatten(valid(rentals.drop(RAW))), valid_now)
    keys = checks.duplicate_keys([
        key for key in checks.declared_keys({**valid_now, "rentals_fact": fact}) if key[0] != "customer_dim"
    ])
    nulls = checks.nulls({"rentals_fact": (fact, ("rental_id",))})
    found = [
        counted("rows", "read", rentals),
        counted("rows", "rejected", house.read_runs("rejects", REJECT, [run])),
        counted("rows", "fact", fact),
        counted("batch", "conflicting customers", checks.batch_conflicts(batch)),
        lines("unresolved", unresolved.groupBy("role").agg(F.sum("rentals").alias("n")), "role", "n"),
        lines("duplicate", keys.groupBy(F.concat_ws(".", "table_name", "key_columns").alias("key")).agg(F.count(F.lit(1)).alias("n")), "key", "n"),
        lines("null", nulls.withColumn("key", F.concat_ws(".", "table_name", "column_name")), "key", "null_count"),
        lines("orphan", checks.fk_orphans(fact, known), "foreign_key", "orphan_rows"),
        house.spark.createDataFrame(_customer_checks(house, commits), CHECK),
    ]
    replace_table(reduce(DataFrame.unionByName, found), house.path(f"checks/{run}"), CHECK)


@_clean
def run_day(
    house: Warehouse,
    ds: str,
    rentals: str,
    customers: str,
    multi_line: bool = False,
    customer: str = "current",
    customer_line_breaks: bool = False,
    is_late: bool = False,
    segments: Segments | None = None,
) -> str:
    """Load the files of one day; ``{ds}`` in the two paths stands for the run date.

    ``multi_line`` reads a day's rentals from JSON arrays. A day already loaded, or before
    days in sight, takes these out of sight, unless ``is_late``: then it is a new day between them.
    Raises ``ConflictError`` if another run has committed meanwhile.
    """
    base, run = house.last_number(), new_run(ds)
    seen = {c.ds for c in house.commits()}
    if is_late and ds in seen:
        raise ValueError(f"day {ds} is loaded")
    is_late = is_late and any(ds < other for other in seen)
    batch = read_customers(house.spark, dated_path(customers, ds), line_breaks=customer_line_breaks, numbered=True)
    (run_late_customers if is_late else run_customers)(house, ds, batch, run)
    parsed = load_day(read_objects(house.spark, dated_path(rentals, ds), multi_line), ds)
    run_fact(house, ds, parsed, run, customer, is_late)
    run_indicators(house, ds, run, segments, is_late)
    run_checks(house, ds, parsed, batch, run, customer, is_late)
    house.commit(ds, run, base, is_late)
    return run
