"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.functions.dates import NOT_GIVEN, days_between, iso_date, run_date, yyyymmdd
from starlane.functions.measures import average_daily_amount, is_long, total_amount
from starlane.operators import checks, dims, drift, kpi_state, kpis, lookups, rentals as R, scd2, version_state
from starlane.operators.keys import assign_keys
from starlane.plans.daily import (
    Warehouse, bootstrap, new_run, run_customers, run_fact, run_indicators, run_late_customers, vacuum,
)
from starlane.plans.fact import build_fact
from starlane.schemas import CUSTOMER_ATTRIBUTES, DATED_FACT, FACT_COLUMNS, RENTAL
from starlane.session import fresh_path, use_adaptive
from starlane.sinks.fact import append_fact, replace_days
from starlane.sources.customers import read_customers, write_customers
from starlane.sources.drift import drift_report
from starlane.sources.evolution import EvolvingTable
from starlane.sources.rentals import parse_rentals, read_objects, read_rentals, write_rentals
from starlane.sources.slices import batch_slice
from starlane.streaming.ledger import Ledger
from starlane.streaming.load_once import load_once
from starlane.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SLICE = "19980101"
LATE_ARRIVALS = "1999-01-01"


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(use_adaptive(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# Sources


@query
def src_rental_nested(spark, sf):
    return R.flatten(read_rentals(spark, t.rental_files(spark, sf)))


def _enclosed():
    """Names with doubled quotes, commas and line breaks among them."""
    name, key = F.col("name"), F.col("customer_id").cast("long")
    return (
        F.when(key % 5 == 0, F.concat(F.lit('Ann "Al", '), name))
        .when(key % 5 == 1, F.concat(name, F.lit("\n2nd line")))
        .otherwise(name)
    )


@query
def src_rental_array(spark, sf):
    """From files that are one array each, read in parts."""
    return R.flatten(parse_rentals(read_objects(spark, t.array_files(spark, sf), multi_line=True)).drop(R.RAW))


@query
def src_customer_batch(spark, sf):
    frames = []
    for day, batch in (("day 1", t.batch_1), ("day 2", t.batch_2)):
        path = fresh_path(spark, "customers")
        write_customers(batch(spark, sf).withColumn("name", _enclosed()), path)
        frames.append(read_customers(spark, path, line_breaks=True).withColumn("batch", F.lit(day)))
    return frames[0].unionByName(frames[1])


@query
def src_batch_slice(spark, sf):
    return R.flatten(batch_slice(read_rentals(spark, t.rental_files(spark, sf)), SLICE))


@query
def src_batch_date_default(spark, sf):
    given = yyyymmdd(F.date_add(F.col("o_orderdate").cast("date"), 1))
    param = F.when(F.col("o_orderkey") % 3 == 0, F.lit(NOT_GIVEN)).otherwise(given)
    runs = t.table(spark, sf, "orders").select(run_date(param, F.col("o_orderdate")).alias("run_date"))
    return runs.groupBy("run_date").agg(F.count(F.lit(1)).alias("runs"))


@query
def src_seed_dims(spark, sf):
    """The seeded dimensions, with the orders that fall on each seed."""
    orders = t.table(spark, sf, "orders").select(
        (F.col("o_custkey") % 10 + 1).alias("location_key"),
        (F.col("o_orderkey") % 10 + 1).alias("car_key"),
        (F.lit(20250900) + F.dayofmonth("o_orderdate")).cast("long").alias("date_key"),
    )
    uses = (
        orders.unpivot([], orders.columns, "dim", "key")
        .groupBy("dim", "key").agg(F.count(F.lit(1)).alias("orders"))
    )
    car = F.concat_ws(" ", "make", "model", F.col("year").cast("string"))
    seeds = (
        dims.seed_locations(spark)
        .select(F.lit("location_key").alias("dim"), F.col("location_key").alias("key"),
                F.col("location_id").alias("id"), F.col("location_name").alias("value"))
        .unionAll(dims.seed_cars(spark).select(F.lit("car_key"), "car_key", "car_id", car))
        .unionAll(dims.seed_dates(spark).select(
            F.lit("date_key"), F.col("date_key").cast("long"),
            F.col("date_key").cast("string"), F.col("date").cast("string")))
    )
    return seeds.join(uses, ["dim", "key"], "left").fillna(0, ["orders"])


@query
def src_schema_drift(spark, sf):
    """Files that lack the quantity, carry the amount as text and add a channel."""
    drifted = (
        t.rentals(spark, sf)
        .withColumns({"amount": F.col("amount").cast("decimal(18,2)").cast("string"),
                      "channel": F.col("car.make")})
        .drop("quantity", "batch_date")
    )
    path = fresh_path(spark, "drifted")
    drifted.write.json(path, compression="gzip")
    return drift_report(spark, path, RENTAL)


@query
def src_load_once(spark, sf):
    """Load, load again with nothing new, then load what arrived since."""
    files, target, checkpoint = (fresh_path(spark, n) for n in ("arrivals", "loaded", "load_log"))
    dated = T.StructType([*RENTAL.fields, T.StructField("batch_date", T.DateType())])
    late = F.col("batch_date") >= F.lit(LATE_ARRIVALS).cast("date")

    def load():
        load_once(spark, files, target, checkpoint, dated, partition_by="batch_date")

    write_rentals(t.rentals(spark, sf).filter(~late), files)
    load()
    load()
    write_rentals(t.rentals(spark, sf).filter(late), files, mode="append")
    t.backdate(spark, files, f"batch_date={LATE_ARRIVALS}", days=30)
    load()
    return R.flatten(spark.read.schema(dated).parquet(target))


@query
def src_load_ledger(spark, sf):
    """Load, load again, then load late files while one folder's files are replaced under their names."""
    files, root = fresh_path(spark, "arrivals"), fresh_path(spark, "ledger")
    ledger = Ledger(spark, root, RENTAL)
    late = F.col("batch_date") >= F.lit(LATE_ARRIVALS).cast("date")
    write_rentals(t.rentals(spark, sf).filter(~late), files)
    reports = [ledger.load(files), ledger.load(files)]
    write_rentals(t.rentals(spark, sf).filter(late), files, mode="append")
    t.backdate(spark, files, f"batch_date={LATE_ARRIVALS}", days=30)
    t.replace_files(spark, files, "batch_date=1995-01-01", "batch_date=1996-01-01")
    reports.append(ledger.load(files))
    report = reports[0].unionByName(reports[1]).unionByName(reports[2])
    told = report.groupBy("folder").agg(
        F.sum(F.when(F.col("status") == "new", F.col("rows"))).alias("reported_rows"),
        F.max(F.col("status") == "changed").alias("changed"),
    )
    loaded = ledger.rows().groupBy("folder").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"),
    )
    return told.join(loaded, "folder").select(
        F.split_part("folder", F.lit("="), F.lit(-1)).alias("batch_date"), "reported_rows", "rows", "amount", "changed"
    )


@query
def src_schema_evolution(spark, sf):
    """Files of three times: whole amounts, then amounts in cents, then a new field in the car and a channel."""
    table = EvolvingTable(spark, fresh_path(spark, "evolving"))
    rentals = t.rentals(spark, sf).withColumn("year", F.year("batch_date")).drop("batch_date")
    whole = rentals.filter("year <= 1996").withColumn("amount", F.floor("amount").cast("int")).drop("rental_period")
    table.append(whole.withColumn("quantity", F.col("quantity").cast("smallint")))
    table.append(rentals.filter("year BETWEEN 1997 AND 1999").withColumn("amount", F.col("amount").cast("decimal(14,2)")))
    last = rentals.filter("year >= 2000").withColumns({
        "car": F.struct("car.*", F.upper("car.make").alias("label")), "channel": F.lit("web"), "amount": F.col("amount").cast("bigint"),
    })
    path = fresh_path(spark, "last-rentals")
    last.write.json(path)
    table.append_json(path)
    return table.read().select(
        "rental_id", "customer_id", "car.make", F.col("car.year").alias("car_year"), "car.label", "rental_period.start_date",
        F.col("amount").cast("string").alias("amount"), "quantity", "channel", "year",
    )


# Projections, filters, expressions


@query
def flt_valid_rentals(spark, sf):
    return R.flatten(R.valid(t.rentals(spark, sf)))


def _raw_rental():
    """The text of a rental with an unknown field; some have a fraction for a whole number, another type, or no end."""
    order = F.split_part("rental_id", F.lit("-"), F.lit(1)).cast("long")

    def text(column):
        return F.concat(F.lit('"'), column, F.lit('"'))

    amount = F.col("amount").cast("decimal(18,2)").cast("string")
    quantity = F.col("quantity").cast("string")
    parts = {
        '{"rental_id": ': text(F.col("rental_id")),
        ', "customer_id": ': F.coalesce(text(F.col("customer_id")), F.lit("null")),
        ', "car": {"make": ': text(F.col("make")), ', "model": ': text(F.col("model")),
        ', "year": ': F.when(order % 13 == 0, "true").otherwise(F.col("year").cast("string")),
        '},  "rental_period": {"start_date": ': text(F.col("start_date")), ', "end_date": ': text(F.col("end_date")),
        '}, "rental_location": {"pickup_location": ': text(F.col("pickup_location")),
        ', "dropoff_location": ': text(F.col("dropoff_location")),
        '}, "amount": ': F.when(order % 11 == 0, text(amount)).otherwise(amount),
        ', "quantity": ': F.when(order % 7 == 0, F.concat(quantity, F.lit(".5"))).otherwise(quantity),
        ', "channel": {"n": [1.0, ': quantity,
    }
    whole = F.concat(*[x for lead, value in parts.items() for x in (F.lit(lead), value)], F.lit("]}}"))
    return F.when(order % 17 == 0, F.split_part(whole, F.lit('"car"'), F.lit(1))).otherwise(whole)


@query
def flt_rejected_raw(spark, sf):
    """Rejected rentals with the text they were read from."""
    path = fresh_path(spark, "raw-rentals")
    _flat(spark, sf).select(_raw_rental().alias("value")).write.text(path, compression="gzip")
    return R.rejected(parse_rentals(read_objects(spark, path))).select("rental_id", "missing_fields", R.RAW)


@query
def flt_rejected_rentals(spark, sf):
    return R.flatten(R.rejected(t.rentals(spark, sf)))


@query
def prj_flatten_rental(spark, sf):
    return R.flatten(t.rentals(spark, sf))


@query
def prj_derive_measures(spark, sf):
    return R.measured(t.rentals(spark, sf)).select(
        "rental_id", "start_date", "end_date", "amount", "quantity", "rental_duration_days",
        "total_rental_amount", "average_daily_rental_amount", "is_long_rental",
    )


def _flat(spark, sf):
    return R.flatten(t.rentals(spark, sf))


def _duration():
    return days_between(iso_date(F.col("start_date")), iso_date(F.col("end_date")))


@query
def expr_duration_days(spark, sf):
    return _flat(spark, sf).select(
        "rental_id", "start_date", "end_date", _duration().alias("rental_duration_days")
    )


@query
def expr_total_amount(spark, sf):
    return _flat(spark, sf).select(
        "rental_id", "amount", "quantity",
        total_amount(F.col("amount"), F.col("quantity")).alias("total_rental_amount"),
    )


@query
def expr_avg_daily_amount(spark, sf):
    total = total_amount(F.col("amount"), F.col("quantity"))
    return _flat(spark, sf).select(
        "rental_id", _duration().alias("rental_duration_days"),
        average_daily_amount(total, _duration()).alias("average_daily_rental_amount"),
    )


@query
def expr_long_rental_flag(spark, sf):
    return _flat(spark, sf).select(
        "rental_id", _duration().alias("rental_duration_days"),
        is_long(_duration()).alias("is_long_rental"),
    )


# Keys and lookups


@query
def dim_date(spark, sf):
    orders = t.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return dims.calendar_over(orders, "day", "day")


@query
def key_surrogate(spark, sf):
    """Customers numbered behind the keys the car dimension holds."""
    customers = t.table(spark, sf, "customer").select("c_custkey", "c_name")
    return assign_keys(
        customers, F.col("c_custkey").cast("string"), "car_key", after=t.car_dim(spark, sf)
    ).withColumnRenamed("car_key", "customer_key")


def _with_car(spark, sf):
    return lookups.car_key(R.measured(t.rentals(spark, sf)), t.car_dim(spark, sf))


@query
def fact_car_key(spark, sf):
    return _with_car(spark, sf).select("rental_id", "car_key", "total_rental_amount")


@query
def fact_location_keys(spark, sf):
    return lookups.location_keys(_with_car(spark, sf), t.location_dim(spark, sf)).select(
        "rental_id", "car_key", "pickup_location_key", "dropoff_location_key"
    )


@query
def fact_date_keys(spark, sf):
    return lookups.date_keys(_with_car(spark, sf), t.date_dim(spark, sf)).select(
        "rental_id", "car_key", "start_date_key", "end_date_key"
    )


_VERSIONED = ("rental_id", "car_key", "start_date", "customer_key")


@query
def fact_customer_all_versions(spark, sf):
    dim = t.customer_dim_literal(spark, sf)
    return lookups.customer_all_versions(_with_car(spark, sf), dim).select(*_VERSIONED)


@query
def fact_customer_current(spark, sf):
    dim = t.customer_dim_1(spark, sf)
    return lookups.customer_current(_with_car(spark, sf), dim).select(*_VERSIONED)


def _as_of(spark, sf, dim, rows=None, customers=None, **options):
    spread = lookups.spread_customers(t.rental_customers(spark, sf) if customers is None else customers)
    rows = _with_car(spark, sf) if rows is None else rows
    return lookups.customer_as_of(rows, dim, spread=spread, **options).select(*_VERSIONED)


@query
def fact_customer_as_of(spark, sf):
    return _as_of(spark, sf, t.customer_dim_early(spark, sf))


@query
def fact_customer_as_of_first_open(spark, sf):
    return _as_of(spark, sf, t.customer_dim_early(spark, sf), first_version_open=True)


@query
def fact_customer_as_of_hot(spark, sf):
    """A third of all rentals on one customer, versions straight from the batches, not a stored table."""
    def hot(order):
        return F.when(order % 3 == 0, F.lit("4")).otherwise(F.col("customer_id"))

    order = F.split_part("rental_id", F.lit("-"), F.lit(1)).cast("long")
    versions = scd2.history(t.snapshots(spark, sf), ("seen_at", "seen_key"))
    rows = _with_car(spark, sf).withColumn("customer_id", hot(order))
    customers = t.rental_customers(spark, sf).withColumn("customer_id", hot(F.col("order")))
    return _as_of(spark, sf, versions, rows, customers)


@query
def fact_rentals(spark, sf):
    return build_fact(t.rentals(spark, sf), t.dimensions(spark, sf)).select(FACT_COLUMNS)


# Change handling


@query
def scd2_batch_dedup(spark, sf):
    return scd2.latest_per_key(t.snapshots(spark, sf), ("seen_at", "seen_key"))


@query
def scd2_changed_null_unsafe(spark, sf):
    return scd2.changed_customers(
        t.customer_dim_1(spark, sf), t.batch_2(spark, sf), null_safe=False
    )


@query
def scd2_changed(spark, sf):
    return scd2.changed_customers(t.customer_dim_1(spark, sf), t.batch_2(spark, sf))


@query
def scd2_close(spark, sf):
    return scd2.close(t.customer_dim_1(spark, sf), t.batch_2(spark, sf), t.DAY_2)


@query
def scd2_insert_all(spark, sf):
    dim, batch = t.customer_dim_1(spark, sf), t.batch_2(spark, sf)
    return scd2.apply_literal(dim, batch, t.DAY_2)


@query
def scd2_insert_changed(spark, sf):
    return scd2.insert_changed(t.customer_dim_1(spark, sf), t.batch_2(spark, sf), t.DAY_2)


@query
def scd2_apply(spark, sf):
    return scd2.apply(t.customer_dim_1(spark, sf), t.batch_2(spark, sf), t.DAY_2)


@query
def scd2_history(spark, sf):
    return scd2.history(t.snapshots(spark, sf), ("seen_at", "seen_key"))


@query
def scd2_change_summary(spark, sf):
    return scd2.change_summary(t.customer_dim_1(spark, sf), t.batch_2(spark, sf))


# Checks


@query
def chk_table_profile(spark, sf):
    return checks.table_profile({
        **t.dimensions(spark, sf),
        "rentals_fact": t.fact(spark, sf).select(FACT_COLUMNS),
        "rentals": _flat(spark, sf).drop("batch_date"),
    })


@query
def chk_nulls(spark, sf):
    d = t.dimensions(spark, sf)
    return checks.nulls({
        "location_dim": (d["location_dim"], ("location_key", "location_id")),
        "car_dim": (d["car_dim"], ("car_key", "car_id")),
        "date_dim": (d["date_dim"], ("date_key", "date")),
        "customer_dim": (d["customer_dim"], ("customer_key", "customer_id", "email", "phone")),
        "rentals_fact": (t.fact(spark, sf), ("rental_id", "customer_key", "pickup_location_key")),
        "rentals": (_flat(spark, sf), ("rental_id", "customer_id")),
    })


@query
def chk_duplicate_keys(spark, sf):
    d = t.dimensions(spark, sf)
    return checks.duplicate_keys(checks.declared_keys({**d, "rentals_fact": t.fact(spark, sf)}))


def _incomplete_dims(spark, sf):
    """The dimensions with some members taken out, so that the checks find something."""
    d = t.dimensions(spark, sf)
    return {
        "customer_dim": t.customer_dim_1(spark, sf),
        "car_dim": d["car_dim"].filter("year <= 40"),
        "location_dim": d["location_dim"].filter("location_key > 1"),
        "date_dim": d["date_dim"].filter("year >= 1997"),
    }


@query
def chk_fk_orphans(spark, sf):
    return checks.fk_orphans(t.fact(spark, sf), _incomplete_dims(spark, sf))


@query
def chk_unresolved_lookups(spark, sf):
    return checks.unresolved_lookups(
        R.flatten(R.valid(t.rentals(spark, sf))),
        {**t.dimensions(spark, sf), "customer_dim": t.customer_dim_1(spark, sf)},
    )


@query
def chk_lookup_suggestions(spark, sf):
    """Rentals with misspelt cars and locations, and what they may mean."""
    order = F.split_part("rental_id", F.lit("-"), F.lit(1)).cast("long")
    make = (
        F.when(order % 5 == 0, F.replace("make", F.lit("#"), F.lit("")))
        .when(order % 5 == 1, F.reverse("make")).otherwise(F.col("make"))
    )
    model = F.when(order % 7 == 0, F.concat("model", F.lit("'s"))).otherwise(F.col("model"))
    place = F.when(order % 3 == 0, F.replace("pickup_location", F.lit("_"), F.lit(" -"))).otherwise(F.col("pickup_location"))
    flat = R.flatten(R.valid(t.rentals(spark, sf))).withColumns({"make": make, "model": model, "pickup_location": place})
    dims_now = t.dimensions(spark, sf)
    path = fresh_path(spark, "unresolved")
    checks.unresolved_lookups(flat, dims_now).write.parquet(path)
    return checks.lookup_suggestions(spark.read.parquet(path), dims_now)


@query
def chk_scd2_invariants(spark, sf):
    documented = checks.scd2_invariants(t.customer_dim(spark, sf))
    literal = checks.scd2_invariants(t.customer_dim_literal(spark, sf))
    return documented.withColumn("dimension", F.lit("documented")).unionByName(
        literal.withColumn("dimension", F.lit("literal"))
    )


@query
def chk_drift(spark, sf):
    """Years against the years before; the rentals of 1998 cost half as much again, those of 1999 begin in few places."""
    year = F.year("batch_date")
    rows = R.derive(_flat(spark, sf)).withColumns({
        "amount": F.when(year == 1998, F.col("amount") * 1.5).otherwise(F.col("amount")),
        "pickup_location": F.when((year == 1999) & (F.col("quantity") % 2 == 0), "NATION_0").otherwise(F.col("pickup_location")),
        "customer": F.col("customer_id").isNull().cast("string"),
    })
    # Profiles of two halves add up.
    halves = [rows.filter("quantity <= 25"), rows.filter("quantity > 25 OR quantity IS NULL")]
    numbers = drift.added([drift.number_profile(h, "batch_date", ["amount", "rental_duration_days"]) for h in halves])
    words = drift.text_profile(rows, "batch_date", ["make", "pickup_location", "customer"])
    of_words = drift.text_drift(words).select(
        "column_name", "day", "previous", "rows", F.lit(None).cast("long").alias("nulls"),
        F.lit(None).cast("long").alias("not_positive"), "distance_per_mille",
    )
    return drift.number_drift(numbers).unionByName(of_words)


@query
def chk_scd2_incremental(spark, sf):
    """The same rules from states of customers, ended versions first, current ones added."""
    frames = []
    for name, dim in (("documented", t.customer_dim(spark, sf)), ("literal", t.customer_dim_literal(spark, sf))):
        past, now = (version_state.states(dim.filter(kind)) for kind in ("NOT is_current", "is_current"))
        total = version_state.settled(version_state.merged(past, now), lambda dim=dim: dim)
        rules = version_state.violations(total).select("many_current", "overlap", "flag_mismatch", "repeated_start")
        frames.append(rules.unpivot([], rules.columns, "rule", "violations").withColumn("dimension", F.lit(name)))
    return frames[0].unionByName(frames[1])


# Sinks


def _fact_with_rerun(spark, sf, write):
    """All days, then one of them again."""
    path = fresh_path(spark, "fact")
    fact = build_fact(t.rentals(spark, sf), t.dimensions(spark, sf))
    write(fact, path)
    write(batch_slice(fact, SLICE), path, one_day=True)
    return spark.read.schema(DATED_FACT).parquet(path)


@query
def sink_fact_append(spark, sf):
    return _fact_with_rerun(spark, sf, append_fact)


@query
def run_row_accounts(spark, sf):
    """Per day, rentals read = in the fact + rejected + of unknown cars."""
    rentals, car_dim = t.rentals(spark, sf), t.car_dim(spark, sf)
    car = car_dim.select("make", "model", "year", F.lit(True).alias("known")).distinct()
    complete = R.flatten(rentals.withColumn("valid", R.complete()))
    kinds = complete.join(car, ["make", "model", "year"], "left")
    is_fact = F.col("valid") & F.col("known").isNotNull()
    return kinds.groupBy("batch_date").agg(
        F.count(F.lit(1)).alias("read"),
        F.count_if(is_fact).alias("in_fact"),
        F.count_if(~F.col("valid")).alias("rejected"),
        F.count_if(F.col("valid") & F.col("known").isNull()).alias("unknown_car"),
    )


@query
def run_uncommitted_day(spark, sf):
    """The fact after a committed day, a re-run of it and a next day that were not committed."""
    house = _new_house(spark, sf, fresh_path(spark, "house"))

    def load(ds, batch, commit):
        run = new_run(ds)
        run_customers(house, ds, batch, run)
        run_fact(house, ds, batch_slice(t.stored_rentals(spark, sf), ds).drop("batch_date"), run)
        if commit:
            house.commit(ds, run)

    load(SLICE, t.batch_1(spark, sf), True)
    load(SLICE, t.batch_2(spark, sf), False)
    load("19990101", t.batch_2(spark, sf), False)
    return house.fact().select("rental_id", "car_key", "customer_key", "batch_date")


def _new_house(spark, sf, root):
    return bootstrap(spark, root, t.location_dim(spark, sf), t.car_dim(spark, sf), t.date_dim(spark, sf))


@query
def run_late_days(spark, sf):
    """The customer history from batches of two years, two of them loaded after later ones."""
    house = bootstrap(spark, fresh_path(spark, "house"))
    odd_year = F.year("batch_date") - (F.year("batch_date") + 1) % 2
    rare = t.snapshots(spark, sf).withColumn("batch_date", F.make_date(odd_year, F.lit(1), F.lit(1)))
    batches = scd2.latest_per_key(rare, ("seen_at", "seen_key"), ("customer_id", "batch_date"))
    stored = fresh_path(spark, "rare-batches")
    batches.write.parquet(stored)
    batches = spark.read.schema(batches.schema).parquet(stored)
    for year, late in ((1997, False), (2001, False), (1995, True), (1999, True)):
        ds = f"{year}0101"
        run = new_run(ds)
        batch = batch_slice(batches, ds).select("customer_id", *CUSTOMER_ATTRIBUTES)
        (run_late_customers if late else run_customers)(house, ds, batch, run)
        house.commit(ds, run, late=late)
    return house.customer_dim().drop("customer_key")


@query
def sink_fact_idempotent(spark, sf):
    return _fact_with_rerun(spark, sf, replace_days)


# Indicators


@query
def kpi_revenue_by_car(spark, sf):
    return kpis.revenue_by_car(t.fact(spark, sf), t.car_dim(spark, sf))


@query
def kpi_revenue_by_location(spark, sf):
    return kpis.revenue_by_location(t.fact(spark, sf), t.location_dim(spark, sf))


@query
def kpi_long_rental_ratio(spark, sf):
    return kpis.long_rental_ratio(t.fact(spark, sf), t.car_dim(spark, sf))


@query
def kpi_avg_duration(spark, sf):
    return kpis.average_duration(t.fact(spark, sf), t.location_dim(spark, sf))


@query
def kpi_tickets_by_segment(spark, sf):
    return kpis.tickets_by_segment(t.fact(spark, sf), t.segments(spark, sf))


# Indicators from the states of runs


def _kept_states(spark, sf):
    """A warehouse that has loaded all rentals in three days, the last one twice."""
    def load(house, ds, batch, first, last):
        run = new_run(ds)
        run_customers(house, ds, batch, run)
        years = F.year("batch_date").between(first, last)
        run_fact(house, ds, t.stored_rentals(spark, sf).filter(years).drop("batch_date"), run)
        run_indicators(house, ds, run, lambda customers: t.segments_of(customers, sf))
        house.commit(ds, run)

    def build(root):
        house = _new_house(spark, sf, root)
        batch_1, batch_2 = t.batch_1(spark, sf), t.batch_2(spark, sf)
        load(house, "19970101", batch_1, 1995, 1997)
        load(house, "19990101", batch_2, 1998, 1999)
        load(house, "20010101", batch_2, 2000, 2000)
        load(house, "20010101", batch_2, 2000, 2001)
        vacuum(house)

    return Warehouse(spark, t.once(spark, sf, "house_of_states", build)).indicators()


@query
def kpi_state_revenue_by_car(spark, sf):
    return kpi_state.revenue_by_car(_kept_states(spark, sf), t.car_dim(spark, sf))


@query
def kpi_state_revenue_by_location(spark, sf):
    return kpi_state.revenue_by_location(_kept_states(spark, sf), t.location_dim(spark, sf))


@query
def kpi_state_long_rental_ratio(spark, sf):
    return kpi_state.long_rental_ratio(_kept_states(spark, sf), t.car_dim(spark, sf))


@query
def kpi_state_avg_duration(spark, sf):
    return kpi_state.average_duration(_kept_states(spark, sf), t.location_dim(spark, sf))


@query
def kpi_state_tickets_by_segment(spark, sf):
    return kpi_state.tickets_by_segment(_kept_states(spark, sf))
