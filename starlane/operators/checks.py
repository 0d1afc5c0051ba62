"""Integrity checks. Each shrinks its table by an aggregate before any join or window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.functions.dates import iso_date
from starlane.functions.measures import money
from starlane.operators import suggest
from starlane.operators.keys import shown
from starlane.schemas import CUSTOMER_ATTRIBUTES, FACT_REFERENCES

CAR = "car"
LOOKUP_ROLES = (CAR, "customer", "dropoff_location", "end_date", "pickup_location", "start_date")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _text(value: Column, kind: T.DataType) -> Column:
    text = value.cast("string")
    return F.coalesce(money(value).cast("string"), text) if isinstance(kind, T.DoubleType) else text


def profile(name: str, table: DataFrame) -> DataFrame:
    """Rows, NULLs, values not above zero, least and greatest value of each column, in one pass.

    The extremes are text; those of a double are given to the cent.
    """
    fields = table.schema.fields
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(fields):
        column = F.col(field.name)
        numeric = isinstance(field.dataType, T.NumericType)
        below = F.count_if(column <= 0) if numeric else F.lit(None).cast("long")
        aggregates += [
            F.count(column).alias(f"n{i}"),
            below.alias(f"z{i}"),
            F.min(column).alias(f"a{i}"),
            F.max(column).alias(f"b{i}"),
        ]
    lines = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            F.col(f"z{i}").alias("not_positive_count"),
            _text(F.col(f"a{i}"), field.dataType).alias("min_value"),
            _text(F.col(f"b{i}"), field.dataType).alias("max_value"),
        )
        for i, field in enumerate(fields)
    ]
    return table.agg(*aggregates).select(
        F.lit(name).alias("table_name"), F.inline(F.array(*lines))
    )


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([profile(name, table) for name, table in tables.items()])


def nulls(required: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULLs in the columns declared NOT NULL; one row per declared column."""
    frames = []
    for name, (table, columns) in required.items():
        counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        frames.append(
            counts.unpivot([], list(columns), "column_name", "null_count")
            .withColumn("table_name", F.lit(name))
        )
    return _union(frames)


def duplicate_keys(keys: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Values that occur more than once in a column list declared unique."""
    frames = []
    for name, table, columns in keys:
        counts = table.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
        frames.append(
            counts.filter("row_count > 1").select(
                F.lit(name).alias("table_name"),
                F.lit(",".join(columns)).alias("key_columns"),
                shown(*columns).alias("key_value"),
                "row_count",
            )
        )
    return _union(frames)


# The keys that the tables declare. Versions of a customer share its id.
DECLARED_KEYS = {
    "location_dim": (("location_key",), ("location_id",)),
    "car_dim": (("car_key",), ("car_id",), ("make", "model", "year")),
    "date_dim": (("date_key",), ("date",)),
    "customer_dim": (("customer_key",), ("customer_id", "effective_date")),
    "rentals_fact": (("rental_id",),),
}


def declared_keys(tables: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame, Sequence[str]]]:
    return [(name, tables[name], columns) for name, keys in DECLARED_KEYS.items() for columns in keys]


def fk_orphans(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct keys of the fact that point nowhere, one line per foreign key.

    One scan counts the rows per (foreign key, value); only these counts are
    joined. A NULL key is no orphan.
    """
    names = list(FACT_REFERENCES)
    used = (
        fact.select(*[F.col(n).cast("long").alias(n) for n in names])
        .unpivot([], names, "foreign_key", "value")
        .groupBy("foreign_key", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = _union([
        dims[table].select(
            F.lit(name).alias("foreign_key"), F.col(key).cast("long").alias("value")
        )
        for name, (table, key) in FACT_REFERENCES.items()
    ]).withColumn("known", F.lit(True))
    # A value known twice comes out twice, but only unknown values are counted.
    orphan = F.col("value").isNotNull() & F.col("known").isNull()
    return (
        used.join(known, ["foreign_key", "value"], "left")
        .groupBy("foreign_key")
        .agg(
            F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(orphan).alias("orphan_keys"),
        )
    )


def unresolved_lookups(flat: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Natural values that no dimension knows, with the rentals that carry them, per role.

    ``flat`` holds valid, flattened rentals; a malformed date is reported as the text it
    is. One scan counts rentals per (role, typed value); only these counts are joined.
    """
    def typed(*parts: Column) -> Column:
        a, b, c = [*parts, F.lit(None), F.lit(None)][:3]
        return F.struct(a.cast("string").alias("a"), b.cast("string").alias("b"), c.cast("int").alias("c"))

    def day(column: str) -> Column:
        return typed(F.coalesce(iso_date(F.col(column)).cast("string"), F.col(column).cast("string")))

    car = typed(F.col("make"), F.col("model"), F.col("year"))
    values = (
        flat.select(
            car.alias(CAR),
            typed(F.col("customer_id")).alias("customer"),
            typed(F.col("dropoff_location")).alias("dropoff_location"),
            day("end_date").alias("end_date"),
            typed(F.col("pickup_location")).alias("pickup_location"),
            day("start_date").alias("start_date"),
        )
        .unpivot([], list(LOOKUP_ROLES), "role", "value")
        .groupBy("role", "value.a", "value.b", "value.c")
        .agg(F.count(F.lit(1)).alias("rentals"))
    )
    date = typed(F.col("date"))
    location = typed(F.col("location_name"))
    sources = {
        CAR: (dims["car_dim"], car),
        "customer": (dims["customer_dim"].filter("is_current"), typed(F.col("customer_id"))),
        "dropoff_location": (dims["location_dim"], location),
        "end_date": (dims["date_dim"], date),
        "pickup_location": (dims["location_dim"], location),
        "start_date": (dims["date_dim"], date),
    }
    known = _union([
        dim.select(F.lit(role).alias("k_role"), value.alias("k")) for role, (dim, value) in sources.items()
    ]).select("k_role", *[F.col(f"k.{c}").alias(f"k_{c}") for c in "abc"], F.lit(True).alias("known"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in "abc"])
    value = F.when(F.col("role") == CAR, shown("a", "b", "c")).otherwise(F.col("a"))
    # Not an anti join: Catalyst may move one below the counting.
    return (
        values.join(known, (F.col("role") == F.col("k_role")) & same, "left").filter("known IS NULL")
        .select("role", value.alias("natural_value"), "rentals")
    )


def lookup_suggestions(unresolved: DataFrame, dims: Mapping[str, DataFrame], edits: int = suggest.EDITS) -> DataFrame:
    """Unresolved cars and locations with the known value nearest in spelling, NULL if none is near.

    ``unresolved`` is the report of ``unresolved_lookups``.
    """
    location = dims["location_dim"].select(F.col("location_name").alias("text"))
    known = _union([
        dims["car_dim"].select(shown("make", "model", "year").alias("text")).withColumn("kind", F.lit(CAR)),
        location.withColumn("kind", F.lit("pickup_location")), location.withColumn("kind", F.lit("dropoff_location")),
    ])
    open_values = unresolved.filter(F.col("role").isin(CAR, "pickup_location", "dropoff_location"))
    found = suggest.nearest(open_values.select(F.col("role").alias("kind"), F.col("natural_value").alias("text")), known, edits)
    named = found.select(F.col("kind").alias("role"), F.col("text").alias("natural_value"), "suggestion", "edits")
    return open_values.join(named, ["role", "natural_value"], "left")


def batch_conflicts(batch: DataFrame) -> DataFrame:
    """Customers whom one batch gives different attributes, with the number of different rows."""
    return (
        batch.select("customer_id", *CUSTOMER_ATTRIBUTES).distinct()
        .groupBy("customer_id").agg(F.count(F.lit(1)).alias("different_rows"))
        .filter("different_rows > 1")
    )


def scd2_invariants(dim: DataFrame) -> DataFrame:
    """Violations of the version rules, one line per rule.

    ``many_current``: customers with more than one current version;
    ``overlap``: customers with two versions valid at one time;
    ``flag_mismatch``: versions whose flag disagrees with an open end;
    ``repeated_start``: versions beyond the first of one customer and start.

    Versions shrink to one row per customer and start first; starts are batch
    times, so a window group holds at most as many rows as there are batches.
    """
    forever = F.lit("9999-12-31").cast("timestamp_ntz")
    starts = dim.groupBy("customer_id", "effective_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_current").alias("current"),
        F.count_if(F.col("is_current") != F.col("end_date").isNull()).alias("mismatch"),
        F.max(F.coalesce("end_date", forever)).alias("until"),
    )
    earlier = (
        W.partitionBy("customer_id").orderBy("effective_date")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    overlaps = (F.col("n") > 1) | F.coalesce(
        F.max("until").over(earlier) > F.col("effective_date"), F.lit(False)
    )
    customers = starts.withColumn("overlaps", overlaps).groupBy("customer_id").agg(
        F.sum("current").alias("current"),
        F.max("overlaps").alias("overlaps"),
        F.sum("mismatch").alias("mismatch"),
        F.sum(F.col("n") - 1).alias("repeated"),
    )
    rules = customers.agg(
        F.count_if(F.col("current") > 1).alias("many_current"),
        F.count_if("overlaps").alias("overlap"),
        F.coalesce(F.sum("mismatch"), F.lit(0)).alias("flag_mismatch"),
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated_start"),
    )
    return rules.unpivot([], rules.columns, "rule", "violations")
