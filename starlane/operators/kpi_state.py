"""Indicators from states that add up, one set of states per run.

A run's day of the fact shrinks to one row per car, per location and role, and per segment, and to its
distinct tickets by segment. The states of any set of runs add up to those of all their rows, so
the indicators of all days are read without the fact. Tickets are counted exactly: a rental id
that occurs on several days is one ticket, so its runs' ids are joined, not their counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.functions.measures import money, round_cents, too_great
from starlane.operators.kpis import UNKNOWN

STATE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.LongType()),
    T.StructField("segment", T.StringType()),
    T.StructField("rentals", T.LongType()),
    T.StructField("revenue", T.DecimalType(38, 2)),
    T.StructField("amounts_left_out", T.LongType()),
    T.StructField("long_rentals", T.LongType()),
    T.StructField("timed", T.LongType()),
    T.StructField("days", T.LongType()),
])
TICKETS = T.StructType([
    T.StructField("segment", T.StringType()),
    T.StructField("rental_id", T.StringType()),
])
CAR, PICKUP, DROPOFF, SEGMENT = "car", "pickup", "dropoff", "segment"
ADDED = ("rentals", "revenue", "amounts_left_out", "long_rentals", "timed", "days")


@dataclass(frozen=True)
class States:
    sums: DataFrame
    tickets: DataFrame


def states(fact: DataFrame, segments: DataFrame) -> States:
    """The states of some rows of the fact. ``segments`` maps customer_key to segment, each key once.

    A row is counted under its car, its two locations and its segment in one pass.
    """
    named = fact.join(segments.select("customer_key", "segment"), "customer_key", "left").withColumn(
        "segment", F.coalesce("segment", F.lit(UNKNOWN))
    )
    no_key, no_segment = F.lit(None).cast("long"), F.lit(None).cast("string")

    def under(kind: str, key: Column, segment: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), segment.alias("segment"))

    places = F.array(
        under(CAR, F.col("car_key"), no_segment), under(PICKUP, F.col("pickup_location_key"), no_segment),
        under(DROPOFF, F.col("dropoff_location_key"), no_segment), under(SEGMENT, no_key, F.col("segment")),
    )
    amount = F.col("total_rental_amount")
    sums = (
        named.select(F.explode(places).alias("place"), "total_rental_amount", "is_long_rental", "rental_duration_days")
        .groupBy("place.kind", "place.key", "place.segment").agg(
            F.count(F.lit(1)).alias("rentals"),
            F.sum(money(amount)).cast("decimal(38,2)").alias("revenue"),
            F.count_if(too_great(amount)).alias("amounts_left_out"),
            F.count_if("is_long_rental").alias("long_rentals"),
            F.count("rental_duration_days").alias("timed"),
            F.sum("rental_duration_days").cast("long").alias("days"),
        )
    )
    return States(sums.select(STATE.fieldNames()), named.select("segment", "rental_id").distinct())


def combined(found: States) -> States:
    """One state per car, location, segment and ticket."""
    sums = found.sums.groupBy("kind", "key", "segment").agg(*[F.sum(c).alias(c) for c in ADDED])
    return States(sums, found.tickets.distinct())


def _revenue() -> Column:
    return F.col("revenue").cast("double").alias("revenue")


def revenue_by_car(found: States, car_dim: DataFrame) -> DataFrame:
    cars = combined(found).sums.filter(F.col("kind") == CAR).withColumnRenamed("key", "car_key")
    return cars.join(car_dim, "car_key").select("make", "model", "year", "rentals", _revenue(), "amounts_left_out")


def revenue_by_location(found: States, location_dim: DataFrame) -> DataFrame:
    """Both roles; an unresolved location counts as UNKNOWN."""
    roles = combined(found).sums.filter(F.col("kind").isin(PICKUP, DROPOFF)).withColumnRenamed("key", "location_key")
    return roles.join(location_dim, "location_key", "left").select(
        F.col("kind").alias("role"), F.coalesce("location_name", F.lit(UNKNOWN)).alias("location_name"),
        "rentals", _revenue(), "amounts_left_out",
    )


def long_rental_ratio(found: States, car_dim: DataFrame) -> DataFrame:
    """Per car and, with NULL car columns, overall."""
    cars = combined(found).sums.filter(F.col("kind") == CAR).withColumnRenamed("key", "car_key")
    levels = cars.rollup("car_key").agg(
        F.when(F.grouping("car_key") == 1, "overall").otherwise("car").alias("scope"),
        F.sum("rentals").alias("rentals"), F.sum("long_rentals").alias("long_rentals"),
    )
    return levels.join(car_dim, "car_key", "left").select(
        "scope", "make", "model", "year", "rentals", "long_rentals",
        (F.col("long_rentals") / F.col("rentals")).alias("long_rental_ratio"),
    )


def average_duration(found: States, location_dim: DataFrame) -> DataFrame:
    """Per pickup location and overall."""
    places = combined(found).sums.filter(F.col("kind") == PICKUP).withColumnRenamed("key", "location_key")
    named = places.join(location_dim, "location_key", "left").select(
        F.coalesce("location_name", F.lit(UNKNOWN)).alias("location_name"), "timed", "days"
    )
    return named.rollup("location_name").agg(
        F.when(F.grouping("location_name") == 1, "overall").otherwise("pickup").alias("scope"),
        F.sum("timed").alias("rentals"),
        F.try_divide(F.sum("days"), F.sum("timed")).alias("average_duration_days"),
    )


def tickets_by_segment(found: States) -> DataFrame:
    """A ticket is a distinct rental id."""
    both = combined(found)
    tickets = both.tickets.groupBy("segment").agg(F.count(F.lit(1)).alias("tickets"))
    totals = both.sums.filter(F.col("kind") == SEGMENT).select("segment", "rentals", _revenue(), "amounts_left_out")
    return totals.join(tickets, "segment").select(
        "segment", "rentals", "tickets", "revenue", "amounts_left_out",
        round_cents(F.try_divide(F.col("revenue"), F.col("tickets"))).alias("average_ticket"),
    )
