"""Indicators over the fact. The fact shrinks to one row per key before names are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.functions.measures import money, round_cents, too_great

UNKNOWN = "UNKNOWN"


def _rentals() -> Column:
    return F.count(F.lit(1)).alias("rentals")


def _revenue() -> Column:
    return F.sum(money(F.col("total_rental_amount"))).cast("double").alias("revenue")


def _left_out() -> Column:
    """How many amounts the revenue cannot hold."""
    return F.count_if(too_great(F.col("total_rental_amount"))).alias("amounts_left_out")


def revenue_by_car(fact: DataFrame, car_dim: DataFrame) -> DataFrame:
    totals = fact.groupBy("car_key").agg(_rentals(), _revenue(), _left_out())
    return totals.join(car_dim, "car_key").select("make", "model", "year", "rentals", "revenue", "amounts_left_out")


def revenue_by_location(fact: DataFrame, location_dim: DataFrame) -> DataFrame:
    """Both roles in one scan; an unresolved location counts as UNKNOWN."""
    roles = fact.select(
        F.col("pickup_location_key").alias("pickup"),
        F.col("dropoff_location_key").alias("dropoff"),
        "total_rental_amount",
    ).unpivot(["total_rental_amount"], ["pickup", "dropoff"], "role", "location_key")
    totals = roles.groupBy("role", "location_key").agg(_rentals(), _revenue(), _left_out())
    name = F.coalesce("location_name", F.lit(UNKNOWN)).alias("location_name")
    return totals.join(location_dim, "location_key", "left").select(
        "role", name, "rentals", "revenue", "amounts_left_out"
    )


def long_rental_ratio(fact: DataFrame, car_dim: DataFrame) -> DataFrame:
    """Per car and, with NULL car columns, overall."""
    per_car = fact.groupBy("car_key").agg(
        _rentals(), F.count_if("is_long_rental").alias("long_rentals")
    )
    overall = F.grouping("car_key") == 1
    levels = per_car.rollup("car_key").agg(
        F.when(overall, "overall").otherwise("car").alias("scope"),
        F.sum("rentals").alias("rentals"),
        F.sum("long_rentals").alias("long_rentals"),
    )
    return levels.join(car_dim, "car_key", "left").select(
        "scope", "make", "model", "year", "rentals", "long_rentals",
        (F.col("long_rentals") / F.col("rentals")).alias("long_rental_ratio"),
    )


def average_duration(fact: DataFrame, location_dim: DataFrame) -> DataFrame:
    """Per pickup location and overall."""
    per_location = fact.groupBy(F.col("pickup_location_key").alias("location_key")).agg(
        F.count("rental_duration_days").alias("rentals"),
        F.sum("rental_duration_days").alias("days"),
    )
    named = per_location.join(location_dim, "location_key", "left").select(
        F.coalesce("location_name", F.lit(UNKNOWN)).alias("location_name"), "rentals", "days"
    )
    overall = F.grouping("location_name") == 1
    return named.rollup("location_name").agg(
        F.when(overall, "overall").otherwise("pickup").alias("scope"),
        F.sum("rentals").alias("rentals"),
        F.try_divide(F.sum("days"), F.sum("rentals")).alias("average_duration_days"),
    )


def tickets_by_segment(fact: DataFrame, segments: DataFrame) -> DataFrame:
    """``segments`` maps customer_key to segment. A ticket is a distinct rental id."""
    named = fact.select("rental_id", "customer_key", "total_rental_amount").join(
        segments.select("customer_key", "segment"), "customer_key", "left"
    )
    totals = named.groupBy(F.coalesce("segment", F.lit(UNKNOWN)).alias("segment")).agg(
        _rentals(), F.count_distinct("rental_id").alias("tickets"), _revenue(), _left_out()
    )
    return totals.withColumn(
        "average_ticket", round_cents(F.try_divide(F.col("revenue"), F.col("tickets")))
    )
