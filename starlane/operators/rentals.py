"""Validation, flattening and measures of raw rentals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.functions.dates import days_between, iso_date
from starlane.functions.measures import average_daily_amount, is_long, total_amount

# The text of a rental as it was read, where rows carry it.
RAW = "raw"
REQUIRED = (
    "rental_id",
    "customer_id",
    "car.make",
    "car.model",
    "car.year",
    "rental_period.start_date",
    "rental_period.end_date",
    "rental_location.pickup_location",
    "rental_location.dropoff_location",
    "amount",
    "quantity",
)


def complete() -> Column:
    """All required fields are there; a missing parent object misses its fields too."""
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in REQUIRED])


def valid(rentals: DataFrame) -> DataFrame:
    return rentals.filter(complete())


def rejected(rentals: DataFrame) -> DataFrame:
    """The rows ``valid`` drops, with the names of their missing fields."""
    missing = F.concat_ws(",", *[F.when(F.col(f).isNull(), F.lit(f)) for f in REQUIRED])
    return rentals.filter(~complete()).withColumn("missing_fields", missing)


def flatten(rentals: DataFrame) -> DataFrame:
    """Nested fields as plain columns; other top-level columns pass through."""
    nested = ("car", "rental_period", "rental_location")
    return rentals.select(
        *[c for c in rentals.columns if c not in nested],
        F.col("car.make").alias("make"),
        F.col("car.model").alias("model"),
        F.col("car.year").alias("year"),
        F.col("rental_period.start_date").alias("start_date"),
        F.col("rental_period.end_date").alias("end_date"),
        F.col("rental_location.pickup_location").alias("pickup_location"),
        F.col("rental_location.dropoff_location").alias("dropoff_location"),
    )


def dated(flat: DataFrame) -> DataFrame:
    """Dates parsed."""
    return flat.withColumns({"start_date": iso_date(F.col("start_date")), "end_date": iso_date(F.col("end_date"))})


def with_measures(dated: DataFrame) -> DataFrame:
    """The four measures; what they come from is narrower, so they are best added behind shuffles."""
    return (
        dated.withColumns({
            "total_rental_amount": total_amount(F.col("amount"), F.col("quantity")),
            "rental_duration_days": days_between(F.col("start_date"), F.col("end_date")),
        })
        .withColumns({
            "average_daily_rental_amount": average_daily_amount(
                F.col("total_rental_amount"), F.col("rental_duration_days")
            ),
            "is_long_rental": is_long(F.col("rental_duration_days")),
        })
    )


def derive(flat: DataFrame) -> DataFrame:
    """Dates parsed, and the four measures."""
    return with_measures(dated(flat))


def measured(rentals: DataFrame) -> DataFrame:
    """Raw nested rentals to valid, flat rows with measures."""
    return derive(flatten(valid(rentals)))
