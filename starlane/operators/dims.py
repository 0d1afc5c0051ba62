"""Dimension contents: seeds, calendar, cars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.dates import date_key
from starlane.operators.keys import assign_keys, natural_key
from starlane.schemas import CAR_DIM, LOCATION_DIM

# The seed rows, keys 1, 2, 3, ... in this order.
SEED_LOCATIONS = (
    "New York - JFK Airport",
    "Los Angeles - LAX Airport",
    "Chicago - OHare Airport",
    "Houston - Bush Intercontinental Airport",
    "San Francisco - SFO Airport",
    "Miami - MIA Airport",
    "Seattle - SeaTac Airport",
    "Atlanta - Hartsfield-Jackson Airport",
    "Dallas - DFW Airport",
    "Denver - DEN Airport",
)
SEED_CARS = (
    ("Toyota", "Camry", 2020),
    ("Honda", "Civic", 2019),
    ("Ford", "Mustang", 2021),
    ("Chevrolet", "Impala", 2018),
    ("Tesla", "Model S", 2022),
    ("BMW", "3 Series", 2021),
    ("Audi", "A4", 2020),
    ("Mercedes-Benz", "C-Class", 2019),
    ("Volkswagen", "Passat", 2021),
    ("Nissan", "Altima", 2020),
)
SEED_DAYS = ("2025-09-01", "2025-09-30")


def seed_locations(spark: SparkSession) -> DataFrame:
    rows = [(i, f"LOC{i:03d}", name) for i, name in enumerate(SEED_LOCATIONS, 1)]
    return spark.createDataFrame(rows, LOCATION_DIM)


def seed_cars(spark: SparkSession) -> DataFrame:
    rows = [(i, f"CAR{i:03d}", *car) for i, car in enumerate(SEED_CARS, 1)]
    return spark.createDataFrame(rows, CAR_DIM)


def seed_dates(spark: SparkSession) -> DataFrame:
    return calendar(spark, *SEED_DAYS)


def _calendar_of(bounds: DataFrame) -> DataFrame:
    day = F.col("date")
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        date_key(day).alias("date_key"),
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
    )


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day from ``first`` to ``last``, both included."""
    return _calendar_of(
        spark.range(0, 1, 1, 1).select(
            F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
        )
    )


def calendar_over(rows: DataFrame, first: str, last: str) -> DataFrame:
    """Every day from the least value of column ``first`` to the greatest of ``last``."""
    return _calendar_of(rows.agg(F.min(first).alias("first"), F.max(last).alias("last")))


def cars_from(rows: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """A car dimension of the distinct (make, model, year) in ``rows``."""
    distinct = rows.select("make", "model", "year").distinct()
    keyed = assign_keys(distinct, natural_key("make", "model", "year"), "car_key", after)
    car_id = F.concat(F.lit("CAR"), F.lpad(F.col("car_key").cast("string"), 9, "0"))
    return keyed.withColumn("car_id", car_id).select(CAR_DIM.fieldNames())
