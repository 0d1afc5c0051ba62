"""Natural keys to surrogate keys.

Dimensions are stored tables, so the planner knows their size: it broadcasts one
under its threshold and shuffles any other. A shuffled lookup reads both sides
straight from their exchanges, which lets adaptive execution split the partition
of a hot natural key over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.session import fresh_path


def car_key(rentals: DataFrame, car_dim: DataFrame) -> DataFrame:
    """Inner: a rental of an unknown car is dropped."""
    natural = ["make", "model", "year"]
    return rentals.join(car_dim.select("car_key", *natural), natural).drop(*natural)


def location_keys(rentals: DataFrame, location_dim: DataFrame) -> DataFrame:
    """Left, in both roles: an unknown location gives a NULL key."""
    for role in ("pickup", "dropoff"):
        names = location_dim.select(
            F.col("location_key").alias(f"{role}_location_key"),
            F.col("location_name").alias(f"{role}_location"),
        )
        rentals = rentals.join(names, f"{role}_location", "left").drop(f"{role}_location")
    return rentals


def date_keys(rentals: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Left, in both roles: a date outside the calendar gives a NULL key."""
    for role in ("start", "end"):
        days = date_dim.select(
            F.col("date_key").alias(f"{role}_date_key"),
            F.col("date").alias(f"{role}_date"),
        )
        rentals = rentals.join(days, f"{role}_date", "left").drop(f"{role}_date")
    return rentals


def customer_all_versions(rentals: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Left, to every version: a rental comes out once per version of its customer."""
    versions = customer_dim.select("customer_key", "customer_id")
    return rentals.join(versions, "customer_id", "left").drop("customer_id")


def customer_current(rentals: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Left, to the current version."""
    current = customer_dim.filter("is_current").select("customer_key", "customer_id")
    return rentals.join(current, "customer_id", "left").drop("customer_id")


def spread_customers(rentals: DataFrame, parts: int | None = None) -> DataFrame:
    """Customers with more than one part in ``parts`` of all rentals, and how many ``pieces`` theirs make.

    ``parts`` is the number of shuffle partitions unless given. Rentals are counted in the tasks that read them;
    fewer than ``parts`` customers can exceed such a share, so the stored result is small
    however many rentals there are. ``rentals`` needs the column ``customer_id`` only.
    """
    spark = rentals.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rentals.select("customer_id")
    total = ids.count()
    counts = ids.filter("customer_id IS NOT NULL").groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.filter(F.col("_n") * parts > total).select(
        "customer_id", F.ceil(F.col("_n") * parts / F.lit(max(total, 1))).cast("int").alias("pieces")
    )
    path = fresh_path(spark, "heavy-customers")
    heavy.coalesce(1).write.parquet(path)
    return spark.read.schema(heavy.schema).parquet(path)


def _piece(rentals: DataFrame, pieces: Column) -> Column:
    """Which piece of its customer's rentals a rental is in; from its content, so that a lost task deals it alike."""
    row = F.xxhash64(*[F.col(c) for c in rentals.columns])
    return F.when(pieces > 1, F.pmod(row, pieces).cast("int")).otherwise(0)


def customer_as_of(
    rentals: DataFrame,
    customer_dim: DataFrame,
    day: str = "start_date",
    first_version_open: bool = False,
    spread: DataFrame | None = None,
) -> DataFrame:
    """Left, to the version valid at the start of ``day``.

    A customer's versions, at most one per batch, become one row with an ordered list, so
    each rental meets that row in one join. The lists are an aggregate by the join's key, which
    adaptive execution cannot split, so heavy customers are spread beforehand: ``spread``
    says who they are (``spread_customers`` of the rentals unless given); their rentals are
    cut into pieces by content, and their list is repeated for each piece. Rentals without a
    customer find nothing and are spread too. Whatever ``spread`` holds, the result is the same.

    With ``first_version_open`` a customer's first version also covers the time
    before it began. Where versions overlap the latest one wins.
    """
    spread = spread_customers(rentals) if spread is None else spread
    parts = int(rentals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fewer rows than the ``parts`` it was made with.
    heavy = F.broadcast(spread.select(F.col("customer_id").alias("_heavy"), F.col("pieces").alias("_pieces")))
    pieces = F.coalesce("_pieces", F.lit(1))
    versions = customer_dim.groupBy("customer_id").agg(
        F.array_sort(F.collect_list(
            F.struct(F.col("effective_date").alias("at"), "customer_key", "end_date")
        )).alias("_versions")
    )
    lists = versions.join(heavy, F.col("customer_id") == F.col("_heavy"), "left").select(
        F.col("customer_id").alias("_customer"), "_versions",
        F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_part"),
    )
    nobody = F.when(F.col("customer_id").isNull(), F.lit(parts))
    dealt = rentals.join(heavy, F.col("customer_id") == F.col("_heavy"), "left").withColumn(
        "_piece", _piece(rentals, F.coalesce(nobody, pieces))
    )
    at = F.col(day).cast("timestamp_ntz")
    begun = F.filter("_versions", lambda v: v["at"] <= at)
    found = F.try_element_at(begun, F.lit(-1))
    key = F.when(found["end_date"].isNull() | (at < found["end_date"]), found["customer_key"])
    if first_version_open:
        first = F.try_element_at("_versions", F.lit(1))["customer_key"]
        key = F.when(at.isNotNull() & found.isNull(), first).otherwise(key)
    same = (F.col("customer_id") == F.col("_customer")) & (F.col("_piece") == F.col("_part"))
    return dealt.join(lists, same, "left").withColumn("customer_key", key).drop(
        "customer_id", "_customer", "_versions", "_heavy", "_pieces", "_piece", "_part"
    )
