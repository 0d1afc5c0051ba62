"""The state of customers' versions, kept so that a day's checks cost its changes.

``states`` shrinks versions to one row per customer, ``merged`` adds the states of later
versions to those of earlier ones, and ``violations`` counts what the rules of
``checks.scd2_invariants`` and the declared keys find. Two states add up if every version of the
second starts after the first one's last start, and not before its last end; ``merged`` marks the
customers for which that fails, and the caller counts these again from their versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.session import fresh_path

STATE = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("versions", T.LongType()),
    T.StructField("current", T.LongType()),
    T.StructField("mismatch", T.LongType()),
    T.StructField("repeated", T.LongType()),
    T.StructField("repeated_values", T.LongType()),
    T.StructField("null_keys", T.LongType()),
    T.StructField("repeated_keys", T.LongType()),
    T.StructField("first_key", T.LongType()),
    T.StructField("last_key", T.LongType()),
    T.StructField("overlaps", T.BooleanType()),
    T.StructField("first_start", T.TimestampNTZType()),
    T.StructField("last_start", T.TimestampNTZType()),
    T.StructField("until", T.TimestampNTZType()),
])
COUNTS = ("versions", "current", "mismatch", "repeated", "repeated_values", "null_keys", "repeated_keys")
# What is counted per bucket of customers.
VIOLATIONS = (
    "many_current", "overlap", "flag_mismatch", "repeated_start", "duplicate_starts", "null_keys", "null_ids", "repeated_keys",
)
FOREVER = "9999-12-31"


def states(versions: DataFrame) -> DataFrame:
    """One row per customer. A window group holds at most a customer's starts, one per batch."""
    forever = F.lit(FOREVER).cast("timestamp_ntz")
    starts = versions.groupBy("customer_id", "effective_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_current").alias("current"),
        F.count_if(F.col("is_current") != F.col("end_date").isNull()).alias("mismatch"),
        F.count_if(F.col("customer_key").isNull()).alias("null_keys"),
        F.max(F.coalesce("end_date", forever)).alias("until"),
    )
    earlier = W.partitionBy("customer_id").orderBy("effective_date").rowsBetween(W.unboundedPreceding, -1)
    overlaps = (F.col("n") > 1) | F.coalesce(F.max("until").over(earlier) > F.col("effective_date"), F.lit(False))
    found = starts.withColumn("overlaps", overlaps).groupBy("customer_id").agg(
        F.sum("n").alias("versions"),
        F.sum("current").alias("current"),
        F.sum("mismatch").alias("mismatch"),
        F.sum(F.col("n") - 1).alias("repeated"),
        F.count_if(F.col("n") > 1).alias("repeated_values"),
        F.sum("null_keys").alias("null_keys"),
        F.max("overlaps").alias("overlaps"),
        F.min("effective_date").alias("first_start"),
        F.max("effective_date").alias("last_start"),
        F.max("until").alias("until"),
    )
    keys = versions.filter("customer_key IS NOT NULL").groupBy("customer_id", "customer_key").agg(F.count(F.lit(1)).alias("n"))
    keyed = keys.groupBy(F.col("customer_id").alias("_id")).agg(
        F.sum(F.col("n") - 1).alias("repeated_keys"), F.min("customer_key").alias("first_key"), F.max("customer_key").alias("last_key"),
    )
    return found.join(keyed, F.col("customer_id").eqNullSafe(F.col("_id")), "left").fillna(0, ["repeated_keys"]).select(
        STATE.fieldNames()
    )


def merged(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """The states of both sets of versions together, and ``regular``: whether they add up."""
    a, b = earlier.alias("a"), later.alias("b")

    def both(name: str, add) -> Column:
        return add(F.col(f"a.{name}"), F.col(f"b.{name}")).alias(name)

    missing = F.col("a.versions").isNull() | F.col("b.versions").isNull()
    follows = (F.col("b.first_start") >= F.col("a.until")) & (F.col("b.first_start") > F.col("a.last_start"))
    apart = (F.col("b.first_key") > F.col("a.last_key")) | (F.col("b.last_key") < F.col("a.first_key"))
    either = F.coalesce(F.col("a.versions"), F.col("b.versions")).isNotNull()
    joined = a.join(b, F.col("a.customer_id").eqNullSafe(F.col("b.customer_id")), "full").filter(either)
    return joined.select(
        F.coalesce("a.customer_id", "b.customer_id").alias("customer_id"),
        *[both(c, lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))) for c in COUNTS],
        both("overlaps", lambda x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))),
        *[both(c, F.least) for c in ("first_key", "first_start")],
        *[both(c, F.greatest) for c in ("last_key", "last_start", "until")],
        (missing | F.coalesce(follows & apart, F.lit(False))).alias("regular"),
    )


def settled(merged: DataFrame, versions: Callable[[], DataFrame], again: DataFrame | None = None) -> DataFrame:
    """Merged states that all add up: those that do not, and those of customers in ``again``, are counted anew.

    ``versions`` is asked for all versions only if there are such customers; on a usual day there
    are none. The result is stored.
    """
    spark, columns = merged.sparkSession, STATE.fieldNames()

    def stored(frame: DataFrame) -> DataFrame:
        path = fresh_path(spark, "states")
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    merged = stored(merged)
    odd = merged.filter("NOT regular").select("customer_id")
    who = odd if again is None else odd.unionByName(again)
    if who.isEmpty():
        return merged.select(columns)
    who = who.select(F.col("customer_id").alias("_who")).distinct()
    same = F.col("customer_id").eqNullSafe(F.col("_who"))
    counted = states(versions().join(who, same, "left_semi"))
    return stored(merged.select(columns).join(who, same, "left_anti").unionByName(counted))


def violations(found: DataFrame, *by: str) -> DataFrame:
    """What the states break, per value of the columns ``by``."""
    return found.groupBy(*by).agg(
        F.count_if(F.col("current") > 1).alias("many_current"),
        F.count_if("overlaps").alias("overlap"),
        F.sum("mismatch").alias("flag_mismatch"),
        F.sum("repeated").alias("repeated_start"),
        F.sum("repeated_values").alias("duplicate_starts"),
        F.sum("null_keys").alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col("customer_id").isNull(), F.col("versions"))), F.lit(0)).alias("null_ids"),
        F.sum("repeated_keys").alias("repeated_keys"),
    )
