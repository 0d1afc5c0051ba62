"""How the columns of a table change from day to day, from profiles that add up.

A day's profile has, per number column, a histogram with steps of one hundredth of the value's
size (its sign and its first ``DIGITS`` digits), and per text column the count of each value
that is frequent that day. Profiles of several days or runs add up, and no row is kept. Any
quantile read from a histogram is off by less than one step, 1 % of the value. Two days differ
by the greatest difference of their shares up to a step (numbers), or half the sum of the differences
of their shares (texts; what is not frequent counts as one value). All of it is whole-number
arithmetic, so every engine and every order of rows give the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DIGITS = 3
LEAST_SHARE = 1000  # a value is frequent if it makes up one part in this many of its day
OTHER = "<other>"
NULL_VALUE = "<null>"


def _step(value: Column) -> Column:
    """The lower end, in size, of the value's step: all digits behind the first ``DIGITS`` are 0."""
    size = F.length(F.abs(value).cast("string"))
    unit = F.pow(F.lit(10), F.greatest(size - DIGITS, F.lit(0))).cast("long")
    return F.call_function("div", value, unit) * unit


def number_profile(rows: DataFrame, day: str, columns: Sequence[str], scale: int = 100) -> DataFrame:
    """``day, column_name, step, n``; values are counted in whole ``1 / scale``, NULL and what is too great have no step."""
    values = rows.select(F.col(day).alias("day"), *[
        F.round(F.col(c).try_cast("decimal(28,6)") * scale, 0).try_cast("long").alias(c) for c in columns
    ]).unpivot(["day"], list(columns), "column_name", "value")
    return values.groupBy("day", "column_name", _step(F.col("value")).alias("step")).agg(F.count(F.lit(1)).alias("n"))


def text_profile(rows: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """``day, column_name, value, n``: each frequent value, and the rest as one; at most ``LEAST_SHARE`` + 1 a day."""
    values = rows.select(F.col(day).alias("day"), *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_VALUE)).alias(c) for c in columns])
    counts = values.unpivot(["day"], list(columns), "column_name", "value").groupBy("day", "column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = rows.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("total"))
    frequent = F.col("n") * LEAST_SHARE >= F.col("total")
    return counts.join(totals, "day").groupBy(
        "day", "column_name", F.when(frequent, F.col("value")).otherwise(OTHER).alias("value")
    ).agg(F.sum("n").alias("n"))


def added(profiles: Sequence[DataFrame]) -> DataFrame:
    """Profiles of several runs as one."""
    both = reduce(DataFrame.unionByName, profiles)
    return both.groupBy(*[c for c in both.columns if c != "n"]).agg(F.sum("n").alias("n"))


def quantile(profile: DataFrame, per_mille: int, scale: int = 100) -> DataFrame:
    """``day, column_name, value``: the lower end of the step that holds this quantile of the values that are there."""
    by_column = W.partitionBy("day", "column_name")
    known = profile.filter("step IS NOT NULL").select(
        "*", F.sum("n").over(by_column).alias("total"),
        F.sum("n").over(by_column.orderBy("step").rowsBetween(W.unboundedPreceding, 0)).alias("up_to"),
    )
    return known.filter(F.col("up_to") * 1000 >= F.col("total") * per_mille).groupBy("day", "column_name").agg(
        (F.min("step") / scale).alias("value")
    )


def _days(profile: DataFrame) -> DataFrame:
    """Each day with the day before it in the profile; as many rows as days and columns."""
    totals = profile.groupBy("column_name", "day").agg(F.sum("n").alias("total"))
    before = W.partitionBy("column_name").orderBy("day")
    return totals.select("*", F.lag("day").over(before).alias("previous"), F.lag("total").over(before).alias("previous_total"))


def _compared(profile: DataFrame, item: str) -> DataFrame:
    """Counts of each item on a day and on the day before, 0 where it lacks."""
    pairs = _days(profile).filter("previous IS NOT NULL")
    now = pairs.join(profile, ["column_name", "day"]).select("column_name", "day", item, F.col("n").alias("now"), F.lit(0).cast("long").alias("then"))
    earlier = profile.withColumnRenamed("day", "previous")
    then = pairs.join(earlier, ["column_name", "previous"]).select("column_name", "day", item, F.lit(0).cast("long").alias("now"), F.col("n").alias("then"))
    sides = now.unionByName(then).groupBy("column_name", "day", item).agg(F.sum("now").alias("now"), F.sum("then").alias("then"))
    return sides.join(pairs, ["column_name", "day"])


def number_drift(profile: DataFrame) -> DataFrame:
    """Per column and day: rows, NULLs, values not above zero, and how far the day is from the one before, per mille."""
    sides = _compared(profile, "step")
    # A window group has the steps of one column and day: some thousands at most.
    in_order = W.partitionBy("column_name", "day").orderBy(F.col("step").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    apart = F.abs(
        F.sum("now").over(in_order).cast("decimal(38,0)") * F.col("previous_total")
        - F.sum("then").over(in_order).cast("decimal(38,0)") * F.col("total")
    )
    distance = F.floor(F.max("apart") * 1000 / F.max(F.col("total").cast("decimal(19,0)") * F.col("previous_total"))).cast("long")
    return sides.withColumn("apart", apart).groupBy("column_name", "day", "previous").agg(
        F.max("total").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("step").isNull(), F.col("now"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(F.col("step") <= 0, F.col("now"))), F.lit(0)).alias("not_positive"),
        distance.alias("distance_per_mille"),
    )


def text_drift(profile: DataFrame) -> DataFrame:
    """Per column and day: rows, and how far the day is from the one before, per mille."""
    sides = _compared(profile, "value")
    apart = F.abs(F.col("now").cast("decimal(38,0)") * F.col("previous_total") - F.col("then").cast("decimal(38,0)") * F.col("total"))
    distance = F.floor(F.sum("apart") * 500 / F.max(F.col("total").cast("decimal(19,0)") * F.col("previous_total"))).cast("long")
    return sides.withColumn("apart", apart).groupBy("column_name", "day", "previous").agg(
        F.max("total").alias("rows"), distance.alias("distance_per_mille")
    )
