"""A customer batch of an earlier day, merged between the days around it.

The history becomes what it would be had all batches come in order, without running the
later days again. Per customer of the late batch it takes three things: the version valid
before that time, the next version after it, and the next later batch that the customer was in.
A version records only changes, so the last one is needed to tell a customer whom a later batch
confirmed from one whom it lacked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.functions.compare import changed
from starlane.functions.dates import ntz
from starlane.operators.keys import assign_keys, natural_key
from starlane.schemas import CUSTOMER_ATTRIBUTES, CUSTOMER_DIM

COLUMNS = CUSTOMER_DIM.fieldNames()
MOVES = T.StructType([
    T.StructField("customer_key", T.LongType()),
    T.StructField("first_day", T.DateType()),
    T.StructField("end_day", T.DateType()),
    T.StructField("new_key", T.LongType()),
])
# A case per customer whose history changes: what was valid, what comes next, what the batch says.
CASE = ("customer_id", "before", "next", "again_at", "now")


def _attributes(of: str) -> list[Column]:
    return [F.col(f"{of}.{a}") for a in CUSTOMER_ATTRIBUTES]


def _differ(a: str, b: str) -> Column:
    return changed(zip(_attributes(a), _attributes(b), strict=True))


def cases(versions: DataFrame, batch: DataFrame, at: str, seen_later: DataFrame) -> DataFrame:
    """The customers whose history the late batch changes, one row each.

    ``batch`` holds a customer once. ``versions`` may leave out those that end before ``at``.
    ``seen_later`` has the customers of later batches and their times, ``seen_at``. Each side is
    an aggregate by customer, of at most a row per batch, so the join has no hot key.
    """
    time = ntz(at)
    version = F.struct("effective_date", *[c for c in COLUMNS if c != "effective_date"])
    around = versions.join(batch.select("customer_id"), "customer_id", "left_semi").groupBy("customer_id").agg(
        F.max(F.when(F.col("effective_date") < time, version)).alias("before"),
        F.min(F.when(F.col("effective_date") > time, version)).alias("next"),
    )
    again = seen_later.filter(F.col("seen_at") > time).groupBy("customer_id").agg(F.min("seen_at").alias("again_at"))
    now = batch.select("customer_id", F.struct(*CUSTOMER_ATTRIBUTES).alias("now"))
    return (
        now.join(around, "customer_id", "left").join(again, "customer_id", "left")
        .filter(F.col("before").isNull() | _differ("before", "now")).select(*CASE)
    )


def _same_next() -> Column:
    """The next batch that has the customer says the same as the late one."""
    at_next = F.col("next.effective_date") == F.col("again_at")
    return F.coalesce(at_next & ~_differ("next", "now"), F.lit(False))


def _returns() -> Column:
    """That batch says what was valid before: no version starts there yet."""
    at_next = F.coalesce(F.col("next.effective_date") == F.col("again_at"), F.lit(False))
    return F.col("again_at").isNotNull() & ~at_next & F.col("before").isNotNull()


def _version(of: str, **changes: Column) -> Column:
    return F.struct(*[(changes[c] if c in changes else F.col(f"{of}.{c}")).alias(c) for c in COLUMNS])


def dropped(found: DataFrame) -> DataFrame:
    """Keys of the versions that are no longer valid as they are stored."""
    keys = F.array(
        F.when(F.col("before").isNotNull(), F.col("before.customer_key")),
        F.when(_same_next(), F.col("next.customer_key")),
    )
    return found.select(F.explode(F.array_compact(keys)).alias("customer_key"))


def added(found: DataFrame, at: str, highest_key: int) -> DataFrame:
    """The versions that take their place, and the new ones, numbered behind ``highest_key``.

    The one that ends keeps its key, and so has a version that now begins earlier.
    """
    time = ntz(at)
    none = F.lit(None)
    no_key = none.cast("long")
    cut = F.when(F.col("before").isNotNull(), _version("before", end_date=time, is_current=F.lit(False)))
    longer = F.when(_same_next(), _version("next", effective_date=time))
    fresh = F.when(~_same_next(), F.struct(
        no_key.alias("customer_key"), F.col("customer_id"), *[F.col(f"now.{a}").alias(a) for a in CUSTOMER_ATTRIBUTES],
        time.alias("effective_date"), F.col("again_at").alias("end_date"), F.col("again_at").isNull().alias("is_current"),
    ))
    back = F.when(_returns(), _version("before", customer_key=no_key, effective_date=F.col("again_at")))
    versions = found.select(F.explode(F.array_compact(F.array(cut, longer, fresh, back))).alias("v")).select("v.*")
    used = found.sparkSession.createDataFrame([(highest_key,)], "customer_key long")
    numbered = assign_keys(
        versions.filter("customer_key IS NULL").drop("customer_key"),
        natural_key("customer_id", "effective_date"), "customer_key", after=used,
    )
    return versions.filter("customer_key IS NOT NULL").unionByName(numbered.select(COLUMNS)).select(COLUMNS)


def moves(found: DataFrame, new_versions: DataFrame, at: str) -> DataFrame:
    """For which days facts that hold the key valid before the late batch hold another from now on.

    A fact has the key valid right after its day's batch.
    """
    day = ntz(at).cast("date")
    starts = new_versions.select(
        F.col("customer_id").alias("_customer"), F.col("effective_date").alias("_start"), F.col("customer_key").alias("new_key")
    )
    lasting = found.filter("before IS NOT NULL").select(
        "customer_id", F.col("before.customer_key").alias("customer_key"), F.col("before.end_date").cast("date").alias("last"),
        F.col("again_at"), _returns().alias("returns"),
    )
    until = F.coalesce(F.col("again_at").cast("date"), F.col("last"))
    at_once = lasting.select("customer_id", "customer_key", ntz(at).alias("start"), day.alias("first_day"), until.alias("end_day"))
    returned = lasting.filter("returns").select(
        "customer_id", "customer_key", F.col("again_at").alias("start"), F.col("again_at").cast("date").alias("first_day"),
        F.col("last").alias("end_day"),
    )
    spans = at_once.unionByName(returned)
    same = (F.col("customer_id") == F.col("_customer")) & (F.col("start") == F.col("_start"))
    return spans.join(starts, same).select(MOVES.fieldNames())


def move_keys(fact: DataFrame, moved: DataFrame) -> DataFrame:
    """The fact with the keys of ``moved``; a key has at most two moves, of days apart."""
    spans = moved.select(
        F.col("customer_key").alias("_old"), F.col("first_day").alias("_first"),
        F.coalesce("end_day", F.lit("9999-12-31").cast("date")).alias("_end"), F.col("new_key").alias("_new"),
    )
    hit = (F.col("customer_key") == F.col("_old")) & (F.col("batch_date") >= F.col("_first")) & (F.col("batch_date") < F.col("_end"))
    key = F.coalesce("_new", "customer_key")
    return fact.join(spans, hit, "left").withColumn("customer_key", key).select(fact.columns)


def valid_at(versions: DataFrame, at: str) -> DataFrame:
    """The versions valid at a time, as current ones."""
    time = ntz(at)
    holds = (F.col("effective_date") <= time) & (F.col("end_date").isNull() | (F.col("end_date") > time))
    return versions.filter(holds).withColumns({
        "end_date": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True),
    }).select(COLUMNS)


def merge_late(versions: DataFrame, batch: DataFrame, at: str, seen_later: DataFrame) -> DataFrame:
    """All versions after a late batch. ``versions`` must be a stored table: it is read more than once."""
    found = cases(versions, batch, at, seen_later)
    highest = versions.agg(F.max("customer_key")).first()[0] or 0
    kept = versions.join(dropped(found), "customer_key", "left_anti").select(COLUMNS)
    return kept.unionByName(added(found, at, highest))
