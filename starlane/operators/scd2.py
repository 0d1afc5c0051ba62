"""Type-2 history of the customer dimension.

Each function maps DataFrames to a DataFrame. A version is valid in
[effective_date, end_date); the current one has no end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starlane.functions.compare import changed, changed_null_unsafe
from starlane.functions.dates import ntz
from starlane.operators.keys import assign_keys, natural_key
from starlane.schemas import CUSTOMER_ATTRIBUTES, CUSTOMER_DIM
from starlane.session import fresh_path
from starlane.sources.customers import LINE

KEY = "customer_id"
COLUMNS = CUSTOMER_DIM.fieldNames()
# Equal rows of a batch are written out again in runs of at most this many.
RUN = 100_000


def latest_per_key(
    batch: DataFrame, order: Sequence[str] = (), key: Sequence[str] = (KEY,)
) -> DataFrame:
    """One row per key: the last by ``order``, ties broken by the attributes.

    An aggregate, not a window: a key repeated any number of times shrinks to
    one row per task before the shuffle.
    """
    rest = [c for c in batch.columns if c not in key]
    ranking = [*order, *[c for c in rest if c not in order]]
    picked = batch.groupBy(*key).agg(F.max(F.struct(*ranking)).alias("_row"))
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest(batch: DataFrame) -> DataFrame:
    """The batch as far as it can enter the dimension: ids are NOT NULL there.

    Of several lines for one customer the last line of the file holds, where the batch
    carries the lines' order; ``checks.batch_conflicts`` reports such customers.
    """
    order = [LINE] if LINE in batch.columns else []
    return latest_per_key(batch.filter(F.col(KEY).isNotNull()), order).drop(LINE)


def _new(name: str) -> Column:
    return F.col(f"_new_{name}")


def _incoming(batch: DataFrame) -> DataFrame:
    return batch.select(
        F.col(KEY), F.lit(True).alias("_arrived"),
        *[F.col(a).alias(f"_new_{a}") for a in CUSTOMER_ATTRIBUTES],
    )


def _change(null_safe: bool) -> Column:
    test = changed if null_safe else changed_null_unsafe
    return test((F.col(a), _new(a)) for a in CUSTOMER_ATTRIBUTES)


def _opened(rows: DataFrame, at: str, *others: str) -> DataFrame:
    """Customer rows as current versions, without a key unless it is among ``others``."""
    return rows.select(
        *others, KEY, *CUSTOMER_ATTRIBUTES,
        ntz(at).alias("effective_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        F.lit(True).alias("is_current"),
    )


def changed_customers(dim: DataFrame, batch: DataFrame, null_safe: bool = True) -> DataFrame:
    """Current versions whose attributes the batch changes, with old and new values."""
    return (
        dim.filter("is_current")
        .join(_incoming(latest(batch)), KEY)
        .filter(_change(null_safe))
        .select(
            "customer_key", KEY, *CUSTOMER_ATTRIBUTES,
            *[_new(a).alias(f"new_{a}") for a in CUSTOMER_ATTRIBUTES],
        )
    )


def close(dim: DataFrame, batch: DataFrame, at: str, null_safe: bool = True) -> DataFrame:
    """End the current versions that the batch changes. History is not shuffled."""
    hit = F.coalesce(F.col("_arrived") & _change(null_safe), F.lit(False))
    current = (
        dim.filter("is_current")
        .join(_incoming(latest(batch)), KEY, "left")
        .withColumns({
            "end_date": F.when(hit, ntz(at)).otherwise(F.col("end_date")),
            "is_current": ~hit,
        })
    )
    return current.select(COLUMNS).unionByName(dim.filter("is_current IS NOT TRUE").select(COLUMNS))


def _with_keys(opened: DataFrame, dim: DataFrame) -> DataFrame:
    return assign_keys(opened, F.col(KEY), "customer_key", after=dim).select(COLUMNS)


def _numbered_copies(batch: DataFrame) -> DataFrame:
    """Every row of the batch, equal ones told apart by ``_copy``.

    Equal rows are counted before the shuffle and written out again in runs,
    spread by run, so that a row repeated very often stays in no one task.
    """
    columns = [KEY, *CUSTOMER_ATTRIBUTES]
    counted = batch.filter(F.col(KEY).isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    last_run = F.floor((F.col("_n") - 1) / RUN)
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), last_run)))
    first = F.col("_run") * RUN + 1
    last = F.least(F.col("_n"), first + RUN - 1)
    return runs.repartition(*columns, "_run").select(
        *columns, F.explode(F.sequence(first, last)).alias("_copy")
    )


def insert_all(dim: DataFrame, batch: DataFrame, at: str) -> DataFrame:
    """Open a version for every batch row, repeated rows too, whether or not it changes anything."""
    copies = _numbered_copies(batch)
    natural = F.to_json(F.struct(KEY, *CUSTOMER_ATTRIBUTES, "_copy"), {"ignoreNullFields": "false"})
    keyed = assign_keys(
        copies.select("*", natural.alias("_row")), F.col("_row"), "customer_key", after=dim
    )
    return dim.select(COLUMNS).unionByName(_opened(keyed, at, "customer_key").select(COLUMNS))


def insert_changed(dim: DataFrame, batch: DataFrame, at: str) -> DataFrame:
    """Open a version for new customers and for those without an equal current version."""
    rows = latest(batch)
    current = dim.filter("is_current").select(KEY, *CUSTOMER_ATTRIBUTES).alias("c")
    same = [F.col(f"b.{KEY}") == F.col(f"c.{KEY}")]
    same += [F.col(f"b.{a}").eqNullSafe(F.col(f"c.{a}")) for a in CUSTOMER_ATTRIBUTES]
    opened = _opened(rows.alias("b").join(current, same, "left_anti"), at)
    return dim.select(COLUMNS).unionByName(_with_keys(opened, dim))


def initial(batch: DataFrame, at: str) -> DataFrame:
    """The first load: every customer of the batch as a current version."""
    opened = _opened(latest(batch), at)
    return assign_keys(opened, F.col(KEY), "customer_key").select(COLUMNS)


def changes(dim: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch rows that open a version, beside the current version they end, if any.

    Both sides hold a customer once, so no key is hot.
    """
    current = dim.filter("is_current").select(COLUMNS)
    return (
        _incoming(latest(batch))
        .join(current, KEY, "left")
        .filter(F.col("customer_key").isNull() | _change(null_safe=True))
    )


def closed_by(changed_rows: DataFrame, at: str) -> DataFrame:
    """The versions ended by ``changes``."""
    return (
        changed_rows.filter("customer_key IS NOT NULL")
        .withColumns({"end_date": ntz(at), "is_current": F.lit(False)})
        .select(COLUMNS)
    )


def opened_by(changed_rows: DataFrame, dim: DataFrame, at: str) -> DataFrame:
    """The versions opened by ``changes``, numbered behind the keys of ``dim``."""
    fresh = changed_rows.select(KEY, *[_new(a).alias(a) for a in CUSTOMER_ATTRIBUTES])
    return _with_keys(_opened(fresh, at), dim)


def kept_by(changed_rows: DataFrame, dim: DataFrame) -> DataFrame:
    """The versions that ``changes`` leaves alone: history, and current ones it does not end."""
    ended = changed_rows.select("customer_key").filter("customer_key IS NOT NULL")
    return dim.join(ended, "customer_key", "left_anti").select(COLUMNS)


def step(dim: DataFrame, batch: DataFrame, at: str, staged: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Versions kept, closed and opened by one batch at one point in time.

    One join classifies; its rows, only those that change something, are stored at
    ``staged``, because three tables follow from them. The dimension is read for that
    join and for what is kept, and its greatest key is looked up.
    """
    changes(dim, batch).write.parquet(staged)
    changed_rows = dim.sparkSession.read.parquet(staged)
    return kept_by(changed_rows, dim), closed_by(changed_rows, at), opened_by(changed_rows, dim, at)


def apply(dim: DataFrame, batch: DataFrame, at: str) -> DataFrame:
    """Close and insert one batch; applying it again changes nothing."""
    kept, closed, opened = step(dim, batch, at, fresh_path(dim.sparkSession, "changes"))
    return kept.unionByName(closed).unionByName(opened)


def apply_literal(dim: DataFrame, batch: DataFrame, at: str) -> DataFrame:
    """Null-unsafe close, then a version for every row: not idempotent, kept for comparison."""
    return insert_all(close(dim, batch, at, null_safe=False), batch, at)


def change_summary(dim: DataFrame, batch: DataFrame) -> DataFrame:
    """Customers per class: new, changed, unchanged, or absent from the batch (and kept)."""
    status = (
        F.when(F.col("customer_key").isNull(), "new")
        .when(F.col("_arrived").isNull(), "absent")
        .when(_change(null_safe=True), "changed")
        .otherwise("unchanged")
    )
    matched = dim.filter("is_current").join(_incoming(latest(batch)), KEY, "full")
    return matched.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("customers"))


def history(snapshots: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """All versions from many daily snapshots (column ``batch_date``) in one pass.

    Snapshots shrink to one row per customer and day first, so a window group
    holds at most as many rows as there are batches.
    """
    daily = latest_per_key(snapshots, order, (KEY, "batch_date"))
    by_day = W.partitionBy(KEY).orderBy("batch_date")
    is_first = F.col("_previous").isNull()
    differs = changed((F.col(a), F.col(f"_previous.{a}")) for a in CUSTOMER_ATTRIBUTES)
    starts = (
        daily.withColumn("_previous", F.lag(F.struct(*CUSTOMER_ATTRIBUTES)).over(by_day))
        .filter(is_first | differs)
        .withColumn("_next", F.lead("batch_date").over(by_day))
    )
    versions = starts.select(
        KEY, *CUSTOMER_ATTRIBUTES,
        F.col("batch_date").cast("timestamp_ntz").alias("effective_date"),
        F.col("_next").cast("timestamp_ntz").alias("end_date"),
        F.col("_next").isNull().alias("is_current"),
    )
    return assign_keys(
        versions, natural_key(KEY, "effective_date"), "customer_key"
    ).select(COLUMNS)
