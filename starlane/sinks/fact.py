"""Writing the fact, in a folder per ``batch_date``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starlane.functions.dates import batch_day


def _by_day(fact: DataFrame, together: bool) -> DataFrame:
    # Many days at once: bring each day together, so that not every task writes
    # a file per day. Spark splits a day that is too big for one task.
    return fact.hint("rebalance", "batch_date") if together else fact


def append_fact(fact: DataFrame, path: str, one_day: bool = False) -> None:
    """Blind append: running a day twice stores it twice."""
    _by_day(fact, not one_day).write.mode("append").partitionBy("batch_date").parquet(path)


def replace_days(fact: DataFrame, path: str, one_day: bool = False, together: bool = True) -> None:
    """Replace the days present in ``fact`` and leave all others: safe to repeat.

    Without ``together`` the rows stay in the tasks that made them, which saves a shuffle and writes up to a
    file per task and day.
    """
    (
        _by_day(fact, together and not one_day).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("batch_date").parquet(path)
    )


def replace_day(fact: DataFrame, path: str, ds: str) -> None:
    """Replace one day as a whole, also by nothing."""
    day = f"{path}/batch_date={batch_day(ds)}"
    fact.drop("batch_date").write.mode("overwrite").parquet(day)
