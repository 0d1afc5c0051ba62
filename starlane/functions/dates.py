"""Date expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_GIVEN = "NA"


def iso_date(text: Column) -> Column:
    """ISO text to DATE; malformed text gives NULL instead of failing the job."""
    return text.try_cast("date")


def days_between(start: Column, end: Column) -> Column:
    """end - start in days; zero and negative spans are kept as they are."""
    return F.datediff(end, start)


def date_key(day: Column) -> Column:
    """The yyyymmdd smart key of a DATE."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def yyyymmdd(day: Column) -> Column:
    """A DATE or time-zone-free timestamp as 'yyyymmdd' text."""
    return F.replace(day.cast("date").cast("string"), F.lit("-"), F.lit(""))


def run_date(param: Column, scheduled: Column) -> Column:
    """The run date of a batch: the parameter unless it is 'NA', else the schedule day."""
    return F.when(param != NOT_GIVEN, param).otherwise(yyyymmdd(scheduled))


def resolve_run_date(param: str, scheduled: str) -> str:
    """``run_date`` for a single run; ``scheduled`` is an ISO day."""
    return param if param != NOT_GIVEN else scheduled.replace("-", "")


def batch_day(ds: str) -> str:
    """'20250903' -> '2025-09-03'; an error unless it is a day of the calendar."""
    if len(ds) != 8 or not ds.isdigit():
        raise ValueError(f"run date must be yyyymmdd, got {ds!r}")
    return datetime.strptime(ds, "%Y%m%d").date().isoformat()


def ntz(text: str) -> Column:
    """A timestamp literal without time zone."""
    return F.lit(text).cast("timestamp_ntz")
