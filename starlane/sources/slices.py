"""Input of one run date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.functions.dates import batch_day


def dated_path(template: str, ds: str) -> str:
    """``rentals_{ds}.json`` and the like, filled with a checked run date."""
    batch_day(ds)
    return template.format(ds=ds)


def batch_slice(rows: DataFrame, ds: str) -> DataFrame:
    """The rows of one day; over ``batch_date=...`` folders only that folder is read."""
    return rows.filter(F.col("batch_date") == F.lit(batch_day(ds)).cast("date"))
