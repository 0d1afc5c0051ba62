"""Rental measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: rentals of more than this many days are long.
LONG_RENTAL_DAYS = 7


def money(value: Column) -> Column:
    """Exact cents, so that a sum does not depend on the order of its rows.

    NULL for what has no cents in 26 digits; ``too_great`` tells.
    """
    return value.try_cast("decimal(28,2)")


def too_great(value: Column) -> Column:
    """An amount that no sum of cents can hold."""
    return value.isNotNull() & money(value).isNull()


def round_cents(value: Column) -> Column:
    """Half-up on the decimal digits; equal in every engine.

    A value too great for the decimal type has no cents and stays as it is.
    """
    return F.coalesce(F.round(value.try_cast("decimal(28,6)"), 2).cast("double"), value)


def total_amount(amount: Column, quantity: Column) -> Column:
    return amount * quantity


def average_daily_amount(total: Column, days: Column) -> Column:
    """NULL for a rental of zero days."""
    return round_cents(F.try_divide(total, days))


def is_long(days: Column) -> Column:
    """An unknown duration is not long."""
    return F.when(days > LONG_RENTAL_DAYS, True).otherwise(False)
