"""The fact build: validate, derive, look up, project."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from starlane.operators import lookups
from starlane.operators.rentals import dated, flatten, valid, with_measures
from starlane.schemas import DATED_FACT, RENTALS_FACT
from starlane.sinks.tables import conform


def _customer_key(rows: DataFrame, customer_dim: DataFrame, rule: str, **options) -> DataFrame:
    match rule:
        case "current":
            return lookups.customer_current(rows, customer_dim)
        case "all_versions":
            return lookups.customer_all_versions(rows, customer_dim)
        case "as_of":
            return lookups.customer_as_of(rows, customer_dim, **options)
    raise ValueError(f"unknown customer rule {rule!r}")


def build_fact(
    rentals: DataFrame, dims: Mapping[str, DataFrame], customer: str = "current", **options
) -> DataFrame:
    """Raw nested rentals to fact rows; a ``batch_date`` column is kept behind them.

    ``customer`` is the version rule: ``current``, ``all_versions`` or ``as_of``.
    The car lookup drops rows and comes first. The customer lookup is the one that
    shuffles at scale; location names are keys by then, and the measures and date keys follow,
    so that no measure is shuffled and the as-of rule finds its dates.
    """
    rows = lookups.car_key(dated(flatten(valid(rentals))), dims["car_dim"])
    rows = lookups.location_keys(rows, dims["location_dim"])
    if customer == "as_of" and "spread" not in options:
        options["spread"] = lookups.spread_customers(rentals)
    rows = _customer_key(rows, dims["customer_dim"], customer, **options)
    rows = lookups.date_keys(with_measures(rows), dims["date_dim"])
    return conform(rows, DATED_FACT if "batch_date" in rentals.columns else RENTALS_FACT)
