"""Staging projection and the shared enrichment (lookups + business flags)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.functions.flags import is_on_time, is_reportable_arrival
from flightmarts.functions.months import month_start
from flightmarts.schema import FLIGHT_COLUMNS

ENRICHED_EXTRA = [
    "carrier_name",
    "cancellation_reason",
    "month_start",
    "is_reportable_arrival",
    "is_on_time",
]
ENRICHED_COLUMNS = FLIGHT_COLUMNS + ENRICHED_EXTRA


def staging_column(name: str) -> Column:
    """The staging expression of one column over the raw relation."""
    if name == "cancellation_code":
        return F.nullif(F.col(name), F.lit(""))
    return F.col(name)


def stage(flights: DataFrame) -> DataFrame:
    """Explicit 34-column staging projection; ``''`` cancellation code -> NULL.

    The list is explicit so a new raw column (or the load audit column) cannot
    leak downstream.
    """
    return flights.select(*[staging_column(c).alias(c) for c in FLIGHT_COLUMNS])


def enrich(staged: DataFrame, carriers: DataFrame, cancellation_codes: DataFrame) -> DataFrame:
    """Join the two lookups (left, broadcast) and derive the shared flags.

    Unknown carrier codes survive with their code as name; a NULL cancellation
    code never matches. The built-in seeds carry a broadcast hint (their size
    is fixed in code); file-backed lookups are broadcast by the planner only
    under its size threshold, and joined through a shuffle beyond it.
    """
    codes = cancellation_codes.select("cancellation_code", "cancellation_reason")
    joined = with_carrier_name(staged, carriers).join(codes, "cancellation_code", "left")
    return with_flags(joined).select(*ENRICHED_COLUMNS)


def with_carrier_name(rows: DataFrame, carriers: DataFrame) -> DataFrame:
    """Adds ``carrier_name`` to rows with a ``carrier_code``; an unknown code is its own name."""
    names = carriers.select("carrier_code", F.col("carrier_name").alias("_carrier_name"))
    named = rows.join(names, "carrier_code", "left")
    return named.withColumn("carrier_name", F.coalesce("_carrier_name", "carrier_code")).drop("_carrier_name")


def with_flags(flights: DataFrame) -> DataFrame:
    """Adds the month and the shared arrival flags; needs no lookup."""
    reportable = is_reportable_arrival()
    return flights.withColumns(
        {
            "month_start": month_start("flight_date"),
            "is_reportable_arrival": reportable,
            "is_on_time": is_on_time(reportable),
        }
    )
