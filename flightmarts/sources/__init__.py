"""Readers: raw all-string CSV, Parquet lake, seed lookups, test-table bridge."""

from flightmarts.functions.months import month_filter
from flightmarts.sources.lake import read_lake, read_lake_files
from flightmarts.sources.raw import month_raw_path, read_raw
from flightmarts.sources.seeds import cancellation_codes, carriers, read_seed

__all__ = [
    "read_lake",
    "read_lake_files",
    "month_filter",
    "month_raw_path",
    "read_raw",
    "cancellation_codes",
    "carriers",
    "read_seed",
]
