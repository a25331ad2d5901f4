"""Column expressions: exact rounding, flags, month arithmetic."""

from flightmarts.functions.exact import exact_ratio, scaled_long, unscale
from flightmarts.functions.flags import flag_to_bool, is_on_time, is_reportable_arrival
from flightmarts.functions.months import (
    data_month,
    freshness_floor,
    month_of,
    month_sequence,
    month_start,
)

__all__ = [
    "exact_ratio",
    "scaled_long",
    "unscale",
    "flag_to_bool",
    "is_on_time",
    "is_reportable_arrival",
    "data_month",
    "freshness_floor",
    "month_of",
    "month_sequence",
    "month_start",
]
