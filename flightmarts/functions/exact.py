"""Exact HALF_UP rounding of ratios and averages.

Rounding a double HALF_UP is engine-dependent (Spark rounds the shortest
decimal form, other engines the binary value), so every KPI ratio is computed
from whole numbers: measures are summed as scaled ``long``s and the final
quotient is taken in ``decimal(18,0) / decimal(18,0)`` (scale 19, no precision
loss), rounded HALF_UP, then cast to double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Measures (minutes) are summed at this many decimals; the on-time data holds
# whole minutes, and a finer input fails instead of being rounded.
MEASURE_SCALE = 2


def scaled_long(col: Column | str, scale: int = MEASURE_SCALE) -> Column:
    """``col * 10^scale`` as a ``long``; NULL stays NULL, a finer value fails the job."""
    c = F.col(col) if isinstance(col, str) else col
    scaled = c * (10**scale)
    whole = F.round(scaled)
    message = F.concat(F.lit(f"measure is finer than {scale} decimals: "), c.cast("string"))
    return F.when(F.abs(scaled - whole) > 1e-6, F.raise_error(message).cast("long")).otherwise(whole.cast("long"))


def unscale(total: Column | str, scale: int = MEASURE_SCALE) -> Column:
    """Scaled ``long`` sum back to a double (``k / 10^scale``)."""
    c = F.col(total) if isinstance(total, str) else total
    return (c.cast("double") / float(10**scale)).cast("double")


def exact_ratio(num: Column, den: Column, digits: int) -> Column:
    """``round(num / den, digits)`` HALF_UP on the exact value, as double.

    ``num`` and ``den`` must be whole-number columns (counts or scaled sums).
    A zero or NULL denominator gives NULL instead of a division error.
    """
    n = num.cast("decimal(18,0)")
    d = F.nullif(den, F.lit(0)).cast("decimal(18,0)")
    return F.round(n / d, digits).cast("double")
