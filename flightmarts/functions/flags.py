"""Boolean flags and the shared arrival definitions (three-valued logic)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.functions.strict import strict_cast


def flag_to_bool(col: Column | str) -> Column:
    """Source flags ``"1.00"``/``"0.00"`` to boolean.

    Empty or NULL stays NULL (unknown, never false); ``1.00`` is true and every
    other number false. The cast is strict: a non-numeric flag fails the job.
    """
    return strict_cast(col, T.DoubleType()) == F.lit(1.0)


def is_reportable_arrival(
    cancelled: str = "cancelled", diverted: str = "diverted", arr_delay: str = "arr_delay_min"
) -> Column:
    """Flown and arrived with a delay value: ``not c and not d and arr not null``."""
    return ~F.col(cancelled) & ~F.col(diverted) & F.col(arr_delay).isNotNull()


def is_on_time(reportable: Column, arr_delayed_15: str = "arr_delayed_15") -> Column:
    """``not arr_delayed_15`` for reportable arrivals, otherwise NULL."""
    return F.when(reportable, ~F.col(arr_delayed_15))
