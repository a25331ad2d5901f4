"""Month arithmetic as column expressions (data months, spines, freshness)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: publication lag of the source and freshness allowance
PUBLICATION_LAG_MONTHS = 2
FRESHNESS_MONTHS = 4


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(date: Column | str) -> Column:
    """First day of the month as DATE (``trunc`` keeps the date type)."""
    return F.trunc(_col(date), "MM")


def month_of(year: Column | str, month: Column | str) -> Column:
    """DATE of the first day of ``year``/``month`` integer columns."""
    return F.make_date(_col(year), _col(month), F.lit(1))


def month_sequence(start: Column, end: Column) -> Column:
    """Inclusive array of month starts; start after end raises an error."""
    s, e = month_start(start), month_start(end)
    return F.when(s > e, F.raise_error(F.lit("month range: start is after end"))).otherwise(
        F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))
    )


def data_month(run_date: Column | str) -> Column:
    """Data month owned by a run: first of (run month - publication lag)."""
    return F.add_months(month_start(run_date), -PUBLICATION_LAG_MONTHS)


def freshness_floor(as_of: Column | str) -> Column:
    """Newest month must be at least the first of (as_of month - 4)."""
    return F.add_months(month_start(as_of), -FRESHNESS_MONTHS)


def month_numbers(start: str, end: str) -> list[tuple[int, int]]:
    """All (year, month) from one ``'YYYY-MM'`` argument to another, both included."""
    first, last = (12 * y + m - 1 for y, m in (year_month(start), year_month(end)))
    if first > last:
        raise ValueError(f"empty month range: {start} to {end}")
    return [(n // 12, n % 12 + 1) for n in range(first, last + 1)]


def year_month(text: str) -> tuple[int, int]:
    """Driver-side parse of a ``'YYYY-MM'`` argument (validated)."""
    d = dt.datetime.strptime(text + "-01", "%Y-%m-%d").date()
    return d.year, d.month


def month_filter(months: Iterable[tuple[int, int]]) -> Column:
    """Predicate on the partition columns only, so the scan prunes folders.

    Plain equalities on ``year`` and ``month``, which a catalog can evaluate too.
    """
    by_year: dict[int, list[int]] = {}
    for y, m in sorted({(int(y), int(m)) for y, m in months}):
        by_year.setdefault(y, []).append(m)
    out = F.lit(False)
    for y, own in by_year.items():
        out = out | ((F.col("year") == y) & F.col("month").isin(own))
    return out
