"""Counts, reconciliation and month-coverage gaps over the lake."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightmarts.functions.months import data_month, month_of, month_sequence


def rows_by_month(flights: DataFrame) -> DataFrame:
    """Rows per (year, month) (A11, A13); a partial count per task, then one shuffle."""
    return flights.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


def rows_by_month_running(flights: DataFrame) -> DataFrame:
    """Rows per month with the running total in month order.

    The window has no partition key, but it runs over the aggregated months
    only (one row per month: a few hundred rows for decades of data), never
    over legs.
    """
    per_month = rows_by_month(flights)
    w = Window.orderBy("year", "month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_month.withColumn("running_rows", F.sum("rows").over(w))


def reconciliation(spark: SparkSession, rows_in: int, rows_out: int) -> DataFrame:
    """Rows in / out / dropped of a clean run as a one-row frame.

    ``rows_in`` comes from an ``Observation`` on the raw scan during the write,
    ``rows_out`` from the written lake, so the raw files are read once.
    """
    return spark.range(1).select(
        F.lit(int(rows_in)).cast("long").alias("rows_in"),
        F.lit(int(rows_out)).cast("long").alias("rows_out"),
        F.lit(int(rows_in) - int(rows_out)).cast("long").alias("dropped"),
    )


def month_bounds(flights: DataFrame) -> tuple[dt.date, dt.date] | None:
    """First and last month present (one small aggregate, two dates to the driver)."""
    key = month_of("year", "month")
    row = flights.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if row is None or row["lo"] is None:
        return None
    return row["lo"], row["hi"]


BITMAP_MONTHS = 60  # months in one bitmap, a long


def _month_number(year: Column, month: Column) -> Column:
    return year * 12 + month - 1


def coverage(flights: DataFrame, grain: list[str]) -> DataFrame:
    """(entity, block, bits): the months that an entity has rows in, as bitmaps of 60 months.

    A hash aggregate with a fixed-size buffer (``bit_or`` of a long), reduced per task;
    no month is shuffled more than once per task, entity and block. Coverages merge."""
    number = _month_number(F.col("year"), F.col("month"))
    bit = F.expr(f"shiftleft(1L, cast(pmod(year * 12 + month - 1, {BITMAP_MONTHS}) as int))")
    return flights.groupBy(*grain, F.floor(number / BITMAP_MONTHS).cast("int").alias("block")).agg(F.bit_or(bit).alias("bits"))


def merge_coverage(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The coverage of all rows together, from coverages of parts of them."""
    every = first
    for other in others:
        every = every.unionByName(other)
    grain = [c for c in first.columns if c not in ("block", "bits")]
    return every.groupBy(*grain, "block").agg(F.bit_or("bits").alias("bits"))


def coverage_gaps(covered: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """(entity, year, month) of the months from ``first`` to ``last`` without a bit.

    Per entity one small map of its blocks; the rest is bit arithmetic, and only gaps
    become rows."""
    grain = [c for c in covered.columns if c not in ("block", "bits")]
    lo, hi = (d.year * 12 + d.month - 1 for d in (first, last))
    wanted = []  # (block, the bits of the calendar in it): a constant per 60 months
    for block in range(lo // BITMAP_MONTHS, hi // BITMAP_MONTHS + 1):
        at = range(max(lo, block * BITMAP_MONTHS), min(hi, block * BITMAP_MONTHS + BITMAP_MONTHS - 1) + 1)
        wanted.append((block, sum(1 << (m % BITMAP_MONTHS) for m in at)))
    calendar = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(bits).cast("long").alias("calendar")) for b, bits in wanted])
    own = covered.groupBy(*grain).agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("own"))
    open_bits = own.select(*grain, "own", F.inline(calendar)).select(
        *grain, "block", F.expr("calendar & ~coalesce(try_element_at(own, block), 0L)").alias("open")
    ).where("open != 0")
    places = F.filter(F.sequence(F.lit(0), F.lit(BITMAP_MONTHS - 1)), lambda i: F.getbit("open", i) == 1)
    gaps = open_bits.select(*grain, "block", F.explode(places).alias("place")).withColumn("number", F.col("block") * BITMAP_MONTHS + F.col("place"))
    return gaps.select(*grain, F.floor(F.col("number") / 12).cast("int").alias("year"), (F.pmod("number", F.lit(12)) + 1).cast("int").alias("month"))


def missing_months(flights: DataFrame, grain: list[str]) -> DataFrame:
    """(entity, year, month) with no rows between the lake's first and last month."""
    bounds = month_bounds(flights.select("year", "month"))
    covered = coverage(flights.select(*grain, "year", "month"), grain)
    if bounds is None:
        return covered.where(F.lit(False)).select(*grain, F.lit(0).alias("year"), F.lit(0).alias("month"))
    return coverage_gaps(covered, *bounds)


def requested_months_missing(spine: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested (year, month) minus those already landed: skip-if-present."""
    return spine.join(landed.select("year", "month").distinct(), ["year", "month"], "left_anti")


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive (year, month) rows for ``'YYYY-MM'`` bounds; start after end fails."""
    s = F.to_date(F.lit(start + "-01"))
    e = F.to_date(F.lit(end + "-01"))
    return (
        spark.range(1)
        .select(F.explode(month_sequence(s, e)).alias("m"))
        .select(F.year("m").alias("year"), F.month("m").alias("month"))
    )


def data_month_slice(flights: DataFrame, run_date: dt.date) -> DataFrame:
    """Lake rows owned by the run on ``run_date`` (data month = run month - 2),
    counted by carrier (T2, P13).

    The month is a constant expression, folded by the optimizer, so the filter
    on ``year``/``month`` prunes the lake down to that one partition.
    """
    m = data_month(F.lit(run_date))
    return (
        flights.where((F.col("year") == F.year(m)) & (F.col("month") == F.month(m)))
        .groupBy("year", "month", "carrier_code")
        .agg(F.count(F.lit(1)).alias("flights"))
    )
