"""Lake and raw-table writes: partitioned, month-scoped, idempotent.

All writes go through ``DataFrameWriter`` with ``partitionBy("year", "month")``.
Writes of data not yet laid out by month (cleaned raw rows) first ``rebalance``
on the same columns, so each month lands together while AQE still splits an
oversized month into several tasks (no ``coalesce(1)`` single-task writes);
copies out of the lake are map-only. Row counts and the set of months
written are collected by an ``Observation`` during the write itself: no
second scan of the input, no cache.

A lake or raw table made with ``commits=True`` is a ``committed.MonthTable``: every write
below then becomes visible in one step, and the readers resolve its newest version.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.jobs import month_writes, run_concurrently
from flightmarts.schema import (
    DATA_COLUMNS,
    FLIGHT_SCHEMA,
    LAKE_DATA_SCHEMA,
    PARTITION_COLUMNS,
    VARCHAR_LENGTHS,
)
from flightmarts.committed import MonthTable, is_committed, only_months
from flightmarts.functions.months import month_filter
from flightmarts.sources.seeds import literal_frame

# Upper bound of rows per Parquet file; a month of ~600K legs is one file,
# a bigger one is split instead of growing without bound.
MAX_RECORDS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class WriteReport:
    rows: int
    months: list[tuple[int, int]]
    emptied: list[tuple[int, int]]


def _observe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        # bounded by the number of months in the input (hundreds at most)
        F.collect_set(F.col("year") * 100 + F.col("month")).alias("months"),
    )
    return observed, obs


def _writer(df: DataFrame, mode: str, dynamic: bool, rebalance: bool = True):
    """Partitioned Parquet writer.

    ``rebalance`` shuffles rows by month first so each month lands in few,
    well-sized files; inputs already laid out by month (reads of the lake)
    skip it, so copying the lake is a map-only job without a shuffle.
    """
    if rebalance:
        df = df.hint("rebalance", *PARTITION_COLUMNS)
    w = (
        df.write.mode(mode)
        .partitionBy(*PARTITION_COLUMNS)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", "snappy")
    )
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    else:
        w = w.option("partitionOverwriteMode", "static")
    return w


def _report(obs: Observation, emptied: list[tuple[int, int]] | None = None) -> WriteReport:
    got = obs.get
    months = sorted((k // 100, k % 100) for k in (got.get("months") or []))
    return WriteReport(rows=int(got.get("rows") or 0), months=months, emptied=emptied or [])


def _committed(df: DataFrame, root: str, schema: T.StructType, months, rebalance: bool = True) -> WriteReport:
    rows, written, emptied = MonthTable(df.sparkSession, root, schema).commit(df, months, rebalance)
    return WriteReport(rows, written, emptied)


def write_lake(flights: DataFrame, root: str, commits: bool = False, rebalance: bool = True) -> WriteReport:
    """Full overwrite of the lake, partitioned by year/month (K1, K4). Rows that are dealt by
    month already (``clean_for_months``) need no ``rebalance``."""
    if commits or is_committed(flights.sparkSession, root):
        return _committed(flights, root, FLIGHT_SCHEMA, None, rebalance)
    observed, obs = _observe(flights.select(*DATA_COLUMNS, *PARTITION_COLUMNS), "write_lake")
    with month_writes(observed.sparkSession):
        _writer(observed, "overwrite", dynamic=False, rebalance=rebalance).parquet(root)
    return _report(obs)


def overwrite_months(
    flights: DataFrame, root: str, months: Iterable[tuple[int, int]] | None = None, rebalance: bool = True
) -> WriteReport:
    """Replace exactly ``months`` (default: those present in ``flights``; K2/K5).

    Other months are untouched, so re-running a month is idempotent. A row outside
    ``months`` fails the job before anything is replaced: the commit comes after
    all tasks, so the lake stays as it was. Dynamic overwrite cannot express "this
    month is now empty": every month listed in ``months`` that had no rows is
    therefore replaced by an empty partition explicitly, which is a second step; a
    committed table takes both in one.
    """
    if is_committed(flights.sparkSession, root):
        if months is None:
            raise ValueError("name the months to replace in a committed table")
        return _committed(flights, root, FLIGHT_SCHEMA, months, rebalance)
    rows = flights.select(*DATA_COLUMNS, *PARTITION_COLUMNS)
    if months is not None:
        months = list(months)
        rows = only_months(rows, months)
    observed, obs = _observe(rows, "overwrite_months")
    with month_writes(observed.sparkSession):
        _writer(observed, "overwrite", dynamic=True, rebalance=rebalance).parquet(root)
    report = _report(obs)
    emptied = sorted(set(months or []) - set(report.months))
    empty_months(literal_frame(flights.sparkSession, [], LAKE_DATA_SCHEMA), root, emptied)
    return WriteReport(rows=report.rows, months=report.months, emptied=emptied)


def empty_months(empty: DataFrame, root: str, months: Iterable[tuple[int, int]]) -> None:
    empty_partitions(empty, [f"{root.rstrip('/')}/year={y}/month={m}" for y, m in months])


def empty_partitions(empty: DataFrame, paths: list[str]) -> None:
    """Replace partitions by ones without rows (tiny independent jobs, submitted together)."""

    def write(path: str):
        return lambda: empty.write.mode("overwrite").parquet(path)

    run_concurrently({p: write(p) for p in paths})


def with_audit(flights: DataFrame) -> DataFrame:
    """Add the load audit column ``_loaded_at`` (TIMESTAMP_NTZ, K7)."""
    return flights.withColumn("_loaded_at", F.current_timestamp().cast("timestamp_ntz"))


def enforce_lengths(flights: DataFrame, lengths: dict[str, int] = VARCHAR_LENGTHS) -> DataFrame:
    """Fail the write if any string exceeds its ``VARCHAR(n)`` bound (K8).

    The check is an inline ``raise_error`` per bounded column: no extra scan,
    the job fails on the first too-long value.
    """
    out = []
    for c in flights.columns:
        if c in lengths:
            n = lengths[c]
            out.append(
                F.when(
                    F.char_length(F.col(c)) > n,
                    F.raise_error(F.concat(F.lit(f"value too long for {c} VARCHAR({n}): "), F.col(c))),
                )
                .otherwise(F.col(c))
                .alias(c)
            )
        else:
            out.append(F.col(c))
    return flights.select(*out)


RAW_SCHEMA = T.StructType([*LAKE_DATA_SCHEMA, T.StructField("_loaded_at", T.TimestampNTZType()), *[FLIGHT_SCHEMA[c] for c in PARTITION_COLUMNS]])


def read_raw_table(spark: SparkSession, raw_root: str) -> DataFrame:
    """The raw table with its fixed schema (no inference job, no drift)."""
    if is_committed(spark, raw_root):
        return MonthTable(spark, raw_root, RAW_SCHEMA).read()
    return spark.read.schema(RAW_SCHEMA).parquet(raw_root)


def _bounded(lake: DataFrame, lengths: dict[str, int] | None) -> DataFrame:
    df = lake.select(*DATA_COLUMNS, *PARTITION_COLUMNS)
    return with_audit(enforce_lengths(df, lengths) if lengths else df)


def load_full(
    lake: DataFrame, raw_root: str, lengths: dict[str, int] | None = VARCHAR_LENGTHS, commits: bool = False
) -> WriteReport:
    """Truncate-and-load the raw table from the whole lake (K4, K7, K8).

    The lake is already laid out by month, so the copy is map-only (no shuffle).
    ``lengths`` are the table's VARCHAR bounds: a longer value aborts the load,
    as a bounded warehouse table would. ``None`` loads values as they are.
    """
    df = _bounded(lake, lengths)
    if commits or is_committed(lake.sparkSession, raw_root):
        return _committed(df, raw_root, RAW_SCHEMA, None, rebalance=False)
    observed, obs = _observe(df, "load_full")
    with month_writes(observed.sparkSession):
        _writer(observed, "overwrite", dynamic=False, rebalance=False).parquet(raw_root)
    return _report(obs)


def load_months(
    lake: DataFrame,
    raw_root: str,
    months: Iterable[tuple[int, int]],
    lengths: dict[str, int] | None = VARCHAR_LENGTHS,
) -> WriteReport:
    """Reload some months of the raw table in one write (K5): the months'
    partitions are replaced whole, so a re-run never duplicates and never
    leaves a month half-deleted. In a committed table the emptied months go in the same step."""
    months = list(months)
    df = _bounded(lake.where(month_filter(months)), lengths)
    if is_committed(lake.sparkSession, raw_root):
        return _committed(df, raw_root, RAW_SCHEMA, months, rebalance=False)
    observed, obs = _observe(df, "load_months")
    with month_writes(observed.sparkSession):
        _writer(observed, "overwrite", dynamic=True, rebalance=False).parquet(raw_root)
    report = _report(obs)
    emptied = sorted(set(months) - set(report.months))
    empty_months(with_audit(literal_frame(lake.sparkSession, [], LAKE_DATA_SCHEMA)), raw_root, emptied)
    return WriteReport(rows=report.rows, months=report.months, emptied=emptied)


def raw_table_ddl(name: str, location: str, lengths: dict[str, int] = VARCHAR_LENGTHS) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for the raw table: VARCHAR bounds, audit column,
    partitioned by year/month, stored as Parquet at ``location`` (K8, S6)."""
    cols = []
    for f in FLIGHT_SCHEMA.fields:
        if f.name in PARTITION_COLUMNS:
            continue
        sql_type = f"VARCHAR({lengths[f.name]})" if f.name in lengths else f.dataType.simpleString().upper()
        cols.append(f"  `{f.name}` {sql_type}")
    cols.append("  `_loaded_at` TIMESTAMP_NTZ")
    cols += ["  `year` INT", "  `month` INT"]
    body = ",\n".join(cols)
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n{body}\n) USING parquet "
        f"PARTITIONED BY (year, month) LOCATION '{location}'"
    )


def declare_raw_table(spark, name: str, location: str, lengths: dict[str, int] = VARCHAR_LENGTHS):
    """Create the raw table in the catalog if absent and register the month
    partitions present at its location; returns ``spark.table(name)``.

    Inserts through the catalog (``insertInto``/``INSERT``) enforce the VARCHAR
    bounds natively (a too-long value fails with ``EXCEED_LIMIT_LENGTH``).
    """
    spark.sql(raw_table_ddl(name, location, lengths))
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)
