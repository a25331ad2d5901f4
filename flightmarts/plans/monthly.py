"""The monthly run as one driver program: clean -> lake -> raw table -> marts ->
checks -> gate -> export.

DataFrames are passed by reference; only check/gate result rows and month
lists reach the driver. Marts are written as tables (Parquet) and read back,
so checks, gate and export work on the small materialised marts instead of
recomputing the legs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.jobs import run_concurrently
from flightmarts.operators import checks as C
from flightmarts.operators import gate as G
from flightmarts.operators import marts as M
from flightmarts.operators.clean import clean_for_months, plan_by_size
from flightmarts.operators.enrich import stage, with_flags
from flightmarts.operators.reconcile import month_spine, requested_months_missing, rows_by_month
from flightmarts.schema import VARCHAR_LENGTHS
from flightmarts.sinks.export import write_export
from flightmarts.sinks.lake import empty_partitions, load_months, overwrite_months, read_raw_table, write_lake
from flightmarts.sources import seeds
from flightmarts.committed import exists
from flightmarts.functions.months import month_filter, month_numbers, year_month
from flightmarts.sources.lake import read_lake
from flightmarts.sources.raw import month_raw_path, raw_size, read_raw
from flightmarts.sources.seeds import literal_frame


def materialize(
    spark: SparkSession, frames: dict[str, DataFrame], root: str, months: Iterable[tuple[int, int]] | None = None
) -> dict[str, DataFrame]:
    """Write each frame as a Parquet table under ``root`` and read it back (K9).

    The tables are partitioned by ``month_start``. With ``months`` only the
    partitions of those months are replaced, by the frames' rows of those months.

    Writing is also the lineage cut: downstream checks and gate read files in
    shared storage, not a recomputation, and survive executor loss. The writes
    are independent jobs and are submitted concurrently.
    """
    paths = {name: f"{root.rstrip('/')}/{name}" for name in frames}

    mode = "static" if months is None else "dynamic"
    seen = {name: Observation(f"months_{name}") for name in frames}

    def writer(name: str) -> Callable[[], None]:
        # a month of a mart is small: one file each, whatever the tasks
        dealt = frames[name].hint("rebalance", "month_start").observe(seen[name], F.collect_set("month_start").alias("months"))
        return lambda: dealt.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("month_start").parquet(paths[name])

    run_concurrently({name: writer(name) for name in frames})
    if months is not None:  # months that hold no legs any more lose their old rows
        listed = {dt.date(y, m, 1) for y, m in months}
        for name, df in frames.items():
            empty = literal_frame(spark, [], T.StructType([f for f in df.schema if f.name != "month_start"]))
            stale = [f"{paths[name]}/month_start={d.isoformat()}" for d in sorted(listed - set(seen[name].get["months"] or []))]
            empty_partitions(empty, [p for p in stale if exists(spark, p)])
    return {name: spark.read.schema(df.schema).parquet(paths[name]) for name, df in frames.items()}


def mart_frames(staged: DataFrame, carriers: DataFrame) -> dict[str, DataFrame]:
    """The four marts straight from the staged legs.

    No mart reads the cancellation reason, and only the carrier-month marts read a
    lookup column, so the legs meet no lookup: carriers join the aggregated
    carrier-months (a few thousand rows). That is the enriched grouping as long
    as a code has one name, which the ``unique`` check on the lookup guards.
    """
    flagged = with_flags(staged)
    return {
        "_carrier_month": M.carrier_month_facts(flagged, carriers),
        "fct_route_performance": M.route_performance(flagged),
        "fct_airport_congestion": M.airport_congestion(flagged),
    }


def update_summaries(
    spark: SparkSession, marts: dict[str, DataFrame], suites: dict[str, list[G.Expectation]], root: str, months: Iterable[tuple[int, int]] | None = None
) -> dict[str, DataFrame]:
    """Write the gate's monthly summaries of the marts and read them back.

    With ``months`` only those months of the marts are read and only their summaries
    replaced, so the gate of a changed month costs that month and the summaries."""
    if months is not None:
        months = list(months)
        listed = [dt.date(y, m, 1) for y, m in months]
        marts = {n: t.where(F.col("month_start").isin(listed)) for n, t in marts.items()}
    return materialize(spark, {t: G.summarize(marts[t], e, t) for t, e in suites.items()}, root, months)


def materialize_marts(
    spark: SparkSession, staged: DataFrame, carriers: DataFrame, root: str, months: Iterable[tuple[int, int]] | None = None
) -> dict[str, DataFrame]:
    """Write the four marts as tables; the legs are scanned three times, not four.

    The carrier-month aggregate shared by M2 and M5 is written first (it is
    small: carriers x months) and both marts are projections of the stored
    copy, so neither recomputes the legs. Every mart has the month in its grain, so
    with ``months`` only the legs of those months are read (a partition filter) and
    only those partitions replaced; a changed lookup needs the full form.
    """
    if months is not None:
        months = list(months)
        staged = staged.where(month_filter(months))
    frames = mart_frames(staged, carriers)
    base = materialize(spark, {"_carrier_month": frames.pop("_carrier_month")}, root, months)["_carrier_month"]
    facts = base if months is None else base.where(F.col("month_start").isin([dt.date(y, m, 1) for y, m in months]))
    return materialize(
        spark, {"fct_monthly_otp": M.monthly_otp_from(facts), **frames, "fct_delay_causes": M.delay_causes_from(facts)}, root, months
    )


@dataclass(frozen=True)
class Reconciliation:
    rows_in: int
    rows_out: int
    months: list[tuple[int, int]]
    emptied: list[tuple[int, int]]
    by_month: DataFrame | None = None

    @property
    def dropped(self) -> int:
        return self.rows_in - self.rows_out


def clean_history(
    spark: SparkSession, input_glob: str | list[str], lake_root: str, by_month: bool = False, observe: bool = False
) -> Reconciliation:
    """Full clean: every raw file -> typed, deduplicated lake (static overwrite).

    ``rows_in`` is observed on the raw scan during the write and ``rows_out``
    comes from the write, so the raw files are read once (no second count scan).
    ``by_month=True`` adds the per-month reconciliation; the months are not
    known before the scan, so that costs one more narrow pass over the raw
    files (only ``Year``/``Month`` are materialised), aggregated per month. The legs are
    exchanged once; by default the tasks per month follow from the files' sizes,
    ``observe=True`` measures months and heavy keys first (``operators.clean.observe_skew``).
    """
    obs = Observation("clean_history_in")
    raw = read_raw(spark, input_glob)
    plan = None if observe else plan_by_size(*raw_size(spark, input_glob))
    observed = raw.observe(obs, F.count(F.lit(1)).alias("rows"))
    report = write_lake(clean_for_months(observed, plan, again=raw), lake_root, rebalance=False)
    rows_in = int(obs.get["rows"])
    per_month = None
    if by_month:
        counts = (
            raw.groupBy(F.col("Year").cast("int").alias("year"), F.col("Month").cast("int").alias("month"))
            .agg(F.count(F.lit(1)).alias("rows_in"))
            .collect()  # one row per month
        )
        per_month = month_reconciliation(
            spark, {(r["year"], r["month"]): r["rows_in"] for r in counts}, lake_root
        )
    return Reconciliation(rows_in, report.rows, report.months, [], by_month=per_month)


def backfill(
    spark: SparkSession,
    raw_root: str,
    start: str,
    end: str,
    lake_root: str,
    compressed: bool = True,
    path_of: Callable[[str, int, int], str] | None = None,
    skip_landed: bool = False,
) -> Reconciliation:
    """Clean a range of months in one job (instead of one job per month).

    The inclusive month list is expanded on the driver (a few hundred entries at
    most), the month files are read together, and one dynamic overwrite
    replaces exactly those months; a month whose file is now empty is emptied, and
    a row of any other month fails the job. ``path_of(root, year, month)``
    overrides the raw-zone path rule. ``skip_landed`` leaves out months that the
    lake already holds.
    """
    months = month_numbers(start, end)
    if skip_landed:
        landed = read_lake(spark, lake_root).select("year", "month")
        missing = requested_months_missing(month_spine(spark, start, end), landed)
        months = sorted((r["year"], r["month"]) for r in missing.collect())
        if not months:
            return Reconciliation(0, 0, [], [])
    rule = path_of or (lambda root, y, m: month_raw_path(root, y, m, compressed))
    paths = [rule(raw_root, y, m) for y, m in months]
    obs = Observation("backfill_in")
    ym = F.col("Year").cast("int") * 100 + F.col("Month").cast("int")
    # rows in per month, observed on the same scan: one counter per requested month
    counters = [F.count_if(ym == y * 100 + m).alias(f"m{y * 100 + m}") for y, m in months]
    raw = read_raw(spark, paths).observe(obs, F.count(F.lit(1)).alias("rows"), *counters)
    plan = plan_by_size(raw_size(spark, paths)[0], len(months))
    report = overwrite_months(clean_for_months(raw, plan), lake_root, months, rebalance=False)
    got = obs.get
    rows_in = {(y, m): int(got[f"m{y * 100 + m}"]) for y, m in months}
    return Reconciliation(
        int(got["rows"]), report.rows, report.months, report.emptied,
        by_month=month_reconciliation(spark, rows_in, lake_root),
    )


def month_reconciliation(spark: SparkSession, rows_in: dict[tuple[int, int], int], lake_root: str) -> DataFrame:
    """(year, month, rows_in, rows_out, dropped) for the given months.

    ``rows_in`` was observed on the raw scan; ``rows_out`` is counted from the
    lake, pruned to those months. Months with no rows left show ``rows_out`` 0.
    """
    schema = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
                           T.StructField("rows_in", T.LongType())])
    requested = literal_frame(spark, [(y, m, n) for (y, m), n in sorted(rows_in.items())], schema)
    out = rows_by_month(read_lake(spark, lake_root, list(rows_in))).withColumnRenamed("rows", "rows_out")
    rows_out = F.coalesce(F.col("rows_out"), F.lit(0).cast("long"))
    return requested.join(out, ["year", "month"], "left").select(
        "year", "month", "rows_in", rows_out.alias("rows_out"), (F.col("rows_in") - rows_out).alias("dropped")
    )


@dataclass
class RunResult:
    data_month: tuple[int, int]
    rows_in: int
    rows_out: int
    check_rows: list = field(default_factory=list)
    gate_rows: list = field(default_factory=list)
    gate_open: bool = False
    exported: dict[str, int] = field(default_factory=dict)


def run_month(
    spark: SparkSession,
    raw_paths: list[str],
    month: str,
    lake_root: str,
    raw_root: str,
    marts_root: str,
    export_root: str,
    as_of: dt.date,
    bands: G.Bands = G.Bands(),
    carriers: DataFrame | None = None,
    cancellation_codes: DataFrame | None = None,
    lengths: dict[str, int] | None = VARCHAR_LENGTHS,
    changed_only: bool = False,
) -> RunResult:
    """Process one data month end to end; export only when the gate opens.

    ``month`` is the ``'YYYY-MM'`` data month this run owns; ``raw_paths`` are
    its raw files. Every write is a partition overwrite, so the run is
    idempotent and can simply be retried. ``lengths`` are the raw table's
    VARCHAR bounds (``None`` loads values unbounded). ``changed_only`` rebuilds and
    checks only this month: the marts' other partitions stay, and the grain test
    of the legs reads the month alone. The default rebuilds and checks everything,
    as a changed lookup requires.
    """
    ym = year_month(month)
    carriers = carriers if carriers is not None else seeds.carriers(spark)
    codes = cancellation_codes if cancellation_codes is not None else seeds.cancellation_codes(spark)

    # 1. clean the month's raw files into the lake (one read of the raw files)
    obs = Observation("raw_in")
    raw = read_raw(spark, raw_paths).observe(obs, F.count(F.lit(1)).alias("rows"))
    plan = plan_by_size(raw_size(spark, raw_paths)[0], 1)
    report = overwrite_months(clean_for_months(raw, plan), lake_root, [ym], rebalance=False)
    rows_in = int(obs.get["rows"])

    # 2. reload the month in the raw table (one partition overwrite)
    load_months(read_lake(spark, lake_root, [ym]), raw_root, [ym], lengths)

    # 3. marts over the raw table (or the changed month), written as tables
    scope = [ym] if changed_only else None
    raw_table = read_raw_table(spark, raw_root)
    if changed_only:
        raw_table = raw_table.where(month_filter([ym]))
    staged = stage(raw_table)
    marts = materialize_marts(spark, staged, carriers, marts_root, scope)

    # 4. structural checks; error severity stops the run before the gate
    tables = {"raw_flights": raw_table, "stg_flights": staged, "carriers": carriers,
              "cancellation_codes": codes, **marts}
    check_rows = C.summarize(C.run_checks(tables, C.default_checks())).collect()
    C.raise_on_errors(check_rows)

    # 5. release gate, 6. export only when it opens
    results = G.evaluate(marts, G.default_suites(as_of, bands)).collect()
    gate_open = all(r["success"] for r in results)
    exported = write_export(marts, export_root) if gate_open else {}
    return RunResult(
        data_month=ym,
        rows_in=rows_in,
        rows_out=report.rows,
        check_rows=check_rows,
        gate_rows=results,
        gate_open=gate_open,
        exported=exported,
    )
