"""Registered queries over the driver's test tables: ``(spark, sf_dir) -> DataFrame``.

Every query starts from the flight-leg projection of the whole test tables
(``sources.fixture.legs``), so its work grows with them. Artefacts that the
real pipeline keeps in storage (raw CSV files, the Parquet lake, the mart
tables) are written once per session and scale factor under the shared
checkpoint folder, and read back by the queries that need them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightmarts.committed import MonthTable, exists
from flightmarts.config import scratch_path, scratch_table
from flightmarts.functions.months import month_filter
from flightmarts.jobs import month_writes, released_shuffles
from flightmarts.operators import checks as C
from flightmarts.operators import gate as G
from flightmarts.operators import marts
from flightmarts.operators import reconcile as R
from flightmarts.operators.clean import DedupPlan, cast_raw, clean, clean_for_months, deduplicate, deduplicate_in_buckets, drop_missing_keys, key_hash, observe_skew
from flightmarts.operators.enrich import enrich, stage, with_flags
from flightmarts.operators.mart_state import MartState
from flightmarts.plans.monthly import backfill, materialize_marts, update_summaries
from flightmarts.schema import FLIGHT_KEY, FLIGHT_SCHEMA, VARCHAR_LENGTHS
from flightmarts.sinks import export as X
from flightmarts.sinks import push as P
from flightmarts.sinks.lake import (
    RAW_SCHEMA,
    declare_raw_table,
    load_full,
    load_months,
    overwrite_months,
    read_raw_table,
    with_audit,
    write_lake,
)
from flightmarts.sinks.month_writer import FlightMonths
from flightmarts.sources import seeds
from flightmarts.sources.fixture import fixture_carriers, legs, raw_strings, table
from flightmarts.sources.lake import read_lake, read_lake_files
from flightmarts.sources.raw import month_raw_path, read_raw
from flightmarts.streaming.fingerprints import load_changed
from flightmarts.streaming.ledger import incremental_load

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values: dates used by the registered queries
RUN_DATE = dt.date(2001, 10, 15)       # owns data month 2001-08 (run - 2)
AS_OF = dt.date(2001, 9, 15)           # freshness floor 2001-05-01
EMPTIED_MONTH = (1995, 1)              # month whose source turns empty in month_overwrite
RELOADED_MONTH = (2001, 8)             # month reloaded twice in month_overwrite

# A gzip file is read by one task, and Spark gives a task as many files as 128 MB of them hold, each
# counted as 4 MB more: about 1.3 million rows of files of this size
RAW_ROWS_PER_FILE = 50_000

# Row-count bands that the fixture's marts meet from sf0.001 to sf0.1
FIXTURE_BANDS = G.Bands((700, 2_600), (5_000, 800_000), (1_000, 55_000), (700, 2_600))

_WORKSPACES: dict[tuple[str, str], dict] = {}


def _ws(spark: SparkSession, sf_dir: str) -> dict:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    return _WORKSPACES.setdefault(key, {})


def clean_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed legs after the key filter and deterministic dedup."""
    return deduplicate(drop_missing_keys(legs(spark, sf_dir)))


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """All-string raw files (header ``.csv.gz``) of the legs, written once per session."""
    ws = _ws(spark, sf_dir)
    if "raw_csv" not in ws:
        path = scratch_path(spark, "raw-csv")
        with released_shuffles(spark):
            raw = raw_strings(legs(spark, sf_dir)).write.option("header", "true").option("maxRecordsPerFile", RAW_ROWS_PER_FILE)
            raw.option("compression", "gzip").csv(path)
        ws["raw_csv"] = path
    return ws["raw_csv"]


def raw_by_month(spark: SparkSession, sf_dir: str) -> str:
    """The raw zone: ``<root>/<y>/ontime_<y>_<mm>.csv.gz``, one file per month.

    Files of even months have the columns of the source's later layout: one more in
    the middle and two moved. The landing renames each month's part file.
    """
    ws = _ws(spark, sf_dir)
    if "raw_by_month" not in ws:
        path, root = scratch_path(spark, "raw-parts"), scratch_path(spark, "raw-zone")
        flights = legs(spark, sf_dir)
        for name, odd in (("a", 1), ("b", 0)):
            # the legs are dealt by month; strings and copies are made behind the exchange
            own = flights.where(F.col("month") % 2 == odd).repartition("year", "month")
            raw = raw_strings(own).withColumns({"y": F.col("Year"), "m": F.col("Month")})
            if not odd:
                raw = raw.select("DestState", "FlightDate", F.lit("x").alias("DivAirportLandings"), *[c for c in raw.columns if c not in ("DestState", "FlightDate")])
            with month_writes(spark):
                raw.write.partitionBy("y", "m").option("header", "true").option("compression", "gzip").csv(f"{path}/{name}")
        parts = spark.read.format("binaryFile").load([f"{path}/{n}/*/*/*.csv.gz" for n in "ab"]).select("path")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for row in parts.collect():  # one file per month
            keys = dict(p.split("=") for p in row["path"].split("/") if "=" in p)
            target = jvm.org.apache.hadoop.fs.Path(month_raw_path(root, int(keys["y"]), int(keys["m"])))
            fs = target.getFileSystem(conf)
            fs.mkdirs(target.getParent())
            fs.rename(jvm.org.apache.hadoop.fs.Path(row["path"]), target)
        ws["raw_by_month"] = root
    return ws["raw_by_month"]


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """The Parquet lake of the cleaned legs, written once per session: months and heavy keys are
    observed first, then the legs are dealt by month. The joined legs wait in a table for both."""
    ws = _ws(spark, sf_dir)
    if "lake" not in ws:
        path = scratch_path(spark, "lake")
        with scratch_table(drop_missing_keys(legs(spark, sf_dir)), "legs") as flights:
            write_lake(deduplicate_in_buckets(flights, observe_skew(flights)), path, rebalance=False)
        ws["lake"] = path
    return ws["lake"]


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, lake_root(spark, sf_dir))


def lookups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixture_carriers(spark, sf_dir), seeds.cancellation_codes(spark)


def enriched_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    carriers, codes = lookups(spark, sf_dir)
    return enrich(stage(lake(spark, sf_dir)), carriers, codes)


def flagged_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged legs with the shared flags and no lookup, as the marts read them."""
    return with_flags(stage(lake(spark, sf_dir)))


def carrier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.carrier_month_facts(flagged_lake(spark, sf_dir), fixture_carriers(spark, sf_dir))


def mart_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four marts written as tables once per session, read back."""
    ws = _ws(spark, sf_dir)
    if "marts" not in ws:
        ws["marts"] = materialize_marts(
            spark, stage(lake(spark, sf_dir)), fixture_carriers(spark, sf_dir), scratch_path(spark, "marts")
        )
    return ws["marts"]


def check_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    carriers, codes = lookups(spark, sf_dir)
    flights = lake(spark, sf_dir)
    return {
        "raw_flights": flights,
        "stg_flights": stage(flights),
        "carriers": carriers,
        "cancellation_codes": codes,
        **mart_tables(spark, sf_dir),
    }


# ---------------------------------------------------------------- queries


def q_clean_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string CSV -> typed, key-complete, deduplicated legs."""
    return clean(read_raw(spark, f"{raw_csv(spark, sf_dir)}/*.csv.gz"))


def q_clean_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with a hot natural key: the raw rows and a quarter as many differing copies of one leg;
    months and heavy keys are observed, and the copies reduced per task before their exchange."""
    flights = drop_missing_keys(cast_raw(read_raw(spark, f"{raw_csv(spark, sf_dir)}/*.csv.gz")))
    hot = flights.agg(F.min(F.struct(*FLIGHT_KEY)).alias("k")).first()["k"]  # the leg that becomes hot
    own = {c: F.lit(hot[c]) for c in FLIGHT_KEY}
    own |= {"year": F.lit(hot["flight_date"].year), "month": F.lit(hot["flight_date"].month)}
    copied = F.col("flight_number").cast("long") % 4 == 0
    doubled = flights.withColumn("_copy", F.explode(F.when(copied, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    skewed = doubled.select(*[F.when(F.col("_copy"), own[c]).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in flights.columns])
    return deduplicate_in_buckets(skewed, observe_skew(skewed, rows_per_bucket=2_000))


def q_clean_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in (observed during the write), rows out (read back), dropped."""
    obs = Observation("rows_in")
    plain = read_raw(spark, f"{raw_csv(spark, sf_dir)}/*.csv.gz")
    out = scratch_path(spark, "clean-lake")
    write_lake(clean_for_months(plain.observe(obs, F.count(F.lit(1)).alias("n")), again=plain), out, rebalance=False)
    rows_out = spark.read.parquet(out).count()
    return R.reconciliation(spark, obs.get["n"], rows_out)


def q_stage_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging projection over the lake."""
    return stage(lake(spark, sf_dir))


def q_enrich_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key plus the five enrichment columns."""
    e = enriched_lake(spark, sf_dir)
    return e.select(*FLIGHT_KEY, "carrier_name", "cancellation_reason", "month_start",
                    "is_reportable_arrival", "is_on_time")


def q_monthly_otp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.monthly_otp_from(carrier_months(spark, sf_dir))


def q_route_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.route_performance(flagged_lake(spark, sf_dir))


def q_airport_congestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.airport_congestion(flagged_lake(spark, sf_dir))


def q_delay_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.delay_causes_from(carrier_months(spark, sf_dir))


def q_airport_congestion_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport mart as two endpoint aggregates and a full outer join."""
    return marts.airport_congestion_by_join(flagged_lake(spark, sf_dir))


def q_backfill_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month's gzip file, found by the raw-zone path rule and read
    under its own header, cleaned in one backfill job; rows in, out and dropped
    per month."""
    bounds = R.month_bounds(drop_missing_keys(legs(spark, sf_dir)))
    start, end = (f"{d.year}-{d.month:02d}" for d in bounds)
    return backfill(spark, raw_by_month(spark, sf_dir), start, end, scratch_path(spark, "lake-backfill")).by_month


def q_rows_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rows_by_month(lake(spark, sf_dir))


def q_rows_by_month_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rows_by_month_running(lake(spark, sf_dir))


def q_missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 T4 J4 at carrier grain."""
    return R.missing_months(lake(spark, sf_dir), ["carrier_code"])


def q_missing_route_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 J4 at route grain."""
    return R.missing_months(lake(spark, sf_dir), ["origin", "dest"])


def q_data_month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month owned by the run on RUN_DATE, by carrier."""
    return R.data_month_slice(lake(spark, sf_dir), RUN_DATE)


def q_partition_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """year/month parsed from file paths, no partition discovery."""
    return R.rows_by_month(read_lake_files(spark, lake_root(spark, sf_dir)))


def month_content(flights: DataFrame) -> DataFrame:
    """What a month holds: rows and sums of measures (whole numbers, so exact)."""
    return flights.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("distance_miles").cast("long")).alias("miles"),
        F.sum(F.col("dep_delay_min").cast("long")).alias("dep_delay"),
        F.count_if("cancelled").alias("cancelled"),
    )


def revised(flights: DataFrame) -> DataFrame:
    """RELOADED_MONTH as its source was revised: longer distances, no cancelled legs."""
    month = flights.where((F.col("year") == RELOADED_MONTH[0]) & (F.col("month") == RELOADED_MONTH[1]))
    return month.where(~F.col("cancelled")).withColumn("distance_miles", F.col("distance_miles") + 1)


def q_month_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reload one month from revised rows, twice (idempotent), and one month
    from an emptied source (its old rows must go); the lake's content by month."""
    root = scratch_path(spark, "lake-reload")
    flights = lake(spark, sf_dir)
    write_lake(flights, root, rebalance=False)
    overwrite_months(revised(flights), root, [RELOADED_MONTH])
    overwrite_months(revised(flights), root, [RELOADED_MONTH])
    # the re-transformed source of EMPTIED_MONTH holds no rows at all
    overwrite_months(flights.where(F.lit(False)), root, [EMPTIED_MONTH])
    return month_content(read_lake(spark, root))


def q_full_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 K7 K8: truncate-and-load the bounded raw table twice; rows and audit stamps by month."""
    root = scratch_path(spark, "raw-table")
    flights = lake(spark, sf_dir)
    load_full(flights, root)
    load_full(flights, root)
    raw = read_raw_table(spark, root)
    return raw.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_loaded_at").isNotNull()).alias("stamped_rows"),
    )


def q_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 K8: the ledger stream over a lake in which one month is then revised and one
    emptied; the second run loads exactly that, the third nothing."""
    src, target, ckpt = (scratch_path(spark, n) for n in ("lake-ledger", "raw-incremental", "ledger-ckpt"))
    flights = lake(spark, sf_dir)
    write_lake(flights, src, rebalance=False)
    incremental_load(spark, src, target, ckpt, max_files_per_trigger=16)
    overwrite_months(revised(flights), src, [RELOADED_MONTH])
    overwrite_months(flights.where(F.lit(False)), src, [EMPTIED_MONTH])
    incremental_load(spark, src, target, ckpt)
    again = incremental_load(spark, src, target, ckpt)
    return month_content(read_raw_table(spark, target)).withColumn("third_run_batches", F.lit(again).cast("long"))


def q_declared_raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared catalog table after a bounded load and a month reload."""
    root = scratch_path(spark, "raw-declared")
    name = f"raw_flights_{root.rsplit('-', 1)[-1]}"
    flights = lake(spark, sf_dir)
    load_full(flights, root)
    declare_raw_table(spark, name, root)
    changed = scratch_path(spark, "lake-declared")
    write_lake(revised(flights), changed)
    load_months(read_lake(spark, changed), root, [RELOADED_MONTH])
    spark.sql(f"REFRESH TABLE {name}")
    return month_content(declare_raw_table(spark, name, root))


def q_month_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 K5: a committed lake and raw table. A reload that dies between its two steps changes
    nothing; then one month is revised and one emptied in a single commit, and the raw table
    follows through the month writer; content of the raw table by month."""
    root, raw = scratch_path(spark, "lake-commits"), scratch_path(spark, "raw-commits")
    flights = lake(spark, sf_dir)
    write_lake(flights, root, commits=True, rebalance=False)
    load_full(read_lake(spark, root), raw, commits=True)
    months = [RELOADED_MONTH, EMPTIED_MONTH]
    MonthTable(spark, root, FLIGHT_SCHEMA).stage(flights.where(F.lit(False)), "died")  # no manifest follows
    overwrite_months(revised(flights), root, months)
    spark.dataSource.register(FlightMonths)
    changed = with_audit(read_lake(spark, root, months)).select(*RAW_SCHEMA.fieldNames())
    named = ",".join(f"{y}-{m:02d}" for y, m in months)
    changed.write.format("flight_months").option("months", named).mode("append").save(raw)
    return month_content(read_raw_table(spark, raw))


def q_fingerprint_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the ledger of file fingerprints over a lake in which one month is then revised under
    the names its files had, and one emptied; the third load finds nothing."""
    src, target, ledger = (scratch_path(spark, n) for n in ("lake-prints", "raw-prints", "ledger-prints"))
    flights = lake(spark, sf_dir)
    write_lake(flights, src, rebalance=False)
    load_changed(spark, src, target, ledger)
    (year, month), other = RELOADED_MONTH, scratch_path(spark, "lake-prints-revised")
    write_lake(revised(flights).coalesce(1), other)
    replace_in_place(spark, f"{other}/year={year}/month={month}", f"{src}/year={year}/month={month}")
    overwrite_months(flights.where(F.lit(False)), src, [EMPTIED_MONTH])
    load_changed(spark, src, target, ledger)
    again = load_changed(spark, src, target, ledger)
    return month_content(read_raw_table(spark, target)).withColumn("third_run_batches", F.lit(len(again)).cast("long"))


def replace_in_place(spark: SparkSession, source: str, target: str) -> None:
    """The Parquet files of ``source`` take the names of those in ``target``; further ones go."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(target).getFileSystem(conf)
    new, old = (sorted(s.getPath().toString() for s in fs.listStatus(path(p)) if s.getPath().getName().endswith(".parquet")) for p in (source, target))
    for i, name in enumerate(old):
        fs.delete(path(name), False)
        if i < len(new):
            fs.rename(path(new[i]), path(name))


def q_export_push(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts pushed twice through the batch sink; rows and requests per table and
    the totals that the pushes report."""
    out = scratch_path(spark, "export-push")
    tables = mart_tables(spark, sf_dir)
    P.push_export(tables, out)
    totals = P.push_export(tables, out)
    limit, parts = X.ROWS_PER_REQUEST, None
    for name, total in totals.items():
        sizes = P.read_push(spark, out, name).groupBy("request").agg(F.count(F.lit(1)).alias("n"))
        one = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("largest")).select(
            F.lit(name).alias("table_name"), F.col("rows").cast("long").alias("rows"), F.lit(total).cast("long").alias("reported_rows"),
            (F.col("largest") <= limit).alias("within_limit"),
        )
        parts = one if parts is None else parts.unionByName(one)
    return parts


def changed_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts as additive state: all legs as one batch, then one month's old legs out and its
    revised ones in, one month's legs out, that batch a second time, and a compaction."""
    ws = _ws(spark, sf_dir)
    if "state" not in ws:
        state = MartState(spark, scratch_path(spark, "mart-state"))
        flights = lake(spark, sf_dir)
        state.apply("0001-load", added=stage(flights))
        old = flights.where(month_filter([RELOADED_MONTH, EMPTIED_MONTH]))
        for _ in range(2):  # the second time it is known
            state.apply("0002-revised", added=stage(revised(flights)), removed=stage(old))
        state.compact("0003-compact")
        ws["state"] = state
    return ws["state"].marts(fixture_carriers(spark, sf_dir))


def _state_mart(mart: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return changed_marts(spark, sf_dir)[mart]

    q.__doc__ = f"K9 {mart} projected from additive state after a revised and an emptied month"
    return q


def q_gate_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G6 from monthly summaries: those of all marts, then one month revised and one emptied,
    of which alone the summaries are made again."""
    root, suites = scratch_path(spark, "gate-summaries"), G.default_suites(AS_OF, FIXTURE_BANDS)
    update_summaries(spark, mart_tables(spark, sf_dir), suites, root)
    summaries = update_summaries(spark, changed_marts(spark, sf_dir), suites, root, [RELOADED_MONTH, EMPTIED_MONTH])
    return G.evaluate_summaries(summaries, suites)


def q_merged_route_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route-months without rows, from coverages of the odd and the even years merged."""
    flights = lake(spark, sf_dir)
    grain = ["origin", "dest"]
    halves = [R.coverage(flights.where(F.col("year") % 2 == odd), grain) for odd in (0, 1)]
    return R.coverage_gaps(R.merge_coverage(*halves), *R.month_bounds(flights))


def q_requested_months_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested months (from a year before the lake to a year after it) that
    have not landed."""
    flights = lake(spark, sf_dir).select("year", "month")
    lo, hi = R.month_bounds(flights)
    spine = R.month_spine(spark, f"{lo.year - 1}-{lo.month:02d}", f"{hi.year + 1}-{hi.month:02d}")
    return R.requested_months_missing(spine, flights)


def q_seed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carrier lookup written as a seed CSV and scanned with explicit types."""
    path = scratch_path(spark, "seed-csv")
    fixture_carriers(spark, sf_dir).write.option("header", "true").csv(path)
    return seeds.read_seed(spark, path, seeds.CARRIER_SCHEMA)


def q_bounded_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: longest value and violations per VARCHAR-bounded column (one scan)."""
    flights = lake(spark, sf_dir)
    items = list(VARCHAR_LENGTHS.items())
    agg = flights.agg(
        *[F.max(F.char_length(c)).alias(f"_m{i}") for i, (c, _) in enumerate(items)],
        *[F.count_if(F.char_length(c) > n).alias(f"_v{i}") for i, (c, n) in enumerate(items)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(n).alias("max_length"),
            F.col(f"_m{i}").alias("longest"),
            F.col(f"_v{i}").alias("violations"),
        )
        for i, (c, n) in enumerate(items)
    ]
    return agg.select(F.inline(F.array(*rows)))


def _checks(kinds: tuple[str, ...]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return C.run_checks(check_tables(spark, sf_dir), C.checks_of_kind(kinds))

    q.__doc__ = f"D1-D5: {', '.join(kinds)} checks"
    return q


def q_check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 29 declared checks with severity and status."""
    return C.summarize(C.run_checks(check_tables(spark, sf_dir), C.default_checks()))


# Checks that the fixture's dirty relations break, and two that they pass.
DIRTY_CHECKS = [
    C.Check("raw_flights", "unique_combination", tuple(FLIGHT_KEY)),
    C.Check("raw_flights", "not_null", ("dest_city",)),
    C.Check("raw_flights", "not_null", ("flight_date",)),
    C.Check("raw_flights", "accepted_values", ("cancellation_code",), values=("", "A", "B", "C"), severity="warn"),
    C.Check("raw_flights", "accepted_range", ("arr_delay_min",), min_value=-50, max_value=30),
    C.Check("raw_flights", "accepted_range", ("distance_miles",), min_value=100),
    C.Check("carriers", "unique", ("carrier_code",)),
]


def q_check_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks over legs as they land (twice where the source repeats them, with
    NULL cities, an unexpected code and late arrivals) and a lookup whose codes
    repeat: pass, warn and fail all occur."""
    flights = legs(spark, sf_dir)
    tables = {
        "raw_flights": flights.unionByName(flights.where(F.col("flight_number").cast("long") % 10 == 0)),
        "carriers": table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("carrier_code"), F.col("n_name").alias("carrier_name")),
    }
    return C.summarize(C.run_checks(tables, DIRTY_CHECKS))


def gate_results_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.evaluate(mart_tables(spark, sf_dir), G.default_suites(AS_OF))


def q_gate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per expectation (reference bands, as_of fixed)."""
    return gate_results_df(spark, sf_dir)


def q_gate_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-suite statistics."""
    return G.suite_stats(gate_results_df(spark, sf_dir))


def q_gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-row gate decision."""
    return G.decision(gate_results_df(spark, sf_dir))


def q_gate_open_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G6 with bands scaled to the fixture: every expectation passes."""
    return G.evaluate(mart_tables(spark, sf_dir), G.default_suites(AS_OF, FIXTURE_BANDS))


def q_gated_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One target, three runs. The first gate is open and exports the marts; the second is
    closed, so what that run has to export (the marts without one month) stays unwritten and
    the target keeps the first run's rows; the third, open again, replaces them. Rows in the
    target after each run; the gates look at the whole marts."""
    tables = mart_tables(spark, sf_dir)
    fewer = {n: t.where(F.col("month_start") != F.lit(dt.date(*RELOADED_MONTH, 1))) for n, t in tables.items()}
    path = scratch_path(spark, "gated-export")
    out = None
    for run, bands, marts_now in ((1, FIXTURE_BANDS, tables), (2, G.Bands(), fewer), (3, FIXTURE_BANDS, fewer)):
        is_open = G.decision(G.evaluate(tables, G.default_suites(AS_OF, bands))).first()["gate_open"]
        if is_open:
            X.write_export(marts_now, path)
        for name in tables:  # counted before the next run: a few rows per run
            rows = X.read_export(spark, path, name).count() if exists(spark, f"{path}/{name}") else 0
            one = spark.range(1).select(F.lit(run).alias("run"), F.lit(is_open).alias("gate_open"), F.lit(name).alias("table_name"), F.lit(rows).cast("long").alias("rows"))
            out = one if out is None else out.unionByName(one)
    return out


def _export_rows(mart: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = scratch_path(spark, f"export-{mart}")
        X.write_export({mart: mart_tables(spark, sf_dir)[mart]}, out)
        return X.read_export(spark, out, mart).drop("batch_file")

    q.__doc__ = f"K10 P20 S7: the typed export rows of {mart}, read back from the written batches"
    return q


def q_export_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts pushed twice in batches of at most 10,000 rows; rows and
    batches per table from the files, and the overall total."""
    out = scratch_path(spark, "export")
    X.write_export(mart_tables(spark, sf_dir), out)
    X.write_export(mart_tables(spark, sf_dir), out)
    limit = X.ROWS_PER_REQUEST
    b = X.export_batches(spark, out).select(
        "table_name",
        "rows",
        (F.col("max_batch_rows") <= limit).alias("within_limit"),
        (F.col("batches") >= F.ceil(F.col("rows") / limit)).alias("enough_batches"),
    )
    total = b.agg(
        F.lit("(all)").alias("table_name"), F.sum("rows").alias("rows"),
        F.bool_and("within_limit").alias("within_limit"), F.bool_and("enough_batches").alias("enough_batches"),
    )
    return b.unionByName(total)


QUERIES: dict[str, Query] = {
    "clean_flights": q_clean_flights,
    "clean_skewed": q_clean_skewed,
    "clean_reconciliation": q_clean_reconciliation,
    "stage_flights": q_stage_flights,
    "enrich_flights": q_enrich_flights,
    "monthly_otp": q_monthly_otp,
    "route_performance": q_route_performance,
    "airport_congestion": q_airport_congestion,
    "airport_congestion_join": q_airport_congestion_join,
    "delay_causes": q_delay_causes,
    "state_monthly_otp": _state_mart("fct_monthly_otp"),
    "state_route_performance": _state_mart("fct_route_performance"),
    "state_airport_congestion": _state_mart("fct_airport_congestion"),
    "state_delay_causes": _state_mart("fct_delay_causes"),
    "rows_by_month": q_rows_by_month,
    "rows_by_month_running": q_rows_by_month_running,
    "missing_months": q_missing_months,
    "missing_route_months": q_missing_route_months,
    "merged_route_coverage": q_merged_route_coverage,
    "data_month_slice": q_data_month_slice,
    "partition_from_path": q_partition_from_path,
    "month_overwrite": q_month_overwrite,
    "backfill_months": q_backfill_months,
    "full_reload": q_full_reload,
    "incremental_load": q_incremental_load,
    "declared_raw_table": q_declared_raw_table,
    "month_commit": q_month_commit,
    "fingerprint_ledger": q_fingerprint_ledger,
    "requested_months_missing": q_requested_months_missing,
    "seed_csv": q_seed_csv,
    "bounded_lengths": q_bounded_lengths,
    "check_not_null": _checks(("not_null",)),
    "check_unique": _checks(("unique",)),
    "check_grain": _checks(("unique_combination",)),
    "check_accepted_values": _checks(("accepted_values",)),
    "check_accepted_range": _checks(("accepted_range",)),
    "check_summary": q_check_summary,
    "check_failures": q_check_failures,
    "gate_results": q_gate_results,
    "gate_open_results": q_gate_open_results,
    "gate_from_summaries": q_gate_from_summaries,
    "gated_export": q_gated_export,
    "gate_suites": q_gate_suites,
    "gate_decision": q_gate_decision,
    "export_rows": _export_rows("fct_monthly_otp"),
    "export_route_rows": _export_rows("fct_route_performance"),
    "export_airport_rows": _export_rows("fct_airport_congestion"),
    "export_cause_rows": _export_rows("fct_delay_causes"),
    "export_batches": q_export_batches,
    "export_push": q_export_push,
}
