"""Benchmark: the monthly pipeline end to end on the driver's test tables.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the summed wall time of the pipeline stages (clean -> lake ->
raw table -> marts -> checks -> gate -> export -> one-month reload); the raw
all-string CSV input is built from the test tables first and reported
separately (``fixture_raw_csv``), as the reference starts from CSV files.
After an untimed warm-up pass on smaller tables, the pipeline runs twice on
``BENCH_SF_DIR``; the faster pass is reported and both totals are listed.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from flightmarts.config import scratch_path  # noqa: E402
from flightmarts.operators import checks as C  # noqa: E402
from flightmarts.operators import gate as G  # noqa: E402
from flightmarts.operators.clean import clean_for_months, plan_by_size  # noqa: E402
from flightmarts.operators.enrich import stage  # noqa: E402
from flightmarts.plans.monthly import materialize_marts  # noqa: E402
from flightmarts.plans.queries import AS_OF, FIXTURE_BANDS  # noqa: E402
from flightmarts.sinks.export import write_export  # noqa: E402
from flightmarts.sinks.lake import (  # noqa: E402
    load_full,
    load_months,
    overwrite_months,
    read_raw_table,
    write_lake,
)
from flightmarts.sources import seeds  # noqa: E402
from flightmarts.sources.fixture import fixture_carriers, legs, raw_strings  # noqa: E402
from flightmarts.sources.lake import read_lake  # noqa: E402
from flightmarts.sources.raw import raw_size, read_raw  # noqa: E402


def run_pipeline(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], dict[str, object]]:
    """All pipeline stages on one scale factor; returns (seconds per stage, facts)."""
    times: dict[str, float] = {}
    info: dict[str, object] = {}

    def step(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    # raw files land per month, like the source's monthly files: the folders
    # carry copies of Year/Month, the files keep every source column
    raw_dir = scratch_path(spark, "bench-raw")
    step("fixture_raw_csv", lambda: (
        raw_strings(legs(spark, sf_dir))
        .withColumn("landed_year", F.col("Year")).withColumn("landed_month", F.col("Month"))
        .repartition("landed_year", "landed_month")  # one file per month
        .write.partitionBy("landed_year", "landed_month").option("header", "true").csv(raw_dir)
    ))

    lake_dir = scratch_path(spark, "bench-lake")
    raw_table = scratch_path(spark, "bench-raw-table")
    marts_dir = scratch_path(spark, "bench-marts")
    export_dir = scratch_path(spark, "bench-export")

    def clean_step():
        from pyspark.sql import Observation

        obs = Observation("rows_in")
        paths = f"{raw_dir}/*/*/*.csv"
        raw = read_raw(spark, paths).observe(obs, F.count(F.lit(1)).alias("n"))
        report = write_lake(clean_for_months(raw, plan_by_size(*raw_size(spark, paths))), lake_dir, rebalance=False)
        return int(obs.get["n"]), report.rows

    rows_in, rows_out = step("clean_to_lake", clean_step)
    info["rows_in"], info["rows_out"] = rows_in, rows_out

    step("load_raw_table", lambda: load_full(read_lake(spark, lake_dir), raw_table))

    carriers = fixture_carriers(spark, sf_dir)
    codes = seeds.cancellation_codes(spark)

    def marts_step():
        return materialize_marts(spark, stage(read_raw_table(spark, raw_table)), carriers, marts_dir)

    marts = step("marts", marts_step)
    info["mart_rows"] = {k: v.count() for k, v in marts.items()}

    def checks_step():
        flights = read_raw_table(spark, raw_table)
        tables = {"raw_flights": flights, "stg_flights": stage(flights), "carriers": carriers,
                  "cancellation_codes": codes, **marts}
        return C.summarize(C.run_checks(tables, C.default_checks())).collect()

    check_rows = step("checks", checks_step)
    info["checks_failed"] = sum(1 for r in check_rows if r["status"] == "fail")

    # row-count bands scaled to the test tables; the export obeys the gate
    gate_rows = step("gate", lambda: G.evaluate(marts, G.default_suites(AS_OF, FIXTURE_BANDS)).collect())
    info["gate_passed"] = sum(1 for r in gate_rows if r["success"])
    info["gate_open"] = all(r["success"] for r in gate_rows)
    exported = step("export", lambda: write_export(marts, export_dir) if info["gate_open"] else {})
    info["exported_rows"] = sum(exported.values())

    def reload_step():
        ym = (2001, 8)
        paths = f"{raw_dir}/landed_year={ym[0]}/landed_month={ym[1]}/*.csv"
        overwrite_months(clean_for_months(read_raw(spark, paths), plan_by_size(raw_size(spark, paths)[0], 1)), lake_dir, [ym], rebalance=False)
        return load_months(read_lake(spark, lake_dir, [ym]), raw_table, [ym]).rows

    info["reloaded_rows"] = step("month_reload", reload_step)

    # the marts of that month alone, as a monthly run rebuilds them
    step("changed_month_marts", lambda: materialize_marts(
        spark, stage(read_raw_table(spark, raw_table)), carriers, marts_dir, [(2001, 8)]))

    return times, info


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flightmarts-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # untimed warm-up pass on smaller tables: JIT and code generation are then
    # warm, so the timed pass measures the data work
    warm = "/root/testdata/sf0.01" if sf_dir != "/root/testdata/sf0.01" else "/root/testdata/sf0.001"
    run_pipeline(spark, warm if os.path.isdir(warm) else sf_dir)

    def pipeline_total(t: dict[str, float]) -> float:
        return round(sum(v for k, v in t.items() if k != "fixture_raw_csv"), 3)

    # two timed passes (fresh output folders each); the faster whole pass is
    # reported, both totals are listed, because single runs on one VM vary
    passes = [run_pipeline(spark, sf_dir) for _ in range(2)]
    times, info = min(passes, key=lambda p: pipeline_total(p[0]))
    rows_in = info["rows_in"]
    total = pipeline_total(times)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "pipeline_wall_time",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "clean_rows_per_sec": round(rows_in / times["clean_to_lake"]) if times["clean_to_lake"] else None,
        "pipeline_rows_per_sec": round(rows_in / total) if total else None,
        "cpus": cpus,
        "pass_totals": [pipeline_total(p[0]) for p in passes],
        **info,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
