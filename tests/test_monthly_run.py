import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from flightmarts.operators.reconcile import rows_by_month
from flightmarts.plans import queries as Q
from flightmarts.plans.monthly import run_month
from flightmarts.sinks.lake import load_full, write_lake
from flightmarts.sources.fixture import fixture_carriers, legs, raw_strings
from tests.conftest import SF_SMALL
from tests.test_checks_gate import BANDS_SF0001


def test_run_month_end_to_end_and_idempotent(spark, tmp):
    clean = Q.clean_legs(spark, SF_SMALL)
    lake, raw_table = f"{tmp}/lake", f"{tmp}/raw"
    write_lake(clean, lake)
    load_full(spark.read.parquet(lake), raw_table)
    before = {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(raw_table)).collect()}

    month = legs(spark, SF_SMALL).where((F.col("year") == 2001) & (F.col("month") == 8))
    raw_strings(month).write.option("header", "true").csv(f"{tmp}/landing/2001/08")
    kwargs = dict(
        raw_paths=[f"{tmp}/landing/2001/08/*.csv"], month="2001-08", lake_root=lake, raw_root=raw_table,
        marts_root=f"{tmp}/marts", export_root=f"{tmp}/export", as_of=dt.date(2001, 9, 15),
        bands=BANDS_SF0001, carriers=fixture_carriers(spark, SF_SMALL),
    )
    first = run_month(spark, **kwargs)
    second = run_month(spark, **kwargs)
    assert first.data_month == (2001, 8)
    assert first.rows_in >= first.rows_out == before[(2001, 8)]
    assert first.gate_open and sum(first.exported.values()) > 0
    assert [r for r in first.check_rows if r["status"] == "fail"] == []
    after = {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(raw_table)).collect()}
    assert after == before                       # the month was replaced, not appended
    assert (second.rows_out, second.exported) == (first.rows_out, first.exported)


def test_clean_history_and_backfill(spark, tmp):
    from flightmarts.plans.monthly import backfill, clean_history

    all_legs = legs(spark, SF_SMALL)
    for y, m in [(2001, 6), (2001, 7), (2001, 8)]:
        part = all_legs.where((F.col("year") == y) & (F.col("month") == m))
        raw_strings(part).coalesce(1).write.option("header", "true").option("compression", "gzip").csv(
            f"{tmp}/stage/{y}/{m:02d}")
        src = [f for f in os.listdir(f"{tmp}/stage/{y}/{m:02d}") if f.endswith(".csv.gz")][0]
        os.makedirs(f"{tmp}/raw/{y}", exist_ok=True)
        shutil.copy(f"{tmp}/stage/{y}/{m:02d}/{src}", f"{tmp}/raw/{y}/ontime_{y}_{m:02d}.csv.gz")
    full = clean_history(spark, f"{tmp}/raw/*/*.csv.gz", f"{tmp}/lake", by_month=True)
    assert full.months == [(2001, 6), (2001, 7), (2001, 8)] and full.dropped == full.rows_in - full.rows_out
    per_full = full.by_month.collect()
    assert len(per_full) == 3 and sum(r["rows_in"] for r in per_full) == full.rows_in
    assert sum(r["rows_out"] for r in per_full) == full.rows_out
    again = backfill(spark, f"{tmp}/raw", "2001-07", "2001-08", f"{tmp}/lake")
    assert again.months == [(2001, 7), (2001, 8)] and again.emptied == []
    counts = {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(f"{tmp}/lake")).collect()}
    assert sum(counts.values()) == full.rows_out   # the re-run replaced, not appended
    per = {(r["year"], r["month"]): r for r in again.by_month.collect()}
    assert sorted(per) == [(2001, 7), (2001, 8)]
    assert sum(r["rows_in"] for r in per.values()) == again.rows_in
    assert all(r["rows_out"] == counts[k] and r["dropped"] == r["rows_in"] - r["rows_out"] for k, r in per.items())
    # months that have landed are left out on request
    skipped = backfill(spark, f"{tmp}/raw", "2001-07", "2001-08", f"{tmp}/lake", skip_landed=True)
    assert (skipped.rows_in, skipped.months) == (0, [])
    # a file that holds another month's rows stops the backfill and changes nothing
    shutil.copy(f"{tmp}/raw/2001/ontime_2001_06.csv.gz", f"{tmp}/raw/2001/ontime_2001_08.csv.gz")
    with pytest.raises(Exception, match="outside the months"):
        backfill(spark, f"{tmp}/raw", "2001-07", "2001-08", f"{tmp}/lake")
    assert {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(f"{tmp}/lake")).collect()} == counts


def test_changed_month_equals_a_full_rebuild(spark, tmp):
    """Marts of one changed and one emptied month, rebuilt alone, equal the full rebuild."""
    from flightmarts.operators.enrich import stage
    from flightmarts.plans.monthly import materialize_marts

    staged, carriers = stage(Q.clean_legs(spark, SF_SMALL)), fixture_carriers(spark, SF_SMALL)
    materialize_marts(spark, staged, carriers, f"{tmp}/part")
    changed = staged.where("not (year = 1996 and month = 3)").where("not (year = 2001 and month = 8 and cancelled)")
    part = materialize_marts(spark, changed, carriers, f"{tmp}/part", [(1996, 3), (2001, 8)])
    full = materialize_marts(spark, changed, carriers, f"{tmp}/full")
    for name in full:
        cols = full[name].columns
        a, b = (sorted(map(str, df.select(*cols).collect())) for df in (part[name], full[name]))
        assert a == b and len(a) > 0, name


def test_run_of_the_changed_month_only(spark, tmp):
    clean = Q.clean_legs(spark, SF_SMALL)
    write_lake(clean, f"{tmp}/lake")
    load_full(spark.read.parquet(f"{tmp}/lake"), f"{tmp}/raw")
    month = legs(spark, SF_SMALL).where((F.col("year") == 2001) & (F.col("month") == 8))
    raw_strings(month).write.option("header", "true").csv(f"{tmp}/landing")
    kwargs = dict(raw_paths=[f"{tmp}/landing/*.csv"], month="2001-08", lake_root=f"{tmp}/lake", raw_root=f"{tmp}/raw", marts_root=f"{tmp}/marts",
                  export_root=f"{tmp}/export", as_of=dt.date(2001, 9, 15), bands=BANDS_SF0001, carriers=fixture_carriers(spark, SF_SMALL))
    full = run_month(spark, **kwargs)
    again = run_month(spark, changed_only=True, **kwargs)
    assert again.gate_open and again.exported == full.exported and again.rows_out == full.rows_out


def test_run_month_gate_closed_and_check_errors(spark, tmp):
    from flightmarts.operators.gate import Bands

    clean = Q.clean_legs(spark, SF_SMALL)
    lake, raw_table = f"{tmp}/lake", f"{tmp}/raw"
    write_lake(clean, lake)
    load_full(spark.read.parquet(lake), raw_table)
    month = legs(spark, SF_SMALL).where((F.col("year") == 2001) & (F.col("month") == 8))
    raw_strings(month).write.option("header", "true").csv(f"{tmp}/landing")
    kwargs = dict(
        raw_paths=[f"{tmp}/landing/*.csv"], month="2001-08", lake_root=lake, raw_root=raw_table,
        marts_root=f"{tmp}/marts", export_root=f"{tmp}/export", as_of=dt.date(2001, 9, 15),
    )
    # full-history bands: the small fixture is far below them, so nothing is published
    closed = run_month(spark, bands=Bands(), carriers=fixture_carriers(spark, SF_SMALL), **kwargs)
    assert closed.gate_open is False and closed.exported == {}
    assert not os.path.exists(f"{tmp}/export")
    failed = {r["expectation"] for r in closed.gate_rows if not r["success"]}
    assert failed == {"row_count_between"}
    # a duplicated carrier code breaks the seed's unique test (error severity): the run stops
    dup = fixture_carriers(spark, SF_SMALL)
    with pytest.raises(RuntimeError, match="carriers.unique"):
        run_month(spark, bands=BANDS_SF0001, carriers=dup.unionByName(dup.limit(1)), **kwargs)
