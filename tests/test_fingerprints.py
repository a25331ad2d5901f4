"""The ledger of file fingerprints: revisions under the same name, gone files, plain re-runs."""

import datetime as dt
import glob
import os
import shutil
import time

import pytest

from flightmarts.operators.reconcile import rows_by_month
from flightmarts.sinks.lake import overwrite_months, read_raw_table, write_lake
from flightmarts.streaming import fingerprints
from flightmarts.streaming.fingerprints import ledger, load_changed, loaded
from flightmarts.streaming.ledger import incremental_load
from tests.conftest import make_legs


def counts(spark, target):
    return {(r["year"], r["month"]): r["rows"] for r in rows_by_month(read_raw_table(spark, target)).collect()}


@pytest.fixture
def paths(spark, tmp):
    legs = make_legs(spark, [{"flight_date": dt.date(2024, m, 3)} for m in (1, 1, 2, 3)])
    write_lake(legs, f"{tmp}/lake")
    return f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/ledger"


def revise_in_place(spark, lake, tmp):
    """Another month's worth of rows under the very file name that January had."""
    write_lake(make_legs(spark, [{"flight_date": dt.date(2024, 1, d)} for d in (4, 5, 6)]).coalesce(1), f"{tmp}/other")
    (old,), (new,) = (glob.glob(f"{r}/year=2024/month=1/*.parquet") for r in (lake, f"{tmp}/other"))
    for side in glob.glob(f"{lake}/year=2024/month=1/.*.crc"):
        os.remove(side)
    shutil.copy(new, old)
    later = time.time() + 5
    os.utime(old, (later, later))


def test_a_revision_under_the_same_name_is_loaded(spark, tmp, paths):
    lake, raw, led = paths
    assert load_changed(spark, *paths) == [(2024, 1), (2024, 2), (2024, 3)]
    assert load_changed(spark, *paths) == []
    incremental_load(spark, lake, f"{tmp}/by-name", f"{tmp}/ckpt")
    revise_in_place(spark, lake, tmp)
    assert incremental_load(spark, lake, f"{tmp}/by-name", f"{tmp}/ckpt") in (0, 1)
    assert load_changed(spark, *paths) == [(2024, 1)]
    assert counts(spark, raw) == {(2024, 1): 3, (2024, 2): 1, (2024, 3): 1}
    assert load_changed(spark, *paths) == []
    assert loaded(ledger(spark, led)).count() == 3 and ledger(spark, led).count() == 4


def test_new_and_gone_files(spark, tmp, paths):
    lake, raw, led = paths
    load_changed(spark, *paths)
    overwrite_months(make_legs(spark, [{"flight_date": dt.date(2024, 4, 9)}]), lake, [(2024, 4)])
    shutil.rmtree(f"{lake}/year=2024/month=2")
    assert load_changed(spark, *paths) == [(2024, 2), (2024, 4)]
    assert counts(spark, raw) == {(2024, 1): 2, (2024, 3): 1, (2024, 4): 1}
    assert load_changed(spark, *paths) == []


def test_a_load_that_died_is_done_again(spark, tmp, paths, monkeypatch):
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(fingerprints, "load_months", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        load_changed(spark, *paths)
    assert ledger(spark, paths[2]).count() == 0
    assert load_changed(spark, *paths) == [(2024, 1), (2024, 2), (2024, 3)] and counts(spark, paths[1])[(2024, 1)] == 2
