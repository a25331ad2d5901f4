"""Month reloads that become visible in one step, the month writer and the push sink."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from flightmarts.committed import MonthTable, StaleVersion
from flightmarts.schema import FLIGHT_SCHEMA
from flightmarts.sinks.export import export_frame
from flightmarts.sinks.lake import load_full, load_months, overwrite_months, read_raw_table, write_lake
from flightmarts.sinks.month_writer import FlightMonths, MonthWriter
from flightmarts.sinks.push import PushWriter, push_export, pushed, read_push
from flightmarts.sources.lake import read_lake
from tests.conftest import make_legs
from tests.test_export_stream import otp_like


def months_of(df):
    return {(r["year"], r["month"]): r["count"] for r in df.groupBy("year", "month").count().collect()}


@pytest.fixture
def legs(spark):
    return make_legs(spark, [{"flight_date": dt.date(2024, m, 3)} for m in (1, 1, 1, 2, 2, 3)])


@pytest.fixture
def lake(spark, tmp, legs):
    root = f"{tmp}/lake"
    write_lake(legs, root, commits=True)
    return root


def test_replaced_and_emptied_months_change_in_one_step(spark, lake, legs):
    before = read_lake(spark, lake)
    report = overwrite_months(legs.where("month = 1").limit(1), lake, [(2024, 1), (2024, 3)])
    assert (report.rows, report.months, report.emptied) == (1, [(2024, 1)], [(2024, 3)])
    assert months_of(read_lake(spark, lake)) == {(2024, 1): 1, (2024, 2): 2}
    assert months_of(before) == {(2024, 1): 3, (2024, 2): 2, (2024, 3): 1}  # a reader keeps its version
    table = MonthTable(spark, lake, FLIGHT_SCHEMA)
    assert table.versions() == [1, 2] and months_of(table.read(version=1)) == months_of(before)
    assert sorted(map(str, table.read([(2024, 2)]).collect())) == sorted(map(str, legs.where("month = 2").collect()))


def test_a_crash_between_the_steps_changes_nothing(spark, lake, legs, monkeypatch):
    before = months_of(read_lake(spark, lake))

    def killed(*args, **kwargs):
        raise KeyboardInterrupt("killed after staging")

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(MonthTable, "publish", killed)
        overwrite_months(legs.where("month = 1").limit(1), lake, [(2024, 1), (2024, 2)])
    assert len(os.listdir(f"{lake}/data")) == 2  # the staged months are there
    assert months_of(read_lake(spark, lake)) == before  # and nobody reads them
    overwrite_months(legs.where("month = 1").limit(1), lake, [(2024, 1), (2024, 2)])
    assert months_of(read_lake(spark, lake)) == {(2024, 1): 1, (2024, 3): 1}
    gone = MonthTable(spark, lake, FLIGHT_SCHEMA).vacuum(keep_versions=1)
    assert len(gone) == 1 and months_of(read_lake(spark, lake)) == {(2024, 1): 1, (2024, 3): 1}


def test_a_manifest_left_half_written_is_replaced(spark, lake, legs):
    os.makedirs(f"{lake}/_manifest/version=2/_temporary")  # a writer that died before its row was in place
    assert months_of(read_lake(spark, lake)) == {(2024, 1): 3, (2024, 2): 2, (2024, 3): 1}
    overwrite_months(legs.where("false"), lake, [(2024, 2)])
    assert months_of(read_lake(spark, lake)) == {(2024, 1): 3, (2024, 3): 1}


def test_two_writers_of_one_version(spark, lake, legs):
    table = MonthTable(spark, lake, FLIGHT_SCHEMA)
    base = table.version()
    for commit in ("first", "second"):
        table.stage(legs.where("month = 2"), commit)
    table.publish("first", {(2024, 2)}, [(2024, 2)], base)
    with pytest.raises(StaleVersion):
        table.publish("second", {(2024, 2)}, [(2024, 2)], base)
    assert table.version().commit == "first"


def test_stray_rows_abort(spark, lake, legs):
    before = months_of(read_lake(spark, lake))
    with pytest.raises(Exception, match="outside the months"):
        overwrite_months(legs, lake, [(2024, 1)])
    with pytest.raises(ValueError, match="name the months"):
        overwrite_months(legs, lake)
    assert months_of(read_lake(spark, lake)) == before


def test_raw_table_loads_into_a_committed_table(spark, tmp, lake, legs):
    raw = f"{tmp}/raw"
    load_full(read_lake(spark, lake), raw, commits=True)
    overwrite_months(legs.where("month = 3").limit(0), lake, [(2024, 3)])
    report = load_months(read_lake(spark, lake, [(2024, 1), (2024, 3)]), raw, [(2024, 1), (2024, 3)])
    assert report.emptied == [(2024, 3)] and months_of(read_raw_table(spark, raw)) == {(2024, 1): 3, (2024, 2): 2}
    assert read_raw_table(spark, raw).where("_loaded_at is null").count() == 0


def test_empty_first_commit(spark, tmp, legs):
    write_lake(legs.where("false"), f"{tmp}/none", commits=True)
    assert read_lake(spark, f"{tmp}/none").count() == 0 and read_lake(spark, f"{tmp}/none").schema.names == FLIGHT_SCHEMA.names


def test_month_writer_replaces_named_months_only(spark, lake, legs):
    spark.dataSource.register(FlightMonths)
    changed = legs.where("month = 1").limit(2).repartition(2)
    changed.write.format("flight_months").option("months", "2024-01,2024-03").mode("append").save(lake)
    assert months_of(read_lake(spark, lake)) == {(2024, 1): 2, (2024, 2): 2}
    assert sorted(map(str, read_lake(spark, lake, [(2024, 2)]).collect())) == sorted(map(str, legs.where("month = 2").collect()))
    legs.write.format("flight_months").mode("overwrite").save(lake)
    assert sorted(map(str, read_lake(spark, lake).collect())) == sorted(map(str, legs.collect()))


def test_month_writer_aborts_without_a_trace(spark, lake, legs):
    spark.dataSource.register(FlightMonths)
    before, versions = sorted(map(str, read_lake(spark, lake).collect())), os.listdir(f"{lake}/_manifest")
    with pytest.raises(Exception, match="outside the months"):
        legs.repartition(3).write.format("flight_months").option("months", "2024-01").mode("append").save(lake)
    with pytest.raises(Exception, match="name the months"):
        legs.write.format("flight_months").mode("append").save(lake)
    assert sorted(map(str, read_lake(spark, lake).collect())) == before and os.listdir(f"{lake}/_manifest") == versions
    assert not [f for f in os.listdir(f"{lake}/data") if f.startswith("staged")]


@pytest.mark.parametrize("seen", [0, 1])
def test_a_task_that_outlives_the_abort_leaves_nothing(lake, legs, seen):
    writer = MonthWriter(lake, None, "late")
    batches = [b for m in (1, 2) for b in legs.where(f"month = {m}").toArrow().combine_chunks().to_batches()]

    def rows():
        yield from batches[:seen]
        writer.abort([])  # another task has failed meanwhile
        yield from batches[seen:]

    with pytest.raises(OSError):
        writer.write(rows())
    assert not [f for f in os.listdir(f"{lake}/data") if f.startswith("staged")]


def test_a_task_that_ran_twice_counts_once(spark, lake, legs):
    writer = MonthWriter(lake, [(2024, 2)], "retry")
    (batch,) = legs.where("month = 2").toArrow().combine_chunks().to_batches()
    writer.write(iter([batch]))  # an attempt whose report never came
    writer.commit([writer.write(iter([batch])), None])
    assert months_of(read_lake(spark, lake))[(2024, 2)] == 2


def test_push_in_requests_and_replace(spark, tmp):
    assert pushed(tmp, "fct_monthly_otp") is None and read_push(spark, tmp, "fct_monthly_otp").count() == 0
    assert push_export({"fct_monthly_otp": otp_like(spark, 25_000).coalesce(1)}, tmp) == {"fct_monthly_otp": 25_000}
    sizes = sorted(r["count"] for r in read_push(spark, tmp, "fct_monthly_otp").groupBy("request").count().collect())
    assert sizes == [5_000, 10_000, 10_000]
    line = open(f"{tmp}/fct_monthly_otp/push={pushed(tmp, 'fct_monthly_otp')['push']}/{pushed(tmp, 'fct_monthly_otp')['requests'][0]}").readline()
    row = json.loads(line)
    assert row["month_start"] == "2024-01-01" and row["carrier_name"] is None
    mart = otp_like(spark, 700)
    assert push_export({"fct_monthly_otp": mart}, tmp) == {"fct_monthly_otp": 700}
    got = read_push(spark, tmp, "fct_monthly_otp").drop("request")
    assert sorted(map(str, got.collect())) == sorted(map(str, export_frame(mart, "fct_monthly_otp").collect()))
    assert len([f for f in os.listdir(f"{tmp}/fct_monthly_otp") if f.startswith("push=")]) == 1


def test_a_replayed_push_task_doubles_nothing(spark, tmp):
    push_export({"fct_monthly_otp": otp_like(spark, 10)}, tmp)
    writer = PushWriter(f"{tmp}/fct_monthly_otp", "again", 3)
    (batch,) = export_frame(otp_like(spark, 7).coalesce(1), "fct_monthly_otp").toArrow().combine_chunks().to_batches()
    writer.write(iter([batch]))  # its report never came
    writer.commit([writer.write(iter([batch])), None])
    assert pushed(tmp, "fct_monthly_otp")["rows"] == 7 and len(pushed(tmp, "fct_monthly_otp")["requests"]) == 3
    assert read_push(spark, tmp, "fct_monthly_otp").count() == 7


def test_a_failed_push_leaves_the_earlier_one(spark, tmp):
    push_export({"fct_monthly_otp": otp_like(spark, 10)}, tmp)
    bad = otp_like(spark, 50).repartition(3).withColumn("otp_pct", F.when(F.col("scheduled_flights") == 49, F.raise_error(F.lit("no value")).cast("double")).otherwise(F.lit(1.0)))
    with pytest.raises(Exception, match="no value"):
        push_export({"fct_monthly_otp": bad}, tmp)
    assert read_push(spark, tmp, "fct_monthly_otp").count() == 10
    # a task that was still running when the push was aborted may leave its folder to the next one
    push_export({"fct_monthly_otp": otp_like(spark, 5)}, tmp)
    assert len([f for f in os.listdir(f"{tmp}/fct_monthly_otp") if f.startswith("push=")]) == 1
