import datetime as dt

import pytest
from pyspark.sql import functions as F

from flightmarts.operators.reconcile import (
    data_month_slice,
    missing_months,
    month_spine,
    requested_months_missing,
    rows_by_month,
    rows_by_month_running,
)
from flightmarts.sinks.lake import (
    declare_raw_table,
    load_full,
    load_months,
    overwrite_months,
    raw_table_ddl,
    with_audit,
    write_lake,
)
from flightmarts.sources.lake import read_lake, read_lake_files
from tests.conftest import make_legs


def month_rows(df):
    return {(r["year"], r["month"]): r["rows"] for r in rows_by_month(df).collect()}


@pytest.fixture
def three_months(spark):
    rows = []
    for d, n in [(dt.date(2024, 1, 5), 3), (dt.date(2024, 2, 5), 2), (dt.date(2024, 3, 5), 1)]:
        rows += [{"flight_date": d} for _ in range(n)]
    return make_legs(spark, rows)


def test_write_and_prune(spark, tmp, three_months):
    report = write_lake(three_months, f"{tmp}/lake")
    assert report.rows == 6 and report.months == [(2024, 1), (2024, 2), (2024, 3)]
    df = read_lake(spark, f"{tmp}/lake", [(2024, 2)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() == 2
    assert month_rows(read_lake_files(spark, f"{tmp}/lake")) == {(2024, 1): 3, (2024, 2): 2, (2024, 3): 1}


def test_month_overwrite_is_idempotent_and_empties(spark, tmp, three_months):
    root = f"{tmp}/lake"
    write_lake(three_months, root)
    feb = three_months.where("month = 2")
    overwrite_months(feb, root, [(2024, 2)])
    overwrite_months(feb, root, [(2024, 2)])
    assert month_rows(read_lake(spark, root)) == {(2024, 1): 3, (2024, 2): 2, (2024, 3): 1}
    report = overwrite_months(three_months.where(F.lit(False)), root, [(2024, 3)])
    assert report.emptied == [(2024, 3)]
    assert month_rows(read_lake(spark, root)) == {(2024, 1): 3, (2024, 2): 2}


def test_rows_outside_the_months_abort_and_change_nothing(spark, tmp, three_months):
    root = f"{tmp}/lake"
    write_lake(three_months, root)
    stray = make_legs(spark, [{"flight_date": dt.date(2024, 2, 9)}, {"flight_date": dt.date(2024, 1, 9)}])
    with pytest.raises(Exception, match="outside the months"):
        overwrite_months(stray, root, [(2024, 2)])
    assert month_rows(read_lake(spark, root)) == {(2024, 1): 3, (2024, 2): 2, (2024, 3): 1}


def test_raw_table_loads_and_length_bounds(spark, tmp, three_months):
    lake = f"{tmp}/lake"
    write_lake(three_months, lake)
    load_full(read_lake(spark, lake), f"{tmp}/raw")
    load_months(read_lake(spark, lake), f"{tmp}/raw", [(2024, 1)])
    raw = spark.read.parquet(f"{tmp}/raw")
    assert month_rows(raw) == {(2024, 1): 3, (2024, 2): 2, (2024, 3): 1}
    assert raw.where(F.col("_loaded_at").isNull()).count() == 0
    assert dict(raw.dtypes)["_loaded_at"] == "timestamp_ntz"
    too_long = make_legs(spark, [{"origin_state": "EUROPE"}])
    with pytest.raises(Exception, match="VARCHAR"):
        load_full(too_long, f"{tmp}/raw2")


def test_counts_and_gaps(spark, tmp):
    legs = make_legs(spark, [
        {"carrier_code": "AA", "flight_date": dt.date(2024, 1, 5)},
        {"carrier_code": "AA", "flight_date": dt.date(2024, 3, 5)},
        {"carrier_code": "DL", "flight_date": dt.date(2024, 2, 5)},
        {"carrier_code": "DL", "flight_date": dt.date(2024, 2, 6)},
    ])
    gaps = {(r["carrier_code"], r["month"]) for r in missing_months(legs, ["carrier_code"]).collect()}
    assert gaps == {("AA", 2), ("DL", 1), ("DL", 3)}
    run = [(r["month"], r["rows"], r["running_rows"]) for r in rows_by_month_running(legs).orderBy("month").collect()]
    assert run == [(1, 1, 1), (2, 2, 3), (3, 1, 4)]
    sl = data_month_slice(legs, dt.date(2024, 4, 20)).collect()
    assert [(r["carrier_code"], r["flights"]) for r in sl] == [("DL", 2)]
    spine = month_spine(spark, "2023-11", "2024-04")
    todo = requested_months_missing(spine, legs).orderBy("year", "month").collect()
    assert [(r["year"], r["month"]) for r in todo] == [(2023, 11), (2023, 12), (2024, 4)]
    with pytest.raises(Exception):
        month_spine(spark, "2024-05", "2024-01").collect()


def test_declared_raw_table(spark, tmp, three_months):
    ddl = raw_table_ddl("raw_flights_t", f"{tmp}/rawt")
    assert "`origin_state` VARCHAR(4)" in ddl and "`_loaded_at` TIMESTAMP_NTZ" in ddl
    write_lake(three_months, f"{tmp}/lake")
    load_full(read_lake(spark, f"{tmp}/lake"), f"{tmp}/rawt")
    table = declare_raw_table(spark, "raw_flights_t", f"{tmp}/rawt")
    assert month_rows(table) == {(2024, 1): 3, (2024, 2): 2, (2024, 3): 1}
    too_long = make_legs(spark, [{"origin_state": "EUROPE", "flight_date": dt.date(2024, 4, 1)}])
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        with_audit(too_long).select(*table.columns).write.insertInto("raw_flights_t")
    spark.sql("DROP TABLE raw_flights_t")


def test_data_month_slice_prunes_to_one_partition(spark, tmp, three_months):
    write_lake(three_months, f"{tmp}/lake")
    df = data_month_slice(read_lake(spark, f"{tmp}/lake"), dt.date(2024, 4, 20))   # owns 2024-02
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "= 2024" in filters and "= 2" in filters
    assert [(r["year"], r["month"], r["flights"]) for r in df.collect()] == [(2024, 2, 2)]
