import datetime as dt
import os

from pyspark.sql import functions as F

from flightmarts.operators.reconcile import rows_by_month
from flightmarts.sinks.export import export_batches, export_frame, read_export, write_export
from flightmarts.sinks.lake import overwrite_months, write_lake
from flightmarts.streaming.ledger import incremental_load
from tests.conftest import make_legs


def otp_like(spark, n):
    return spark.range(n).select(
        F.lit(dt.date(2024, 1, 1)).alias("month_start"),
        (F.col("id") % 7).cast("string").alias("carrier_code"),
        F.lit(None).cast("string").alias("carrier_name"),
        *[F.col("id").alias(c) for c in ["scheduled_flights", "cancelled_flights", "diverted_flights",
                                          "completed_flights", "on_time_flights"]],
        F.lit(75.5).alias("otp_pct"), F.lit(None).cast("double").alias("cancellation_pct"),
        F.lit(1.25).alias("avg_arr_delay_min"), F.lit(-3.0).alias("avg_dep_delay_min"),
    )


def test_export_batches_of_10000(spark, tmp):
    mart = otp_like(spark, 25_000).coalesce(1)
    totals = write_export({"fct_monthly_otp": mart}, tmp)
    assert totals == {"fct_monthly_otp": 25_000}
    sizes = sorted(r["n"] for r in read_export(spark, tmp, "fct_monthly_otp").groupBy("batch_file")
                   .agg(F.count(F.lit(1)).alias("n")).collect())
    assert sizes == [5_000, 10_000, 10_000]
    b = export_batches(spark, tmp, ["fct_monthly_otp"]).first()
    assert (b["rows"], b["batches"], b["max_batch_rows"]) == (25_000, 3, 10_000)
    line = open(next(os.path.join(tmp, "fct_monthly_otp", f) for f in os.listdir(f"{tmp}/fct_monthly_otp")
                     if f.endswith(".json"))).readline()
    assert '"month_start":"2024-01-01"' in line and '"carrier_name":null' in line  # ISO date, NULL kept


def test_export_types(spark):
    df = export_frame(otp_like(spark, 3), "fct_monthly_otp")
    types = dict(df.dtypes)
    assert types["month_start"] == "string" and types["scheduled_flights"] == "bigint"
    assert types["otp_pct"] == "double"


def test_ledger_stream_loads_each_file_once(spark, tmp):
    legs = make_legs(spark, [{"flight_date": dt.date(2024, m, 3)} for m in (1, 1, 2)])
    lake, target, ckpt = f"{tmp}/lake", f"{tmp}/target", f"{tmp}/ckpt"
    write_lake(legs, lake)
    assert incremental_load(spark, lake, target, ckpt) == 1
    assert incremental_load(spark, lake, target, ckpt) == 0          # plain re-run: nothing new
    counts = {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(target)).collect()}
    assert counts == {(2024, 1): 2, (2024, 2): 1}
    # a re-transformed month lands as new files and is reloaded whole
    jan = make_legs(spark, [{"flight_date": dt.date(2024, 1, d)} for d in (3, 4, 5)])
    overwrite_months(jan, lake, [(2024, 1)])
    assert incremental_load(spark, lake, target, ckpt) == 1
    counts = {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(target)).collect()}
    assert counts == {(2024, 1): 3, (2024, 2): 1}


def test_ledger_empties_a_month_that_became_empty(spark, tmp):
    lake, target, ckpt = f"{tmp}/lake", f"{tmp}/target", f"{tmp}/ckpt"
    legs = make_legs(spark, [{"flight_date": dt.date(2024, m, 3)} for m in (1, 1, 2)])
    write_lake(legs, lake)
    incremental_load(spark, lake, target, ckpt)
    overwrite_months(legs.where("false"), lake, [(2024, 1)])
    assert incremental_load(spark, lake, target, ckpt) >= 1
    counts = {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(target)).collect()}
    assert counts == {(2024, 2): 1}
    assert incremental_load(spark, lake, target, ckpt) == 0


def test_second_push_replaces_the_first(spark, tmp):
    write_export({"fct_monthly_otp": otp_like(spark, 12_000)}, tmp)
    assert write_export({"fct_monthly_otp": otp_like(spark, 700)}, tmp) == {"fct_monthly_otp": 700}
    assert export_batches(spark, tmp, ["fct_monthly_otp"]).first()["rows"] == 700


def test_ledger_month_split_across_batches_is_loaded_whole(spark, tmp):
    lake, target, ckpt = f"{tmp}/lake", f"{tmp}/target", f"{tmp}/ckpt"
    jan_a = make_legs(spark, [{"flight_date": dt.date(2024, 1, d)} for d in (1, 2)])
    jan_b = make_legs(spark, [{"flight_date": dt.date(2024, 1, d), "flight_number": f"9{d}"} for d in (3, 4, 5)])
    # two files in the same month folder
    jan_a.coalesce(1).write.mode("overwrite").partitionBy("year", "month").parquet(lake)
    jan_b.coalesce(1).write.mode("append").partitionBy("year", "month").parquet(lake)
    assert len([f for f in os.listdir(f"{lake}/year=2024/month=1") if f.endswith(".parquet")]) == 2
    batches = incremental_load(spark, lake, target, ckpt, max_files_per_trigger=1)
    assert batches == 2
    counts = {(r["year"], r["month"]): r["rows"] for r in rows_by_month(spark.read.parquet(target)).collect()}
    assert counts == {(2024, 1): 5}   # not just the 2 or 3 rows of the last batch
