import datetime as dt

import pytest
from pyspark.sql import functions as F

from flightmarts.functions import (
    data_month,
    exact_ratio,
    flag_to_bool,
    freshness_floor,
    month_sequence,
)
from flightmarts.functions.exact import scaled_long
from flightmarts.functions.months import month_numbers
from flightmarts.functions.strict import strict_cast


def test_exact_ratio_half_up_and_zero(spark):
    df = spark.createDataFrame(
        [(1, 8), (-1, 8), (2, 3), (5, 0), (1, 40), (1005, 1000)], "n long, d long"
    )
    got = [r[0] for r in df.select(exact_ratio(F.col("n"), F.col("d"), 2)).collect()]
    # 0.125 -> 0.13 and -0.125 -> -0.13 (ties away from zero), 1/40 = 0.025 -> 0.03
    assert got == [0.13, -0.13, 0.67, None, 0.03, 1.01]


def test_flags(spark):
    df = spark.createDataFrame([("1.00",), ("0.00",), ("2.00",), (None,)], "f string")
    assert [r[0] for r in df.select(flag_to_bool("f")).collect()] == [True, False, False, None]


def test_flag_non_numeric_fails(spark):
    df = spark.createDataFrame([("abc",)], "f string")
    with pytest.raises(Exception):
        df.select(flag_to_bool("f")).collect()


def test_month_arithmetic(spark):
    row = spark.range(1).select(
        data_month(F.lit(dt.date(2026, 1, 10))).alias("jan_run"),
        data_month(F.lit(dt.date(2025, 3, 1))).alias("mar_run"),
        freshness_floor(F.lit(dt.date(2026, 1, 31))).alias("floor"),
        F.size(month_sequence(F.lit(dt.date(2024, 11, 5)), F.lit(dt.date(2025, 2, 1)))).alias("n"),
    ).first()
    assert row["jan_run"] == dt.date(2025, 11, 1)  # January run owns November of the year before
    assert row["mar_run"] == dt.date(2025, 1, 1)
    assert row["floor"] == dt.date(2025, 9, 1)
    assert row["n"] == 4
    assert month_numbers("2024-11", "2025-02") == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]
    with pytest.raises(ValueError):
        month_numbers("2025-03", "2025-01")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_casts_whatever_the_session_says(spark, ansi):
    from pyspark.sql import types as T

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("1.5", "2024-02-29"), (None, None)], "n string, d string")
        cols = [strict_cast("n", T.DoubleType()).alias("n"), strict_cast("d", T.DateType()).alias("d")]
        assert [tuple(r) for r in good.select(*cols).collect()] == [(1.5, dt.date(2024, 2, 29)), (None, None)]
        for n, d in (("abc", "2024-02-29"), ("1.5", "2024-02-30"), ("1.5", "soon")):
            with pytest.raises(Exception, match="cannot cast"):
                spark.createDataFrame([(n, d)], "n string, d string").select(*cols).collect()
        with pytest.raises(Exception, match="cannot cast"):
            spark.createDataFrame([("yes",)], "f string").select(flag_to_bool("f")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_measures_finer_than_the_scale_fail(spark):
    df = spark.createDataFrame([(12.34,), (None,), (-0.07,), (1e9 + 0.01,)], "v double")
    assert [r[0] for r in df.select(scaled_long("v")).collect()] == [1234, None, -7, 100000000001]
    with pytest.raises(Exception, match="finer"):
        spark.createDataFrame([(0.125,)], "v double").select(scaled_long("v")).collect()


def test_month_sequence_reversed_fails(spark):
    with pytest.raises(Exception):
        spark.range(1).select(month_sequence(F.lit(dt.date(2025, 3, 1)), F.lit(dt.date(2025, 1, 1)))).collect()


def test_exact_ratio_matches_decimal_half_up(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    rng = random.Random(7)
    pairs = [(rng.randint(-10**12, 10**12), rng.randint(1, 10**7)) for _ in range(300)]
    pairs += [(k * 5, 1000) for k in range(-40, 41)]           # exact ties at the third decimal
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", exact_ratio(F.col("n"), F.col("d"), 2).alias("r")).collect()
    for row in got:
        want = float((Decimal(row["n"]) / Decimal(row["d"])).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert row["r"] == want, (row["n"], row["d"], row["r"], want)
