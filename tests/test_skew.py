"""Hot keys: every leg-level aggregate pre-aggregates before its shuffle."""

import importlib
import re

from pyspark.sql import functions as F

from flightmarts.operators import marts as M
from flightmarts.operators.clean import deduplicate
from flightmarts.operators.enrich import enrich, stage
from flightmarts.plans.monthly import mart_frames
from flightmarts.sources import seeds
from tests.conftest import make_legs

C = importlib.import_module("flightmarts.operators.clean")  # the package re-exports a function of that name


def _partial_before_exchange(df) -> bool:
    """True if every hash exchange in the plan sits on top of a partial aggregate."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(plan):
        if "Exchange hashpartitioning" in line:
            below = "\n".join(plan[i + 1:i + 4])
            if not re.search(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", below):
                return False
    return True


def test_hot_key_dedup_and_marts(spark):
    # one natural key holds a third of all rows (exact copies), the rest are distinct
    hot = [{"flight_number": "1"} for _ in range(30)]
    rest = [{"flight_number": str(100 + i), "carrier_code": "DL" if i % 2 else "AA"} for i in range(60)]
    legs = make_legs(spark, hot + rest)
    d = deduplicate(legs.repartition(6))
    assert d.count() == 61
    assert _partial_before_exchange(d)
    e = enrich(stage(d), seeds.carriers(spark), seeds.cancellation_codes(spark))
    for name, mart in mart_frames(stage(d), seeds.carriers(spark)).items():
        assert _partial_before_exchange(mart), name
    otp = {r["carrier_code"]: r["scheduled_flights"] for r in M.monthly_otp(e).collect()}
    assert otp == {"AA": 31, "DL": 30}


def test_mart_plans_read_no_lookup_over_the_legs(spark):
    from flightmarts.plans import queries as Q
    from tests.conftest import SF_SMALL

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for q, joins in ((Q.q_route_performance, 0), (Q.q_airport_congestion, 0), (Q.q_airport_congestion_join, 1)):
        text = plan(q(spark, SF_SMALL))
        assert text.count("Join") == joins and "carrier_name" not in text
        below = text[text.rindex("SortAggregate") :]  # sorts only what a hash aggregate has reduced
        assert "HashAggregate" in below
    otp = plan(Q.q_monthly_otp(spark, SF_SMALL))
    assert otp.index("Join") < otp.rindex("HashAggregate")  # the lookup meets aggregated rows


def test_adaptive_skew_handling_is_on(spark):
    conf = spark.conf
    assert conf.get("spark.sql.adaptive.enabled") == "true"
    assert conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert conf.get("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled") == "true"


def _leg_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def _mixed(spark):
    """A month with most rows, a key with a third of all, copies that differ, and a stray month."""
    import datetime as dt

    rows = [{"flight_number": "hot", "arr_delay_min": float(i % 7)} for i in range(60)]
    rows += [{"flight_number": f"j{i // 2}", "tail_number": f"N{i % 2}"} for i in range(90)]
    rows += [{"flight_number": f"m{i}", "flight_date": dt.date(2024, 3, 1 + i % 9)} for i in range(20)]
    rows += [{"flight_number": "odd", "year": 2023, "month": 12}, {"flight_number": "odd", "tail_number": "N0", "year": 2024, "month": 1}]
    rows += [{"flight_number": None}] * 3
    return make_legs(spark, rows).repartition(5)


def test_buckets_keep_the_winners_with_one_exchange(spark):

    legs = C.drop_missing_keys(_mixed(spark))
    want = sorted(map(str, deduplicate(legs).collect()))
    for plan in (C.DedupPlan(), C.DedupPlan(default=5), C.DedupPlan(buckets={(2024, 1): 7})):
        got = C.deduplicate_in_buckets(legs, plan)
        n, text = _leg_exchanges(got)
        assert n == 1 and "hashpartitioning(_flown" in text  # the aggregate adds none
        assert sorted(map(str, got.collect())) == want


def test_observed_skew_splits_months_and_reduces_heavy_keys_first(spark):

    legs = C.drop_missing_keys(_mixed(spark))
    plan = C.observe_skew(legs, rows_per_bucket=50)
    assert plan.buckets == {(2024, 1): 1 + 152 // 50, (2024, 3): 1}
    hot = legs.where("flight_number = 'hot'").select(C.key_hash().alias("h")).first()["h"]
    assert plan.heavy == (hot,)
    got = C.deduplicate_in_buckets(legs, plan)
    assert sorted(map(str, got.collect())) == sorted(map(str, deduplicate(legs).collect()))
    _, text = _leg_exchanges(got)
    heavy = text[text.rindex("Exchange hashpartitioning(flight_date") :]
    assert "partial_min" in heavy  # copies of a heavy key are reduced before their exchange
    assert C.observe_skew(legs.where(F.lit(False))) == C.DedupPlan()
    assert C.observe_skew(legs) == C.DedupPlan(buckets={(2024, 1): 1, (2024, 3): 1})
    assert C.plan_by_size(10 * C.BYTES_PER_BUCKET, 2) == C.DedupPlan(default=6)


def test_a_written_month_is_dealt_once(spark, tmp):
    import os

    from flightmarts.sinks.lake import write_lake
    from flightmarts.sources.fixture import raw_strings
    from flightmarts.sources.lake import read_lake

    raw = raw_strings(_mixed(spark).where("flight_number is not null").withColumn("flight_number", F.abs(F.hash("flight_number")).cast("string")))
    out = C.clean_for_months(raw, C.DedupPlan(default=2))
    report = write_lake(out, f"{tmp}/lake", rebalance=False)
    assert sorted(map(str, read_lake(spark, f"{tmp}/lake").collect())) == sorted(map(str, C.clean(raw).collect()))
    assert report.rows == C.clean(raw).count()
    files = [f for f in os.listdir(f"{tmp}/lake/year=2024/month=3") if f.endswith(".parquet")]
    assert len(files) <= 2  # as many as its buckets

