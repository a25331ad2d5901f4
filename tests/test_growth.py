"""Steps whose shuffles, spills or repeated passes grew faster than the tables."""

import datetime as dt
import gzip
import importlib
import itertools
import os

import pytest
from pyspark.sql import functions as F

from flightmarts import config, jobs
from flightmarts.plans import queries as Q
from flightmarts.sinks.lake import write_lake
from flightmarts.sources import fixture
from flightmarts.sources.lake import read_lake
from flightmarts.streaming import ledger
from tests.conftest import SF_SMALL, make_legs, released, shuffle_bytes

C = importlib.import_module("flightmarts.operators.clean")


def _months(spark, n=400):
    rows = [{"flight_number": f"f{i // 2}", "tail_number": f"N{i}", "flight_date": dt.date(2024, 1 + i // 2 % 6, 5)} for i in range(n)]
    return make_legs(spark, rows).repartition(3)


def test_buckets_are_dealt_evenly_in_one_exchange(spark):
    legs = _months(spark)
    plan = C.observe_skew(legs, rows_per_bucket=20)
    assert 1 < plan.tasks <= spark.sparkContext.defaultParallelism and plan.per_task * plan.tasks >= sum(plan.buckets.values())
    got = C.deduplicate_in_buckets(legs, plan)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange shufflepartitionidpassthrough") == 1 and "hashpartitioning" not in text  # the aggregate adds none
    assert sorted(map(str, got.collect())) == sorted(map(str, C.deduplicate(legs).collect()))
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == plan.tasks and max(sizes) <= 2 * min(sizes)


def test_no_task_sorts_more_legs_than_its_share_allows(spark, monkeypatch):
    legs = _months(spark)
    monkeypatch.setattr(C, "ROWS_PER_TASK", 30)
    plan = C.observe_skew(legs, rows_per_bucket=20)
    assert legs.count() / plan.tasks <= 30 and plan.per_task * plan.tasks >= sum(plan.buckets.values())
    assert sorted(map(str, C.deduplicate_in_buckets(legs, plan).collect())) == sorted(map(str, C.deduplicate(legs).collect()))


def test_tasks_stay_as_small_as_those_of_a_small_lake():
    """320,000 legs are a core's share of 3.6 M legs on 12 cores; with more legs there are more tasks."""
    assert C.ROWS_PER_TASK <= 320_000
    plan = C.plan_by_size(80 * 40 * C.BYTES_PER_BUCKET, 80)
    assert plan.per_task * C.ROWS_PER_BUCKET <= 320_000


def test_buckets_by_size_alone_are_dealt_by_month(spark):
    legs = _months(spark)
    plan = C.plan_by_size(6 * 2 * C.BYTES_PER_BUCKET, 6)
    assert (plan.default, plan.per_task, plan.tasks) == (3, 3, 6)
    got = C.deduplicate_in_buckets(legs, plan)
    assert sorted(map(str, got.collect())) == sorted(map(str, C.deduplicate(legs).collect()))
    per_task = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("flight_date").alias("n"))
    assert {r["n"] for r in per_task.collect()} == {1}


def test_months_far_apart_are_looked_up(spark):
    legs = make_legs(spark, [{"flight_date": dt.date(y, 2, 1), "flight_number": str(i)} for y in (1000, 2024) for i in range(9)])
    plan = C.observe_skew(legs, rows_per_bucket=4)
    assert C.deduplicate_in_buckets(legs, plan).count() == 18


def test_a_key_is_heavy_by_its_share_of_all_rows(spark):
    rows = [{"flight_number": f"f{i // 3}"} for i in range(900)] + [{"flight_number": "hot"}] * 90
    legs = make_legs(spark, rows)
    many = legs.crossJoin(spark.range(20).withColumnRenamed("id", "copy"))
    many = many.withColumn("flight_number", F.when(F.col("flight_number") == "hot", "hot").otherwise(F.concat_ws("-", "flight_number", "copy"))).drop("copy")
    plan = C.observe_skew(many, rows_per_bucket=8)  # 3 copies would do by the bucket alone
    assert len(plan.heavy) == 1


def test_a_write_by_month_does_not_sort(spark, tmp):
    legs = _months(spark)
    before = spark.conf.get(jobs.OPEN_FILES, "0")
    with jobs.unsorted_writes(spark):
        with jobs.unsorted_writes(spark):
            assert spark.conf.get(jobs.OPEN_FILES) == str(jobs.OPEN_MONTHS)
        assert spark.conf.get(jobs.OPEN_FILES) == str(jobs.OPEN_MONTHS)
    assert spark.conf.get(jobs.OPEN_FILES, "0") == before
    with pytest.raises(ZeroDivisionError), jobs.unsorted_writes(spark):
        1 / 0
    assert spark.conf.get(jobs.OPEN_FILES, "0") == before
    spark.conf.set(jobs.OPEN_FILES, "3")
    try:
        with jobs.unsorted_writes(spark):
            assert spark.conf.get(jobs.OPEN_FILES) == "3"  # the caller's value stays
    finally:
        spark.conf.unset(jobs.OPEN_FILES)
    # one task with all months keeps a file of each open: rows stay in the order they had
    ordered = legs.coalesce(1).sortWithinPartitions("tail_number")
    write_lake(ordered, f"{tmp}/lake", rebalance=False)
    seen = [r["tail_number"] for r in spark.read.parquet(f"{tmp}/lake").where("month = 1").select("tail_number").collect()]
    assert seen == sorted(seen) and read_lake(spark, f"{tmp}/lake").count() == legs.count()


def test_a_month_in_several_batches_is_loaded_once(spark, tmp, monkeypatch):
    legs = _months(spark, 60).where("month = 1 or month = 2")
    write_lake(legs.repartition(4), f"{tmp}/lake", rebalance=False)
    assert len([f for f in os.listdir(f"{tmp}/lake/year=2024/month=1") if f.endswith(".parquet")]) > 1
    loads = []
    load = ledger.load_months
    monkeypatch.setattr(ledger, "load_months", lambda lake, root, months, lengths: (loads.extend(months), load(lake, root, months, lengths)))
    assert ledger.incremental_load(spark, f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/ckpt", max_files_per_trigger=1) > 2
    assert sorted(loads) == sorted(set(loads))
    assert ledger.read_raw_table(spark, f"{tmp}/raw").count() == legs.count()


def test_raw_rows_come_from_one_pass_over_the_legs(spark):
    raw = fixture.raw_strings(fixture.legs(spark, SF_SMALL))
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber") and plan.count("l_suppkey#") and "Union" not in plan
    legs = fixture.legs(spark, SF_SMALL)
    tens = legs.where(F.col("flight_number").cast("long") % fixture.DUPLICATE_MODULUS == 0).count()
    assert raw.count() == legs.count() + tens


@pytest.mark.parametrize("name", ["month_overwrite", "incremental_load", "month_commit", "fingerprint_ledger"])
def test_reloads_copy_the_lake_as_it_lies(spark, monkeypatch, name):
    Q.lake(spark, SF_SMALL)

    def again(*_):
        raise AssertionError("the legs are joined and cleaned again")

    monkeypatch.setattr(Q, "legs", again)
    write, kinds = Q.write_lake, []

    def spy(flights, root, commits=False, rebalance=True):
        kinds.append(rebalance)
        return write(flights, root, commits, rebalance)

    monkeypatch.setattr(Q, "write_lake", spy)
    assert Q.QUERIES[name](spark, SF_SMALL).count() == 79
    assert kinds[0] is False  # no exchange for rows that lie by month


def test_backfill_needs_no_lake_for_its_bounds(spark, monkeypatch):
    def built(*_):
        raise AssertionError("a lake of all legs is built for two dates")

    monkeypatch.setattr(Q, "lake", built)
    assert Q.q_backfill_months(spark, SF_SMALL).count() == 80


@pytest.fixture
def own_artefacts(spark, monkeypatch):
    """Artefacts are made anew, with exchanges for all joins."""
    monkeypatch.setattr(Q, "_WORKSPACES", {})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_files_are_compressed_and_their_exchanges_gone(spark, monkeypatch, own_artefacts):
    monkeypatch.setattr(Q, "RAW_ROWS_PER_FILE", 500)
    before = shuffle_bytes(spark)
    path = Q.raw_csv(spark, SF_SMALL)
    assert released(spark, before)
    files = [f"{path}/{x}" for x in os.listdir(path) if x.endswith(".csv.gz")]
    texts = [gzip.open(f).read() for f in files]
    assert sum(map(os.path.getsize, files)) < sum(map(len, texts)) / 4
    assert max(t.count(b"\n") for t in texts) <= 501  # a task reads a file whole
    raw = fixture.raw_strings(fixture.legs(spark, SF_SMALL))
    assert sum(t.count(b"\n") - 1 for t in texts) == raw.count()
    own, legs = (f(spark, SF_SMALL).drop("cancellation_code") for f in (Q.q_clean_flights, Q.clean_legs))  # an empty text is read as none
    assert sorted(map(str, own.collect())) == sorted(map(str, legs.collect()))


def test_the_legs_cross_their_exchanges_narrow(spark, own_artefacts):
    """Names of places and columns that nothing uses stay behind the exchanges."""
    plan = fixture.legs(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at, join = next((i, line.index("Join")) for i, line in enumerate(plan) if "Join Inner" in line and "p_partkey" in line)
    below = list(itertools.takewhile(lambda line: len(line) - len(line.lstrip(" :+-")) > join, plan[at + 1 :]))
    assert any("l_orderkey" in line for line in below)
    assert not any(word in line for word in ("city", "state", "n_name") for line in below if "Relation" not in line)


def test_observed_skew_leaves_no_exchange(spark, own_artefacts):
    before = shuffle_bytes(spark) + 8_000  # places, which two joins share, are not released
    plan = C.observe_skew(fixture.legs(spark, SF_SMALL), rows_per_bucket=20)
    assert plan.tasks > 1 and released(spark, before)
    skewed = Q.q_clean_skewed(spark, SF_SMALL)
    assert released(spark, before)  # only what the query itself will exchange is to come
    assert skewed.count() == Q.clean_legs(spark, SF_SMALL).count()


def test_writes_by_month_leave_no_exchange(spark, tmp, own_artefacts):
    legs = fixture.legs(spark, SF_SMALL)
    n = C.deduplicate(legs).count()
    plan = C.observe_skew(legs)
    before = shuffle_bytes(spark) + 8_000
    for commits in (False, True):
        write_lake(C.deduplicate_in_buckets(legs, plan), f"{tmp}/lake-{commits}", commits=commits, rebalance=False)
        assert released(spark, before)
        assert read_lake(spark, f"{tmp}/lake-{commits}").count() == n
    [row] = Q.q_clean_reconciliation(spark, SF_SMALL).collect()
    assert released(spark, before) and row["rows_out"] == n


def test_a_lake_joins_its_legs_once(spark, monkeypatch, own_artefacts):
    """The months are observed on the joined legs as they wait in a table, which goes with its exchanges."""
    made, roots = [], []
    legs, path = Q.legs, config.scratch_path

    def spy(s, name):
        roots.append(path(s, name))
        return roots[-1]

    observe = Q.observe_skew

    def observed(flights):
        made.append(flights._jdf.queryExecution().optimizedPlan().toString())
        return observe(flights)

    monkeypatch.setattr(config, "scratch_path", spy)
    monkeypatch.setattr(Q, "observe_skew", observed)
    before = shuffle_bytes(spark) + 8_000
    root = Q.lake_root(spark, SF_SMALL)
    assert len(made) == 1 and "Join" not in made[0]
    assert released(spark, before)
    [waited] = [r for r in roots if "/legs-" in r]
    assert not os.path.exists(waited) and os.path.exists(root)
    assert read_lake(spark, root).count() == C.deduplicate(legs(spark, SF_SMALL)).count()


def test_a_scratch_table_goes_when_its_block_fails(spark):
    with pytest.raises(ZeroDivisionError), config.scratch_table(spark.range(5), "short") as rows:
        [path] = {os.path.dirname(f.removeprefix("file://")) for f in rows.inputFiles()}
        assert os.path.exists(path) and rows.count() == 5
        1 / 0
    assert not os.path.exists(path)
