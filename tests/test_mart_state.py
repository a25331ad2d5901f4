"""Additive mart state, monthly gate summaries and coverage bitmaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flightmarts.operators import gate as G
from flightmarts.operators import reconcile as R
from flightmarts.operators.enrich import stage
from flightmarts.operators.mart_state import MartState
from flightmarts.plans.monthly import mart_frames, materialize_marts, update_summaries
from flightmarts.operators import marts as M
from flightmarts.sources import seeds
from tests.conftest import make_legs

LATE = {"arr_delay_min": 30.0, "arr_delayed_15": True, "carrier_delay_min": 10.0, "weather_delay_min": 20.0,
        "nas_delay_min": 0.0, "security_delay_min": 0.0, "late_aircraft_delay_min": 0.0}


def some_legs(spark, seed=0):
    rows = []
    for m in (1, 2, 3):
        for i in range(12):
            rows.append({
                "flight_date": dt.date(2024, m, 1 + i), "carrier_code": ["AA", "DL", "??"][(i + seed) % 3], "origin": ["JFK", "LAX"][i % 2], "dest": ["SFO", "JFK", "BOS"][i % 3],
                "origin_city": "Old Town" if i == 0 and m == 2 else ["New York, NY", "Los Angeles, CA"][i % 2], "dest_city": None if i == 4 else "Somewhere",
                "flight_number": f"{m}-{i}-{seed}", **(LATE if i % 4 == seed else {}), "cancelled": i % 5 == 0, "taxi_in_min": None if i % 2 else 4.0,
            })
    return make_legs(spark, rows)


def rebuilt(spark, legs):
    frames = mart_frames(stage(legs), seeds.carriers(spark))
    facts = frames.pop("_carrier_month")
    return {"fct_monthly_otp": M.monthly_otp_from(facts), **frames, "fct_delay_causes": M.delay_causes_from(facts)}


def same(got, want):
    for name, mart in want.items():
        a, b = (sorted(map(str, df.select(*mart.columns).collect())) for df in (got[name], mart))
        assert a == b, name


def test_state_equals_a_rebuild_after_revise_empty_and_compaction(spark, tmp):
    legs, other = some_legs(spark), some_legs(spark, 1)
    state, carriers = MartState(spark, f"{tmp}/state"), seeds.carriers(spark)
    assert state.batches() == []
    with pytest.raises(ValueError):
        state.rows("route_month")
    assert state.apply("1", added=stage(legs))
    same(state.marts(carriers), rebuilt(spark, legs))
    feb, new = legs.where("month = 2"), other.where("month = 2")
    assert state.apply("2", added=stage(new), removed=stage(feb)) and not state.apply("2", added=stage(new), removed=stage(feb))
    now = legs.where("month != 2").unionByName(new)
    same(state.marts(carriers), rebuilt(spark, now))
    state.apply("3", removed=stage(legs.where("month = 1")))  # emptied
    now = now.where("month != 1")
    same(state.marts(carriers), rebuilt(spark, now))
    assert state.rows("carrier_month").where("month_start = '2024-01-01'").count() == 0
    state.compact("4")
    assert state.batches() == ["4"] and not state.apply("3", removed=stage(legs))
    same(state.marts(carriers), rebuilt(spark, now))
    state.apply("5", added=stage(legs.where("month = 1")))
    same(state.marts(carriers), rebuilt(spark, now.unionByName(legs.where("month = 1"))))


def test_a_batch_without_its_marker_does_not_count(spark, tmp, monkeypatch):
    legs, state = some_legs(spark), MartState(spark, f"{tmp}/state")
    state.apply("1", added=stage(legs))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(MartState, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        state.apply("2", removed=stage(legs.where("month = 1")))
    same(state.marts(seeds.carriers(spark)), rebuilt(spark, legs))
    assert state.apply("2", removed=stage(legs.where("month = 1")))
    same(state.marts(seeds.carriers(spark)), rebuilt(spark, legs.where("month != 1")))


def test_an_unchanged_month_adds_no_delta_rows(spark, tmp):
    legs, state = some_legs(spark), MartState(spark, f"{tmp}/state")
    state.apply("1", added=stage(legs))
    state.apply("2", added=stage(legs.where("month = 3")), removed=stage(legs.where("month = 3")))
    assert spark.read.parquet(f"{tmp}/state/route_month/2").count() == 0


def test_gate_from_summaries_equals_the_gate_and_reads_only_changed_months(spark, tmp):
    legs, carriers = some_legs(spark), seeds.carriers(spark)
    suites = G.default_suites(dt.date(2024, 4, 1), G.Bands((1, 9), (1, 99), (1, 99), (1, 9)))
    marts = materialize_marts(spark, stage(legs), carriers, f"{tmp}/marts")
    summaries = update_summaries(spark, marts, suites, f"{tmp}/summaries")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(G.evaluate_summaries(summaries, suites)) == key(G.evaluate(marts, suites))
    changed = legs.where("month = 1").unionByName(some_legs(spark, 1).where("month = 3"))  # February is emptied
    months = [(2024, 2), (2024, 3)]
    marts = materialize_marts(spark, stage(changed), carriers, f"{tmp}/marts", months)
    summaries = update_summaries(spark, marts, suites, f"{tmp}/summaries", months)
    assert summaries["fct_monthly_otp"].where("month_start = '2024-02-01'").count() == 0
    assert key(G.evaluate_summaries(summaries, suites)) == key(G.evaluate(marts, suites))
    one = marts["fct_monthly_otp"].where(F.col("month_start").isin([dt.date(2024, 3, 1)]))
    plan = G.summarize(one, suites["fct_monthly_otp"])._jdf.queryExecution().executedPlan().toString()
    assert "month_start" in plan.split("PartitionFilters: [")[1].split("]")[0]
    nothing = {t: G.summarize(m.where(F.lit(False)), suites[t], t) for t, m in marts.items()}
    assert key(G.evaluate_summaries(nothing, suites)) == key(G.evaluate({t: m.where(F.lit(False)) for t, m in marts.items()}, suites))


def test_coverage_over_many_years_and_merged(spark):
    have = {("a", y, m) for y in range(1995, 2013) for m in range(1, 13) if (y * 12 + m) % 7} | {("b", 1999, 12), ("b", 2000, 1)}
    rows = spark.createDataFrame([(e, y, m) for e, y, m in have for _ in range(2)] + [(None, 2005, 5)], "e string, year int, month int")
    first, last = dt.date(1994, 11, 1), dt.date(2012, 12, 1)
    every = {(y, m) for y in range(1994, 2013) for m in range(1, 13) if dt.date(y, m, 1) >= first}
    want = {(e, y, m) for e in ("a", "b", None) for y, m in every if (e, y, m) not in have | {(None, 2005, 5)}}
    whole = R.coverage(rows, ["e"])
    parts = R.merge_coverage(*[R.coverage(rows.where(f"month % 3 = {i}"), ["e"]) for i in range(3)])
    for covered in (whole, parts):
        got = [tuple(r) for r in R.coverage_gaps(covered, first, last).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert R.missing_months(rows.where("false"), ["e"]).collect() == []
