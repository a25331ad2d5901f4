import datetime as dt

import pytest
from pyspark.sql import functions as F

from flightmarts.operators import checks as C
from flightmarts.operators import gate as G
from flightmarts.plans import queries as Q
from tests.conftest import SF_SMALL

BANDS_SF0001 = G.Bands(monthly_otp=(100, 2600), route_performance=(1_000, 10_000),
                       airport_congestion=(500, 5_000), delay_causes=(100, 2600))


@pytest.fixture(scope="module")
def tables(spark):
    return Q.check_tables(spark, SF_SMALL)


def test_all_declared_checks_pass_on_fixture(tables):
    checks = C.default_checks()
    assert len(checks) == 29
    rows = C.summarize(C.run_checks(tables, checks)).collect()
    assert len(rows) == 29
    assert [r for r in rows if r["status"] != "pass"] == []
    C.raise_on_errors(rows)


def test_checks_report_failures(spark, tables):
    otp = tables["fct_monthly_otp"]
    broken = {**tables, "fct_monthly_otp": otp.unionByName(otp.limit(3)).withColumn(
        "otp_pct", F.when(F.col("otp_pct").isNotNull(), F.lit(120.0)))}
    res = {(r["check_name"], r["column_name"]): r for r in
           C.summarize(C.run_checks(broken, [c for c in C.default_checks()
                                             if c.relation == "fct_monthly_otp"])).collect()}
    assert res[("unique_combination", "month_start,carrier_code")]["failures"] == 3
    assert res[("accepted_range", "otp_pct")]["failures"] > 0
    with pytest.raises(RuntimeError, match="data tests failed"):
        C.raise_on_errors(list(res.values()))
    codes = spark.createDataFrame([("A",), ("Z",), (None,)], "cancellation_code string")
    warn = C.summarize(C.run_checks({"stg_flights": codes}, [c for c in C.default_checks()
                                    if c.kind == "accepted_values" and c.relation == "stg_flights"])).first()
    assert (warn["failures"], warn["status"]) == (1, "warn")   # NULL passes, 'Z' warns
    C.raise_on_errors([warn])                                     # warnings do not stop the run


def test_gate_opens_and_closes(spark):
    marts = Q.mart_tables(spark, SF_SMALL)
    as_of = dt.date(2001, 9, 15)
    res = G.evaluate(marts, G.default_suites(as_of, BANDS_SF0001))
    assert res.count() == 16
    assert G.decision(res).first()["gate_open"] is True
    stats = {r["suite"]: r for r in G.suite_stats(res).collect()}
    assert stats["fct_monthly_otp"]["evaluated_expectations"] == 6
    # partial load: drop most months -> row-count band fails
    partial = {**marts, "fct_monthly_otp": marts["fct_monthly_otp"].where("month_start >= date'2001-01-01'")}
    assert G.decision(G.evaluate(partial, G.default_suites(as_of, BANDS_SF0001))).first()["gate_open"] is False
    # broken OTP definition: plausible shape, implausible mean
    broken = {**marts, "fct_monthly_otp": marts["fct_monthly_otp"].withColumn("otp_pct", F.lit(10.0))}
    failed = [r for r in G.evaluate(broken, G.default_suites(as_of, BANDS_SF0001)).collect() if not r["success"]]
    assert [(r["suite"], r["expectation"]) for r in failed] == [("fct_monthly_otp", "mean_between")]
    # stale data: newest month older than the freshness floor
    stale = G.evaluate(marts, G.default_suites(dt.date(2002, 6, 1), BANDS_SF0001)).collect()
    assert [r["expectation"] for r in stale if not r["success"]] == ["newest_month_fresh"]


def test_mostly_tolerance(spark):
    df = spark.createDataFrame([(float(v),) for v in [5] * 99 + [500]], "avg_taxi_out_min double")
    e = [G.Expectation("values_between", "avg_taxi_out_min", 0, 120, mostly=0.99)]
    r = G.evaluate({"t": df}, {"t": e}).first()
    assert (r["n_unexpected"], r["success"]) == (1, True)
    e2 = [G.Expectation("values_between", "avg_taxi_out_min", 0, 120, mostly=0.995)]
    assert G.evaluate({"t": df}, {"t": e2}).first()["success"] is False
