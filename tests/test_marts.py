import datetime as dt

from pyspark.sql import functions as F

from flightmarts.operators import marts as M
from flightmarts.operators.enrich import ENRICHED_COLUMNS, enrich, stage
from flightmarts.sources import seeds
from tests.conftest import make_legs

JAN = dt.date(2024, 1, 10)
FEB = dt.date(2024, 2, 10)


def enriched(spark, rows):
    return enrich(stage(make_legs(spark, rows)), seeds.carriers(spark), seeds.cancellation_codes(spark))


def test_enrichment_semantics(spark):
    e = enriched(spark, [
        {"carrier_code": "ZZ"},                                           # unknown carrier
        {"cancelled": True, "cancellation_code": "B", "arr_delay_min": None, "arr_delayed_15": None},
        {"cancelled": True, "cancellation_code": "Z", "arr_delay_min": None, "arr_delayed_15": None},
        {"cancelled": True, "cancellation_code": None, "arr_delay_min": None, "arr_delayed_15": None},
        {"diverted": True, "arr_delay_min": None, "arr_delayed_15": None},
        {"arr_delayed_15": None},                                         # reportable, flag unknown
        {"cancelled": None},                                              # unknown cancellation
    ])
    assert e.columns == ENRICHED_COLUMNS
    r = e.orderBy("flight_number").collect()
    assert r[0]["carrier_name"] == "ZZ" and r[1]["carrier_name"] == "American Airlines"
    assert r[0]["month_start"] == dt.date(2024, 1, 1)
    assert r[1]["cancellation_reason"] == "Weather"
    assert r[2]["cancellation_reason"] is None and r[2]["cancellation_code"] == "Z"
    assert r[3]["cancellation_code"] is None
    assert r[0]["cancellation_code"] is None          # '' -> NULL in staging
    assert (r[1]["is_reportable_arrival"], r[1]["is_on_time"]) == (False, None)
    assert (r[4]["is_reportable_arrival"], r[4]["is_on_time"]) == (False, None)
    assert (r[5]["is_reportable_arrival"], r[5]["is_on_time"]) == (True, None)
    assert r[6]["is_reportable_arrival"] is None      # (NULL, false, 5) -> NULL


def test_monthly_otp_edges(spark):
    rows = [{"carrier_code": "DL", "cancelled": True, "arr_delay_min": None, "dep_delay_min": None,
             "arr_delayed_15": None, "cancellation_code": "A"} for _ in range(3)]
    # 40 reportable flights with delays summing to 1 minute: mean 0.025 -> 0.03 (HALF_UP)
    rows += [{"carrier_code": "UA", "arr_delay_min": 1.0 if i == 0 else 0.0, "dep_delay_min": 0.0}
             for i in range(40)]
    rows += [{"carrier_code": "UA", "arr_delayed_15": None},   # completed but not on time
             {"carrier_code": "UA", "cancelled": None}]        # unknown: not cancelled, not reportable
    otp = {r["carrier_code"]: r for r in M.monthly_otp(enriched(spark, rows)).collect()}
    dl, ua = otp["DL"], otp["UA"]
    assert (dl["scheduled_flights"], dl["cancelled_flights"], dl["completed_flights"]) == (3, 3, 0)
    assert dl["otp_pct"] is None and dl["avg_arr_delay_min"] is None and dl["cancellation_pct"] == 100.0
    assert ua["scheduled_flights"] == 42 and ua["completed_flights"] == 41 and ua["on_time_flights"] == 40
    assert ua["cancelled_flights"] == 0
    assert ua["otp_pct"] == 97.56  # 40/41 = 97.5609...
    # 41 reportable arrivals, delays 1 + 0*39 + 5 (flag-unknown row keeps its delay) = 6 -> 0.1463 -> 0.15
    assert ua["avg_arr_delay_min"] == 0.15


def test_delay_cause_edges(spark):
    late = {"arr_delay_min": 30.0, "arr_delayed_15": True}
    rows = [
        {"carrier_code": "AA"},                                                   # no late flight
        {"carrier_code": "DL", **late, "carrier_delay_min": 0.0, "weather_delay_min": 0.0,
         "nas_delay_min": 0.0, "security_delay_min": 0.0, "late_aircraft_delay_min": 0.0},
        {"carrier_code": "UA", **late, "carrier_delay_min": 10.0, "weather_delay_min": 20.0,
         "nas_delay_min": None, "security_delay_min": 0.0, "late_aircraft_delay_min": 0.0},
        {"carrier_code": "B6", **late, "carrier_delay_min": 10.0, "weather_delay_min": 20.0,
         "nas_delay_min": 0.0, "security_delay_min": 0.0, "late_aircraft_delay_min": 0.0},
    ]
    d = {r["carrier_code"]: r for r in M.delay_causes(enriched(spark, rows)).collect()}
    assert d["AA"]["total_delay_min"] is None and d["AA"]["carrier_pct"] is None
    assert d["DL"]["total_delay_min"] == 0.0 and d["DL"]["carrier_pct"] is None
    assert d["UA"]["total_delay_min"] is None                 # one cause entirely NULL
    assert d["B6"]["total_delay_min"] == 30.0
    assert (d["B6"]["carrier_pct"], d["B6"]["weather_pct"]) == (33.3, 66.7)


def test_airport_congestion_edges(spark):
    rows = [
        {"origin": "AAA", "dest": "BBB", "taxi_out_min": 10.0, "taxi_in_min": 4.0},
        {"origin": "AAA", "dest": "CCC", "diverted": True, "arr_delay_min": None, "taxi_in_min": None,
         "taxi_out_min": 20.0},
        {"origin": "AAA", "dest": "BBB", "cancelled": True, "arr_delay_min": None, "taxi_out_min": None},
        {"origin": "DDD", "dest": "AAA", "origin_city": "D", "origin_state": "DS", "flight_date": FEB},
    ]
    a = {(r["airport_code"], r["month_start"].month): r
         for r in M.airport_congestion(enriched(spark, rows)).collect()}
    aaa = a[("AAA", 1)]
    assert (aaa["departures"], aaa["arrivals"], aaa["total_movements"]) == (2, 0, 2)
    assert aaa["avg_taxi_out_min"] == 15.0 and aaa["avg_taxi_in_min"] is None
    assert aaa["city"] == "New York, NY"
    bbb = a[("BBB", 1)]
    assert (bbb["departures"], bbb["arrivals"], bbb["city"]) == (0, 1, None)
    ccc = a[("CCC", 1)]                      # diverted flight still counts as an arrival at dest
    assert (ccc["arrivals"], ccc["avg_taxi_in_min"]) == (1, None)
    assert a[("AAA", 2)]["arrivals"] == 1 and a[("DDD", 2)]["city"] == "D"


def test_route_and_shared_aggregate_agree(spark):
    rows = [{"carrier_code": c, "origin": o, "dest": d, "arr_delay_min": x, "dep_delay_min": y}
            for c, o, d, x, y in [("AA", "A", "B", 3.0, 1.0), ("AA", "A", "B", 20.0, 18.0),
                                  ("DL", "B", "A", -4.0, 0.0)]]
    e = enriched(spark, rows)
    facts = M.carrier_month_facts(e)
    assert sorted(M.monthly_otp_from(facts).collect()) == sorted(M.monthly_otp(e).collect())
    assert sorted(M.delay_causes_from(facts).collect()) == sorted(M.delay_causes(e).collect())
    # the lookup joined after the aggregate gives the same marts, unknown codes included
    late = M.carrier_month_facts(e.drop("carrier_name"), seeds.carriers(spark))
    assert sorted(M.monthly_otp_from(late).collect()) == sorted(M.monthly_otp(e).collect())
    r = {(x["origin"], x["dest"]): x for x in M.route_performance(e).collect()}
    assert r[("A", "B")]["avg_arr_delay_min"] == 11.5 and r[("A", "B")]["scheduled_flights"] == 2
    assert r[("B", "A")]["avg_arr_delay_min"] == -4.0
    assert F is not None


def test_airport_expand_equals_full_outer_join(spark):
    from flightmarts.plans import queries as Q
    from tests.conftest import SF_SMALL

    e = Q.enriched_lake(spark, SF_SMALL)
    a = sorted(M.airport_congestion(e).collect(), key=repr)
    b = sorted(M.airport_congestion_by_join(e).select(*M.AIRPORT_COLUMNS).collect(), key=repr)
    assert len(a) > 0 and a == b
