"""The four monthly KPI marts over enriched legs (M2-M5).

Each mart is one grouped aggregate (partial aggregation before the shuffle,
so hot carriers or airports are pre-reduced per map task). Ratios and
averages are exact HALF_UP (see ``functions.exact``); ``any_value`` is
replaced by ``max`` so results repeat run to run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.functions.exact import MEASURE_SCALE, exact_ratio, scaled_long, unscale
from flightmarts.operators.enrich import with_carrier_name
from flightmarts.schema import CAUSE_COLUMNS

CARRIER_MONTH = ["month_start", "carrier_code", "carrier_name"]

MONTHLY_OTP_COLUMNS = [
    "month_start", "carrier_code", "carrier_name",
    "scheduled_flights", "cancelled_flights", "diverted_flights",
    "completed_flights", "on_time_flights",
    "otp_pct", "cancellation_pct", "avg_arr_delay_min", "avg_dep_delay_min",
]
ROUTE_COLUMNS = [
    "month_start", "origin", "origin_city", "origin_state",
    "dest", "dest_city", "dest_state", "distance_miles",
    "scheduled_flights", "cancelled_flights", "completed_flights",
    "otp_pct", "cancellation_pct", "avg_arr_delay_min",
]
AIRPORT_COLUMNS = [
    "airport_code", "city", "state", "month_start",
    "departures", "arrivals", "total_movements",
    "avg_taxi_out_min", "avg_taxi_in_min",
]
CAUSE_PCT = [c.replace("_delay_min", "_pct") for c in CAUSE_COLUMNS]
DELAY_CAUSE_COLUMNS = CARRIER_MONTH + CAUSE_COLUMNS + ["total_delay_min"] + CAUSE_PCT

_SCALE = 10**MEASURE_SCALE


def _pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return exact_ratio(part * 100, whole, digits)


def _avg(total: Column, n: Column, digits: int = 2) -> Column:
    """Exact rounded mean from a scaled sum and a non-NULL count."""
    return exact_ratio(total, n * _SCALE, digits)


def _when_sum(cond: Column, col: str) -> Column:
    return F.sum(F.when(cond, scaled_long(col)))


def _when_count(cond: Column, col: str) -> Column:
    return F.count(F.when(cond, F.col(col)))


def _otp_measures() -> list[Column]:
    rep = F.col("is_reportable_arrival")
    return [
        F.count(F.lit(1)).alias("scheduled_flights"),
        F.count_if(F.col("cancelled")).alias("cancelled_flights"),
        F.count_if(F.col("diverted")).alias("diverted_flights"),
        F.count_if(rep).alias("completed_flights"),
        F.count_if(F.col("is_on_time")).alias("on_time_flights"),
        _when_sum(rep, "arr_delay_min").alias("_arr_sum"),
        _when_count(rep, "arr_delay_min").alias("_arr_n"),
    ]


def carrier_month_facts(flights: DataFrame, carriers: DataFrame | None = None) -> DataFrame:
    """One aggregate at carrier x month grain feeding both M2 and M5.

    The two marts share their grain, so a pipeline run scans the legs and
    shuffles once for both; ``monthly_otp_from``/``delay_causes_from`` project it.
    ``flights`` are enriched legs; with ``carriers`` they need no carrier name, as the
    lookup then joins the aggregate.
    """
    rep = F.col("is_reportable_arrival")
    keys = CARRIER_MONTH if carriers is None else CARRIER_MONTH[:2]
    facts = flights.groupBy(*keys).agg(
        *_otp_measures(),
        _when_sum(rep, "dep_delay_min").alias("_dep_sum"),
        _when_count(rep, "dep_delay_min").alias("_dep_n"),
        *[F.sum(scaled_long(c)).alias(f"_{c}") for c in CAUSE_COLUMNS],
    )
    return facts if carriers is None else with_carrier_name(facts, carriers)


def carrier_month_rows(flagged: DataFrame) -> DataFrame:
    """The carrier-month aggregate without names, with the number of values of each cause:
    sums and counts only, so rows of disjoint legs add up."""
    rep = F.col("is_reportable_arrival")
    return flagged.groupBy(*CARRIER_MONTH[:2]).agg(
        *_otp_measures(),
        _when_sum(rep, "dep_delay_min").alias("_dep_sum"),
        _when_count(rep, "dep_delay_min").alias("_dep_n"),
        *[F.sum(scaled_long(c)).alias(f"_{c}") for c in CAUSE_COLUMNS],
        *[F.count(c).alias(f"_n_{c}") for c in CAUSE_COLUMNS],
    )


def monthly_otp_from(facts: DataFrame) -> DataFrame:
    """M2 columns from the carrier-month aggregate."""
    return facts.select(
        *CARRIER_MONTH,
        "scheduled_flights",
        "cancelled_flights",
        "diverted_flights",
        "completed_flights",
        "on_time_flights",
        _pct(F.col("on_time_flights"), F.col("completed_flights")).alias("otp_pct"),
        _pct(F.col("cancelled_flights"), F.col("scheduled_flights")).alias("cancellation_pct"),
        _avg(F.col("_arr_sum"), F.col("_arr_n")).alias("avg_arr_delay_min"),
        _avg(F.col("_dep_sum"), F.col("_dep_n")).alias("avg_dep_delay_min"),
    )


def delay_causes_from(facts: DataFrame) -> DataFrame:
    """M5 columns from the carrier-month aggregate.

    Sums ignore NULL; a group without any late flight keeps NULL sums, a NULL
    total (any cause NULL makes the total NULL) and NULL shares; a zero total
    gives NULL shares instead of a division error.
    """
    total = F.col("_carrier_delay_min")
    for c in CAUSE_COLUMNS[1:]:
        total = total + F.col(f"_{c}")
    with_total = facts.withColumn("_total", total)
    return with_total.select(
        *CARRIER_MONTH,
        *[unscale(f"_{c}").alias(c) for c in CAUSE_COLUMNS],
        unscale("_total").alias("total_delay_min"),
        *[
            _pct(F.col(f"_{c}"), F.col("_total"), 1).alias(p)
            for c, p in zip(CAUSE_COLUMNS, CAUSE_PCT)
        ],
    )


def monthly_otp(enriched: DataFrame) -> DataFrame:
    """M2: on-time performance by carrier and month."""
    rep = F.col("is_reportable_arrival")
    facts = enriched.groupBy(*CARRIER_MONTH).agg(
        *_otp_measures(),
        _when_sum(rep, "dep_delay_min").alias("_dep_sum"),
        _when_count(rep, "dep_delay_min").alias("_dep_n"),
    )
    return monthly_otp_from(facts)


def delay_causes(enriched: DataFrame) -> DataFrame:
    """M5: attributed delay minutes and shares by carrier and month."""
    facts = enriched.groupBy(*CARRIER_MONTH).agg(
        *[F.sum(scaled_long(c)).alias(f"_{c}") for c in CAUSE_COLUMNS]
    )
    return delay_causes_from(facts)


ROUTE_DESCRIPTIVE = ["origin_city", "origin_state", "dest_city", "dest_state", "distance_miles"]


def route_rows(enriched: DataFrame) -> DataFrame:
    """First level of M3: additive sums per route, month and descriptive values."""
    rep = F.col("is_reportable_arrival")
    return enriched.groupBy("month_start", "origin", "dest", *ROUTE_DESCRIPTIVE).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("cancelled")).alias("_cancelled"),
        F.count_if(rep).alias("_completed"),
        F.count_if(F.col("is_on_time")).alias("_on_time"),
        _when_sum(rep, "arr_delay_min").alias("_arr_sum"),
        _when_count(rep, "arr_delay_min").alias("_arr_n"),
    )


def route_performance_from(rows: DataFrame) -> DataFrame:
    """M3 from its first level, where ``max`` picks the descriptive values."""
    agg = rows.groupBy("month_start", "origin", "dest").agg(
        *[F.max(c).alias(c) for c in ROUTE_DESCRIPTIVE],
        F.sum("_n").alias("scheduled_flights"),
        F.sum("_cancelled").alias("cancelled_flights"),
        F.sum("_completed").alias("completed_flights"),
        F.sum("_on_time").alias("_on_time"),
        F.sum("_arr_sum").alias("_arr_sum"),
        F.sum("_arr_n").alias("_arr_n"),
    )
    return agg.select(
        "month_start", "origin", "origin_city", "origin_state",
        "dest", "dest_city", "dest_state", "distance_miles",
        "scheduled_flights", "cancelled_flights", "completed_flights",
        _pct(F.col("_on_time"), F.col("completed_flights")).alias("otp_pct"),
        _pct(F.col("cancelled_flights"), F.col("scheduled_flights")).alias("cancellation_pct"),
        _avg(F.col("_arr_sum"), F.col("_arr_n")).alias("avg_arr_delay_min"),
    )


def route_performance(enriched: DataFrame) -> DataFrame:
    """M3: directed route x month; descriptive columns take the max value.

    Two levels, so no aggregation buffer holds a string: the legs are
    hash-aggregated with the descriptive columns (city, state, distance) as
    extra grouping keys, then the small result is reduced to one row per
    (month, origin, dest), where ``max`` picks the descriptive values.
    ``max`` of a string directly over the legs would force a sort-based
    aggregate over all of them.
    """
    return route_performance_from(route_rows(enriched))


def airport_movements(enriched: DataFrame) -> DataFrame:
    """Each non-cancelled leg as two movements: a departure at ``origin`` and an
    arrival at ``dest`` (diverted legs included). NULL ``cancelled`` drops out."""
    dep = F.struct(
        F.col("origin").alias("airport_code"),
        F.lit(True).alias("is_departure"),
        F.col("origin_city").alias("city"),
        F.col("origin_state").alias("state"),
        F.col("taxi_out_min").alias("taxi_min"),
    )
    arr = F.struct(
        F.col("dest").alias("airport_code"),
        F.lit(False).alias("is_departure"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.col("taxi_in_min").alias("taxi_min"),
    )
    return enriched.where(~F.col("cancelled")).select("month_start", F.inline(F.array(dep, arr)))


def airport_rows(enriched: DataFrame) -> DataFrame:
    """First level of M4: additive sums per airport, month, side and place name."""
    return airport_movements(enriched).groupBy(
        "airport_code", "month_start", "is_departure", "city", "state"
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(scaled_long("taxi_min")).alias("_taxi_sum"),
        F.count("taxi_min").alias("_taxi_n"),
    )


def airport_congestion_from(rows: DataFrame) -> DataFrame:
    """M4 from its first level."""
    is_dep = F.col("is_departure")
    agg = rows.groupBy("airport_code", "month_start").agg(
        F.max(F.when(is_dep, F.col("city"))).alias("city"),
        F.max(F.when(is_dep, F.col("state"))).alias("state"),
        F.coalesce(F.sum(F.when(is_dep, F.col("_n"))), F.lit(0)).alias("departures"),
        F.coalesce(F.sum(F.when(~is_dep, F.col("_n"))), F.lit(0)).alias("arrivals"),
        F.sum(F.when(is_dep, F.col("_taxi_sum"))).alias("_out_sum"),
        F.sum(F.when(is_dep, F.col("_taxi_n"))).alias("_out_n"),
        F.sum(F.when(~is_dep, F.col("_taxi_sum"))).alias("_in_sum"),
        F.sum(F.when(~is_dep, F.col("_taxi_n"))).alias("_in_n"),
    )
    return agg.select(
        "airport_code", "city", "state", "month_start",
        "departures", "arrivals",
        (F.col("departures") + F.col("arrivals")).alias("total_movements"),
        _avg(F.col("_out_sum"), F.col("_out_n")).alias("avg_taxi_out_min"),
        _avg(F.col("_in_sum"), F.col("_in_n")).alias("avg_taxi_in_min"),
    )


def airport_congestion(enriched: DataFrame) -> DataFrame:
    """M4: airport x month volume and taxi times from both endpoints.

    Equivalent to aggregating departures and arrivals separately and full-outer
    joining them on (airport, month) with coalesced keys and zero defaults, but
    with one scan of the legs: legs are expanded to movements and aggregated.
    City/state come from the departure side only (NULL for arrival-only
    airports). As in M3 the strings are grouping keys of the first,
    hash-based level and only the small second level takes their ``max``.
    """
    return airport_congestion_from(airport_rows(enriched))


def airport_congestion_by_join(enriched: DataFrame) -> DataFrame:
    """M4 written as the two endpoint aggregates and a full outer join.

    Same result as ``airport_congestion`` (the tests compare them) at the cost
    of two scans and two shuffles plus the join; kept as the literal form of
    the definition. The USING-style join coalesces the keys; city/state only
    come from the departure side.
    """
    flown = enriched.where(~F.col("cancelled"))
    # as in M3: strings are keys of the hash-based first level over the legs
    by_place = flown.groupBy(F.col("origin").alias("airport_code"), "month_start", "origin_city", "origin_state").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(scaled_long("taxi_out_min")).alias("_sum"),
        F.count("taxi_out_min").alias("_taxi_n"),
    )
    deps = by_place.groupBy("airport_code", "month_start").agg(
        F.max("origin_city").alias("city"),
        F.max("origin_state").alias("state"),
        F.sum("_n").alias("departures"),
        F.sum("_sum").alias("_out_sum"),
        F.sum("_taxi_n").alias("_out_n"),
    )
    arrs = flown.groupBy(F.col("dest").alias("airport_code"), "month_start").agg(
        F.count(F.lit(1)).alias("arrivals"),
        F.sum(scaled_long("taxi_in_min")).alias("_in_sum"),
        F.count("taxi_in_min").alias("_in_n"),
    )
    joined = deps.join(arrs, ["airport_code", "month_start"], "full_outer")
    dep_n = F.coalesce(F.col("departures"), F.lit(0))
    arr_n = F.coalesce(F.col("arrivals"), F.lit(0))
    return joined.select(
        "airport_code", "city", "state", "month_start",
        dep_n.alias("departures"),
        arr_n.alias("arrivals"),
        (dep_n + arr_n).alias("total_movements"),
        _avg(F.col("_out_sum"), F.col("_out_n")).alias("avg_taxi_out_min"),
        _avg(F.col("_in_sum"), F.col("_in_n")).alias("avg_taxi_in_min"),
    )


MARTS = {
    "fct_monthly_otp": monthly_otp,
    "fct_route_performance": route_performance,
    "fct_airport_congestion": airport_congestion,
    "fct_delay_causes": delay_causes,
}
