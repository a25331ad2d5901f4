"""Release gate: statistical expectations over the marts.

All expectations of one table compile into one aggregate (one scan of the
mart); the single result row is unpivoted into one row per expectation.
Suite statistics and the gate decision are small aggregates over those rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.functions.months import FRESHNESS_MONTHS, freshness_floor

RESULT_COLUMNS = [
    "suite", "expectation", "column_name", "arguments",
    "n_evaluated", "n_unexpected", "observed_value", "observed_date", "success",
]


@dataclass(frozen=True)
class Expectation:
    kind: str  # row_count_between | values_between | mean_between | newest_month_fresh | not_null
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    as_of: dt.date | None = None
    mostly: float = 1.0

    @property
    def arguments(self) -> str:
        parts = []
        if self.min_value is not None:
            parts.append(f"min_value={self.min_value:g}")
        if self.max_value is not None:
            parts.append(f"max_value={self.max_value:g}")
        if self.as_of is not None:
            parts.append(f"as_of={self.as_of.isoformat()}, months={FRESHNESS_MONTHS}")
        if self.mostly != 1.0:
            parts.append(f"mostly={self.mostly:g}")
        return ", ".join(parts)


def _between(c: Column, lo: float | None, hi: float | None) -> Column:
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (c >= F.lit(lo))
    if hi is not None:
        ok = ok & (c <= F.lit(hi))
    return ok


def _result(suite: str, e: Expectation, n_eval: Column, n_bad: Column,
            value: Column, date: Column, success: Column) -> Column:
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).cast("string").alias("column_name"),
        F.lit(e.arguments).alias("arguments"),
        n_eval.cast("long").alias("n_evaluated"),
        n_bad.cast("long").alias("n_unexpected"),
        value.cast("double").alias("observed_value"),
        date.cast("date").alias("observed_date"),
        success.alias("success"),
    )


def _compile(suite: str, i: int, e: Expectation) -> tuple[list[Column], Column]:
    """Aggregate expressions for one expectation and the result struct built on them."""
    p = f"_{i}_"
    none_d = F.lit(None).cast("double")
    none_t = F.lit(None).cast("date")
    if e.kind == "row_count_between":
        aggs = [F.count(F.lit(1)).alias(p + "n")]
        n = F.col(p + "n")
        ok = _between(n, e.min_value, e.max_value)
        return aggs, _result(suite, e, n, F.when(ok, 0).otherwise(1), n, none_t, ok)
    c = F.col(e.column)
    if e.kind == "values_between":
        aggs = [
            F.count(c).alias(p + "n"),
            F.count_if(~_between(c, e.min_value, e.max_value)).alias(p + "bad"),
        ]
        n, bad = F.col(p + "n"), F.col(p + "bad")
        share_ok = F.when(n == 0, F.lit(1.0)).otherwise((n - bad) / n)
        ok = (bad == 0) if e.mostly >= 1.0 else (share_ok >= F.lit(e.mostly))
        return aggs, _result(suite, e, n, bad, share_ok, none_t, ok)
    if e.kind == "mean_between":
        # exact decimal sum: a double sum would depend on row order
        aggs = [F.count(c).alias(p + "n"), F.sum(c.cast("decimal(18,2)")).alias(p + "sum")]
        n = F.col(p + "n")
        mean = F.col(p + "sum").cast("double") / F.nullif(n, F.lit(0))
        ok = F.coalesce(_between(mean, e.min_value, e.max_value), F.lit(False))
        return aggs, _result(suite, e, n, F.when(ok, 0).otherwise(1), mean, none_t, ok)
    if e.kind == "newest_month_fresh":
        aggs = [F.count(c).alias(p + "n"), F.max(c).alias(p + "max")]
        mx = F.col(p + "max")
        ok = F.coalesce(mx >= freshness_floor(F.lit(e.as_of)), F.lit(False))
        return aggs, _result(suite, e, F.col(p + "n"), F.when(ok, 0).otherwise(1), none_d, mx, ok)
    if e.kind == "not_null":
        aggs = [F.count(F.lit(1)).alias(p + "n"), F.count_if(c.isNull()).alias(p + "bad")]
        bad = F.col(p + "bad")
        return aggs, _result(suite, e, F.col(p + "n"), bad, none_d, none_t, bad == 0)
    raise ValueError(f"unknown expectation {e.kind}")


def evaluate(tables: dict[str, DataFrame], suites: dict[str, list[Expectation]]) -> DataFrame:
    """One row per expectation; each table is aggregated once for its whole suite."""
    parts = []
    for table, expectations in suites.items():
        aggs, results = [], []
        for i, e in enumerate(expectations):
            a, r = _compile(table, i, e)
            aggs.extend(a)
            results.append(r)
        parts.append(tables[table].agg(*aggs).select(F.inline(F.array(*results))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*RESULT_COLUMNS)


# -- mergeable summaries: the gate of a changed month reads that month alone ------------


def summarize(mart: DataFrame, expectations: list[Expectation], table: str = "") -> DataFrame:
    """One row per month with what the expectations need of it: counts, exact sums, a maximum.

    All of these merge, so the rows of unchanged months can be kept and the gate is decided
    from the summaries (``evaluate_summaries``), whatever the size of the mart."""
    aggs = [a for i, e in enumerate(expectations) for a in _compile(table, i, e)[0]]
    return mart.groupBy("month_start").agg(*aggs)


def _merge(name: str) -> Column:
    if name.endswith("_max"):
        return F.max(name).alias(name)
    total = F.sum(name)
    # a count over no rows is 0, a sum over none NULL
    return (total if name.endswith("_sum") else F.coalesce(total, F.lit(0))).alias(name)


def evaluate_summaries(summaries: dict[str, DataFrame], suites: dict[str, list[Expectation]]) -> DataFrame:
    """The rows of ``evaluate`` from the tables' monthly summaries."""
    parts = []
    for table, expectations in suites.items():
        results = [_compile(table, i, e)[1] for i, e in enumerate(expectations)]
        names = [c for c in summaries[table].columns if c != "month_start"]
        parts.append(summaries[table].agg(*[_merge(n) for n in names]).select(F.inline(F.array(*results))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*RESULT_COLUMNS)


def suite_stats(results: DataFrame) -> DataFrame:
    """Per suite: evaluated, successful, success."""
    return results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.bool_and(F.col("success")).alias("success"),
    )


def decision(results: DataFrame) -> DataFrame:
    """One row: the gate is open only if every expectation of every suite passed."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.bool_and(F.col("success")).alias("gate_open"),
    )


@dataclass(frozen=True)
class Bands:
    """Row-count bands per mart (parameters; they age with the history length)."""

    monthly_otp: tuple[int, int] = (1_500, 2_600)
    route_performance: tuple[int, int] = (450_000, 800_000)
    airport_congestion: tuple[int, int] = (30_000, 55_000)
    delay_causes: tuple[int, int] = (1_500, 2_600)


def default_suites(as_of: dt.date, bands: Bands = Bands()) -> dict[str, list[Expectation]]:
    """The 16 expectations in 4 suites; ``as_of`` fixes the freshness floor."""
    E = Expectation
    return {
        "fct_monthly_otp": [
            E("row_count_between", min_value=bands.monthly_otp[0], max_value=bands.monthly_otp[1]),
            E("values_between", "otp_pct", 0, 100),
            E("values_between", "cancellation_pct", 0, 100),
            E("mean_between", "otp_pct", 60, 95),
            E("newest_month_fresh", "month_start", as_of=as_of),
            E("not_null", "carrier_code"),
        ],
        "fct_route_performance": [
            E("row_count_between", min_value=bands.route_performance[0], max_value=bands.route_performance[1]),
            E("values_between", "otp_pct", 0, 100),
            E("values_between", "scheduled_flights", 1, None),
        ],
        "fct_airport_congestion": [
            E("row_count_between", min_value=bands.airport_congestion[0], max_value=bands.airport_congestion[1]),
            E("values_between", "total_movements", 1, None),
            E("values_between", "avg_taxi_out_min", 0, 120, mostly=0.99),
        ],
        "fct_delay_causes": [
            E("row_count_between", min_value=bands.delay_causes[0], max_value=bands.delay_causes[1]),
            E("values_between", "total_delay_min", 0, None),
            E("values_between", "carrier_pct", 0, 100),
            E("values_between", "late_aircraft_pct", 0, 100),
        ],
    }


__all__ = [
    "Bands",
    "Expectation",
    "decision",
    "default_suites",
    "evaluate",
    "evaluate_summaries",
    "suite_stats",
    "summarize",
]
