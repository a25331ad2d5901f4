"""Structural data tests over tables.

A check's failing rows are what it reports; zero failing rows means pass.
Row-level checks of one relation (not_null, accepted_values, accepted_range)
compile into a single aggregate, so each relation is scanned once for all of
them; grain checks (unique, unique combination) are one grouped count each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.operators.enrich import staging_column
from flightmarts.schema import FLIGHT_KEY


@dataclass(frozen=True)
class Check:
    relation: str
    kind: str  # not_null | unique | unique_combination | accepted_values | accepted_range
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None
    severity: str = "error"  # error stops downstream work, warn only reports

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)

    @property
    def is_grain(self) -> bool:
        return self.kind in ("unique", "unique_combination")


def _fails(check: Check, col=F.col) -> Column:
    """Predicate that is TRUE exactly on a failing row (NULL never fails)."""
    c = col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(list(check.values))
    if check.kind == "accepted_range":
        ok = F.lit(True)
        if check.min_value is not None:
            ok = ok & (c >= F.lit(check.min_value))
        if check.max_value is not None:
            ok = ok & (c <= F.lit(check.max_value))
        return ~ok
    raise ValueError(f"not a row-level check: {check.kind}")


def failing_rows(df: DataFrame, check: Check, col=F.col) -> DataFrame:
    """The rows a check reports: violating rows, or duplicated key groups.

    ``col`` maps a column name to its expression over ``df`` (identity unless
    the checked relation is a view evaluated on its base relation).
    """
    if check.is_grain:
        keys = [col(c).alias(c) for c in check.columns]
        grouped = df.where(col(check.columns[0]).isNotNull()) if check.kind == "unique" else df
        return grouped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    return df.where(_fails(check, col))


def _row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.relation).alias("relation"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column_name).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("long").alias("failures"),
    )


# Relations that are fixed projections of another relation: their checks run
# on the base relation through the view's column expressions, so the base is
# scanned once for the row-level checks of both.
VIEWS = {"stg_flights": ("raw_flights", staging_column)}


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One result row per check: relation, check, column(s), severity, failures.

    Row-level checks are grouped per scanned relation into one aggregate; a
    view listed in ``VIEWS`` whose base relation is also given is evaluated on
    the base (its results keep the view's name).
    """
    parts: list[DataFrame] = []
    by_source: dict[str, list[tuple[Check, object]]] = {}
    for chk in checks:
        source, col = chk.relation, F.col
        if chk.relation in VIEWS and VIEWS[chk.relation][0] in tables:
            source, col = VIEWS[chk.relation]
        by_source.setdefault(source, []).append((chk, col))
    for source, items in by_source.items():
        df = tables[source]
        row_checks = [(c, col) for c, col in items if not c.is_grain]
        if row_checks:
            agg = df.agg(*[F.count_if(_fails(c, col)).alias(f"_c{i}") for i, (c, col) in enumerate(row_checks)])
            parts.append(
                agg.select(F.inline(F.array(*[_row(c, F.col(f"_c{i}")) for i, (c, _) in enumerate(row_checks)])))
            )
        for chk, col in ((c, col) for c, col in items if c.is_grain):
            n = failing_rows(df, chk, col).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(n.select(F.inline(F.array(_row(chk, F.col("_n"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summarize(results: DataFrame) -> DataFrame:
    """Add a status per check: pass, warn (warn severity failing) or fail."""
    status = (
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return results.withColumn("status", status)


def raise_on_errors(summary_rows: list) -> None:
    """Stop the run when any error-severity check failed (warns only report)."""
    failed = [r for r in summary_rows if r["status"] == "fail"]
    if failed:
        desc = ", ".join(f"{r['relation']}.{r['check_name']}({r['column_name']})={r['failures']}" for r in failed)
        raise RuntimeError(f"data tests failed: {desc}")


# --- fixed values: the declared structural tests per relation
ACCEPTED_CODES = ("A", "B", "C", "D")
_KEY4 = ("flight_date", "carrier_code", "origin", "dest")


def _nn(relation: str, cols) -> list[Check]:
    return [Check(relation, "not_null", (c,)) for c in cols]


def default_checks() -> list[Check]:
    """The 29 declared tests: raw 4, staging 6, marts 13, seeds 6."""
    return [
        *_nn("raw_flights", _KEY4),
        Check("stg_flights", "unique_combination", tuple(FLIGHT_KEY)),
        *_nn("stg_flights", _KEY4),
        Check("stg_flights", "accepted_values", ("cancellation_code",), values=ACCEPTED_CODES, severity="warn"),
        Check("fct_monthly_otp", "unique_combination", ("month_start", "carrier_code")),
        *_nn("fct_monthly_otp", ("month_start", "carrier_code")),
        Check("fct_monthly_otp", "accepted_range", ("otp_pct",), min_value=0, max_value=100),
        Check("fct_monthly_otp", "accepted_range", ("cancellation_pct",), min_value=0, max_value=100),
        Check("fct_monthly_otp", "accepted_range", ("scheduled_flights",), min_value=1),
        Check("fct_route_performance", "unique_combination", ("month_start", "origin", "dest")),
        Check("fct_route_performance", "accepted_range", ("otp_pct",), min_value=0, max_value=100),
        Check("fct_airport_congestion", "unique_combination", ("month_start", "airport_code")),
        *_nn("fct_airport_congestion", ("airport_code",)),
        Check("fct_airport_congestion", "accepted_range", ("total_movements",), min_value=1),
        Check("fct_delay_causes", "unique_combination", ("month_start", "carrier_code")),
        Check("fct_delay_causes", "accepted_range", ("total_delay_min",), min_value=0),
        Check("carriers", "unique", ("carrier_code",)),
        *_nn("carriers", ("carrier_code", "carrier_name")),
        Check("cancellation_codes", "unique", ("cancellation_code",)),
        *_nn("cancellation_codes", ("cancellation_code",)),
        Check("cancellation_codes", "accepted_values", ("cancellation_code",), values=ACCEPTED_CODES),
    ]


def checks_of_kind(kinds: tuple[str, ...]) -> list[Check]:
    return [c for c in default_checks() if c.kind in kinds]
