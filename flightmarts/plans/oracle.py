"""DuckDB oracle SQL for every registered query.

Each statement starts from the same flight-leg projection as the Spark side
(``sources.fixture``), written independently in plain SQL over the
pre-registered test tables. Exact rounding uses integer arithmetic:
``sign(n) * ((2*|n|*10^s + d) // (2*d)) / 10^s``.
"""

from __future__ import annotations

from flightmarts.schema import CAUSE_COLUMNS, EXPORT_TABLES, FLIGHT_COLUMNS, FLIGHT_KEY, PAYLOAD_COLUMNS, VARCHAR_LENGTHS

SCALE = 100  # measures are summed as round(x * 100)


def xround(num: str, den: str, digits: int) -> str:
    """Exact HALF_UP round(num/den, digits) on whole numbers; NULL if den is 0."""
    p = 10**digits
    n = f"cast({num} as hugeint)"
    d = f"cast(nullif({den}, 0) as hugeint)"
    return f"cast(sign({n}) * ((2 * abs({n}) * {p} + {d}) // (2 * {d})) as double) / {p}.0"


def portable_counts(sql: str) -> str:
    """Write ``count_if(x)`` as ``count(case when x then 1 end)``.

    DuckDB's ``count_if`` returns NULL when every input of a group is NULL;
    Spark (and the warehouse the marts were defined on) return 0.
    """
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"count(case when {portable_counts(sql[j + len(key):k - 1])} then 1 end)")
        i = k


def sc(col: str) -> str:
    return f"cast(round({col} * {SCALE}) as bigint)"


LEGS = """
legs_src as (
    select
        cast(o.o_orderdate as date)                         as flight_date,
        cast(l.l_suppkey % 30 as varchar)                   as carrier_code,
        cast(l.l_orderkey as varchar)                       as flight_number,
        'N' || cast(l.l_partkey % 5000 as varchar)          as tail_number,
        'A' || lpad(cast(c.c_nationkey as varchar), 2, '0') as origin,
        n1.n_name                                           as origin_city,
        left(r1.r_name, 4)                                  as origin_state,
        'A' || lpad(cast(p.p_size % 30 as varchar), 2, '0') as dest,
        n2.n_name                                           as dest_city,
        left(r2.r_name, 4)                                  as dest_state,
        cast(100 + abs(c.c_nationkey - p.p_size % 30) * 50 as double) as distance_miles,
        lpad(cast(l.l_linenumber * 300 as varchar), 4, '0')       as crs_dep_time,
        lpad(cast(l.l_linenumber * 300 + 100 as varchar), 4, '0') as crs_arr_time,
        l.l_orderkey, l.l_partkey, l.l_quantity, l.l_returnflag, l.l_linestatus,
        cast(round(l.l_tax * 100) as integer)      as tax,
        cast(round(l.l_discount * 100) as integer) as disc
    from lineitem l
    join orders o   on l.l_orderkey = o.o_orderkey
    join customer c on o.o_custkey = c.c_custkey
    join part p     on l.l_partkey = p.p_partkey
    join nation n1  on n1.n_nationkey = c.c_nationkey
    join region r1  on r1.r_regionkey = n1.n_regionkey
    left join nation n2 on n2.n_nationkey = p.p_size % 30
    left join region r2 on r2.r_regionkey = n2.n_regionkey
),
legs_flags as (
    select *,
        (l_returnflag = 'R' and tax >= 7) as cancelled
    from legs_src
),
legs_flags2 as (
    select *,
        (not cancelled and l_linestatus = 'O' and disc = 0) as diverted
    from legs_flags
),
legs_measures as (
    select *,
        case when not cancelled then l_quantity * 2 - 60 end as dep_delay_min,
        case when not cancelled and not diverted then l_quantity * 2 - 60 + tax - 4 end as arr_delay_min,
        case when not cancelled then cast(5 + l_orderkey % 30 as double) end as taxi_out_min,
        case when not cancelled and not diverted then cast(3 + l_partkey % 15 as double) end as taxi_in_min,
        case when cancelled then (case l_orderkey % 4 when 0 then 'A' when 1 then 'B'
                                                       when 2 then 'C' else 'D' end)
             else '' end as cancellation_code,
        60.0 + distance_miles / 10 as crs_elapsed_min
    from legs_flags2
),
legs_causes as (
    select *,
        cast(arr_delay_min as bigint) as a,
        case when cast(arr_delay_min as bigint) >= 15 then
            (case when l_orderkey % 2 = 0 then cast(arr_delay_min as bigint) // 5 else 0 end) end as w,
        case when cast(arr_delay_min as bigint) >= 15 then
            (case when l_orderkey % 3 = 0 then cast(arr_delay_min as bigint) // 4 else 0 end) end as nn,
        case when cast(arr_delay_min as bigint) >= 15 then
            (case when l_orderkey % 5 = 0 then 1 else 0 end) end as sec,
        case when cast(arr_delay_min as bigint) >= 15 then
            (case when l_orderkey % 7 < 3 then cast(arr_delay_min as bigint) // 3 else 0 end) end as la
    from legs_measures
),
legs as (
    select
        flight_date, carrier_code, flight_number, tail_number,
        origin, origin_city, origin_state, dest, dest_city, dest_state, distance_miles,
        crs_dep_time, crs_dep_time as dep_time, dep_delay_min, dep_delay_min >= 15 as dep_delayed_15,
        taxi_out_min, taxi_in_min,
        crs_arr_time, crs_arr_time as arr_time, arr_delay_min, arr_delay_min >= 15 as arr_delayed_15,
        crs_elapsed_min,
        crs_elapsed_min + arr_delay_min - dep_delay_min as actual_elapsed_min,
        crs_elapsed_min + arr_delay_min - dep_delay_min - taxi_out_min - taxi_in_min as air_time_min,
        cancelled, cancellation_code, diverted,
        cast(a - w - nn - sec - la as double) as carrier_delay_min,
        cast(w as double)   as weather_delay_min,
        cast(nn as double)  as nas_delay_min,
        cast(sec as double) as security_delay_min,
        cast(la as double)  as late_aircraft_delay_min,
        cast(year(flight_date) as integer) as year,
        cast(month(flight_date) as integer) as month
    from legs_causes
)"""

_ORDER = ", ".join(f"{c} asc nulls first" for c in PAYLOAD_COLUMNS)
_KEY = ", ".join(FLIGHT_KEY)
_COLS = ", ".join(FLIGHT_COLUMNS)

CLEAN = f"""
clean as (
    select {_COLS} from (
        select *, row_number() over (partition by {_KEY} order by {_ORDER}) as _rn
        from legs
    ) where _rn = 1
)"""

# After the CSV round trip an empty cancellation code reads back as NULL.
CLEAN_CSV = f"""
clean_csv as (
    select {_COLS} from (
        select *, row_number() over (partition by {_KEY} order by {_ORDER}) as _rn
        from (select * replace (nullif(cancellation_code, '') as cancellation_code) from legs)
    ) where _rn = 1
)"""

STG = """
stg as (
    select * replace (nullif(cancellation_code, '') as cancellation_code) from clean
)"""

ENRICHED = """
carriers as (
    select cast(n_nationkey as varchar) as carrier_code, n_name as carrier_name
    from nation
),
cancellation_codes as (
    select * from (values ('A', 'Carrier'), ('B', 'Weather'),
                          ('C', 'National Air System'), ('D', 'Security'))
        as t(cancellation_code, cancellation_reason)
),
enriched as (
    select f.*,
        coalesce(c.carrier_name, f.carrier_code) as carrier_name,
        cc.cancellation_reason,
        cast(date_trunc('month', f.flight_date) as date) as month_start,
        (not f.cancelled and not f.diverted and f.arr_delay_min is not null) as is_reportable_arrival,
        case when not f.cancelled and not f.diverted and f.arr_delay_min is not null
             then not f.arr_delayed_15 end as is_on_time
    from stg f
    left join carriers c on f.carrier_code = c.carrier_code
    left join cancellation_codes cc on f.cancellation_code = cc.cancellation_code
)"""


def with_ctes(*ctes: str) -> str:
    return "with " + ",".join(ctes)


MONTHLY_OTP = f"""
fct_monthly_otp as (
    select month_start, carrier_code, carrier_name,
        cast(count(*) as bigint) as scheduled_flights,
        cast(count_if(cancelled) as bigint) as cancelled_flights,
        cast(count_if(diverted) as bigint) as diverted_flights,
        cast(count_if(is_reportable_arrival) as bigint) as completed_flights,
        cast(count_if(is_on_time) as bigint) as on_time_flights,
        {xround("100 * count_if(is_on_time)", "count_if(is_reportable_arrival)", 2)} as otp_pct,
        {xround("100 * count_if(cancelled)", "count(*)", 2)} as cancellation_pct,
        {xround(f"sum(case when is_reportable_arrival then {sc('arr_delay_min')} end)",
                f"{SCALE} * count(case when is_reportable_arrival then arr_delay_min end)", 2)}
            as avg_arr_delay_min,
        {xround(f"sum(case when is_reportable_arrival then {sc('dep_delay_min')} end)",
                f"{SCALE} * count(case when is_reportable_arrival then dep_delay_min end)", 2)}
            as avg_dep_delay_min
    from enriched
    group by month_start, carrier_code, carrier_name
)"""

ROUTE = f"""
fct_route_performance as (
    select month_start, origin,
        max(origin_city) as origin_city, max(origin_state) as origin_state,
        dest, max(dest_city) as dest_city, max(dest_state) as dest_state,
        max(distance_miles) as distance_miles,
        cast(count(*) as bigint) as scheduled_flights,
        cast(count_if(cancelled) as bigint) as cancelled_flights,
        cast(count_if(is_reportable_arrival) as bigint) as completed_flights,
        {xround("100 * count_if(is_on_time)", "count_if(is_reportable_arrival)", 2)} as otp_pct,
        {xround("100 * count_if(cancelled)", "count(*)", 2)} as cancellation_pct,
        {xround(f"sum(case when is_reportable_arrival then {sc('arr_delay_min')} end)",
                f"{SCALE} * count(case when is_reportable_arrival then arr_delay_min end)", 2)}
            as avg_arr_delay_min
    from enriched
    group by month_start, origin, dest
)"""

AIRPORT = f"""
departures as (
    select origin as airport_code, max(origin_city) as city, max(origin_state) as state,
        month_start, count(*) as departures,
        sum({sc('taxi_out_min')}) as out_sum, count(taxi_out_min) as out_n
    from enriched where not cancelled
    group by origin, month_start
),
arrivals as (
    select dest as airport_code, month_start, count(*) as arrivals,
        sum({sc('taxi_in_min')}) as in_sum, count(taxi_in_min) as in_n
    from enriched where not cancelled
    group by dest, month_start
),
fct_airport_congestion as (
    select
        coalesce(d.airport_code, a.airport_code) as airport_code,
        d.city, d.state,
        coalesce(d.month_start, a.month_start) as month_start,
        cast(coalesce(d.departures, 0) as bigint) as departures,
        cast(coalesce(a.arrivals, 0) as bigint) as arrivals,
        cast(coalesce(d.departures, 0) + coalesce(a.arrivals, 0) as bigint) as total_movements,
        {xround("d.out_sum", f"{SCALE} * d.out_n", 2)} as avg_taxi_out_min,
        {xround("a.in_sum", f"{SCALE} * a.in_n", 2)} as avg_taxi_in_min
    from departures d
    full outer join arrivals a
        on d.airport_code = a.airport_code and d.month_start = a.month_start
)"""

_CAUSE_SUMS = ",\n        ".join(f"sum({sc(c)}) as s_{c}" for c in CAUSE_COLUMNS)
_TOTAL = " + ".join(f"s_{c}" for c in CAUSE_COLUMNS)
_CAUSE_OUT = ",\n        ".join(f"cast(s_{c} as double) / {SCALE}.0 as {c}" for c in CAUSE_COLUMNS)
_CAUSE_PCT = ",\n        ".join(
    f"{xround(f'100 * s_{c}', 's_total', 1)} as {c.replace('_delay_min', '_pct')}"
    for c in CAUSE_COLUMNS
)
DELAY = f"""
cause_sums as (
    select month_start, carrier_code, carrier_name,
        {_CAUSE_SUMS}
    from enriched
    group by month_start, carrier_code, carrier_name
),
cause_total as (
    select *, {_TOTAL} as s_total from cause_sums
),
fct_delay_causes as (
    select month_start, carrier_code, carrier_name,
        {_CAUSE_OUT},
        cast(s_total as double) / {SCALE}.0 as total_delay_min,
        {_CAUSE_PCT}
    from cause_total
)"""

MARTS = with_ctes(LEGS, CLEAN, STG, ENRICHED, MONTHLY_OTP, ROUTE, AIRPORT, DELAY)


def over_marts(select: str) -> str:
    return f"{MARTS}\n{select}"



def _months_sql(where: str = "") -> str:
    return f"select year, month, cast(count(*) as bigint) as rows from clean {where} group by year, month"


def _missing_sql(grain: list[str]) -> str:
    g = ", ".join(grain)
    eq = " and ".join(f"p.{c} = s.{c}" for c in grain)
    return over_marts(f"""
, present as (select distinct {g}, make_date(year, month, 1) as m from clean),
bounds as (select min(m) as lo, max(m) as hi from present),
entities as (select distinct {g} from present),
spine as (
    select {", ".join("e." + c for c in grain)},
           cast(unnest(generate_series(b.lo, b.hi, interval 1 month)) as date) as m
    from entities e, bounds b
)
select {", ".join("s." + c for c in grain)},
       cast(year(s.m) as integer) as year, cast(month(s.m) as integer) as month
from spine s
where not exists (select 1 from present p where {eq} and p.m = s.m)""")


_REL = {"raw_flights": "clean", "stg_flights": "stg"}


def _check_sql(chk) -> str:
    rel = _REL.get(chk.relation, chk.relation)
    head = (f"select '{chk.relation}' as relation, '{chk.kind}' as check_name, "
            f"'{chk.column_name}' as column_name, '{chk.severity}' as severity, ")
    c = chk.columns[0]
    if chk.kind == "not_null":
        return head + f"cast(count_if({c} is null) as bigint) as failures from {rel}"
    if chk.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in chk.values)
        return head + f"cast(count_if({c} not in ({vals})) as bigint) as failures from {rel}"
    if chk.kind == "accepted_range":
        conds = []
        if chk.min_value is not None:
            conds.append(f"{c} >= {chk.min_value}")
        if chk.max_value is not None:
            conds.append(f"{c} <= {chk.max_value}")
        return head + f"cast(count_if(not ({' and '.join(conds)})) as bigint) as failures from {rel}"
    cols = ", ".join(chk.columns)
    where = f"where {c} is not null" if chk.kind == "unique" else ""
    return head + (f"cast(count(*) as bigint) as failures from "
                   f"(select {cols} from {rel} {where} group by {cols} having count(*) > 1)")


def _checks_sql(checks, summary: bool = False) -> str:
    body = "\nunion all\n".join(_check_sql(c) for c in checks)
    if not summary:
        return over_marts(body)
    return over_marts(f"""
, results as ({body})
select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status
from results""")


def _dirty_sql(checks) -> str:
    """The checks over the legs as they land and a lookup with repeated codes."""
    body = "\nunion all\n".join(_check_sql(c).replace(" from clean", " from landed").replace("from carriers", "from regions") for c in checks)
    return with_ctes(LEGS) + f"""
, landed as (select * from legs union all select * from legs where cast(flight_number as bigint) % 10 = 0),
regions as (select cast(n_regionkey as varchar) as carrier_code, n_name as carrier_name from nation),
results as ({body})
select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status from results"""


def _between_sql(c: str, lo, hi) -> str:
    conds = []
    if lo is not None:
        conds.append(f"{c} >= {lo}")
    if hi is not None:
        conds.append(f"{c} <= {hi}")
    return " and ".join(conds) if conds else "true"


def _expectation_sql(suite: str, e) -> str:
    head = (f"select '{suite}' as suite, '{e.kind}' as expectation, "
            f"{'NULL' if e.column is None else repr(e.column)}::varchar as column_name, "
            f"'{e.arguments}' as arguments, ")
    null_d, null_t = "cast(NULL as double)", "cast(NULL as date)"
    if e.kind == "row_count_between":
        ok = _between_sql("count(*)", e.min_value, e.max_value)
        return head + (f"cast(count(*) as bigint) as n_evaluated, "
                       f"cast(case when {ok} then 0 else 1 end as bigint) as n_unexpected, "
                       f"cast(count(*) as double) as observed_value, {null_t} as observed_date, "
                       f"({ok}) as success from {suite}")
    c = e.column
    if e.kind == "values_between":
        n = f"count({c})"
        bad = f"count_if(not ({_between_sql(c, e.min_value, e.max_value)}))"
        share = f"(case when {n} = 0 then 1.0 else cast({n} - {bad} as double) / {n} end)"
        ok = f"({bad} = 0)" if e.mostly >= 1.0 else f"({share} >= {e.mostly})"
        return head + (f"cast({n} as bigint) as n_evaluated, cast({bad} as bigint) as n_unexpected, "
                       f"cast({share} as double) as observed_value, {null_t} as observed_date, "
                       f"{ok} as success from {suite}")
    if e.kind == "mean_between":
        mean = f"(cast(sum(cast({c} as decimal(18,2))) as double) / nullif(count({c}), 0))"
        ok = f"coalesce({_between_sql(mean, e.min_value, e.max_value)}, false)"
        return head + (f"cast(count({c}) as bigint) as n_evaluated, "
                       f"cast(case when {ok} then 0 else 1 end as bigint) as n_unexpected, "
                       f"{mean} as observed_value, {null_t} as observed_date, {ok} as success from {suite}")
    if e.kind == "newest_month_fresh":
        ok = f"coalesce(max({c}) >= date_trunc('month', date '{e.as_of.isoformat()}') - interval 4 month, false)"
        return head + (f"cast(count({c}) as bigint) as n_evaluated, "
                       f"cast(case when {ok} then 0 else 1 end as bigint) as n_unexpected, "
                       f"{null_d} as observed_value, cast(max({c}) as date) as observed_date, "
                       f"{ok} as success from {suite}")
    if e.kind == "not_null":
        return head + (f"cast(count(*) as bigint) as n_evaluated, "
                       f"cast(count_if({c} is null) as bigint) as n_unexpected, "
                       f"{null_d} as observed_value, {null_t} as observed_date, "
                       f"(count_if({c} is null) = 0) as success from {suite}")
    raise ValueError(e.kind)


def _gate_body(suites) -> str:
    return "\nunion all\n".join(_expectation_sql(s, e) for s, es in suites.items() for e in es)


def _gate_sql(suites, tail: str) -> str:
    return over_marts(f"\n, results as ({_gate_body(suites)})\n{tail}")


_BOUNDED = "\nunion all\n".join(
    f"select '{c}' as column_name, {n} as max_length, cast(max(length({c})) as integer) as longest, "
    f"cast(count_if(length({c}) > {n}) as bigint) as violations from clean"
    for c, n in VARCHAR_LENGTHS.items()
)

def _export_sql(mart: str) -> str:
    cols = [f"strftime({n}, '%Y-%m-%d') as {n}" if kind == "Datetime" else n for n, kind in EXPORT_TABLES[mart]]
    return over_marts(f"select {', '.join(cols)} from {mart}")


_FOUR = ("fct_monthly_otp", "fct_route_performance", "fct_airport_congestion", "fct_delay_causes")
_EXPORT_EACH = "\nunion all\n".join(f"select '{t}' as table_name, cast(count(*) as bigint) as rows from {t}" for t in _FOUR)
_EXPORT_COUNTS = f"""
, pushed as ({_EXPORT_EACH})
select table_name, rows, true as within_limit, true as enough_batches from pushed
union all select '(all)', cast(sum(rows) as bigint), true, true from pushed"""


def _content(rows: str) -> str:
    return (
        "select year, month, cast(count(*) as bigint) as rows, cast(sum(cast(distance_miles as bigint)) as bigint) as miles, "
        "cast(sum(cast(dep_delay_min as bigint)) as bigint) as dep_delay, cast(count_if(cancelled) as bigint) as cancelled "
        f"from ({rows}) group by year, month"
    )


def _reloaded(emptied: tuple[int, int] | None, month: tuple[int, int]) -> str:
    """The lake after one month was revised and another emptied."""
    (y, m), gone = month, "true" if emptied is None else f"not (year = {emptied[0]} and month = {emptied[1]})"
    here = f"(year = {y} and month = {m})"
    cols = "year, month, dep_delay_min, cancelled"
    return (
        f"select {cols}, distance_miles from clean where not {here} and {gone} "
        f"union all select {cols}, distance_miles + 1 from clean where {here} and not cancelled"
    )


def _changed(select: str) -> str:
    """Over the marts of the lake after one month was revised and another emptied."""
    from flightmarts.plans.queries import EMPTIED_MONTH, RELOADED_MONTH

    (y, m), (ey, em) = RELOADED_MONTH, EMPTIED_MONTH
    here = f"(year = {y} and month = {m})"
    before = CLEAN.replace("clean as (", "clean_before as (", 1)
    changed = f"""
clean as (
    select * from clean_before where not {here} and not (year = {ey} and month = {em})
    union all
    select * replace (distance_miles + 1 as distance_miles) from clean_before where {here} and not cancelled
)"""
    return with_ctes(LEGS, before, changed, STG, ENRICHED, MONTHLY_OTP, ROUTE, AIRPORT, DELAY) + f"\n{select}"


def _skewed_sql() -> str:
    """The cleaned raw rows with copies of one leg that carry other legs' values."""
    cols = ", ".join(f"h.{c}" if c in FLIGHT_KEY or c in ("year", "month") else f"c.{c}" for c in FLIGHT_COLUMNS)
    return with_ctes(LEGS, CLEAN_CSV) + f"""
, hot as (select * from clean_csv order by {_KEY} limit 1),
skewed as (
    select {_COLS} from clean_csv
    union all
    select {cols} from clean_csv c cross join hot h where cast(c.flight_number as bigint) % 4 = 0
)
select {_COLS} from (select *, row_number() over (partition by {_KEY} order by {_ORDER}) as nth from skewed) where nth = 1"""


def _fewer_sql(month: tuple[int, int]) -> str:
    """Rows per mart without one month."""
    return " union all ".join(
        f"select '{t}' as table_name, count(*) as rows from {t} where month_start <> make_date({month[0]}, {month[1]}, 1)" for t in EXPORT_TABLES
    )


def build_oracles() -> dict[str, str]:
    return {k: portable_counts(v) for k, v in _oracles().items()}


def _oracles() -> dict[str, str]:
    from flightmarts.operators import checks as C
    from flightmarts.operators import gate as G
    from flightmarts.plans.queries import AS_OF, DIRTY_CHECKS, EMPTIED_MONTH, FIXTURE_BANDS, RELOADED_MONTH, RUN_DATE

    suites = G.default_suites(AS_OF)
    scaled = G.default_suites(AS_OF, FIXTURE_BANDS)
    rd = RUN_DATE.month - 2
    dy, dm = (RUN_DATE.year, rd) if rd >= 1 else (RUN_DATE.year - 1, rd + 12)
    return {
        "clean_flights": with_ctes(LEGS, CLEAN_CSV) + "\nselect * from clean_csv",
        "clean_reconciliation": with_ctes(LEGS, CLEAN) + """
select rows_in, rows_out, rows_in - rows_out as dropped from (
    select cast((select count(*) from legs)
              + (select count(*) from legs where cast(flight_number as bigint) % 10 = 0) as bigint) as rows_in,
           cast((select count(*) from clean) as bigint) as rows_out)""",
        "stage_flights": over_marts("select * from stg"),
        "enrich_flights": over_marts(
            f"select {_KEY}, carrier_name, cancellation_reason, month_start, "
            "is_reportable_arrival, is_on_time from enriched"),
        "monthly_otp": over_marts("select * from fct_monthly_otp"),
        "route_performance": over_marts("select * from fct_route_performance"),
        "airport_congestion": over_marts("select * from fct_airport_congestion"),
        "airport_congestion_join": over_marts("select * from fct_airport_congestion"),
        "delay_causes": over_marts("select * from fct_delay_causes"),
        "rows_by_month": over_marts(_months_sql()),
        "rows_by_month_running": over_marts(
            f"select *, cast(sum(rows) over (order by year, month rows between unbounded preceding "
            f"and current row) as bigint) as running_rows from ({_months_sql()})"),
        "missing_months": _missing_sql(["carrier_code"]),
        "missing_route_months": _missing_sql(["origin", "dest"]),
        "data_month_slice": over_marts(
            f"select year, month, carrier_code, cast(count(*) as bigint) as flights from clean "
            f"where year = {dy} and month = {dm} group by year, month, carrier_code"),
        "partition_from_path": over_marts(_months_sql()),
        "month_overwrite": over_marts(_content(_reloaded(EMPTIED_MONTH, RELOADED_MONTH))),
        "declared_raw_table": over_marts(_content(_reloaded(None, RELOADED_MONTH))),
        "requested_months_missing": over_marts("""
, bounds as (select min(make_date(year, month, 1)) as lo, max(make_date(year, month, 1)) as hi from clean),
spine as (select cast(unnest(generate_series(lo - interval 1 year, hi + interval 1 year, interval 1 month)) as date) as m from bounds)
select cast(year(m) as integer) as year, cast(month(m) as integer) as month from spine
where (year(m), month(m)) not in (select (year, month) from clean)"""),
        "seed_csv": "select cast(n_nationkey as varchar) as carrier_code, n_name as carrier_name from nation",
        "backfill_months": over_marts("""
, raw_in as (
    select year, month,
           count(*) + count_if(cast(flight_number as bigint) % 10 = 0) as rows_in
    from legs group by year, month
),
kept as (select year, month, count(*) as rows_out from clean group by year, month)
select r.year, r.month, cast(r.rows_in as bigint) as rows_in,
       cast(coalesce(k.rows_out, 0) as bigint) as rows_out,
       cast(r.rows_in - coalesce(k.rows_out, 0) as bigint) as dropped
from raw_in r left join kept k on r.year = k.year and r.month = k.month"""),
        "full_reload": over_marts(
            "select year, month, cast(count(*) as bigint) as rows, cast(count(*) as bigint) as stamped_rows "
            "from clean group by year, month"),
        "incremental_load": over_marts(
            f"select *, cast(0 as bigint) as third_run_batches from ({_content(_reloaded(EMPTIED_MONTH, RELOADED_MONTH))})"),
        "bounded_lengths": over_marts(_BOUNDED),
        "check_not_null": _checks_sql(C.checks_of_kind(("not_null",))),
        "check_unique": _checks_sql(C.checks_of_kind(("unique",))),
        "check_grain": _checks_sql(C.checks_of_kind(("unique_combination",))),
        "check_accepted_values": _checks_sql(C.checks_of_kind(("accepted_values",))),
        "check_accepted_range": _checks_sql(C.checks_of_kind(("accepted_range",))),
        "check_summary": _checks_sql(C.default_checks(), summary=True),
        "check_failures": _dirty_sql(DIRTY_CHECKS),
        "gate_results": _gate_sql(suites, "select * from results"),
        "gate_open_results": _gate_sql(scaled, "select * from results"),
        "gated_export": over_marts(f"""
, scaled as ({_gate_body(scaled)}), reference as ({_gate_body(suites)}),
gates as (select (select bool_and(success) from scaled) as wide, (select bool_and(success) from reference) as narrow),
pushed as ({_EXPORT_EACH}),
fewer as ({_fewer_sql(RELOADED_MONTH)}),
sizes as (select p.table_name, p.rows as every_row, f.rows as fewer_rows, wide, narrow
          from pushed p join fewer f on p.table_name = f.table_name cross join gates),
after as (select *, case when wide then every_row else 0 end as after1 from sizes),
after2 as (select *, case when narrow then fewer_rows else after1 end as after2 from after)
select cast(1 as int) as run, wide as gate_open, table_name, cast(after1 as bigint) as rows from after2
union all select cast(2 as int), narrow, table_name, cast(after2 as bigint) from after2
union all select cast(3 as int), wide, table_name, cast(case when wide then fewer_rows else after2 end as bigint) from after2"""),
        "clean_skewed": _skewed_sql(),
        "state_monthly_otp": _changed("select * from fct_monthly_otp"),
        "state_route_performance": _changed("select * from fct_route_performance"),
        "state_airport_congestion": _changed("select * from fct_airport_congestion"),
        "state_delay_causes": _changed("select * from fct_delay_causes"),
        "gate_from_summaries": _changed(f", results as ({_gate_body(scaled)}) select * from results"),
        "merged_route_coverage": _missing_sql(["origin", "dest"]),
        "month_commit": over_marts(_content(_reloaded(EMPTIED_MONTH, RELOADED_MONTH))),
        "fingerprint_ledger": over_marts(
            f"select *, cast(0 as bigint) as third_run_batches from ({_content(_reloaded(EMPTIED_MONTH, RELOADED_MONTH))})"),
        "export_push": over_marts(f", pushed as ({_EXPORT_EACH}) "
            "select table_name, cast(rows as bigint) as rows, cast(rows as bigint) as reported_rows, true as within_limit from pushed"),
        "gate_suites": _gate_sql(
            suites,
            "select suite, cast(count(*) as bigint) as evaluated_expectations, "
            "cast(count_if(success) as bigint) as successful_expectations, bool_and(success) as success "
            "from results group by suite"),
        "gate_decision": _gate_sql(
            suites,
            "select cast(count(*) as bigint) as evaluated_expectations, "
            "cast(count_if(success) as bigint) as successful_expectations, bool_and(success) as gate_open "
            "from results"),
        "export_rows": _export_sql("fct_monthly_otp"),
        "export_route_rows": _export_sql("fct_route_performance"),
        "export_airport_rows": _export_sql("fct_airport_congestion"),
        "export_cause_rows": _export_sql("fct_delay_causes"),
        "export_batches": over_marts(_EXPORT_COUNTS),
    }
