"""Structural cleaning: select + strict cast, flag normalisation, key filter, dedup."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.functions.flags import flag_to_bool
from flightmarts.functions.strict import strict_cast
from flightmarts.jobs import released_shuffles
from flightmarts.schema import FLIGHT_COLUMNS, FLIGHT_KEY, SOURCE_COLUMNS


def cast_raw(raw: DataFrame) -> DataFrame:
    """Select the 34 used source columns by name, rename and cast.

    Strictness is part of the expressions, so a malformed value fails the job
    with ANSI mode on or off. A missing source column fails at analysis.
    """
    flags = {name: flag_to_bool(src) for src, name, t in SOURCE_COLUMNS if t == T.BooleanType()}
    texts = {name: F.col(src) for src, name, t in SOURCE_COLUMNS if t == T.StringType()}
    others = {name: strict_cast(src, t) for src, name, t in SOURCE_COLUMNS if name not in flags and name not in texts}
    typed = {**flags, **texts, **others}
    return raw.select(*[typed[name].alias(name) for name in FLIGHT_COLUMNS])


def drop_missing_keys(flights: DataFrame) -> DataFrame:
    """Drop rows with NULL in any natural-key column."""
    return flights.dropna(subset=FLIGHT_KEY)


def deduplicate(flights: DataFrame) -> DataFrame:
    """One row per natural key, the same one every run (A1).

    The winner is the smallest row by all non-key columns in schema order,
    ascending, NULLs first: ``min(struct(...))`` per key. It is an aggregate,
    so each map task pre-reduces its rows per key before the shuffle and a
    key holding a third of all rows arrives as one row per map task.
    """
    payload = [c for c in flights.columns if c not in FLIGHT_KEY]
    winner = F.min(F.struct(*[F.col(c) for c in payload])).alias("_row")
    return (
        flights.groupBy(*FLIGHT_KEY)
        .agg(winner)
        .select(*FLIGHT_KEY, *[F.col(f"_row.{c}").alias(c) for c in payload])
        .select(*[c for c in flights.columns])
    )


def clean(raw: DataFrame) -> DataFrame:
    """Typed, key-complete, deduplicated legs from all-string raw rows."""
    return deduplicate(drop_missing_keys(cast_raw(raw))).select(*FLIGHT_COLUMNS)


# -- cleaning for a write by month: one exchange of leg size ---------------------------

ROWS_PER_BUCKET = 80_000  # legs of a bucket at most
BYTES_PER_BUCKET = 24 << 20  # raw bytes that hold about as many
ROWS_PER_TASK = 4 * ROWS_PER_BUCKET  # legs that one task sorts, about 220 MB
HEAVY_CELLS = 1_024
MOST_HEAVY = 4_096  # a heavy key holds a larger share than 1 / this of all rows


@dataclass(frozen=True)
class DedupPlan:
    """How ``deduplicate_in_buckets`` deals the legs: buckets per month of flight (``default``
    where a month is not listed), and the hashes of natural keys with very many copies.

    With ``tasks`` the buckets, numbered by month, go to tasks in that order, ``per_task`` to
    each; without, each goes where the hash of its month and number falls, so that some tasks
    get several times what others get."""

    default: int = 1
    buckets: dict[tuple[int, int], int] = field(default_factory=dict)
    heavy: tuple[int, ...] = ()
    tasks: int = field(default=0, compare=False)
    per_task: int = field(default=1, compare=False)


def key_hash() -> Column:
    return F.xxhash64(*FLIGHT_KEY)


def plan_by_size(raw_bytes: int, months: int, bytes_per_bucket: int = BYTES_PER_BUCKET) -> DedupPlan:
    """Buckets from the size of the raw files alone, for months of similar size."""
    default = 1 + raw_bytes // (max(1, months) * bytes_per_bucket)
    per_task = min(default, ROWS_PER_TASK // ROWS_PER_BUCKET)
    return DedupPlan(default=default, tasks=-(-default * max(1, months) // per_task), per_task=per_task)


def observe_skew(flights: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DedupPlan:
    """Buckets per month and heavy keys from the data, in narrow pre-passes over the key columns.

    Rows are counted by (month, cell of the key's hash), pre-aggregated per task. A month gets
    a bucket per ``rows_per_bucket`` rows. A key is heavy with more copies than a quarter of
    that and than a ``MOST_HEAVY``-th of all rows; it fills its cell, so only keys of overfull
    cells are counted one by one, however many rows there are. What reaches the driver: a row
    per month with at most ``HEAVY_CELLS`` counts, and at most ``MOST_HEAVY`` heavy keys.
    """
    with released_shuffles(flights.sparkSession):
        return _observe(flights, rows_per_bucket)


def _observe(flights: DataFrame, rows_per_bucket: int) -> DedupPlan:
    least = max(2, rows_per_bucket // 4)
    keyed = flights.select(F.year("flight_date").alias("y"), F.month("flight_date").alias("m"), key_hash().alias("h"))
    cells = keyed.groupBy("y", "m", F.pmod("h", F.lit(HEAVY_CELLS)).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    months = cells.groupBy("y", "m").agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") > least, F.struct("cell", "n"))).alias("full")).collect()
    buckets = {(r["y"], r["m"]): 1 + r["n"] // rows_per_bucket for r in months}
    rows, total = sum(r["n"] for r in months), sum(buckets.values())
    # a task per core, but no task with more legs than ROWS_PER_TASK however many there are
    per_task = -(-total // flights.sparkSession.sparkContext.defaultParallelism)
    per_task = max(1, min(per_task, ROWS_PER_TASK * total // max(1, rows)))
    tasks = -(-total // per_task)
    least = max(least, rows // MOST_HEAVY)
    full = sorted({c["cell"] for r in months for c in r["full"] if c["n"] > least})
    if not full:
        return DedupPlan(buckets=buckets, tasks=tasks, per_task=per_task)
    copies = keyed.where(F.pmod("h", F.lit(HEAVY_CELLS)).isin(full)).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    heavy = tuple(sorted(r["h"] for r in copies.where(F.col("n") > least).select("h").collect()))
    return DedupPlan(buckets=buckets, heavy=heavy, tasks=tasks, per_task=per_task)


def _of_month(values: dict[tuple[int, int], int]) -> Column:
    """The value of a leg's month, NULL for other months: an array by month number, which is
    read in one step, unless the months lie far apart."""
    number = F.year("flight_date") * 12 + F.month("flight_date")
    by_number = {y * 12 + m: F.lit(v).cast("long") for (y, m), v in sorted(values.items())}
    lo, hi = min(by_number), max(by_number)
    if hi - lo > 2_400:
        return F.try_element_at(F.create_map(*[x for n, v in by_number.items() for x in (F.lit(n), v)]), number)
    return F.get(F.array(*[by_number.get(n, F.lit(None).cast("long")) for n in range(lo, hi + 1)]), number - lo)


def _task_of(plan: DedupPlan) -> Column:
    """The task of a leg's bucket: ``per_task`` each, in the order of their months."""
    number = (F.year("flight_date") * 12 + F.month("flight_date")).cast("long") * plan.default  # of a month's first bucket
    if plan.buckets:
        firsts, first = {}, 0
        for ym, b in sorted(plan.buckets.items()):
            firsts[ym] = first
            first += b
        number = F.coalesce(_of_month(firsts), number)
    return F.pmod(F.floor((number + F.col("_bucket")) / plan.per_task), F.lit(plan.tasks)).cast("int")


def deduplicate_in_buckets(flights: DataFrame, plan: DedupPlan, again: DataFrame | None = None) -> DataFrame:
    """The rows of ``deduplicate``, dealt by month of flight and bucket of the key in one exchange.

    The month and the bucket follow from the natural key, so all copies of a leg meet in one
    task, the aggregate needs no exchange of its own, and a month arrives in as many tasks as
    its size asks for, laid out for a write by month. Heavy keys are the exception: their
    copies are reduced per task first (``deduplicate``), so that a key with a third of all
    rows costs one row per task instead of a third of the exchange in one task. They are read
    by a scan of their own, from ``again`` if given (the same rows without an observation).
    """
    hashed = key_hash()
    light, heavy = flights, None
    if plan.heavy:
        light, heavy = flights.where(~hashed.isin(*plan.heavy)), deduplicate((again or flights).where(hashed.isin(*plan.heavy)))
    n = F.lit(plan.default)
    if plan.buckets:
        n = F.coalesce(_of_month(plan.buckets), n)
    payload = [c for c in flights.columns if c not in FLIGHT_KEY]
    flown = light.withColumn("_flown", F.year("flight_date") * 100 + F.month("flight_date")).withColumn("_bucket", F.pmod(hashed, n.cast("long")))
    if plan.tasks:
        dealt = flown.withColumn("_task", _task_of(plan)).drop("_flown", "_bucket").repartitionById(plan.tasks, F.col("_task"))
        # the aggregate sorts by its keys: one number, the date and then the hash, settles nearly every comparison
        dealt = dealt.withColumn("_order", F.shiftleft(F.unix_date("flight_date").cast("long"), 40) + F.shiftrightunsigned(hashed, 24))
        by = ["_order", "_task"]
    else:
        dealt, by = flown.repartition("_flown", "_bucket"), ["_flown", "_bucket"]
    rows = (
        dealt.groupBy(*by, *FLIGHT_KEY)
        .agg(F.min(F.struct(*[F.col(c) for c in payload])).alias("_row"))
        .select(*[F.col(c) if c in FLIGHT_KEY else F.col(f"_row.{c}").alias(c) for c in flights.columns])
    )
    return rows if heavy is None else rows.unionByName(heavy)


def clean_for_months(raw: DataFrame, plan: DedupPlan | None = None, again: DataFrame | None = None) -> DataFrame:
    """``clean`` for a write by month; ``plan`` None observes the skew first. ``again``: the
    raw rows without an observation, for pre-passes and heavy keys."""
    flights, other = (drop_missing_keys(cast_raw(r)) for r in (raw, again or raw))
    plan = observe_skew(other) if plan is None else plan
    return deduplicate_in_buckets(flights, plan, other).select(*FLIGHT_COLUMNS)
