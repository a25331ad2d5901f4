"""Flight-shaped legs derived from the TPC-H-like test tables.

The test data holds no flights, so a deterministic projection turns every
``lineitem`` row into one flight leg (the rules are the fixture's fixed
values, listed in ``FIXTURES.md`` section 5). The work grows with
``lineitem``: it shuffles by ``l_orderkey`` to meet the orders side
(``orders`` meets ``customer`` first, so the big side never shuffles by
customer) and, once ``part`` outgrows the broadcast threshold, by
``l_partkey``. nation/region and part are left to the planner's
size check (broadcast only while their file size is under the threshold,
re-checked by AQE at runtime).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.schema import FLAG_COLUMNS, FLIGHT_COLUMNS, SOURCE_COLUMNS

# --- fixed values: fixture rules
DEST_MODULUS = 30          # dest airport = p_size % 30 (A25..A29 have no nation)
TAIL_MODULUS = 5000        # tail number = 'N' || l_partkey % 5000
CARRIER_MODULUS = 30       # carrier = l_suppkey % 30; 25..29 are in no lookup
STATE_LENGTH = 4           # state = first letters of the region, within VARCHAR(4)
CANCEL_CODES = ["A", "B", "C", "D"]  # by l_orderkey % 4
DUPLICATE_MODULUS = 10     # raw variant repeats rows with l_orderkey % 10 = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region as (key, city, state).

    No broadcast hint: both are file-backed, so the planner knows their size
    and broadcasts them only below ``spark.sql.autoBroadcastJoinThreshold``
    (AQE re-checks with runtime sizes); otherwise it keeps a shuffled join.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").alias("place_key"),
        F.col("n_name").alias("place_city"),
        F.substring("r_name", 1, STATE_LENGTH).alias("place_state"),
    )


def fixture_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier lookup of the fixture: every nation (code, name)."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("carrier_code"),
        F.col("n_name").alias("carrier_name"),
    )


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flight legs (34 lake columns), one per lineitem row."""
    place = places(spark, sf_dir)

    # orders side: one row per order with its date and origin nation
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("flight_date"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    origin = place.select(
        F.col("place_key").alias("c_nationkey"),
        F.col("place_city").alias("origin_city"),
        F.col("place_state").alias("origin_state"),
    )
    order_side = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").select("o_orderkey", "flight_date", "c_nationkey")

    # line side: what the rules need of a line item, with part size and destination place
    tax = F.round(F.col("l_tax") * 100).cast("int")
    disc = F.round(F.col("l_discount") * 100).cast("int")
    cancelled = (F.col("l_returnflag") == "R") & (tax >= 7)
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        (F.col("l_suppkey") % CARRIER_MODULUS).alias("carrier"),
        tax.alias("tax"),
        cancelled.alias("cancelled"),
        (~cancelled & (F.col("l_linestatus") == "O") & (disc == 0)).alias("diverted"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    dest = place.select(
        F.col("place_key").alias("dest_key"),
        F.col("place_city").alias("dest_city"),
        F.col("place_state").alias("dest_state"),
    )
    # lineitem meets the orders side first: the narrow scan shuffles by
    # l_orderkey, and the part/place probes run after the exchange,
    # spread over all shuffle partitions.
    base = (
        lineitem.join(order_side, lineitem.l_orderkey == order_side.o_orderkey, "inner")
        .join(part, lineitem.l_partkey == part.p_partkey, "inner")
        .withColumn("dest_key", F.col("p_size") % DEST_MODULUS)
        .join(dest, "dest_key", "left")
        .join(origin, "c_nationkey", "inner")
    )

    tax, cancelled, diverted = F.col("tax"), F.col("cancelled"), F.col("diverted")
    flown = ~cancelled & ~diverted
    dep_delay = F.when(~cancelled, F.col("l_quantity") * 2 - 60)
    arr_delay = F.when(flown, F.col("l_quantity") * 2 - 60 + tax - 4)
    distance = (F.lit(100) + F.abs(F.col("c_nationkey") - F.col("dest_key")) * 50).cast("double")
    code_idx = (F.col("l_orderkey") % 4).cast("int")
    code = F.element_at(F.array(*[F.lit(c) for c in CANCEL_CODES]), code_idx + 1)

    step1 = base.select(
        "flight_date",
        F.col("carrier").cast("string").alias("carrier_code"),
        F.col("l_orderkey").cast("string").alias("flight_number"),
        F.concat(F.lit("N"), (F.col("l_partkey") % TAIL_MODULUS).cast("string")).alias("tail_number"),
        F.concat(F.lit("A"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("origin"),
        "origin_city",
        "origin_state",
        F.concat(F.lit("A"), F.lpad(F.col("dest_key").cast("string"), 2, "0")).alias("dest"),
        "dest_city",
        "dest_state",
        distance.alias("distance_miles"),
        F.lpad((F.col("l_linenumber") * 300).cast("string"), 4, "0").alias("crs_dep_time"),
        F.lpad((F.col("l_linenumber") * 300 + 100).cast("string"), 4, "0").alias("crs_arr_time"),
        dep_delay.alias("dep_delay_min"),
        arr_delay.alias("arr_delay_min"),
        F.when(~cancelled, (F.col("l_orderkey") % 30 + 5).cast("double")).alias("taxi_out_min"),
        F.when(flown, (F.col("l_partkey") % 15 + 3).cast("double")).alias("taxi_in_min"),
        "cancelled",
        F.when(cancelled, code).otherwise(F.lit("")).alias("cancellation_code"),
        "diverted",
        F.col("l_orderkey").alias("_ok"),
    )

    a = F.col("arr_delay_min").cast("long")
    late = a >= 15

    def cause(modulus_test, value):
        return F.when(late, F.when(modulus_test, value).otherwise(F.lit(0).cast("long")))

    weather = cause(F.col("_ok") % 2 == 0, F.floor(a / 5).cast("long"))
    nas = cause(F.col("_ok") % 3 == 0, F.floor(a / 4).cast("long"))
    security = cause(F.col("_ok") % 5 == 0, F.lit(1).cast("long"))
    late_aircraft = cause(F.col("_ok") % 7 < 3, F.floor(a / 3).cast("long"))
    crs_elapsed = F.lit(60.0) + F.col("distance_miles") / 10
    actual = F.col("crs_elapsed_min") + F.col("arr_delay_min") - F.col("dep_delay_min")

    step2 = step1.select(
        "*",
        F.col("crs_dep_time").alias("dep_time"),
        F.col("crs_arr_time").alias("arr_time"),
        (F.col("dep_delay_min") >= 15).alias("dep_delayed_15"),
        (F.col("arr_delay_min") >= 15).alias("arr_delayed_15"),
        crs_elapsed.alias("crs_elapsed_min"),
        weather.alias("_w"),
        nas.alias("_n"),
        security.alias("_s"),
        late_aircraft.alias("_l"),
        F.year("flight_date").alias("year"),
        F.month("flight_date").alias("month"),
    )
    step3 = step2.select(
        "*",
        actual.alias("actual_elapsed_min"),
        (a - F.col("_w") - F.col("_n") - F.col("_s") - F.col("_l")).cast("double").alias("carrier_delay_min"),
        F.col("_w").cast("double").alias("weather_delay_min"),
        F.col("_n").cast("double").alias("nas_delay_min"),
        F.col("_s").cast("double").alias("security_delay_min"),
        F.col("_l").cast("double").alias("late_aircraft_delay_min"),
    )
    air_time = F.col("actual_elapsed_min") - F.col("taxi_out_min") - F.col("taxi_in_min")
    return step3.select(
        *[
            air_time.alias("air_time_min") if c == "air_time_min" else F.col(c)
            for c in FLIGHT_COLUMNS
        ]
    )


def raw_strings(legs_df: DataFrame) -> DataFrame:
    """All-string raw variant of the legs, with source header names.

    Flags become ``'1.00'``/``'0.00'``, NULL stays NULL, and rows with
    ``l_orderkey % 10 = 0`` appear twice (an exact duplicate per such row), so
    cleaning must drop them again.
    """
    exprs = []
    for src, name, _ in SOURCE_COLUMNS:
        c = F.col(name)
        if name in FLAG_COLUMNS:
            c = F.when(c, F.lit("1.00")).when(~c, F.lit("0.00"))
        exprs.append(c.cast("string").alias(src))
    raw = legs_df.select(*exprs)
    again = F.col("Flight_Number_Reporting_Airline").cast("long") % DUPLICATE_MODULUS == 0
    # one pass over the legs, which are a join: the copy is made beside its row
    return raw.withColumn("_copy", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_copy")
