"""Seed lookups: carriers and cancellation codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CARRIER_SCHEMA = T.StructType(
    [T.StructField("carrier_code", T.StringType()), T.StructField("carrier_name", T.StringType())]
)
CANCELLATION_SCHEMA = T.StructType(
    [
        T.StructField("cancellation_code", T.StringType()),
        T.StructField("cancellation_reason", T.StringType()),
    ]
)

# --- fixed values: reporting-carrier codes and names
CARRIERS: list[tuple[str, str]] = [
    ("AA", "American Airlines"),
    ("AS", "Alaska Airlines"),
    ("B6", "JetBlue Airways"),
    ("DL", "Delta Air Lines"),
    ("F9", "Frontier Airlines"),
    ("G4", "Allegiant Air"),
    ("HA", "Hawaiian Airlines"),
    ("NK", "Spirit Airlines"),
    ("UA", "United Airlines"),
    ("WN", "Southwest Airlines"),
    ("OO", "SkyWest Airlines"),
    ("YX", "Republic Airways"),
    ("MQ", "Envoy Air"),
    ("OH", "PSA Airlines"),
    ("9E", "Endeavor Air"),
    ("YV", "Mesa Airlines"),
    ("EV", "ExpressJet Airlines"),
    ("VX", "Virgin America"),
    ("US", "US Airways"),
    ("QX", "Horizon Air"),
]

# --- fixed values: cancellation reason codes
CANCELLATION_CODES: list[tuple[str, str]] = [
    ("A", "Carrier"),
    ("B", "Weather"),
    ("C", "National Air System"),
    ("D", "Security"),
]


def literal_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small constant table built from literals inside the plan.

    Unlike ``createDataFrame(list)`` (a Python RDD, evaluated by Python
    workers in every job that reads it) this stays in the JVM and in codegen.
    """
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def carriers(spark: SparkSession) -> DataFrame:
    """The 20-row carrier seed; its size is fixed in code, so it is broadcast."""
    return F.broadcast(literal_frame(spark, CARRIERS, CARRIER_SCHEMA))


def cancellation_codes(spark: SparkSession) -> DataFrame:
    """The 4-row cancellation-code seed; fixed size, so it is broadcast."""
    return F.broadcast(literal_frame(spark, CANCELLATION_CODES, CANCELLATION_SCHEMA))


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed CSV with explicit column types (S5); header row, no inference."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)
