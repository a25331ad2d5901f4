"""Flight-leg data model: source columns, typed schema, natural key, bounds.

Everything here is a fixed value: the raw on-time files use these header
names, the cleaned lake uses these target names and types, and the warehouse
table bounds its strings to these lengths.
"""

from __future__ import annotations

from pyspark.sql import types as T

DATE = T.DateType()
STRING = T.StringType()
DOUBLE = T.DoubleType()
BOOLEAN = T.BooleanType()
INT = T.IntegerType()

# --- fixed values: raw header name, lake column name, lake type (in file order)
SOURCE_COLUMNS: list[tuple[str, str, T.DataType]] = [
    ("FlightDate", "flight_date", DATE),
    ("Reporting_Airline", "carrier_code", STRING),
    ("Flight_Number_Reporting_Airline", "flight_number", STRING),
    ("Tail_Number", "tail_number", STRING),
    ("Origin", "origin", STRING),
    ("OriginCityName", "origin_city", STRING),
    ("OriginState", "origin_state", STRING),
    ("Dest", "dest", STRING),
    ("DestCityName", "dest_city", STRING),
    ("DestState", "dest_state", STRING),
    ("Distance", "distance_miles", DOUBLE),
    ("CRSDepTime", "crs_dep_time", STRING),
    ("DepTime", "dep_time", STRING),
    ("DepDelay", "dep_delay_min", DOUBLE),
    ("DepDel15", "dep_delayed_15", BOOLEAN),
    ("TaxiOut", "taxi_out_min", DOUBLE),
    ("TaxiIn", "taxi_in_min", DOUBLE),
    ("CRSArrTime", "crs_arr_time", STRING),
    ("ArrTime", "arr_time", STRING),
    ("ArrDelay", "arr_delay_min", DOUBLE),
    ("ArrDel15", "arr_delayed_15", BOOLEAN),
    ("CRSElapsedTime", "crs_elapsed_min", DOUBLE),
    ("ActualElapsedTime", "actual_elapsed_min", DOUBLE),
    ("AirTime", "air_time_min", DOUBLE),
    ("Cancelled", "cancelled", BOOLEAN),
    ("CancellationCode", "cancellation_code", STRING),
    ("Diverted", "diverted", BOOLEAN),
    ("CarrierDelay", "carrier_delay_min", DOUBLE),
    ("WeatherDelay", "weather_delay_min", DOUBLE),
    ("NASDelay", "nas_delay_min", DOUBLE),
    ("SecurityDelay", "security_delay_min", DOUBLE),
    ("LateAircraftDelay", "late_aircraft_delay_min", DOUBLE),
    ("Year", "year", INT),
    ("Month", "month", INT),
]

# --- fixed values: natural key of one scheduled flight leg
FLIGHT_KEY: list[str] = [
    "flight_date",
    "carrier_code",
    "flight_number",
    "origin",
    "dest",
    "crs_dep_time",
]

# --- fixed values: VARCHAR bounds of the warehouse raw table
VARCHAR_LENGTHS: dict[str, int] = {
    "carrier_code": 8,
    "flight_number": 8,
    "tail_number": 12,
    "origin": 5,
    "origin_city": 64,
    "origin_state": 4,
    "dest": 5,
    "dest_city": 64,
    "dest_state": 4,
    "crs_dep_time": 6,
    "dep_time": 6,
    "crs_arr_time": 6,
    "arr_time": 6,
    "cancellation_code": 2,
}

PARTITION_COLUMNS = ["year", "month"]
FLIGHT_COLUMNS: list[str] = [name for _, name, _ in SOURCE_COLUMNS]
DATA_COLUMNS: list[str] = [c for c in FLIGHT_COLUMNS if c not in PARTITION_COLUMNS]
PAYLOAD_COLUMNS: list[str] = [c for c in FLIGHT_COLUMNS if c not in FLIGHT_KEY]
FLAG_COLUMNS: list[str] = [n for _, n, t in SOURCE_COLUMNS if isinstance(t, T.BooleanType)]
CAUSE_COLUMNS: list[str] = [
    "carrier_delay_min",
    "weather_delay_min",
    "nas_delay_min",
    "security_delay_min",
    "late_aircraft_delay_min",
]

FLIGHT_SCHEMA = T.StructType([T.StructField(n, t) for _, n, t in SOURCE_COLUMNS])
LAKE_DATA_SCHEMA = T.StructType([f for f in FLIGHT_SCHEMA.fields if f.name not in PARTITION_COLUMNS])

# --- fixed values: export schema per mart (column, export type)
EXPORT_TABLES: dict[str, list[tuple[str, str]]] = {
    "fct_monthly_otp": [
        ("month_start", "Datetime"), ("carrier_code", "String"),
        ("carrier_name", "String"), ("scheduled_flights", "Int64"),
        ("cancelled_flights", "Int64"), ("diverted_flights", "Int64"),
        ("completed_flights", "Int64"), ("on_time_flights", "Int64"),
        ("otp_pct", "Double"), ("cancellation_pct", "Double"),
        ("avg_arr_delay_min", "Double"), ("avg_dep_delay_min", "Double"),
    ],
    "fct_route_performance": [
        ("month_start", "Datetime"), ("origin", "String"),
        ("origin_city", "String"), ("origin_state", "String"),
        ("dest", "String"), ("dest_city", "String"), ("dest_state", "String"),
        ("distance_miles", "Double"), ("scheduled_flights", "Int64"),
        ("cancelled_flights", "Int64"), ("completed_flights", "Int64"),
        ("otp_pct", "Double"), ("cancellation_pct", "Double"),
        ("avg_arr_delay_min", "Double"),
    ],
    "fct_airport_congestion": [
        ("month_start", "Datetime"), ("airport_code", "String"),
        ("city", "String"), ("state", "String"), ("departures", "Int64"),
        ("arrivals", "Int64"), ("total_movements", "Int64"),
        ("avg_taxi_out_min", "Double"), ("avg_taxi_in_min", "Double"),
    ],
    "fct_delay_causes": [
        ("month_start", "Datetime"), ("carrier_code", "String"),
        ("carrier_name", "String"), ("carrier_delay_min", "Double"),
        ("weather_delay_min", "Double"), ("nas_delay_min", "Double"),
        ("security_delay_min", "Double"), ("late_aircraft_delay_min", "Double"),
        ("total_delay_min", "Double"), ("carrier_pct", "Double"),
        ("weather_pct", "Double"), ("nas_pct", "Double"),
        ("security_pct", "Double"), ("late_aircraft_pct", "Double"),
    ],
}

# Export type -> Spark type the value is cast to before serialisation.
EXPORT_CASTS: dict[str, T.DataType] = {
    "Datetime": STRING,
    "String": STRING,
    "Int64": T.LongType(),
    "Double": DOUBLE,
}

ROWS_PER_REQUEST = 10_000
