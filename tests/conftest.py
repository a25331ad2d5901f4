from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
import time

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from flightmarts.schema import FLIGHT_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("flightmarts-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fm-ckpt-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def shuffle_bytes(spark) -> int:
    """What exchanges have left on the local disks of a local session."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = [f"{d}/{x}" for top in dirs for d, _, names in os.walk(top) for x in names if x.startswith("shuffle_")]
    return sum(os.path.getsize(f) for f in files if os.path.exists(f))


def released(spark, before: int) -> bool:
    """No more than ``before`` is left; files are deleted in the background."""
    for _ in range(50):
        if shuffle_bytes(spark) <= before:
            return True
        time.sleep(0.1)
    return False


BASE_LEG = {
    "flight_date": dt.date(2024, 1, 10),
    "carrier_code": "AA",
    "flight_number": "100",
    "tail_number": "N1",
    "origin": "JFK",
    "origin_city": "New York, NY",
    "origin_state": "NY",
    "dest": "LAX",
    "dest_city": "Los Angeles, CA",
    "dest_state": "CA",
    "distance_miles": 2475.0,
    "crs_dep_time": "0800",
    "dep_time": "0805",
    "dep_delay_min": 5.0,
    "dep_delayed_15": False,
    "taxi_out_min": 10.0,
    "taxi_in_min": 5.0,
    "crs_arr_time": "1100",
    "arr_time": "1105",
    "arr_delay_min": 5.0,
    "arr_delayed_15": False,
    "crs_elapsed_min": 360.0,
    "actual_elapsed_min": 360.0,
    "air_time_min": 345.0,
    "cancelled": False,
    "cancellation_code": "",
    "diverted": False,
    "carrier_delay_min": None,
    "weather_delay_min": None,
    "nas_delay_min": None,
    "security_delay_min": None,
    "late_aircraft_delay_min": None,
    "year": 2024,
    "month": 1,
}


def make_legs(spark, rows):
    """Typed legs from dicts overriding BASE_LEG (year/month follow flight_date)."""
    out = []
    for i, r in enumerate(rows):
        leg = {**BASE_LEG, "flight_number": str(1000 + i), **r}
        leg.setdefault("year", leg["flight_date"].year)
        if "year" not in r:
            leg["year"], leg["month"] = leg["flight_date"].year, leg["flight_date"].month
        out.append(tuple(leg[f.name] for f in FLIGHT_SCHEMA.fields))
    return spark.createDataFrame(out, FLIGHT_SCHEMA)
