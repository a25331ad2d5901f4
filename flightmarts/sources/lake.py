"""Parquet lake: Hive-partitioned by ``year``/``month`` (values not zero-padded)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.functions.months import month_filter
from flightmarts.schema import FLIGHT_SCHEMA, LAKE_DATA_SCHEMA
from flightmarts.committed import MonthTable, is_committed


def read_lake(
    spark: SparkSession, root: str, months: Iterable[tuple[int, int]] | None = None
) -> DataFrame:
    """Read the lake back with its fixed schema (S3), optionally a set of months.

    ``year``/``month`` come from partition discovery; a month list becomes a
    partition filter (``PartitionFilters`` in the scan, no other folder read). A committed
    lake is read at its newest version, where only the months' own folders are listed.
    """
    if is_committed(spark, root):
        return MonthTable(spark, root, FLIGHT_SCHEMA).read(months)
    df = spark.read.schema(FLIGHT_SCHEMA).parquet(root)
    if months is not None:
        df = df.where(month_filter(months))
    return df


def read_lake_files(spark: SparkSession, root: str) -> DataFrame:
    """Read lake files without partition discovery; year/month parsed from the path.

    ``recursiveFileLookup`` turns discovery off, the file path comes from the
    ``_metadata`` column and ``regexp_extract`` pulls the values out of it.
    """
    df = spark.read.schema(LAKE_DATA_SCHEMA).option("recursiveFileLookup", "true").parquet(root)
    path = F.col("_metadata.file_path")
    return df.select(
        *LAKE_DATA_SCHEMA.fieldNames(),
        F.regexp_extract(path, r"year=([0-9]+)", 1).cast("int").alias("year"),
        F.regexp_extract(path, r"month=([0-9]+)", 1).cast("int").alias("month"),
    )
