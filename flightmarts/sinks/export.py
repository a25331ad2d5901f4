"""Typed, batched, replace-all export of the marts.

Each mart is cast to its export schema (dates as ISO strings, integers as
``long``, decimals and averages as ``double``, NULL kept) and written as JSON
lines with at most 10,000 rows per file: one file is one request body of the
push interface. ``mode("overwrite")`` gives replace-all semantics per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.jobs import run_concurrently
from flightmarts.schema import EXPORT_CASTS, EXPORT_TABLES, ROWS_PER_REQUEST


def export_frame(mart: DataFrame, table: str) -> DataFrame:
    """Project and cast a mart to its export schema."""
    cols = []
    for name, kind in EXPORT_TABLES[table]:
        c = F.col(name)
        if kind == "Datetime":
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.cast(EXPORT_CASTS[kind]).alias(name))
    return mart.select(*cols)


def export_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(n, EXPORT_CASTS[k]) for n, k in EXPORT_TABLES[table]])


def write_export(marts: dict[str, DataFrame], out_dir: str) -> dict[str, int]:
    """Write every mart as JSON batches of <= 10,000 rows; returns rows per table.

    NULL fields are written (``ignoreNullFields=false``) so every request row
    carries the full schema.
    """
    def push(table: str, mart: DataFrame):
        def run() -> int:
            obs = Observation(f"export_{table}")
            frame = export_frame(mart, table).observe(obs, F.count(F.lit(1)).alias("rows"))
            (
                frame.write.mode("overwrite")
                .option("maxRecordsPerFile", ROWS_PER_REQUEST)
                .option("ignoreNullFields", "false")
                .json(f"{out_dir.rstrip('/')}/{table}")
            )
            return int(obs.get["rows"])

        return run

    # tables are independent: one job each, submitted side by side
    return run_concurrently({table: push(table, mart) for table, mart in marts.items()})


def read_export(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """Read one exported table back with its export schema, plus the batch file."""
    return (
        spark.read.schema(export_schema(table))
        .json(f"{out_dir.rstrip('/')}/{table}")
        .withColumn("batch_file", F.col("_metadata.file_name"))
    )


def export_batches(spark: SparkSession, out_dir: str, tables: list[str] | None = None) -> DataFrame:
    """Rows, batches and the largest batch per exported table, from the written files."""
    parts = []
    for table in tables or list(EXPORT_TABLES):
        per_file = read_export(spark, out_dir, table).groupBy("batch_file").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_file.agg(
                F.sum("n").cast("long").alias("rows"),
                F.count(F.lit(1)).alias("batches"),
                F.max("n").cast("long").alias("max_batch_rows"),
            ).select(F.lit(table).alias("table_name"), "*")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
