"""Session-level helpers: shared scratch space and tables that live there for a while."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from flightmarts.jobs import released_shuffles


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A cluster has to set it, because executors can only share tables written to
    storage that all of them reach. A ``local[*]`` session (tests, bench) without one
    gets a private folder, registered as the session's checkpoint folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="flightmarts-ckpt-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/flightmarts/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_table(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows as a table in the scratch space, gone when the block ends.

    What reads the rows several times makes them once, and the exchanges behind them are
    released before its own begin; columns on disk take a fraction of the rows of an exchange."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        with released_shuffles(spark):
            rows.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
