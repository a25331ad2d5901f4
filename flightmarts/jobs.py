"""Driver-side job submission helpers."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_MONTHS = 64  # files that a task keeps open; with more months than that it sorts the rest
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
_HELD: dict[tuple[str, str], int] = {}  # holders of a setting, by application and setting


def run_concurrently(actions: dict[str, Callable[[], object]], max_jobs: int = 4) -> dict[str, object]:
    """Submit independent Spark actions from a few driver threads at once.

    Each action is its own job; running them side by side lets the scheduler
    fill the cores that one small job leaves idle. The first failure is raised.
    """
    if len(actions) <= 1:
        return {k: f() for k, f in actions.items()}
    with ThreadPoolExecutor(max_workers=min(max_jobs, len(actions))) as pool:
        futures = {k: pool.submit(f) for k, f in actions.items()}
        return {k: fut.result() for k, fut in futures.items()}


@contextmanager
def _held(spark: SparkSession, conf: str, default: str, value: str) -> Iterator[None]:
    """A session setting that holds until the last of its holders leaves; one that the caller set stays."""
    key = (spark.sparkContext.applicationId, conf)
    with _LOCK:
        ours = key in _HELD or spark.conf.get(conf, default) == default
        if ours:
            _HELD[key] = _HELD.get(key, 0) + 1
            spark.conf.set(conf, value)
    try:
        yield
    finally:
        with _LOCK:
            if ours:
                _HELD[key] -= 1
                if not _HELD[key]:
                    del _HELD[key]
                    spark.conf.unset(conf)


def unsorted_writes(spark: SparkSession):
    """Partitioned writes inside keep a file open per month instead of sorting their rows.

    A write by month sorts each task's rows by month first, and a task that copies 128 MB of
    Parquet holds millions of wide rows, which that sort spills. Spark has no option of a write
    for it, so the session's setting holds while such writes run and goes with the last of
    them; a value that the caller set stays.
    """
    return _held(spark, OPEN_FILES, "0", str(OPEN_MONTHS))


def released_shuffles(spark: SparkSession):
    """Queries that are run inside delete their shuffle files when they end.

    Else those files stay until the driver happens to collect its garbage, so the exchanges of
    a chain of written tables lie on disk side by side, though nothing reads them again. Spark
    has no option of a write for it. A ``DataFrame`` that is run twice makes its exchanges twice.
    """
    return _held(spark, RELEASE, "false", "true")


@contextmanager
def month_writes(spark: SparkSession) -> Iterator[None]:
    """Writes by month inside neither sort their rows nor leave shuffle files behind."""
    with unsorted_writes(spark), released_shuffles(spark):
        yield
