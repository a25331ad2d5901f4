"""Month tables whose reloads become visible in one step (K2, K5).

A committed table is a folder of staged month partitions and of manifests:

    <root>/data/commit=<id>/year=<y>/month=<m>/*.parquet
    <root>/_manifest/version=<n>/*.parquet      one row: the months and the commit each is in

A commit first writes its months into a folder of its own, which no reader looks at, and
then one manifest row that points the replaced months at it and leaves the emptied ones
out. That row is a single file, renamed into place by Spark's committer, so a reader sees
all of a commit or none of it: a crash between the steps, or a task that fails, leaves the
table as it was, and the same commit can be run again. ``DataFrame``s read before a commit
keep reading the folders of their version.

Versions are numbered; a second writer that took the same number fails when it finds that
manifest written, so one writer at a time gets through. ``vacuum`` deletes folders that no
kept manifest names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.functions.months import month_filter
from flightmarts.jobs import month_writes
from flightmarts.schema import PARTITION_COLUMNS

Month = tuple[int, int]

_ENTRY = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("commit", T.StringType())])
MANIFEST = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("commit", T.StringType()),
    T.StructField("months", T.ArrayType(_ENTRY)),
])


def only_months(rows: DataFrame, months: Iterable[Month]) -> DataFrame:
    """The same rows; the job fails on one that belongs to another month."""
    inside = F.coalesce(month_filter(months), F.lit(False))
    message = F.concat(F.lit("row outside the months to replace: "), F.concat_ws("-", "year", "month"))
    return rows.withColumn("year", F.when(inside, F.col("year")).otherwise(F.raise_error(message).cast("int")))


@dataclass(frozen=True)
class Version:
    number: int
    commit: str
    months: dict[Month, str]  # month -> the commit whose folder holds it


class StaleVersion(RuntimeError):
    """Another writer committed the version that this one was going to write."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder: versions or commits, a few each."""
    p, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def is_committed(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root.rstrip('/')}/_manifest")


class MonthTable:
    """Rows of ``schema`` (with year and month) under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    # -- reading ------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = _children(self.spark, f"{self.root}/_manifest")
        numbers = sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))
        # a version counts once its row is in place
        return [n for n in numbers if exists(self.spark, f"{self._manifest(n)}/_SUCCESS")]

    def _manifest(self, number: int) -> str:
        return f"{self.root}/_manifest/version={number}"

    def version(self, number: int | None = None) -> Version:
        """The newest version, or one by its number; number 0 is the empty table."""
        known = self.versions()
        number = (known[-1] if known else 0) if number is None else number
        if number == 0:
            return Version(0, "", {})
        if number not in known:
            raise ValueError(f"{self.root} has no version {number}")
        row = self.spark.read.schema(MANIFEST).parquet(self._manifest(number)).first()
        return Version(number, row["commit"], {(e["year"], e["month"]): e["commit"] for e in row["months"]})

    def read(self, months: Iterable[Month] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version; only the folders of ``months`` are listed and read."""
        now = self.version(version)
        wanted = sorted(now.months if months is None else set(now.months) & {(int(y), int(m)) for y, m in months})
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.root}/data/commit={now.months[ym]}/year={ym[0]}/month={ym[1]}" for ym in wanted]
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data").parquet(*folders)
        return rows.select(*self.schema.fieldNames())

    # -- writing ------------------------------------------------------------------

    def stage(self, rows: DataFrame, commit: str, rebalance: bool = True, max_records: int = 5_000_000) -> tuple[int, set[Month]]:
        """First step: the rows into the commit's own folder; (rows, months written).

        Running it again for the same commit replaces the folder."""
        rows = rows.select(*self.schema.fieldNames())
        if rebalance:
            rows = rows.hint("rebalance", *PARTITION_COLUMNS)
        seen = Observation(f"stage_{commit}")
        # at most one entry per month of the input
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col("year") * 100 + F.col("month")).alias("months"))
        with month_writes(self.spark):
            (
                rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", max_records)
                .partitionBy(*PARTITION_COLUMNS).parquet(f"{self.root}/data/commit={commit}")
            )
        got = seen.get
        return int(got.get("rows") or 0), {(k // 100, k % 100) for k in got.get("months") or []}

    def publish(self, commit: str, written: set[Month], replaced: Iterable[Month] | None, base: Version) -> Version:
        """Second step: the manifest. ``replaced`` months that were not written are empty from
        now on; None replaces the whole table."""
        kept = {} if replaced is None else {ym: c for ym, c in base.months.items() if ym not in set(replaced)}
        months = {**kept, **{ym: commit for ym in written}}
        number = base.number + 1
        row = [(number, commit, [(y, m, c) for (y, m), c in sorted(months.items())])]
        if exists(self.spark, self._manifest(number)):
            if number in self.versions():
                raise StaleVersion(f"version {number} of {self.root} is already written")
            p, fs = _path(self.spark, self._manifest(number))
            fs.delete(p, True)  # what a writer left that died before its row was in place
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("error").parquet(self._manifest(number))
        return Version(number, commit, months)

    def commit(self, rows: DataFrame, months: Iterable[Month] | None, rebalance: bool = True) -> tuple[int, list[Month], list[Month]]:
        """Replace ``months`` (None: the whole table) by ``rows`` in one step; (rows, months
        written, months emptied). A row of another month fails before anything is visible."""
        base, commit = self.version(), uuid.uuid4().hex[:12]
        listed = None if months is None else sorted({(int(y), int(m)) for y, m in months})
        if listed is not None:
            rows = only_months(rows, listed)
        count, written = self.stage(rows, commit, rebalance)
        self.publish(commit, written, listed, base)
        return count, sorted(written), sorted((set(base.months) if listed is None else set(listed)) - written)

    def vacuum(self, keep_versions: int = 2) -> list[str]:
        """Delete older manifests and the folders that none of the kept ones names."""
        known = self.versions()
        kept, old = known[-keep_versions:], known[:-keep_versions]
        named = {c for n in kept for c in self.version(n).months.values()}
        gone = [c for c in (n.split("=")[1] for n in _children(self.spark, f"{self.root}/data")) if c not in named]
        for n in old:
            p, fs = _path(self.spark, self._manifest(n))
            fs.delete(p, True)
        for c in gone:
            p, fs = _path(self.spark, f"{self.root}/data/commit={c}")
            fs.delete(p, True)
        return gone
