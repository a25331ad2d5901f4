"""Load ledger by file fingerprints (K6, second form).

The ledger is a table of every file loaded, with its length and modification time, in
batches. A load lists the lake, anti-joins the listing with the ledger's present state and
the other way round: months with a file that is new, revised under its old name, or gone are
reloaded whole, and their files enter the ledger as the next batch. The batch is written last,
so a load that died is simply done again. A plain re-run finds nothing.

Unlike the file stream of ``ledger``, which knows files by name only, this sees a revision
that keeps the name. Listing and ledger are one narrow row per file; they are joined as tables,
and only the months to reload reach the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightmarts.schema import VARCHAR_LENGTHS
from flightmarts.sinks.lake import load_months
from flightmarts.sources.lake import read_lake

_LEDGER = "path string, year int, month int, length long, modified timestamp, present boolean, batch long"
_PRINT = ["path", "length", "modified"]


def listing(spark: SparkSession, lake_root: str) -> DataFrame:
    """One row per Parquet file: path, year, month, length, modified; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(lake_root)
    return files.select(
        "path",
        F.regexp_extract("path", r"/year=([0-9]+)/", 1).cast("int").alias("year"),
        F.regexp_extract("path", r"/month=([0-9]+)/", 1).cast("int").alias("month"),
        "length", F.col("modificationTime").alias("modified"),
    )


def ledger(spark: SparkSession, ledger_root: str) -> DataFrame:
    """All batches of the ledger; empty before the first."""
    try:
        return spark.read.schema(_LEDGER).parquet(f"{ledger_root.rstrip('/')}/entries")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def loaded(entries: DataFrame) -> DataFrame:
    """The files that count as loaded: of each path the latest entry, if the file was there."""
    latest = Window.partitionBy("path").orderBy(F.desc("batch"))
    return entries.withColumn("nth", F.row_number().over(latest)).where("nth = 1 and present").drop("nth")


def changed_files(files: DataFrame, known: DataFrame) -> DataFrame:
    """Entries to make: files whose fingerprint is not known, and known paths that are gone."""
    new = files.join(known.select(*_PRINT), _PRINT, "left_anti").withColumn("present", F.lit(True))
    gone = known.join(files.select("path"), "path", "left_anti").withColumn("present", F.lit(False))
    columns = ["path", "year", "month", "length", "modified", "present"]
    return new.select(*columns).unionByName(gone.select(*columns))


def load_changed(
    spark: SparkSession, lake_root: str, target_root: str, ledger_root: str, lengths: dict[str, int] | None = VARCHAR_LENGTHS
) -> list[tuple[int, int]]:
    """Reload the months whose files changed since the last load; returns those months."""
    root = ledger_root.rstrip("/")
    entries = ledger(spark, root)
    batch = int(entries.agg(F.max("batch")).first()[0] or 0) + 1
    # the listing is fixed before the load: a file that changes meanwhile enters the ledger
    # with its old print and is seen by the next load
    pending = f"{root}/pending/batch={batch}"
    changed_files(listing(spark, lake_root), loaded(entries)).write.mode("overwrite").parquet(pending)
    found = spark.read.schema(", ".join(c for c in _LEDGER.split(", ") if not c.startswith("batch"))).parquet(pending)
    months = sorted((r["year"], r["month"]) for r in found.select("year", "month").distinct().collect())
    if months:
        load_months(read_lake(spark, lake_root, months), target_root, months, lengths)
        found.write.mode("overwrite").parquet(f"{root}/entries/batch={batch}")
    return months
