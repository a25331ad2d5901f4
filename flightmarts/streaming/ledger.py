"""Incremental lake -> raw-table load with a file ledger (K6).

A file-source stream over the lake with a checkpoint remembers which files
were already loaded: a plain re-run processes nothing, and a month that was
re-transformed (new file names) is picked up again. Each micro-batch reloads
the months it touches *whole*: it re-reads those partitions from the lake and
overwrites them in the target, so a month split across two batches is never
reduced to the second batch's rows, and replays are idempotent. A month whose files
come in several batches of one run is reloaded with the first of them only.

A month that became empty brings no rows into any batch. So after the stream
the months of the target are compared with those of the lake, and months that the
lake no longer holds are emptied.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from flightmarts.schema import FLIGHT_SCHEMA, VARCHAR_LENGTHS
from flightmarts.sinks.lake import load_months, read_raw_table
from flightmarts.sources.lake import read_lake


def lake_stream(spark: SparkSession, lake_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of the partitioned lake (explicit schema, year/month from the path)."""
    reader = spark.readStream.schema(FLIGHT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(lake_root)


def incremental_load(
    spark: SparkSession,
    lake_root: str,
    target_root: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    lengths: dict[str, int] | None = VARCHAR_LENGTHS,
) -> int:
    """Load every lake file not yet in the ledger, then stop (``availableNow``).

    Returns the number of micro-batches that carried data, plus one if months had
    to be emptied.
    """
    batches, loaded = [], set()

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # distinct months of the batch: bounded by the months in the lake
        months = [(r["year"], r["month"]) for r in batch.select("year", "month").distinct().collect()]
        if not months:
            return
        batches.append(batch_id)
        # the run's files were all listed before its first batch, so a month that an earlier
        # batch reloaded whole holds what this batch brings of it
        new = [ym for ym in months if ym not in loaded]
        if new:
            load_months(read_lake(spark, lake_root, new), target_root, new, lengths)
            loaded.update(new)

    query = (
        lake_stream(spark, lake_root, max_files_per_trigger)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load_batch)
        .start()
    )
    query.awaitTermination()
    stale = stale_months(spark, lake_root, target_root)
    if stale:
        load_months(read_lake(spark, lake_root, stale), target_root, stale, lengths)
    return len(batches) + bool(stale)


def stale_months(spark: SparkSession, lake_root: str, target_root: str) -> list[tuple[int, int]]:
    """Months with rows in the target and none in the lake (a list of months)."""
    try:
        target = read_raw_table(spark, target_root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []  # nothing was ever loaded
    months = target.select("year", "month").distinct()
    left = months.join(read_lake(spark, lake_root).select("year", "month").distinct(), ["year", "month"], "left_anti")
    return sorted((r["year"], r["month"]) for r in left.collect())
