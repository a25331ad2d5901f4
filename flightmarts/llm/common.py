"""Helpers shared by the corpus operators: reading, scratch tables, Arrow batches."""

from __future__ import annotations

import pickle
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flightmarts.config import scratch_path

# Text of one numpy pass; a longer text is one pass of its own.
CHUNK_BYTES = 1 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="flightmarts-py-")) / "flightmarts.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, so a
    lost executor costs one re-read and non-deterministic plans run once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], object], order: list[str]):
    """Fit a model on a bounded sample inside one task, so that neither the sample nor the
    training arrays weigh on the driver; None if the sample is empty."""
    ship(sample.sparkSession)

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        made = pickle.dumps(fit(pa.Table.from_batches(parts))) if parts else None
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["model"])

    rows = sample.coalesce(1).sortWithinPartitions(*order).mapInArrow(run, "model binary").collect()
    made = [bytes(r["model"]) for r in rows if r["model"] is not None]
    return pickle.loads(made[0]) if made else None


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, row offsets); a null row is empty."""
    filled = pc.fill_null(column, "") if column.null_count else column
    arr = filled.cast(pa.large_binary())
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def map_texts(
    df: DataFrame,
    text: str,
    fn: Callable[[pa.Array], dict[str, pa.Array]],
    fields: T.StructType,
    keep: list[str],
) -> DataFrame:
    """``keep`` columns plus the columns that ``fn`` derives from the text column.

    ``fn`` gets a slice of the texts and returns one array per field. A derived
    column replaces a kept one of the same name.
    """
    ship(df.sparkSession)
    keep = [c for c in keep if c not in fields.names]
    schema = T.StructType([df.schema[c] for c in keep] + list(fields))
    source = text if text in keep else "__text"

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, source):
                made = fn(part.column(source))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [made[f.name] for f in fields],
                    names=keep + fields.names,
                )

    cols = [df[c] for c in keep] + ([] if text in keep else [df[text].alias("__text")])
    return df.select(*cols).mapInArrow(run, schema)
