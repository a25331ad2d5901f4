"""``format("flight_push")``: the export as a batch sink.

Tasks write request bodies of at most 10,000 rows each, as JSON lines with NULL fields kept,
into a folder of this push. ``commit`` writes the push's record: the requests that the
successful task attempts reported and the rows in them; the record is what makes the
push the table's content (replace-all), and readers follow it. A repeated task leaves requests
that no report names, so nothing is doubled; a failed push leaves the earlier one in place, and what
a task wrote after the push was given up goes with the next one. Executors need this package
(``--py-files``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from flightmarts.schema import ROWS_PER_REQUEST
from flightmarts.sinks.export import export_frame, export_schema
from flightmarts.files import delete_folder, listed, read_file, write_file


@dataclass
class Pushed(WriterCommitMessage):
    requests: list[tuple[str, int]] = field(default_factory=list)  # file name, rows


class PushWriter(DataSourceArrowWriter):
    def __init__(self, root: str, push: str, rows_per_request: int):
        self.root, self.push, self.limit = root.rstrip("/"), push, rows_per_request

    @property
    def folder(self) -> str:
        return f"{self.root}/push={self.push}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Pushed:
        context = TaskContext.get()
        attempt = f"{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex[:8]}"
        done, body = Pushed(), []

        def send():
            name = f"request-{attempt}-{len(done.requests):05d}.json"
            write_file(f"{self.folder}/{name}", "".join(json.dumps(r, ensure_ascii=False, separators=(",", ":")) + "\n" for r in body).encode())
            done.requests.append((name, len(body)))
            body.clear()

        for batch in iterator:
            for row in batch.to_pylist():
                body.append(row)
                if len(body) == self.limit:
                    send()
        if body:
            send()
        return done

    def commit(self, messages: list[Pushed | None]) -> None:
        requests = sorted(r for m in messages if m is not None for r in m.requests)
        record = {"push": self.push, "rows": sum(n for _, n in requests), "requests": [name for name, _ in requests]}
        write_file(f"{self.root}/_pushed.json", json.dumps(record).encode())
        for old in listed(self.root):
            if old.base_name.startswith("push=") and old.base_name != f"push={self.push}":
                delete_folder(f"{self.root}/{old.base_name}")

    def abort(self, messages: list[Pushed | None]) -> None:
        delete_folder(self.folder)


class FlightPush(DataSource):
    @classmethod
    def name(cls) -> str:
        return "flight_push"

    def writer(self, schema: StructType, overwrite: bool) -> PushWriter:
        if not overwrite:
            raise ValueError("a push replaces the table: use mode overwrite")
        return PushWriter(self.options["path"], uuid.uuid4().hex[:12], int(self.options.get("rowsPerRequest", ROWS_PER_REQUEST)))


def pushed(out_dir: str, table: str) -> dict | None:
    """The record of the last push of a table: push, rows, requests; None before the first."""
    found = read_file(f"{out_dir.rstrip('/')}/{table}/_pushed.json")
    return None if found is None else json.loads(found)


def push_export(marts: dict[str, DataFrame], out_dir: str) -> dict[str, int]:
    """Push every mart; rows per table (K12), read from the records of the pushes.

    One after another: a registered source is known to the calling thread's session only."""
    totals = {}
    for table, mart in marts.items():
        mart.sparkSession.dataSource.register(FlightPush)
        export_frame(mart, table).write.format("flight_push").mode("overwrite").save(f"{out_dir.rstrip('/')}/{table}")
        totals[table] = pushed(out_dir, table)["rows"]
    return totals


def read_push(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """The rows of the last push with the request that each came in."""
    record = pushed(out_dir, table)
    schema = export_schema(table)
    if record is None or not record["requests"]:
        return spark.createDataFrame([], schema).withColumn("request", F.lit(None).cast("string"))
    folder = f"{out_dir.rstrip('/')}/{table}/push={record['push']}"
    rows = spark.read.schema(schema).json([f"{folder}/{name}" for name in record["requests"]])
    return rows.withColumn("request", F.col("_metadata.file_name"))
