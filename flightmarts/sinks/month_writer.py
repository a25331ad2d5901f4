"""``format("flight_months")``: a batch writer that replaces the months it is told to (K5).

``df.write.format("flight_months").option("months", "2001-08,1995-01").mode("append").save(root)``
replaces those months of the committed table at ``root`` (``flightmarts.committed``), and
``mode("overwrite")`` without months the whole table. Every task writes one Parquet file per
month into a folder of its own attempt and reports it; a row outside the months raises. If
all tasks end, ``commit`` points a new manifest at the reported attempts' files. If
any fails, ``abort`` removes what was staged, and the table is as it was. The driver alone makes
the folder of staged files, so a task that outlives the abort ends with an error and leaves nothing
(where a store makes a file's folders with the file, such a task may leave files nobody reads). An
attempt that was repeated or ran twice is in nobody's report, so its rows do not count. Executors
need this package (``--py-files``).
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from flightmarts.functions.months import year_month
from flightmarts.schema import PARTITION_COLUMNS
from flightmarts.files import delete_folder, listed, open_fs, read_file, write_file

ROWS_PER_GROUP = 1 << 17


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    rows: dict[tuple[int, int], int]  # by month


class MonthWriter(DataSourceArrowWriter):
    def __init__(self, root: str, months: list[tuple[int, int]] | None, commit: str):
        self.root, self.months, self.commit_id = root.rstrip("/"), months, commit
        store, base = open_fs(self.staged)
        store.create_dir(base, recursive=True)

    @property
    def staged(self) -> str:
        return f"{self.root}/data/staged={self.commit_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        attempt = f"{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex[:8]}"
        open_files: dict[tuple[int, int], tuple] = {}
        rows: dict[tuple[int, int], int] = {}
        store, base = open_fs(f"{self.staged}/{attempt}")
        for batch in iterator:
            keys = [batch.column(c) for c in PARTITION_COLUMNS]
            for y, m in sorted({(y, m) for y, m in zip(*(k.to_pylist() for k in keys))}, key=str):
                if y is None or m is None or (self.months is not None and (y, m) not in self.months):
                    raise ValueError(f"row outside the months to replace: {y}-{m}")
                own = batch.filter(pc.and_(pc.equal(keys[0], y), pc.equal(keys[1], m))).drop_columns(PARTITION_COLUMNS)
                if (y, m) not in open_files:
                    for folder in (base, f"{base}/year={y}", f"{base}/year={y}/month={m}"):
                        store.create_dir(folder, recursive=False)  # an error once the write was given up
                    out = store.open_output_stream(f"{base}/year={y}/month={m}/part-{attempt}.snappy.parquet")
                    open_files[y, m] = (out, pq.ParquetWriter(out, own.schema, compression="snappy"))
                open_files[y, m][1].write_batch(own, row_group_size=ROWS_PER_GROUP)
                rows[y, m] = rows.get((y, m), 0) + own.num_rows
        for out, parquet in open_files.values():
            parquet.close()
            out.close()
        return Written(attempt, rows)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        manifests = sorted(int(i.base_name.split("=")[1]) for i in listed(f"{self.root}/_manifest") if i.base_name.startswith("version="))
        manifests = [n for n in manifests if read_file(f"{self.root}/_manifest/version={n}/_SUCCESS") is not None]
        number = (manifests[-1] if manifests else 0) + 1
        kept = []
        if manifests and self.months is not None:
            folder = f"{self.root}/_manifest/version={manifests[-1]}"
            rows = [r for i in listed(folder) if i.base_name.endswith(".parquet") for r in pq.read_table(io.BytesIO(read_file(f"{folder}/{i.base_name}"))).to_pylist()]
            kept = [e for r in rows for e in r["months"] if (e["year"], e["month"]) not in self.months]
        # the reported files go into the commit's folder; what no report names stays behind
        for message in done:
            for y, m in message.rows:
                store, at = open_fs(f"{self.staged}/{message.attempt}/year={y}/month={m}/part-{message.attempt}.snappy.parquet")
                to = open_fs(f"{self.root}/data/commit={self.commit_id}/year={y}/month={m}")[1]
                store.create_dir(to, recursive=True)
                store.move(at, f"{to}/part-{message.attempt}.snappy.parquet")
        made = sorted({ym for message in done for ym in message.rows})
        entries = kept + [{"year": y, "month": m, "commit": self.commit_id} for y, m in made]
        entry = pa.struct([("year", pa.int32()), ("month", pa.int32()), ("commit", pa.string())])
        schema = pa.schema([("version", pa.int64()), ("commit", pa.string()), ("months", pa.list_(entry))])
        data = io.BytesIO()
        pq.write_table(pa.Table.from_pylist([{"version": number, "commit": self.commit_id, "months": entries}], schema=schema), data)
        write_file(f"{self.root}/_manifest/version={number}/part-{self.commit_id}.parquet", data.getvalue())
        write_file(f"{self.root}/_manifest/version={number}/_SUCCESS", b"")  # the version counts from here on
        delete_folder(self.staged)

    def abort(self, messages: list[Written | None]) -> None:
        delete_folder(self.staged)


class FlightMonths(DataSource):
    @classmethod
    def name(cls) -> str:
        return "flight_months"

    def writer(self, schema: StructType, overwrite: bool) -> MonthWriter:
        named = self.options.get("months")
        if named is None and not overwrite:
            raise ValueError("name the months to replace, or overwrite the whole table")
        if named is not None and overwrite:
            raise ValueError("mode append replaces the named months; overwrite replaces the whole table")
        missing = [c for c in PARTITION_COLUMNS if c not in schema.names]
        if missing:
            raise ValueError(f"the rows have no column {missing}")
        months = None if named is None else [year_month(m.strip()) for m in named.split(",") if m.strip()]
        return MonthWriter(self.options["path"], months, uuid.uuid4().hex[:12])
