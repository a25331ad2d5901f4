"""Token counts by source, language and tokenizer version, kept up to date by deltas.

``TokenRollup`` is a folder of signed batches. A batch inserts documents, deletes
them, or revises their counts; it is turned into signed rows against the documents'
present state, and those are added up per (source, lang, version) before
they are written. The totals are the sum over all committed batches, so they
are additive and never rebuilt from the documents.

A batch is written as partition folders that a retry overwrites, and it counts only
once its marker is written at the end. Applying a committed batch again does nothing,
and a batch that died half-way has no effect until it is applied again.

Hot sources: all sums are partial aggregates. The state is joined by document only for the
ids of the batch.

Defined results: null source and language are groups of their own; null text has no
tokens; rows without an id are counted but can't be deleted or revised; of rows that share
id and version in a batch the one with the most tokens counts; inserting a document again
replaces its count; deleting or revising an unknown one does nothing; empty batches commit.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, map_texts, materialize, ship
from .textscan import NOT_SPACE, Words

GROUP = ["source", "lang", "version"]
_STATE = "doc_id long, version string, source string, lang string, n_docs long, n_tokens long"
_TOTAL = "source string, lang string, version string, n_docs long, n_tokens long"


class TokenRollup:
    """Totals under ``root`` (a folder that all executors share)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- reading ------------------------------------------------------------------

    def committed(self) -> list[str]:
        """Batches with a marker, one short string each."""
        return sorted(r["id"] for r in self._read("commits", "id string").collect())

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _batches(self, name: str, schema: str) -> DataFrame:
        """Rows of all committed batches."""
        paths = [f"{self.root}/{name}/{b}" for b in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def state(self) -> DataFrame:
        """The documents counted now: one row per id and version."""
        rows = self._batches("documents", _STATE)
        summed = rows.groupBy("doc_id", *GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs != 0")

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens over all committed batches."""
        rows = self._batches("totals", _TOTAL)
        return rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs != 0")

    # -- writing ------------------------------------------------------------------

    def apply(self, batch: str, inserts: DataFrame | None = None, deletes: DataFrame | None = None, revisions: DataFrame | None = None) -> bool:
        """Commit a batch; False if it already is.

        ``inserts``: doc_id, version, source, lang, n_tokens. ``deletes``: doc_id.
        ``revisions``: doc_id, version, n_tokens. A document may be in one of them only.
        """
        if batch in self.committed():
            return False
        state = self.state()
        signed = []
        if inserts is not None:
            # written once: what follows reads it three times, and counting is the costly part
            rows = materialize(inserts.select("doc_id", "version", "source", "lang", "n_tokens"), "token-inserts")
            known = rows.where("doc_id is not null").groupBy("doc_id", "version").agg(
                F.max(F.struct("n_tokens", "source", "lang")).alias("r")
            ).select("doc_id", "version", "r.source", "r.lang", F.lit(1).cast("long").alias("n_docs"), "r.n_tokens")
            loose = rows.where("doc_id is null").select("doc_id", "version", "source", "lang", F.lit(1).cast("long").alias("n_docs"), "n_tokens")
            signed += [known, loose, self._negative(state.join(known.select("doc_id", "version"), ["doc_id", "version"], "left_semi"))]
        if deletes is not None:
            signed.append(self._negative(state.join(deletes.select("doc_id").distinct(), "doc_id", "left_semi")))
        if revisions is not None:
            new = materialize(revisions.groupBy("doc_id", "version").agg(F.max("n_tokens").alias("new")), "token-revisions")
            signed.append(state.join(new, ["doc_id", "version"]).where("new != n_tokens").select(
                "doc_id", "version", "source", "lang", F.lit(0).cast("long").alias("n_docs"), (F.col("new") - F.col("n_tokens")).alias("n_tokens")
            ))
        rows = self.spark.createDataFrame([], _STATE)
        for part in signed:
            rows = rows.unionByName(part.select(*[f.name for f in T.StructType.fromDDL(_STATE)]))
        path = f"{self.root}/documents/{batch}"
        rows.write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(_STATE).parquet(path)
        written.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.mode("overwrite").parquet(f"{self.root}/totals/{batch}")
        # the marker comes last, in a folder of its own, so a retry can't double it
        self.spark.range(1).select(F.lit(batch).alias("id")).write.mode("overwrite").parquet(f"{self.root}/commits/batch={batch}")
        return True

    @staticmethod
    def _negative(state: DataFrame) -> DataFrame:
        return state.withColumns({c: -F.col(c) for c in ("n_docs", "n_tokens")})


# -- counting ---------------------------------------------------------------------


def count_words(texts: pa.Array) -> list[int]:
    """Words between ASCII white space."""
    return Words(*flat_bytes(texts), NOT_SPACE).count.tolist()


class BytePairCounter:
    """Counts tokens of a byte-pair vocabulary given as ranks; the encoder is
    built once per worker process."""

    _built: dict[str, object] = {}

    def __init__(self, name: str, ranks: dict[bytes, int], pattern: str):
        self.name, self.ranks, self.pattern = name, ranks, pattern

    def __call__(self, texts: pa.Array) -> list[int]:
        import tiktoken

        if self.name not in self._built:
            self._built[self.name] = tiktoken.Encoding(self.name, pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        encoder = self._built[self.name]
        return [len(encoder.encode_ordinary(t)) if t else 0 for t in texts.to_pylist()]


def count_tokens(docs: DataFrame, version: str, counter: Callable[[pa.Array], list[int]], text: str = "text") -> DataFrame:
    """Rows for ``apply``: doc_id, version, source, lang, n_tokens."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(counter)  # a vocabulary has a fixed size
    field = T.StructType([T.StructField("n_tokens", T.LongType())])
    counted = map_texts(docs, text, lambda t: {"n_tokens": pa.array(shared.value(t), pa.int64())}, field, ["doc_id", "source", "lang"])
    return counted.withColumn("version", F.lit(version))


def without_repeated_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that a repeated line shrinks, each line kept where it comes first."""
    lines = F.split(text, "\n", -1)
    return docs.withColumn("__once", F.array_join(F.array_distinct(lines), "\n")).where(F.col("__once") != F.col(text)).withColumn(text, F.col("__once")).drop("__once")
