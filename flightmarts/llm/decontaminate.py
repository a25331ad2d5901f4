"""Benchmark decontamination: broadcast hash set of normalised test n-grams.

Words: ASCII letters lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.
A benchmark item's windows are its runs of ``window`` consecutive words; an item
with fewer words (but not none) is one window. Every training text is scanned
once: rolling window hashes are looked up in the sorted array of benchmark
hashes, and each hit is verified on the words themselves.

The window set is broadcast only while it holds at most ``MAX_WINDOWS`` windows,
counted before; beyond that the windows are joined through a shuffle instead
(``_join_hits``), with the same result.

Defined results: null and empty texts have no words and are clean; null
benchmark texts have no windows; windows of items without an id are hits like
others but name no item (n_items and items_sha256 leave them out); repeated rows are scanned one by one; an empty
benchmark hits nothing; a result column replaces an input column of its name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, map_texts, materialize, ship, text_chunks
from .textscan import ALNUM, Words

WINDOW = 10
MAX_WINDOWS = 2_000_000

_HIT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("hit_words", T.ArrayType(T.LongType())),
])


def benchmark_windows(bench: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (words, k, item_ids): the window text, its word count, its items as strings."""
    ship(bench.sparkSession)

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "t"):
                data, offs = flat_bytes(part.column("t"))
                words = Words(data, offs, ALNUM)
                ids, grams, sizes = [], [], []
                for doc, item in enumerate(part.column("i").to_pylist()):
                    k = min(window, int(words.count[doc]))
                    for at in range(words.first[doc], words.first[doc + 1] - k + 1 if k else words.first[doc]):
                        ids.append(item)
                        grams.append(words.text(at, k))
                        sizes.append(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(grams, pa.binary()), pa.array(sizes, pa.int32())],
                    names=["item", "words", "k"],
                )

    rows = bench.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))
    return (
        rows.mapInArrow(run, "item string, words binary, k int")
        .groupBy("words", "k").agg(F.collect_set("item").alias("item_ids"))  # null ids drop out here
    )


class WindowIndex:
    """Sorted window hashes by length, for lookups; the words decide each hit."""

    def __init__(self, windows: list[tuple[bytes, int, list[str]]]):
        self.by_k: dict[int, tuple[np.ndarray, dict[bytes, list[str]]]] = {}
        for k in sorted({w[1] for w in windows}):
            own = {bytes(w[0]): list(w[2]) for w in windows if w[1] == k}
            joined = b" ".join(own)
            words = Words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), ALNUM)
            hashes = np.unique(words.grams(k)[0][::k])  # windows stand every k words
            self.by_k[k] = hashes, own

    def scan(self, texts: pa.Array) -> dict[str, pa.Array]:
        data, offs = flat_bytes(texts)
        words = Words(data, offs, ALNUM)
        n_docs, n = len(offs) - 1, len(words.hash)
        cover = np.zeros(n + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        doc_of = np.repeat(np.arange(n_docs), words.count)
        for k, (hashes, own) in self.by_k.items():
            grams, ok = words.grams(k)
            if not len(grams):
                continue
            at = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
            for i in np.flatnonzero(ok & (hashes[at] == grams)):
                found = own.get(words.text(i, k))  # verify on the words
                if found is not None:
                    cover[i] += 1
                    cover[i + k] -= 1
                    items.setdefault(int(doc_of[i]), set()).update(found)
        hit = np.cumsum(cover[:n]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[words.first[1:]] - total[words.first[:-1]]
        where = [[] for _ in range(n_docs)]
        for i in np.flatnonzero(hit):
            where[doc_of[i]].append(int(i - words.first[doc_of[i]]))
        return {
            "n_words": pa.array(words.count, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "item_ids": pa.array([sorted(items.get(i, ())) for i in range(n_docs)], pa.list_(pa.string())),
            "hit_words": pa.array(where, pa.list_(pa.int64())),
        }


def find_contamination(
    docs: DataFrame, bench: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id",
    bench_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``keep`` columns plus n_words, n_hit, item_ids (sorted strings), hit_words
    (positions of the words inside benchmark windows)."""
    windows = benchmark_windows(bench, item_id, bench_text, window)
    rows = windows.limit(max_windows + 1).collect()  # the size check of the broadcast
    if len(rows) > max_windows:
        return _join_hits(docs, windows, keep, text)
    index = docs.sparkSession.sparkContext.broadcast(WindowIndex([tuple(r) for r in rows]))
    return map_texts(docs, text, lambda t: index.value.scan(t), _HIT, keep)


def _join_hits(docs: DataFrame, windows: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The same result for a window set too large to broadcast: all document
    windows are joined to the benchmark's by their words."""
    sizes = [r["k"] for r in windows.select("k").distinct().collect()]  # at most `window` values
    # the row number has to be the same wherever it is read, so it is written once
    rows = materialize(docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col(text).alias("t"))
                       .withColumn("row", F.monotonically_increasing_id()), "decontam-rows")

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "t"):
                data, offs = flat_bytes(part.column("t"))
                words = Words(data, offs, ALNUM)
                ids = np.repeat(np.asarray(part.column("row")), words.count)
                local = np.arange(len(ids)) - np.repeat(words.first[:-1], words.count)
                for k in sizes:
                    at = np.flatnonzero(words.grams(k)[1])
                    for lo in range(0, len(at), 20_000):
                        p = at[lo : lo + 20_000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[p]), pa.array(local[p]), pa.array(np.full(len(p), k, np.int32)),
                             pa.array([words.text(i, k) for i in p], pa.binary())],
                            names=["row", "at", "k", "words"],
                        )

    found = rows.select("row", "t").mapInArrow(run, "row long, at long, k int, words binary").join(windows, ["words", "k"])
    hit = found.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.expr("sequence(at, at + k - 1)"))))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
    )
    counted = map_texts(rows, "t", lambda t: {"n_words": pa.array(Words(*flat_bytes(t), ALNUM).count, pa.int64())},
                        T.StructType([T.StructField("n_words", T.LongType())]),
                        [c for c in rows.columns if c != "t"])
    none_s, none_l = F.expr("cast(array() as array<string>)"), F.expr("cast(array() as array<bigint>)")
    return counted.join(hit, "row", "left").select(
        *[F.col(f"k_{c}").alias(c) for c in keep if c not in _HIT.names], "n_words",
        F.size(F.coalesce("hit_words", none_l)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", none_s).alias("item_ids"), F.coalesce("hit_words", none_l).alias("hit_words"),
    )


def remove_spans(texts: list[str | None], hits: list[list[int]]) -> list[str | None]:
    """Texts without the words at the given positions (the rest stays as it was)."""
    out = []
    for text, hit in zip(texts, hits, strict=True):
        if not hit:
            out.append(text)
            continue
        raw = text.encode()
        words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM)
        keep = np.ones(len(raw), dtype=bool)
        for i in hit:
            keep[words.start[i] : words.end[i]] = False
        out.append(np.frombuffer(raw, np.uint8)[keep].tobytes().decode())
    return out


def decontaminate(docs: DataFrame, bench: DataFrame, mode: str = "documents", text: str = "text", **options) -> DataFrame:
    """Documents without benchmark passages, with the columns of ``docs``: whole
    documents go (mode ``documents``) or only the words of the hits (``spans``)."""
    names = docs.columns
    own = docs.select(F.struct(*names).alias("doc"), F.col(text).alias("scanned"))
    found = find_contamination(own, bench, ["doc", "scanned"], text="scanned", **options)
    if mode == "documents":
        return found.where("n_hit = 0").select("doc.*")
    cut = F.pandas_udf(lambda t, h: pd.Series(remove_spans(list(t), [list(x) for x in h])), "string")
    clean = F.when(F.col("n_hit") > 0, cut("scanned", "hit_words")).otherwise(F.col("scanned"))
    return found.withColumn("scanned", clean).select(
        *[F.col("scanned").alias(c) if c == text else F.col("doc")[c].alias(c) for c in names]
    )


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The digest columns of a scan."""
    return found.select(
        doc_id, "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
