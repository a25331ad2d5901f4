"""Ranked lexical search by dense blocked matrix products.

Terms are the maximal runs of ASCII letters and digits and everything beyond ASCII, with
ASCII letters lower-cased. An item's score of a document sums, over the item's terms with
repeats, w * ((10**9 * tf) div (1000 * tf + 12 * m)): w = floor(1000 ln((2N + 2) / (2df + 1))),
m = 75 + (25 n N) div L, for N documents with any term, L terms in all of them, n terms in
the document, tf of them this one, and df documents with it.

The items' vocabulary is broadcast as sorted hashes; one scan reduces every document to its
length and the counts of vocabulary terms, a small table from which N, L and df are summed.
Then tiles meet: ``ITEM_TILE`` items times the compact vocabulary that they use, times that
vocabulary's impacts in ``DOC_TILE`` documents, as float64 products. Impacts stay below
10**6, and an item's weights are split into slabs of at most 2**53 / 10**6, so every partial
sum is a whole number below 2**53 and exact; slabs are added as 64-bit integers. Each tile
keeps its k best per item (a stable sort over columns in order of doc_id, so a tie never
loses the smaller id), each task its k best over tiles, and a window ranks what tasks leave.

Items are taken in waves of about ``WAVE_BYTES`` of text, each of which is all that the
driver holds and broadcasts, however many items there are.

Defined results: null texts have no terms; items without known terms have no rows; rows of
one item_id and text are one item, rows of one item_id with other texts are further items of
that id; documents of one doc_id are ranked one by one; null doc_ids rank behind others of
their score; extra columns are ignored; empty tables give no rows. Terms are told apart by
64 bits of hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import flat_bytes, materialize, ship, text_chunks
from .textscan import ALNUM, Words

TOP = 20
ITEM_TILE = 256
DOC_TILE = 512
WAVE_BYTES = 1 << 20
MAX_IMPACT = 10**6  # a term's impact in a document is smaller
SLAB = 2**53 // MAX_IMPACT  # an item's weight in one product, at most


def item_terms(texts: list[str | None]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(sorted hashes of all terms, per text its (places there, repeats))."""
    words = Words(*flat_bytes(pa.array(texts, pa.string())), ALNUM)
    vocabulary = np.unique(words.hash)
    each = []
    for i in range(len(texts)):
        own, times = np.unique(words.hash[words.first[i] : words.first[i + 1]], return_counts=True)
        each.append((np.searchsorted(vocabulary, own), times))
    return vocabulary, each


def postings(docs: DataFrame, vocabulary: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) per document: its terms in all, and those of the vocabulary."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for batch in batches:
            for part in text_chunks(batch, "t"):
                words = Words(*flat_bytes(part.column("t")), ALNUM)
                at = np.minimum(np.searchsorted(known, words.hash), max(0, len(known) - 1))
                hit = np.flatnonzero(known[at] == words.hash) if len(known) else np.zeros(0, np.int64)
                doc = np.searchsorted(words.first, hit, side="right") - 1
                keys, times = np.unique(doc * max(1, len(known)) + at[hit], return_counts=True)
                ends = np.concatenate([[0], np.cumsum(np.bincount(keys // max(1, len(known)), minlength=part.num_rows))])
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(words.count, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(keys % max(1, len(known)), pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                    names=["id", "n", "terms", "tfs"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def slabs(weights: np.ndarray, limit: int) -> list[np.ndarray]:
    """Matrices that add up to ``weights`` (rows are items), no row of which sums up to more than ``limit``."""
    left, out = weights.copy(), []
    while left.any():
        before = np.cumsum(left, axis=1) - left
        take = np.minimum(left, np.maximum(0, limit - before))
        out.append(take)
        left = left - take
    return out


class ItemTile:
    """Some items as a dense matrix over the compact vocabulary that they use."""

    def __init__(self, rows: np.ndarray, terms: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, limit: int):
        self.rows = rows
        self.vocabulary = np.unique(np.concatenate([terms[r][0] for r in rows])) if len(rows) else np.zeros(0, np.int64)
        dense = np.zeros((len(rows), len(self.vocabulary)), np.int64)
        for i, r in enumerate(rows):
            own, times = terms[r]
            dense[i, np.searchsorted(self.vocabulary, own)] = times * weight[own]
        self.slabs = [s.astype(np.float64) for s in slabs(dense, limit)]

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Items times documents, whole numbers."""
        place = np.minimum(np.searchsorted(self.vocabulary, term), max(0, len(self.vocabulary) - 1))
        on = self.vocabulary[place] == term if len(self.vocabulary) else np.zeros(len(term), bool)
        used, column = np.unique(place[on], return_inverse=True)
        tile = np.zeros((len(used), n_docs))
        tile[column, doc[on]] = impact[on]
        total = np.zeros((len(self.rows), n_docs), np.int64)
        for slab in self.slabs:
            total += (slab[:, used] @ tile).astype(np.int64)
        return total


def best(scores: np.ndarray, ids: np.ndarray, absent: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best columns of every row: by falling score, present ids first, by rising id."""
    order = np.lexsort((ids, absent, -scores), axis=1)[:, :k]
    return tuple(np.take_along_axis(v, order, axis=1) for v in (scores, ids, absent))


def _search_wave(docs: DataFrame, keys: list, texts: list, k: int, doc_id: str, text: str, limit: int) -> DataFrame:
    """(item, id, score): the candidates of one wave; ``item`` is a place in ``keys``."""
    spark = docs.sparkSession
    vocabulary, terms = item_terms(texts)
    found = materialize(postings(docs, vocabulary, doc_id, text), "search-postings")
    n_docs, n_terms = (int(v or 0) for v in found.agg(F.count_if(F.col("n") > 0), F.sum("n")).first())
    df = np.zeros(len(vocabulary))
    for row in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term of the wave
        df[row["t"]] = row["count"]
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    shared = spark.sparkContext.broadcast((terms, weight))

    def run(batches):
        terms, weight = shared.value
        tiles = [ItemTile(np.arange(i, min(i + ITEM_TILE, len(terms))), terms, weight, limit) for i in range(0, len(terms), ITEM_TILE)]
        top = None
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(at, DOC_TILE)
                none = np.asarray(part.column("id").is_null())
                ids = np.asarray(part.column("id").fill_null(0)).astype(np.int64)
                n = np.asarray(part.column("n"))
                doc = np.repeat(np.arange(part.num_rows), np.asarray(part.column("terms").value_lengths()))
                term, tf = (np.asarray(part.column(c).flatten()).astype(np.int64) for c in ("terms", "tfs"))
                m = 75 + (25 * n * n_docs) // max(1, n_terms)
                impact = (10**9 * tf) // (1000 * tf + 12 * m[doc])
                scores = np.concatenate([t.scores(doc, term, impact, part.num_rows) for t in tiles])
                own = best(scores, np.broadcast_to(ids, scores.shape), np.broadcast_to(none, scores.shape), k)
                top = own if top is None else best(*(np.concatenate(pair, axis=1) for pair in zip(top, own)), k)
        if top is not None:
            scores, ids, absent = top
            item, place = np.nonzero(scores > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(ids[item, place], pa.int64(), mask=absent[item, place]), pa.array(scores[item, place], pa.int64())],
                names=["item", "id", "score"],
            )

    return found.mapInArrow(run, "item int, id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", wave_bytes: int = WAVE_BYTES, limit: int = SLAB,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest scores above 0 for
    every item, equal scores by rising doc_id."""
    spark = docs.sparkSession
    ship(spark)
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("t")).distinct()
    size = wanted.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    waves = 1 + size // wave_bytes
    wanted = wanted.withColumn("wave", F.pmod(F.xxhash64("item_id", "t"), F.lit(waves)))
    kind = items.schema[item_id].dataType
    out = None
    for wave in range(waves):
        rows = wanted.where(F.col("wave") == wave).orderBy("item_id", "t").collect()  # about wave_bytes of text
        if not rows:
            continue
        found = _search_wave(docs, [r["item_id"] for r in rows], [r["t"] for r in rows], k, doc_id, text, limit)
        # item numbers run on from wave to wave, so that rows of one id and other texts stay apart
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id " + kind.simpleString())
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return out
