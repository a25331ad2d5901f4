"""Embedding near-dedup with product quantisation and an exact rerank.

Coarse centroids cut the unit sphere into inverted lists; every vector is stored in the
list of its nearest centroid with ``SUBSPACES`` byte codes of its residual and the length of
what the codes miss. Queries look their distances up in asymmetric tables.

No link is lost, by two bounds. A vector within distance d of the query lies in another
list only if the query is within d of the plane between both centroids, so those lists
are probed. A table distance minus the stored error is a lower bound of the true
distance, so a candidate is dropped only if that exceeds d. All candidates are
reranked by the cosine of the full vectors in double precision.

Each pair is met once, in the lower-numbered of its two lists. Neighbouring lists make up
blocks of at most about ``INDEX_BLOCK`` classes, and a list of more is dealt into several, so
a unit of work, two blocks, has a bounded size whatever list or vector is common. Units go in
rounds: a round sends a class to at most ``2 * ROUND`` of them, and its shuffle files are gone
before the next one, so the disk in use follows the classes and not their pairs. Equal vectors
collapse to one class first and count by weight; a unit returns counts and a spanning forest
of its links, never the pairs.

Each vector length has an index of its own. Its centroids and codebooks are fitted on
``SAMPLE`` classes of that length, those of the smallest hash of their id, and have a fixed
size; every vector is indexed.

Defined results: vectors that are null, zero, or hold null or non-finite components link
with nothing; vectors of different lengths don't link with one another; an empty table
gives no rows; extra columns are ignored; repeated rows are vectors of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmarts.jobs import released_shuffles

from .common import materialize, ship
from .graph import components

SAMPLE = 8_192
SUBSPACES = 16
CODES = 256
ROUNDS = 8
INDEX_BLOCK = 32_768  # classes of a block
BLOCKS = 12  # of an index, with which there is work for some cores, unless they were tiny
ROUND = 4  # distances between the numbers of two blocks that one round compares
QUERY_CHUNK = 512
ENTRY_CHUNK = 1_024
PAIRS = 1 << 20  # links that a unit holds before it counts them
SLACK = 2e-5  # of a squared table distance, which is summed in single precision


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = nearest(x, centers)
        for j in range(x.shape[1]):
            total = np.bincount(near, weights=x[:, j], minlength=k)
            count = np.bincount(near, minlength=k)
            centers[:, j] = np.where(count > 0, total / np.maximum(count, 1), centers[:, j])
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * x @ centers.T, axis=1)


@dataclass
class Index:
    """Centroids, and a codebook for each run of dimensions ``cuts[s]:cuts[s + 1]``."""

    centers: np.ndarray
    books: list[np.ndarray]
    cuts: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, lists: int) -> Index:
        centers = kmeans(x, min(lists, len(x)), 1)
        rest = x - centers[nearest(x, centers)]
        cuts = np.unique(np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int))
        books = [kmeans(rest[:, a:b], min(CODES, len(x)), 2) for a, b in zip(cuts[:-1], cuts[1:])]
        return cls(centers, books, cuts)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of the residual that the codes miss) of unit vectors."""
        home = nearest(x, self.centers)
        rest = x - self.centers[home]
        codes = np.stack([nearest(rest[:, a:b], book) for a, b, book in zip(self.cuts[:-1], self.cuts[1:], self.books)], axis=1)
        return home, codes.astype(np.uint8), np.linalg.norm(rest - self._spelled(codes), axis=1)

    def _spelled(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, s]] for s, book in enumerate(self.books)], axis=1)

    @cached_property
    def between(self) -> np.ndarray:
        """Distances of the centroids."""
        return np.stack([np.linalg.norm(self.centers - c, axis=1) for c in self.centers])

    def opened(self, x: np.ndarray, home: np.ndarray, lists: np.ndarray, radius: float) -> np.ndarray:
        """Which of ``lists``, up to the own one, can hold a vector within the radius; a row per query."""
        length = (self.centers**2).sum(axis=1)
        far = length[lists] - 2 * x @ self.centers[lists].T
        own = length[home] - 2 * np.einsum("ij,ij->i", x, self.centers[home])
        margin = (far - own[:, None]) / np.maximum(2 * self.between[np.ix_(home, lists)], 1e-12)
        return (lists == home[:, None]) | ((margin <= radius) & (lists < home[:, None]))

    def probes(self, x: np.ndarray, home: np.ndarray, radius: float) -> list[np.ndarray]:
        """The lists up to the own one that can hold a vector within the radius."""
        return [np.flatnonzero(row) for row in self.opened(x, home, np.arange(len(self.centers)), radius)]

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Inner products with the code words, a table per subspace with a row per code and a
        column per query; the same for all lists."""
        return [(book @ q[:, a:b].T).astype(np.float32) for a, b, book in zip(self.cuts[:-1], self.cuts[1:], self.books)]

    def lengths(self, home: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared lengths of what centroid and codes spell."""
        return ((self.centers[home] + self._spelled(codes)) ** 2).sum(axis=1).astype(np.float32)

    def asked(self, q: np.ndarray, home: int) -> np.ndarray:
        """The part of a squared table distance that depends on the query and the list alone."""
        return ((q**2).sum(axis=1) - 2 * q @ self.centers[home]).astype(np.float32)

    @staticmethod
    def squares(tables: list[np.ndarray], asked: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Squared table-lookup distances, a row per entry and a column per query."""
        total = tables[0][codes[:, 0]]
        for s in range(1, len(tables)):
            total += tables[s][codes[:, s]]
        total *= -2
        total += lengths[:, None]
        total += asked
        return total

    def lower_bounds(self, q: np.ndarray, home: int, codes: np.ndarray, error: np.ndarray) -> np.ndarray:
        """Table-lookup distances less the errors, a row per entry and a column per query."""
        total = self.squares(self.tables(q), self.asked(q, home), codes, self.lengths(np.full(len(codes), home), codes))
        return np.sqrt(np.maximum(total, 0)) - error[:, None].astype(np.float32)


class Links:
    """Links among some classes, numbered by ascending id: the weight linked to each, and its
    smallest class reachable. What it holds does not grow with the links."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.linked, self.root = weight, np.zeros(len(weight), np.int64), np.arange(len(weight))
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.pairs = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.waiting.append((a, b))
        self.pairs += len(a)
        if self.pairs >= PAIRS:
            self.fold()

    def fold(self) -> None:
        if not self.pairs:
            return
        a, b = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.pairs = [], 0
        for one, other in ((a, b), (b, a)):
            self.linked += np.bincount(one, weights=self.weight[other], minlength=len(self.weight)).astype(np.int64)
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, key (of the exact vector, null if it can't be linked), unit (its doubles,
    scaled to length one)."""
    ship(vectors.sparkSession)

    def run(batches):
        for batch in batches:
            keys, units = [], []
            for row in batch.column("e").to_pylist():
                x = np.array([np.nan if v is None else v for v in row] if row else [], dtype=np.float64) + 0.0  # no -0.0
                top = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                if top > 0:
                    unit = x / top  # keeps the squares finite
                    units.append((unit / np.linalg.norm(unit)).tobytes())
                    keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                else:
                    units.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(units, pa.binary())], names=["vec_id", "key", "unit"])

    source = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e"))
    return source.mapInArrow(run, "vec_id long, key binary, unit binary")


def _floats(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _linked(vectors: DataFrame, threshold: float, vec_id: str, embedding: str, sample: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The vectors with their classes' keys, the classes, the weight linked to each, the components."""
    spark = vectors.sparkSession
    rows = materialize(_classes(vectors, vec_id, embedding), "pq-rows")
    classes = materialize(
        rows.where("key is not null and vec_id is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit")),
        "pq-classes",
    )
    sizes = classes.groupBy(F.length("unit").alias("bytes")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("bytes").collect()
    units = None
    for size in sizes:  # vectors of different lengths never link, so each length has its index
        own, dim = classes.where(F.length("unit") == size["bytes"]), size["bytes"] // 8
        ids = own.select("rep").orderBy(F.xxhash64("rep"), "rep").limit(sample)  # narrow: every task offers as many
        picked = [bytes(r["unit"]) for r in own.join(F.broadcast(ids), "rep", "left_semi").orderBy("rep").select("unit").collect()]
        x = np.stack([np.frombuffer(p, np.float64) for p in picked])
        # lists grow with the square root of the classes as long as the sample can place them
        lists = min(int(size["n"] ** 0.5) + 1, max(1, len(x) // 8))
        index = spark.sparkContext.broadcast(Index.fit(x, lists))
        joined = _join_lists(own, index, dim, threshold)
        units = joined if units is None else units.unionByName(joined)
    links = spark.createDataFrame([], "rep long, links long")
    found = spark.createDataFrame([], "id long, component long")
    if units is not None:
        links = units.where("links > 0").groupBy("rep").agg(F.sum("links").alias("links"))
        found = components(units.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    return rows, classes, links, found


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding",
                    sample: int = SAMPLE) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id
    (the smallest id reachable), kept (vec_id = component_id)."""
    spark = vectors.sparkSession
    with released_shuffles(spark):
        rows, classes, links, found = _linked(vectors, threshold, vec_id, embedding, sample)
    by_class = (
        classes.select("key", "rep", "weight").join(links, "rep", "left").join(found.withColumnRenamed("id", "rep"), "rep", "left")
        .select("key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    return (
        rows.select("vec_id", "key").join(by_class, "key", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _join_lists(classes: DataFrame, index, dim: int, threshold: float) -> DataFrame:
    """rep, links (weight of the classes linked within a unit of work), root (a linked
    class of the smallest id there); several rows per rep."""
    spark = classes.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def place(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                home, codes, error = index.value.encode(_floats(part.column("unit"), dim))
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("weight"), part.column("unit"), pa.array(home.astype(np.int32)),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                    names=["rep", "weight", "unit", "home", "codes", "error"],
                )

    placed = materialize(classes.select("rep", "weight", "unit").mapInArrow(
        place, "rep long, weight long, unit binary, home int, codes binary, error double"), "pq-placed")
    sizes = placed.groupBy("home").agg(F.count(F.lit(1)).alias("n")).orderBy("home").collect()  # a row per list
    deal, blocks = _deal([(r["home"], r["n"]) for r in sizes])
    dealt = (
        placed.join(F.broadcast(spark.createDataFrame(deal, "home int, first int, parts int")), "home")
        .withColumn("block", F.expr("first + cast(pmod(xxhash64(rep), parts) as int)")).drop("first", "parts")
    )

    def compare(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lo, hi = (k.as_py() for k in key)
        rows = rows.sort_by("rep")
        block, home, rep, weight, error = (np.asarray(rows.column(c)) for c in ("block", "home", "rep", "weight", "error"))
        x = _floats(rows.column("unit"), dim)
        codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
        links, found = Links(weight), index.value
        entries, queries = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        lists = np.unique(home[entries])
        of_list = [entries[home[entries] == at] for at in lists]
        lengths = [found.lengths(home[e], codes[e]) for e in of_list]
        limits = [((radius + 1e-4 + error[e]) ** 2 + SLACK).astype(np.float32) for e in of_list]
        for at in range(0, len(queries), QUERY_CHUNK):
            q = queries[at : at + QUERY_CHUNK]
            opened = found.opened(x[q], home[q], lists, radius)
            tables = found.tables(x[q])
            for k in np.flatnonzero(opened.any(axis=0)):
                own = np.flatnonzero(opened[:, k])
                few = 8 * len(own) < len(q)  # else all queries of the chunk cost less than picking their columns
                some = [t.take(own, axis=1) for t in tables] if few else tables
                own = own if few else np.arange(len(q))
                asked = found.asked(x[q[own]], lists[k])
                for cut in range(0, len(of_list[k]), ENTRY_CHUNK):
                    e, part = of_list[k][cut : cut + ENTRY_CHUNK], slice(cut, cut + ENTRY_CHUNK)
                    near = found.squares(some, asked, codes[e], lengths[k][part]) <= limits[k][part, None]
                    j, i = np.nonzero(near & opened[own, k])
                    a, b = q[own[i]], e[j]
                    if lo == hi:  # within the list both vectors ask; the larger id answers
                        once = (home[a] != lists[k]) | (a > b)
                        a, b = a[once], b[once]
                    for low in range(0, len(a), 65_536):
                        c, d = a[low : low + 65_536], b[low : low + 65_536]
                        ok = np.einsum("ij,ij->i", x[c], x[d]) >= threshold
                        links.add(c[ok], d[ok])
        links.fold()
        some = np.flatnonzero(links.linked)
        return pa.table({"rep": rep[some], "links": links.linked[some], "root": rep[links.root[some]]})

    joined = None
    for units in _rounds(dealt, blocks):
        met = materialize(units.groupBy("lo", "hi").applyInArrow(compare, "rep long, links long, root long"), "pq-links")
        joined = met if joined is None else joined.unionByName(met)
    return joined


def _rounds(dealt: DataFrame, blocks: int) -> Iterator[DataFrame]:
    """The rows of all pairs of blocks (lo, hi), a few pairs of each block at a time: two blocks
    meet in the round of the shorter way between their numbers, counted around."""
    for first in range(0, blocks // 2 + 1, ROUND):
        last = min(first + ROUND, blocks // 2 + 1) - 1
        others = F.expr(f"array_distinct(flatten(transform(sequence({first}, {last}), d -> array(pmod(block + d, {blocks}), pmod(block - d, {blocks})))))")
        yield dealt.withColumn("other", F.explode(others)).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other")


def _deal(sizes: list[tuple[int, int]]) -> tuple[list[tuple[int, int, int]], int]:
    """(list, its first block, how many blocks it is dealt into) by list, in their order, and the number of blocks."""
    total = sum(n for _, n in sizes)
    most = min(INDEX_BLOCK, max(1_024, -(-total // BLOCKS)))
    deal, block, room = [], -1, 0
    for home, n in sizes:
        parts = -(-n // most)
        if parts > 1 or n > room:
            block, room = block + 1, most
        deal.append((home, block, parts))
        block, room = block + parts - 1, 0 if parts > 1 else room - n
    return deal, block + 1
