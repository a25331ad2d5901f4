"""Near-duplicate documents by HyperMinHash, verified exactly.

A document is the set of its distinct ``k``-word shingles. Its sketch hashes every
shingle to one of ``BUCKETS`` buckets and keeps, per bucket, the smallest hash as a
16-bit register: 6 bits count its leading zeros, 10 bits are the mantissa behind them.
Sets smaller than the buckets need more hashes than they have shingles: in a size
class 2**c <= n < 2**(c+1) each shingle is hashed ``spread(c)`` times with as many
salts, which leaves the Jaccard similarity of two sets as it is. A set that could
match one of the next class is sketched there too.

1. Documents with equal sets collapse to one representative (the smallest id).
2. ``BANDS`` bands of ``ROWS`` registers are the candidate keys. With 32 bands of 4 a pair
   at the threshold 0.8 shares no key with probability 5e-8.
3. In every bucket of a key, members are paired with one hub instead of one another.
   The collision-corrected estimate from all registers drops pairs that are below the
   threshold for all but one in 10**9, and the rest is verified on the full shingle sets.
4. Links join components. Members of one bucket in different components are paired with
   other hubs; what is still apart after ``STAR_ROUNDS`` rounds is compared within
   units of bounded size, so that no link between components is missed and no group is
   ever in one task or expanded into all its pairs.

Defined results: null, empty and blank texts have no shingles and are linked with
nothing; with fewer than k words the whole sequence is the one shingle; rows of one id
are one document; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, map_texts, materialize, ship
from .graph import components
from .textscan import NOT_SPACE, Words, mix

BUCKETS = 256
BANDS, ROWS = 32, 4
FILL = 8  # hashes per bucket, at least
STAR_ROUNDS = 2
BLOCK = 1_024
_EMPTY = 0xFFFF

_SKETCH = T.StructType([
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_key", T.BinaryType()),
    T.StructField("sketches", T.ArrayType(T.StructType([
        T.StructField("class", T.IntegerType()), T.StructField("registers", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ]))),
])


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(*flat_bytes(texts), NOT_SPACE)
    grams, _ = words.grams(k)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:  # the whole sequence, told apart by its length
            h = np.uint64(b - a)
            for w in words.hash[a:b]:
                h = mix(np.array([h ^ w]))[0]
            out.append(np.array([h], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def spread(size_class: int) -> int:
    return max(1, -(-FILL * BUCKETS >> size_class))


def size_classes(n: int, threshold: float) -> list[int]:
    """The set's own class, and the next if a larger set could still match."""
    return sorted({int(n).bit_length() - 1, int(n / threshold).bit_length() - 1})


def registers(shingles: np.ndarray, size_class: int) -> np.ndarray:
    """One 16-bit register per bucket."""
    salts = mix(np.arange(1, spread(size_class) + 1, dtype=np.uint64))
    hashed = np.sort(mix((shingles[None, :] ^ salts[:, None]).ravel()))
    bucket = (hashed >> np.uint64(56)).astype(np.int64)  # the top 8 bits
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    low = hashed[first] & np.uint64((1 << 56) - 1)
    _, exponent = np.frexp((low >> np.uint64(3)).astype(np.float64))  # 53 bits are exact
    zeros = (53 - exponent).astype(np.uint64)
    mantissa = (low << (np.uint64(9) + zeros)) >> np.uint64(54)
    out = np.full(BUCKETS, _EMPTY, dtype=np.uint16)
    out[bucket[first]] = (zeros << np.uint64(10) | mantissa).astype(np.uint16)
    return out


def band_keys(regs: np.ndarray, size_class: int) -> np.ndarray:
    """A key per band; bands of empty registers only have none."""
    values = np.ascontiguousarray(regs[: BANDS * ROWS]).view(np.uint64)
    salt = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(size_class * BANDS))
    return mix(values ^ salt)[values != np.uint64(2**64 - 1)].view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows, corrected for accidental collisions.

    Two unrelated minima with rates x and y fall into the same leading zeros and
    mantissa with a probability of about 0.72 * 2**-10 * x * y / (x + y)**2.
    """
    used = (a != _EMPTY) | (b != _EMPTY)
    share = ((a == b) & used).sum(axis=-1) / np.maximum(used.sum(axis=-1), 1)
    by_chance = 0.72 / 1024 * n_a * n_b / (n_a + n_b) ** 2
    return (share - by_chance) / (1 - by_chance)


def least_estimate(threshold: float, risk: float = 1e-9) -> float:
    """An estimate that a pair at the threshold falls short of with less than ``risk``."""
    total = 0.0
    for hits in range(BUCKETS + 1):
        log_p = math.lgamma(BUCKETS + 1) - math.lgamma(hits + 1) - math.lgamma(BUCKETS - hits + 1)
        total += math.exp(log_p + hits * math.log(threshold) + (BUCKETS - hits) * math.log(1 - threshold))
        if total > risk:
            return (hits - 1) / BUCKETS
    return 0.0


def sketch(docs: DataFrame, k: int, threshold: float, doc_id: str, text: str) -> DataFrame:
    def run(texts):
        sets = shingle_sets(texts, k)
        made = [
            [{"class": c, "registers": (r := registers(s, c)).tobytes(), "bands": band_keys(r, c).tolist()} for c in size_classes(len(s), threshold)]
            if len(s) else [] for s in sets
        ]
        return {
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "set_key": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            "sketches": pa.array(made, pa.list_(pa.struct([("class", pa.int32()), ("registers", pa.binary()), ("bands", pa.list_(pa.int64()))]))),
        }

    return map_texts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", run, _SKETCH, ["doc_id"])


def _likely(pairs: DataFrame, regs: DataFrame, threshold: float) -> DataFrame:
    """Distinct (a, b) of (a, b, class) whose estimate may reach the threshold."""
    least = least_estimate(threshold)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
            na, nb = (np.asarray(batch.column(c)).astype(float) for c in ("na", "nb"))
            ok = (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9) & (estimate(ra, rb, na, nb) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    side = lambda x: regs.select(F.col("rep").alias(x), "class", F.col("registers").alias(f"r{x}"), F.col("n").alias(f"n{x}"))
    return pairs.join(side("a"), ["a", "class"]).join(side("b"), ["b", "class"]).select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a long, b long").distinct()


def _verify(pairs: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold, with their similarity."""
    percent = round(100 * threshold)

    def run(batches):
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def sets(ids, column):
            new = {i: t for i, t in zip(ids, column) if i not in known}
            for i, s in zip(new, shingle_sets(pa.array(list(new.values()), pa.string()), k)):
                known[i] = s

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                sets(a, part.column("ta").to_pylist())
                sets(b, part.column("tb").to_pylist())
                both = [len(np.intersect1d(known[x], known[y], assume_unique=True)) for x, y in zip(a, b)]
                union = [len(known[x]) + len(known[y]) - n for x, y, n in zip(a, b, both)]
                ok = [100 * n >= percent * u for n, u in zip(both, union)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v for v, o in zip(c, ok) if o], t) for c, t in ((a, pa.int64()), (b, pa.int64()), ([n / u for n, u in zip(both, union)], pa.float64()))],
                    names=["a", "b", "jaccard"],
                )
                while len(known) > 64:
                    known.popitem(last=False)

    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, jaccard double").distinct()


def _links_apart(members: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """Links between components that still share a bucket, verified; enough of them to
    join all that belong together.

    Members are dealt into blocks of about ``BLOCK``: those whose buckets have the same
    smallest member (a family of copies, mostly) by the hash of their id. Two blocks that
    meet in any bucket are one unit of work, however many buckets they share, and a unit
    gets the members that meet there, once. It estimates all its pairs in different
    components, verifies the likely ones on the full sets while their components are
    apart, and returns links only.
    """
    least, percent = least_estimate(threshold), round(100 * threshold)
    lowest = members.groupBy("key").agg(F.min("rep").alias("low"))
    family = materialize(members.join(lowest, "key").groupBy("rep").agg(F.min("low").alias("family")), "minhash-families")
    size = family.groupBy("family").agg(F.expr(f"cast(ceil(count(1) / {BLOCK}) as int)").alias("blocks"))
    block = family.join(size, "family").select("rep", F.expr("xxhash64(family, pmod(xxhash64(rep), blocks))").alias("block"))
    placed = materialize(members.join(block, "rep").select("key", "rep", "component", "block"), "minhash-placed")
    met = materialize(placed.select("key", F.col("block").alias("other")).distinct(), "minhash-met")
    units = (
        placed.join(met, "key").select("rep", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).distinct()
    )
    wanted = texts.select(F.col("doc_id").alias("rep"), "text")
    rows = materialize(units, "minhash-units").join(wanted, "rep").repartition("i", "j").sortWithinPartitions("i", "j")

    def compare(part: pa.Table):
        rep, comp, block = (np.asarray(part[c].combine_chunks()) for c in ("rep", "component", "block"))
        sets = shingle_sets(part["text"].combine_chunks(), k)
        n = np.array([len(s) for s in sets], dtype=np.int64)
        root = {int(c): int(c) for c in comp}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        left = np.flatnonzero(block == part["i"][0].as_py())
        right = np.flatnonzero(block == part["j"][0].as_py())
        classes = [size_classes(x, threshold) for x in n]
        found = []
        for c in sorted({max(size_classes(x, threshold)[0], 0) for x in n}):  # a pair meets in its larger set's class
            here = [v for v in range(len(n)) if c in classes[v]]
            regs = np.zeros((len(n), BUCKETS), dtype=np.uint16)
            for v in here:
                regs[v] = registers(sets[v], c)
            inside = np.zeros(len(n), dtype=bool)
            inside[here] = True
            own = inside & (n.astype(np.uint64) >= 1 << c) & (n < 1 << (c + 1))
            for x in left[inside[left]]:
                y = right[inside[right] & (comp[right] != comp[x]) & (own[right] | own[x])]
                y = y[(np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]) - 1e-9)]
                if not len(y):
                    continue
                y = y[estimate(regs[x][None, :], regs[y], float(n[x]), n[y].astype(float)) >= least]
                for v in y:
                    one, two = find(int(comp[x])), find(int(comp[v]))
                    if one == two:
                        continue
                    both = len(np.intersect1d(sets[x], sets[v], assume_unique=True))
                    if 100 * both >= percent * (n[x] + n[v] - both):
                        root[max(one, two)] = min(one, two)
                        found.append((min(int(rep[x]), int(rep[v])), max(int(rep[x]), int(rep[v])), both / (n[x] + n[v] - both)))
        cols = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["a", "b", "jaccard"])

    def run(batches):
        held, name = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = np.stack([np.asarray(batch.column(c)) for c in ("i", "j")], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1, [len(unit)]])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and tuple(unit[lo]) != name:
                    yield compare(pa.Table.from_batches(held))
                    held = []
                name = tuple(unit[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield compare(pa.Table.from_batches(held))

    return rows.select("i", "j", "block", "rep", "component", "text").mapInArrow(run, "a long, b long, jaccard double").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest
    doc_id reachable over links), kept (doc_id = component_id)."""
    ship(docs.sparkSession)
    sketched = materialize(sketch(docs, k, threshold, doc_id, text), "minhash-sketches")
    reps = materialize(
        sketched.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "minhash-reps"
    )
    own = sketched.join(reps, (sketched.set_key == reps.set_key) & (sketched.doc_id == reps.rep)).select("rep", F.col("n_shingles").alias("n"), F.inline("sketches"))
    own = materialize(own, "minhash-own")
    regs = own.select("rep", "class", "registers", "n")
    # members of candidate buckets with at least two representatives
    banded = own.select("rep", "class", F.explode("bands").alias("key"))
    shared = materialize(banded.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "minhash-keys")
    members = materialize(banded.join(shared, "key").select("key", "class", "rep", F.col("rep").alias("component")), "minhash-members")
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = materialize(wanted.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "minhash-texts")

    links, found = None, None
    for turn in range(STAR_ROUNDS + 1):
        if found is not None:  # buckets that still hold several components
            labelled = members.drop("component").join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
            labelled = labelled.withColumn("component", F.coalesce("component", "rep"))
            apart = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
            members = materialize(labelled.join(apart, "key").select("key", "class", "rep", "component"), "minhash-members")
        if turn < STAR_ROUNDS:
            order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
            hubs = members.groupBy("key").agg(F.min_by("rep", order).alias("hub"), F.min_by("component", order).alias("hub_component"))
            pairs = members.join(hubs, "key").where("component != hub_component").select(
                F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"), "class"
            ).distinct()
            new = _verify(_likely(pairs, regs, threshold), texts, k, threshold)
        else:
            new = _links_apart(members, texts, k, threshold)
        new = materialize(new, "minhash-links")
        links = new if links is None else links.unionByName(new)
        found = components(links)

    to = reps.join(found.select(F.col("id").alias("rep"), "component"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    return sketched.select("doc_id", "n_shingles", "set_key").join(to, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group (the smallest id), with the columns of ``docs``; rows without
    an id all stay. A row goes only for its own text: rows of one id and other texts are
    compared one by one, and rows of one id and text are one document."""
    clash = docs.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1")
    if clash.isEmpty():
        groups = near_duplicates(docs, k, threshold, doc_id, text).where("not kept").select(F.col("doc_id").alias("__id")).distinct()
        return docs.join(groups, docs[doc_id] == groups["__id"], "left_anti")
    # ids that name a row are needed: numbered once, written, so that all steps see the same
    own = docs.where(F.col(doc_id).isNotNull()).dropDuplicates([doc_id, text])
    numbered = materialize(own.withColumn("__row", F.monotonically_increasing_id()), "minhash-numbered")
    groups = near_duplicates(numbered, k, threshold, "__row", text).select(F.col("doc_id").alias("__row"), "component_id")
    first = numbered.select(F.col(doc_id).alias("__id"), "__row").join(groups, "__row").groupBy("component_id").agg(F.min(F.struct("__id", "__row")).alias("best"))
    kept = numbered.join(first.select(F.col("best.__row").alias("__row")), "__row", "left_semi").select(*docs.columns)
    return docs.where(F.col(doc_id).isNull()).unionByName(kept)
