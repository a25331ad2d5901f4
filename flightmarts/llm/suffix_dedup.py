"""Removal of long repeated substrings over a sparse suffix array.

Every byte covered by a ``length``-byte string that also starts anywhere else goes.
Three steps keep the suffixes to sort few without losing any repeat:

1. Candidates. A window of ``length`` bytes is known by its minimiser, the ``gram``-byte
   substring of the smallest hash in it, so equal windows have the same minimiser at the
   same place. Only windows whose minimiser occurs twice in the corpus stay.
2. Blocks. The windows of one minimiser form a block, a string of up to 2 * length bytes,
   and adjoining blocks form chains, cut where the minimiser's hash says so. Chains whose
   hash occurs twice are repeats as a whole, so that a long one is a few suffixes. The
   blocks of the others, with those of one occurrence of each repeated chain, are judged
   likewise. Those that are left are cut into aligned nodes of ``NODES`` windows, down to
   single ones at the ends of repeats, together with one occurrence of each repeat that they
   might overlap; a node goes on only if what all its windows share occurs twice. Counts are partial aggregates, so a passage in a third of
   all documents costs a row per task.
3. Suffix sort. Hashes only picked candidates: every place whose string may be repeated
   (all occurrences) sends the suffix from there on into a distributed merge sort. Tasks
   sort their suffixes into runs, in which equal ones are one entry, and front-code them
   (length of the prefix shared with the one before, and the rest); splitters cut the runs
   for the exchange, and each range is merged by a loser tree that keeps the common prefix
   of every head with the last output and compares only bytes behind it. The longest
   common prefix of a suffix with its neighbours in that order decides how many windows
   from its start are repeated.

A passage in a third of all documents reaches the merge once per run, where its equal
suffixes are settled; (hash, windows) keys that hold more than a thousandth of the rows are
joined by broadcast.

Defined results: null and empty texts keep nothing and lose nothing; texts shorter than
``length`` lose nothing; overlaps of a string with itself count; repeated rows repeat each
other's text; a document is known by its id and the hash of its text; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, materialize, ship, text_chunks
from .textscan import powers, prefix_hash, substring_hash

LENGTH = 400
NODES = (32, 4, 1)
CHAIN = 8  # blocks of a chain, on average
LONGEST_CHAIN = 64
PLACE_BITS = 21  # of a position in a buffer; of longer texts more
PASS_BYTES = 256 << 10  # text of one pass over the windows: its arrays stay in a core's cache
RUN_BYTES = 8 << 20  # suffix bytes of one sorted run, about
RANGE_BYTES = 16 << 20  # suffix bytes of one merged range, about
SPLITTERS = 4_096  # at most; more ranges than that are cut further by a hash of the prefix
SPLITTER_BYTES = 256
HOT_KEYS = 1_024  # keys with more than this part of the rows are joined by broadcast
_KEY = ["d", "x"]
_LOAD_DDL = "struct<d: bigint, x: bigint, s: int, n: int>"
_LOAD = pa.struct([("d", pa.int64()), ("x", pa.int64()), ("s", pa.int32()), ("n", pa.int32())])

# -- candidate windows ------------------------------------------------------------


class Blocks:
    """Blocks of a buffer of texts: ``doc``, first window ``s`` (a buffer position), number
    of windows ``n``, minimiser position ``m`` and its hash ``gram``."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, length: int, gram: int):
        self.offs, self.prefix = offs, prefix_hash(data)
        size = len(data)
        self.s = self.n = self.m = np.zeros(0, dtype=np.int64)
        if size >= length:
            mask = np.uint64((1 << max(PLACE_BITS, size.bit_length())) - 1)
            low = self._smallest(mask, length, gram)
            # cut where the minimiser changes, and at the first window of each text and past its last
            texts = offs[:-1][np.diff(offs) >= length]
            ends = offs[1:][np.diff(offs) >= length] - length + 1
            cuts = np.unique(np.concatenate([np.flatnonzero(low[1:] != low[:-1]) + 1, texts, ends]))
            inside = np.searchsorted(texts, cuts, side="right") > np.searchsorted(ends, cuts, side="right")
            at = np.flatnonzero(inside)  # the last cut ends a text, so another one follows
            self.s, self.n = cuts[at], cuts[at + 1] - cuts[at]
            self.m = (low[self.s] & mask).astype(np.int64)
        self.gram = substring_hash(self.prefix, self.m, self.m + gram)
        self.doc = np.searchsorted(offs, self.s, side="right") - 1

    def _smallest(self, mask: np.uint64, length: int, gram: int) -> np.ndarray:
        """Of every window of the buffer the smallest of its grams' hashes, with the gram's
        position in the low bits, which breaks ties by the leftmost."""
        low = self.prefix[gram:] - self.prefix[:-gram]
        low *= powers(len(self.prefix))[1][: len(low)]
        low ^= low >> np.uint64(32)
        low *= np.uint64(0xBF58476D1CE4E5B9)
        low &= ~mask
        low |= np.arange(len(low), dtype=np.uint64)
        wide, step = length - gram + 1, 1
        while 2 * step <= wide:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        return np.minimum(low[: len(low) - wide + step], low[wide - step :]) if wide > step else low


def _keep_list(batch: pa.RecordBatch, index: np.ndarray) -> list[pa.Array]:
    at = pa.array(index)
    return [batch.column(c).take(at) for c in _KEY]


def _anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "text", PASS_BYTES):
                b = Blocks(*flat_bytes(part.column("text")), length, gram)
                yield pa.RecordBatch.from_arrays([*_keep_list(part, b.doc), pa.array(b.gram.view(np.int64))], names=[*_KEY, "gram"])

    return texts.mapInArrow(run, "d long, x long, gram long")


_ITEMS = "d long, x long, s int, n int, m int, w int, h long, core long"


def _item_batch(part: pa.RecordBatch, doc, offs, prefix, s, n, m, w, core, length: int) -> pa.RecordBatch:
    """n windows from s on with their minimiser at m (positions in the text), their weight
    w, the hash of the string that they cover, and that of the ``core`` range."""
    base = offs[doc]
    whole = [v.astype(np.int32) for v in (s - base, n, m - base, w)]
    return pa.RecordBatch.from_arrays(
        [*_keep_list(part, doc), *map(pa.array, whole), pa.array(substring_hash(prefix, s, s + n - 1 + length).view(np.int64)),
         pa.array(substring_hash(prefix, *core).view(np.int64))],
        names=[*_KEY, "s", "n", "m", "w", "h", "core"],
    )


_BLOCKS = "array<struct<s: int, n: int, m: int, h: bigint, core: bigint>>"


def chain_heads(s: np.ndarray, n: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Where chains start among blocks. The first and the last block of an unbroken row of
    blocks, whose other neighbours are not candidates, stand alone; within, a chain starts at
    minimisers whose hash says so, which equal rows share, and after LONGEST_CHAIN blocks."""
    broken = np.append(True, s[1:] != s[:-1] + n[:-1])
    last = np.append(broken[1:], True)
    head = broken | last | np.append(True, broken[:-1]) | (gram % np.uint64(CHAIN) == 0)
    first = np.maximum.accumulate(np.where(head, np.arange(len(s)), 0))
    return head | ((np.arange(len(s)) - first) % LONGEST_CHAIN == 0)


def _chains(cand: DataFrame, length: int, gram: int) -> DataFrame:
    """(d, x, s, n, h, blocks): the candidates' chains, h the hash of the string that all its
    windows cover."""

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "text", PASS_BYTES):
                b = Blocks(*flat_bytes(part.column("text")), length, gram)
                repeated = np.unique(np.asarray(part.column("grams").flatten())).view(np.uint64)
                on = np.flatnonzero(np.isin(b.gram, repeated))
                if not len(on):
                    continue
                doc, s, n, m = b.doc[on], b.s[on], b.n[on], b.m[on]
                head = np.flatnonzero(chain_heads(s, n, b.gram[on]) | np.append(True, doc[1:] != doc[:-1]))
                stop = np.append(head[1:], len(on))

                def covered(s, end):
                    return pa.array(substring_hash(b.prefix, s, end - 1 + length).view(np.int64))

                base = b.offs[doc]
                blocks = pa.StructArray.from_arrays(
                    [pa.array(v.astype(np.int32)) for v in (s - base, n, m - base)] + [covered(s, s + n), pa.array(b.gram[on].view(np.int64))],
                    names=["s", "n", "m", "h", "core"],
                )
                end = (s + n)[stop - 1]
                yield pa.RecordBatch.from_arrays(
                    [*_keep_list(part, doc[head]), *(pa.array(v.astype(np.int32)) for v in ((s - base)[head], end - s[head])), covered(s[head], end),
                     pa.ListArray.from_arrays(pa.array(np.append(head, len(on)).astype(np.int32)), blocks)],
                    names=[*_KEY, "s", "n", "h", "blocks"],
                )

    return cand.mapInArrow(run, f"d long, x long, s int, n int, h long, blocks {_BLOCKS}")


def aligned_nodes(first: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [first, first + n) cut at the multiples of ``size``: (range number, node number)."""
    low, high = first // size, (first + n - 1) // size
    count = high - low + 1
    at = np.repeat(np.arange(len(first)), count)
    return at, low[at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)


def _smaller(cand: DataFrame, items: DataFrame, size: int, length: int, gram: int) -> DataFrame:
    """The items cut into nodes of ``size`` windows, aligned by the distance from a
    window's start to its minimiser, which equal windows share."""
    per_text = items.groupBy(*_KEY).agg(F.collect_set(F.struct("s", "n", "m", "w")).alias("items"))
    joined = cand.select(*_KEY, "text").join(per_text, _KEY)

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "text"):
                data, offs = flat_bytes(part.column("text"))
                prefix = prefix_hash(data)
                flat = part.column("items").flatten()
                s, n, m, w = (np.asarray(flat.field(i)).astype(np.int64) for i in range(4))
                doc = np.repeat(np.arange(part.num_rows), np.asarray(part.column("items").value_lengths()))
                near = m - s - n + 1  # the last window's distance, the smallest
                at, node = aligned_nodes(near, n, size)
                low, high = node * size, np.minimum((node + 1) * size, length - gram + 1)
                lo, hi = np.maximum(low, near[at]), np.minimum(high, (near + n)[at])
                place = m[at] + offs[doc[at]]
                core = place - low, place - high + 1 + length
                yield _item_batch(part, doc[at], offs, prefix, place - hi + 1, hi - lo, place, w[at], core, length)

    return joined.mapInArrow(run, _ITEMS)


# -- distributed merge sort ---------------------------------------------------------


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    top = min(len(a), len(b))
    step = 32
    at = start
    while at < top and a[at : at + step] == b[at : at + step]:
        at += step
        step *= 2
    if at >= top:
        return top
    end = min(at + step, top)  # the first difference, if any, is in here
    differ = int.from_bytes(a[at:end]) ^ int.from_bytes(b[at:end])
    return end - (differ.bit_length() + 7) // 8


class LoserTree:
    """Merge of front-coded sorted runs without re-comparing known prefixes.

    Each run's head carries the length of its common prefix with the last output. Of two
    heads the one with the longer such prefix is the smaller; only on a tie are the bytes
    behind the prefix compared, and the loser then carries its prefix with the winner.
    """

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.head: list[tuple[bytes, object] | None] = [None] * len(runs)
        self.shared = [0] * len(runs)
        for r in range(len(runs)):
            self._advance(r, b"")
        self.tree = [-1] * max(1, len(runs))
        self.winner = -1
        for r in range(len(runs)):
            self._seat(r)

    def _advance(self, r: int, last: bytes) -> None:
        item = next(self.runs[r], None)
        if item is None:
            self.head[r] = None
        else:
            lcp, rest, load = item
            self.head[r], self.shared[r] = (last[:lcp] + rest, load), lcp

    def _beats(self, a: int, b: int) -> bool:
        """Whether head a comes first; updates the loser's common prefix."""
        if self.head[b] is None or self.head[a] is None:
            return self.head[a] is not None
        if self.shared[a] != self.shared[b]:
            return self.shared[a] > self.shared[b]
        x, y = self.head[a][0], self.head[b][0]
        n = common_prefix(x, y, self.shared[a])
        first = n == len(x) or (n < len(y) and x[n] < y[n])
        self.shared[b if first else a] = n
        return first

    def _seat(self, r: int) -> None:
        """Play a new run up to the first free seat."""
        node = (r + len(self.tree)) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:
                self.tree[node] = r
                return
            if self._beats(other, r):
                self.tree[node], r = r, other
            node //= 2
        self.winner = r

    def __iter__(self):
        """(string, load, length of the common prefix with the one before)."""
        tree, head, shared, seats = self.tree, self.head, self.shared, len(self.tree)
        r = self.winner
        while r >= 0 and head[r] is not None:
            string, load = head[r]
            yield string, load, shared[r]
            self._advance(r, string)
            node = (r + seats) // 2
            while node > 0:
                other = tree[node]
                if other >= 0 and head[other] is not None:
                    # _beats without a call where the prefixes alone decide
                    if head[r] is None or shared[other] > shared[r] or (shared[other] == shared[r] and self._beats(other, r)):
                        tree[node], r = r, other
                node //= 2


def front_code(strings: list[tuple[bytes, object]]):
    """(common prefix with the string before, rest, load) of sorted strings."""
    before = b""
    for string, load in strings:
        n = common_prefix(before, string, 0)
        yield n, string[n:], load
        before = string


def thinned(rate: float, *cols: str) -> Column:
    """A condition that holds for about ``rate`` of the rows, by their hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) < F.lit(int(min(1.0, rate) * (1 << 30)))


def splitters_of(heads: list[bytes], ranges: int) -> list[bytes]:
    """At most ``ranges - 1`` strings that cut a sample into equal parts."""
    ordered = sorted(heads)
    ranges = min(ranges, SPLITTERS)
    return sorted({ordered[i * len(ordered) // ranges] for i in range(1, ranges)}) if ordered else []


def suffix_runs(suffixes: DataFrame, splitters: list[bytes], ranges: int, prefix: int = SPLITTER_BYTES, cut: Callable | None = None) -> DataFrame:
    """Sorted, front-coded runs of (string binary, load), one row (``part``, ``run``,
    ``block``) per run and range. A block is a compressed Arrow stream: of every distinct
    string ``lcp``, ``rest`` and, if one suffix has it, the ``load``. Suffixes that are equal
    within a run are settled there: their loads follow in a block without ``rest``, with the
    string's length in ``lcp``, in a part below zero, and only the string goes to its range.
    Strings that share ``prefix`` bytes get the same part if no splitter is longer. ``cut``
    makes batches of (string, load) from those of ``suffixes`` in the task that sorts them."""
    spark = suffixes.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(splitters)  # SPLITTERS strings of SPLITTER_BYTES at most
    buckets = -(-ranges // SPLITTERS)

    def coded(held: list[pa.RecordBatch], run: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        strings = table.column("string").to_pylist()
        parts: dict[int, list] = {}
        bounds = shared.value
        for i in sorted(range(len(strings)), key=strings.__getitem__):
            part = bisect_right(bounds, strings[i])
            if buckets > 1:
                part = part * buckets + crc32(strings[i][:prefix]) % buckets
            own = parts.setdefault(part, [])
            if own and own[-1][0] == strings[i]:
                own[-1][1].append(i)
            else:
                own.append((strings[i], [i]))
        loads = table.column("load").chunk(0)

        def block(rows: list[tuple]) -> bytes:
            lcp, rest, load = zip(*rows)
            batch = pa.RecordBatch.from_arrays([pa.array(lcp, pa.int32()), pa.array(rest, pa.binary()), loads.take(pa.array(load, pa.int64()))], names=["lcp", "rest", "load"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            return sink.getvalue().to_pybytes()

        made = {part: block([(n, rest, m[0] if len(m) == 1 else None) for n, rest, m in front_code(own)]) for part, own in sorted(parts.items())}
        settled = [(len(strings[i]), None, i) for own in parts.values() for _, m in own if len(m) > 1 for i in m]
        if settled:
            made[-1 - crc32(run.to_bytes(8, "big")) % ranges] = block(settled)
        return pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), pa.array([run] * len(made), pa.int64()), pa.array(list(made.values()), pa.binary())], names=["part", "run", "block"])

    def sort_runs(batches):
        run, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in cut(batches) if cut else batches:
            for piece in text_chunks(batch, "string", RUN_BYTES):
                held.append(piece)
                size += piece.column("string").nbytes
                if size >= RUN_BYTES:
                    yield coded(held, run)
                    run, held, size = run + 1, [], 0
        if any(p.num_rows for p in held):
            yield coded(held, run)

    return (suffixes if cut else suffixes.select("string", "load")).mapInArrow(sort_runs, "part int, run long, block binary")


def merge_runs(runs: DataFrame, ranges: int, load: str) -> DataFrame:
    """(load, length, shared): of every suffix the longest common prefix with another one in
    the sorted order of its part; its whole length if it was settled in its run."""

    def merged(part: list[list], loads: list[pa.Array]):
        at, length, shared = [], [], []
        for string, i, lcp in LoserTree(part):
            if at and lcp > shared[-1]:
                shared[-1] = lcp
            at.append(i)
            length.append(len(string))
            shared.append(lcp)
        own = pa.concat_arrays(loads).take(pa.array(at, pa.int64()))
        out = pa.RecordBatch.from_arrays([own, pa.array(length, pa.int32()), pa.array(shared, pa.int32())], names=["load", "length", "shared"])
        return out.filter(own.is_valid())  # strings of settled suffixes were there to be compared with

    def merge(batches):
        part, held, loads, size = None, [], [], 0
        for batch in batches:
            for p, block in zip(batch.column("part").to_pylist(), batch.column("block")):
                run = pa.ipc.open_stream(block.as_buffer()).read_all().combine_chunks()
                load = run.column("load").chunk(0)
                if p < 0:
                    whole = run.column("lcp")
                    yield from pa.table({"load": load, "length": whole, "shared": whole}).to_batches()
                    continue
                if p != part:
                    if held:
                        yield merged(held, loads)
                    part, held, loads, size = p, [], [], 0
                held.append(list(zip(run.column("lcp").to_pylist(), run.column("rest").to_pylist(), range(size, size + len(load)))))
                loads.append(load)
                size += len(load)
        if held:
            yield merged(held, loads)

    dealt = runs.repartition(max(1, ranges), "part").sortWithinPartitions("part", "run")
    return dealt.mapInArrow(merge, f"load {load}, length int, shared int")


def merge_sorted_suffixes(suffixes: DataFrame, ranges: int, splitters: list[bytes] | None = None, prefix: int = SPLITTER_BYTES) -> DataFrame:
    """(load, length, shared): of every suffix (string binary, load) the longest common
    prefix with another one in the sorted order of its range. The order is cut into at
    least ``ranges`` parts, at ``splitters`` or at a thinned sample of the strings. Partitions
    of ``suffixes`` have to be in the same order when a lost task runs again."""
    if splitters is None:
        rows = suffixes.count()
        heads = suffixes.where(thinned(8 * min(ranges, SPLITTERS) / max(1, rows), "string", "load")).select(F.substring("string", 1, min(prefix, SPLITTER_BYTES)).alias("head"))
        splitters = splitters_of([bytes(r["head"]) for r in heads.collect()], ranges)
    return merge_runs(suffix_runs(suffixes, splitters, ranges, prefix), ranges, suffixes.schema["load"].dataType.simpleString())


# -- the operator -------------------------------------------------------------------


def split_hot(rows: DataFrame, keys: DataFrame, on: list[str], count: str, total: int, how: str) -> DataFrame:
    """``rows`` semi- or anti-joined with ``keys``, unique by ``on`` and with the number of
    their rows in ``count``. At most about HOT_KEYS keys hold more than that part of
    ``total`` rows; they are broadcast, the others exchanged."""
    most = total // HOT_KEYS + 1_000
    hot = F.broadcast(keys.where(F.col(count) > most).select(on))
    cold = rows.join(hot, on, "left_anti").join(keys.where(F.col(count) <= most).select(on), on, how)
    return cold if how == "left_anti" else cold.unionByName(rows.join(hot, on, "left_semi"))


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(cand, spans): the texts that may hold repeats, and (d, x, s, n): n windows from
    byte s on are repeated. ``gram`` is three fifths of ``length`` unless given."""
    gram = max(1, length * 3 // 5) if gram is None else gram
    if not 1 <= gram <= length:
        raise ValueError(f"gram {gram} is not within 1 and the length {length}")
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("d"), F.xxhash64(text).alias("x"), F.col(text).alias("text"))
    anchors = materialize(_anchors(texts, length, gram), "suffix-anchors")
    # written, so that the join below has an exchange on either side and Spark can split a hot gram
    twice = materialize(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram"), "suffix-grams")
    per_text = anchors.join(twice, "gram").groupBy(*_KEY).agg(F.collect_set("gram").alias("grams"))
    cand = materialize(texts.join(per_text, _KEY), "suffix-candidates")

    chains = materialize(_chains(cand, length, gram), "suffix-chains")
    total = chains.count()
    found = materialize(chains.groupBy("h", "n").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(*_KEY, "s")).alias("a")).where("c > 1"), "suffix-repeats")
    places = split_hot(chains.select(*_KEY, "s", "n", "h"), found, ["h", "n"], "c", total, "left_semi").select(*_KEY, "s", "n")
    # the blocks of the other chains, and those of one occurrence of each repeat
    rest = split_hot(chains, found, ["h", "n"], "c", total, "left_anti").select(*_KEY, F.lit(1).alias("w"), "blocks")
    again = chains.join(found.select("a.*"), [*_KEY, "s"], "left_semi").select(*_KEY, F.lit(2).alias("w"), "blocks")
    level = rest.unionByName(again).select(*_KEY, "w", F.inline("blocks")).select(*_KEY, "s", "n", "m", "w", "h", "core")
    level = materialize(level, "suffix-blocks")
    for size in (*NODES, None):
        total = level.count()
        found = materialize(
            level.groupBy("h", "n").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(*_KEY, "s", "m")).alias("a"), F.min("core").alias("core"), F.min("w").alias("w")).where("c > 1"), "suffix-repeats",
        )
        # strings of repeats found before alone are at their places already
        places = places.unionByName(split_hot(level, found.where("w = 1"), ["h", "n"], "c", total, "left_semi").select(*_KEY, "s", "n"))
        if size is None:
            break
        # what is still open, and one occurrence of each repeat for it to be matched with
        rest = split_hot(level, found, ["h", "n"], "c", total, "left_anti").select(*_KEY, "s", "n", "m", "w", "core")
        again = found.select("a.d", "a.x", "a.s", "n", "a.m", F.lit(2).alias("w"), "core")
        both = rest.unionByName(again)
        core = both.groupBy("core").agg(F.sum("w").alias("all"), F.count_if(F.col("w") == 1).alias("open")).where("all > 1 and open > 0")
        level = materialize(_smaller(cand, split_hot(both, core, ["core"], "all", total, "left_semi"), size, length, gram), "suffix-nodes")

    # the suffixes of all occurrences, twice those of repeated rows
    places = materialize(places.groupBy(*_KEY, "s", "n").agg((F.count(F.lit(1)) > 1).alias("twice")), "suffix-places")
    rows, size = places.agg(F.count(F.lit(1)), F.sum(F.col("n") - 1 + length)).first()
    ranges = 1 + (size or 0) // RANGE_BYTES
    few = places.where(thinned(8 * min(ranges, SPLITTERS) / max(1, rows), *_KEY, "s", "n"))  # bounded by the splitters
    one_text = cand.dropDuplicates(_KEY)

    def suffixes(batches, width: int | None = None):
        for batch in batches:
            for part in text_chunks(batch, "text"):
                data, offs = flat_bytes(part.column("text"))
                raw, flat = data.tobytes(), part.column("items").flatten()
                doc = np.repeat(np.arange(part.num_rows), np.asarray(part.column("items").value_lengths()))
                s, n, twice = (np.asarray(flat.field(i).cast(pa.int64())) for i in range(3))
                order = np.lexsort((n, s, doc))  # of the strings from one place the longest, the last, stands for all
                doc, s, n, twice = (v[order] for v in (doc, s, n, twice))
                new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (s[1:] != s[:-1])))[: len(s)]
                twice = np.maximum.reduceat(twice, new) if len(s) else twice
                own = np.repeat(np.append(new[1:], len(s))[: len(new)] - 1, 1 + twice)
                for at in range(0, len(own), 4_096):
                    some = own[at : at + 4_096]
                    start = s[some] + offs[doc[some]]
                    end = start + (n[some] - 1 + length if width is None else width)
                    loads = [*_keep_list(part, doc[some]), pa.array(s[some].astype(np.int32)), pa.array(n[some].astype(np.int32))]
                    strings = [raw[a:b] for a, b in zip(start.tolist(), np.minimum(end, offs[doc[some] + 1]).tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(strings, pa.binary()), pa.StructArray.from_arrays(loads, fields=list(_LOAD))], names=["string", "load"])

    def of(chosen: DataFrame) -> DataFrame:
        return chosen.groupBy(*_KEY).agg(F.collect_list(F.struct("s", "n", "twice")).alias("items"))

    prefix = min(length, SPLITTER_BYTES)
    heads = cand.join(F.broadcast(of(few)), _KEY).select(*_KEY, "text", "items").mapInArrow(lambda b: suffixes(b, prefix), f"string binary, load {_LOAD_DDL}")
    splitters = splitters_of([bytes(r["string"]) for r in heads.select("string").distinct().collect()], ranges)
    whole = one_text.join(of(places), _KEY).select(*_KEY, "text", "items").sortWithinPartitions(*_KEY)  # a lost task makes the same runs again
    runs = suffix_runs(whole, splitters, ranges, length, suffixes)
    order = materialize(merge_runs(runs, ranges, _LOAD_DDL), "suffix-order")
    repeated = F.least(F.col("load.n"), F.col("shared") - length + 1)
    return cand, order.where(F.col("shared") >= length).select("load.d", "load.x", "load.s", repeated.alias("n"))


_CUT = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept_bytes", T.BinaryType())])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int | None = None, with_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on
    request kept_bytes (what is left; a cut may fall inside a character)."""
    cand, spans = repeated_windows(docs, doc_id, text, length, gram)
    per_text = spans.groupBy(*_KEY).agg(F.collect_list(F.struct("s", "n")).alias("spans"))
    hit = cand.select(*_KEY, "text").dropDuplicates(_KEY).join(per_text, _KEY)
    fields = [f for f in _CUT if with_bytes or f.name != "kept_bytes"]

    def run(batches):
        for batch in batches:
            rows = []
            for t, items in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = np.frombuffer(t.encode(), np.uint8)
                edge = np.zeros(len(raw) + 1, dtype=np.int64)
                start = np.array([i["s"] for i in items])
                stop = start + np.array([i["n"] for i in items]) - 1 + length
                np.add.at(edge, start, 1)
                np.add.at(edge, stop, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = raw[~gone].tobytes()
                rows.append((int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
            made = dict(zip(_CUT.names, zip(*rows))) if rows else {c: [] for c in _CUT.names}
            types = {"n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept_bytes": pa.binary()}
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in _KEY] + [pa.array(made[f.name], types[f.name]) for f in fields], names=[*_KEY, *[f.name for f in fields]])

    cut = hit.mapInArrow(run, T.StructType([T.StructField(c, T.LongType()) for c in _KEY] + fields))
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("d"), F.xxhash64(text).alias("x"),
        F.length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole"), *([raw.alias("all_bytes")] if with_bytes else []),
    )
    zero = F.lit(0).cast("long")
    return base.join(cut, _KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), *([F.coalesce("kept_bytes", "all_bytes").alias("kept_bytes")] if with_bytes else []),
    )
