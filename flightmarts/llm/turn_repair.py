"""Conversation structure repair by prefix-doubling path ranking.

A conversation's rows in order of turn are edited at least cost until the initials of their
roles read ``(s?(ua)+)?``. Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert
(an empty user or assistant row) 5; a truncated row that stays costs 5 more; blank and
duplicate rows have to go. Among the cheapest edits those are taken whose initials in order,
the audit, are the least in ASCII.

Nodes are (rows done, grammar state). A dynamic programme from the end gives every node its
cost to the end; arcs that attain it are optimal, and each letter leaves a node by one
of them at most. Ranking the nodes by their least audit: at first by its first letter; then,
as in building a suffix array, the rank by 2k letters is that of the pair (rank by k letters,
rank by k letters of the node k letters on), and the pointer to that node is doubled with it. The
final ranks choose each node's arc; the audit and the nodes along it are read through the
doubled pointers, every position by the bits of its number.

Rows are dealt by ranges of (conversation, turn), and cut into chunks of at most
``CHUNK_ROWS`` rows, so a conversation that holds a third of all rows spreads over tasks.
Only chunks that may share their conversation with another one (at a task's edge, or full) are
summarised first: their least cost between each two states, a 4 x 4 matrix, and the rows they
repeat from earlier chunks. From the matrices each learns the costs behind its end. Then all
chunks are edited on their own, from every state they can be entered in, and the last step
reads a conversation's chunks in order, as a stream: it carries the state, the counts and the
running SHA-256, which has to see the rows in order. Its memory is one chunk and the audit.

Defined results: rows of one turn are taken by role, then by the hash of their text; null
turns come first; a null role or text is one space; a null conversation id is an id like
others; a row is blank without any of ``[^\\x20\\x09-\\x0D]``, a duplicate if role and text
were seen earlier (compared by a 128-bit digest), truncated if the last such character is
not one of ``.!?``, and its first fault counts; roles are judged by their first character,
an empty role fits nothing; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, ship

CHUNK_ROWS = 4_096
CHUNK_BYTES = 1 << 20
BATCH_ROWS = 1 << 16  # rows edited in one numpy pass, about

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
STATES = 4  # nothing yet; after s; after u; after a
# state behind an accepted initial, -1: not accepted
BEHIND = {"s": np.array([1, -1, -1, -1]), "u": np.array([2, 2, -1, 2]), "a": np.array([-1, -1, 3, -1])}
ROLE_OF_STATE = {2: "user", 3: "assistant"}
FINAL = np.array([0, 3])
KEEP, REROLE, DELETE, INSERT, LEFT_TRUNCATED = 0, 1, 2, 5, 5
LETTERS = "DIKR"  # in ASCII order
FAR = 1 << 50

_LAST = re.compile("[^\x20\x09-\x0d](?=[\x20\x09-\x0d]*\\Z)")
_LEGAL = {"su", "ua", "au"}


def digest_of(role: str, text: str) -> bytes:
    return hashlib.blake2b(role.encode() + b"\0" + text.encode(), digest_size=16).digest()


def fault_of(text: str) -> int:
    """The fault of a row that repeats no other one."""
    last = _LAST.search(text.rstrip("\x20\x09\x0a\x0b\x0c\x0d"))
    if last is None:
        return BLANK
    return SOUND if last.group() in ".!?" else TRUNCATED


# -- editing chunks -----------------------------------------------------------------


class Edits:
    """Costs and least audits of a batch of chunks.

    ``size``: rows per chunk; ``fault``, ``kind``: per row, its fault and the initial's
    number in ``sua`` (-1: none); ``after``: per chunk the cost behind its end by state;
    ``closes``: whether rows may still be inserted there (the conversation's end)."""

    def __init__(self, size: np.ndarray, fault: np.ndarray, kind: np.ndarray, after: np.ndarray, closes: np.ndarray):
        self.size = size
        self.layer = np.concatenate([[0], np.cumsum(size + 1)])  # first layer of each chunk
        layers = int(self.layer[-1])
        self.last = self.layer[1:] - 1
        first_row = np.concatenate([[0], np.cumsum(size)])[:-1]
        self.cost = np.full((layers, STATES), FAR)
        self.row_of = np.full(layers, -1)  # the row that leaves a layer
        inner = np.ones(layers, bool)
        inner[self.last] = False
        self.row_of[inner] = np.arange(len(fault))
        self.inserts = np.ones(layers, bool)
        self.inserts[self.last] = closes
        self.fault, self.kind = fault, kind
        self.cost[self.last] = after
        self._insert(self.last[closes])
        by_size = np.argsort(-size, kind="stable")
        for back in range(1, int(size.max(initial=0)) + 1):
            own = by_size[: np.searchsorted(-size[by_size], -back, side="right")]
            self._leave(self.last[own] - back, first_row[own] + size[own] - back)

    def _insert(self, layer: np.ndarray) -> None:
        c = self.cost[layer]
        user, assistant = np.minimum(c[:, 2], INSERT + c[:, 3]), np.minimum(c[:, 3], INSERT + c[:, 2])
        c[:, 0], c[:, 1], c[:, 2], c[:, 3] = np.minimum(c[:, 0], INSERT + user), np.minimum(c[:, 1], INSERT + user), user, assistant
        self.cost[layer] = c

    def _ways(self, row: np.ndarray):
        """(letter, cost of the edit, state behind it by state before; -1: not possible)."""
        fault, kind = self.fault[row], self.kind[row]
        stays = np.isin(fault, (SOUND, TRUNCATED))
        extra = np.where(fault == TRUNCATED, LEFT_TRUNCATED, 0)
        yield "D", np.full(len(row), DELETE), np.broadcast_to(np.arange(STATES), (len(row), STATES))
        kept = np.full((len(row), STATES), -1)
        for i, initial in enumerate("sua"):
            kept[stays & (kind == i)] = BEHIND[initial]
        yield "K", KEEP + extra, kept
        either = np.maximum(BEHIND["u"], BEHIND["a"])
        yield "R", REROLE + extra, np.where(stays[:, None], either, -1)

    def _leave(self, layer: np.ndarray, row: np.ndarray) -> None:
        best = np.full((len(layer), STATES), FAR)
        for _, price, behind in self._ways(row):
            there = np.take_along_axis(self.cost[layer + 1], np.maximum(behind, 0), axis=1) + price[:, None]
            best = np.minimum(best, np.where(behind >= 0, there, FAR))
        self.cost[layer] = best
        self._insert(layer)

    def _arcs(self) -> np.ndarray:
        """Target of the optimal arc by node and letter, -1 where there is none."""
        layers = len(self.cost)
        arc = np.full((layers, STATES, len(LETTERS)), -1)
        at = np.flatnonzero(self.row_of >= 0)
        for letter, price, behind in self._ways(self.row_of[at]):
            there = np.take_along_axis(self.cost[at + 1], np.maximum(behind, 0), axis=1) + price[:, None]
            arc[at, :, LETTERS.index(letter)] = np.where((behind >= 0) & (there == self.cost[at]), (at[:, None] + 1) * STATES + behind, -1)
        behind = np.maximum(BEHIND["u"], BEHIND["a"])
        there = self.cost[:, behind] + INSERT
        arc[:, :, LETTERS.index("I")] = np.where((there == self.cost) & self.inserts[:, None], np.arange(layers)[:, None] * STATES + behind, -1)
        return arc.reshape(-1, len(LETTERS))

    def rank(self) -> None:
        """Rank all nodes by their least audits and keep the doubled pointers."""
        arc = self._arcs()
        nodes = np.arange(len(arc))
        ends = (arc < 0).all(axis=1)
        letter = np.where(ends, 0, 1 + np.argmax(arc >= 0, axis=1))  # the least one, the end before all
        rank, to = letter, np.where(ends, nodes, arc[nodes, np.maximum(letter - 1, 0)])
        while not ends[to].all():
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[to], return_inverse=True)
            to = to[to]
        # the arc of the least (letter, rank behind it) begins the least audit
        place = np.where(arc >= 0, np.arange(len(LETTERS)) * (int(rank.max(initial=0)) + 1) + rank[np.maximum(arc, 0)], FAR)
        chosen = np.argmin(place, axis=1)
        self.letter = np.where(ends, -1, chosen)
        self.pointers = [np.where(ends, nodes, arc[nodes, chosen])]
        self.length = (~ends).astype(np.int64)
        while not ends[self.pointers[-1]].all():
            to = self.pointers[-1]
            self.length = self.length + self.length[to]
            self.pointers.append(to[to])

    def audits(self, chunk: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(letters, where each audit begins, the state at its end) from a chunk's first layer."""
        start = self.layer[chunk] * STATES + state
        length = self.length[start]
        begin = np.concatenate([[0], np.cumsum(length)])
        node, place = np.repeat(start, length), np.arange(begin[-1]) - np.repeat(begin[:-1], length)
        for bit, to in enumerate(self.pointers):
            on = (place >> bit) & 1 > 0
            node[on] = to[node[on]]
        return np.frombuffer(LETTERS.encode(), np.uint8)[self.letter[node]], begin, self.pointers[-1][start] % STATES


def applied(audit: str, state: int, roles: list[str], texts: list[str]):
    """The rows that an audit leaves: (edit, role, text)."""
    row = 0
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        if edit == "K":
            state = int(BEHIND[roles[row][:1]][state])
            yield edit, roles[row], texts[row]
            row += 1
            continue
        state = int(max(BEHIND["u"][state], BEHIND["a"][state]))
        yield edit, ROLE_OF_STATE[state], texts[row] if edit == "R" else ""
        row += edit == "R"


# -- chunks -------------------------------------------------------------------------


def _chunks(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    """Conversations in order, cut: chunk numbers rise along the table's order. ``whole``
    marks chunks that hold all of a conversation for certain, ``opens`` its first ones."""
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("conv", turns.schema[conv_id].dataType),
        T.StructField("opens", T.BooleanType()), T.StructField("whole", T.BooleanType()),
        T.StructField("turns", T.ArrayType(T.LongType())), T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
    ])

    def run(batches):
        number, held, size, opens = TaskContext.get().partitionId() << 32, [], 0, False
        conv, first = None, True

        def cut(whole: bool):
            columns = list(zip(*held))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([conv], kind), pa.array([opens]), pa.array([whole]),
                 *[pa.array([list(c)], pa.list_(t)) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()))]],
                names=schema.names,
            )

        kind = None
        for batch in batches:
            kind = batch.schema.field("c").type
            for c, *row in zip(*(batch.column(n).to_pylist() for n in ("c", "t", "r", "x"))):
                if first or c != conv:
                    if held:
                        yield cut(opens)  # the next row is of another conversation
                        number += 1
                    conv, held, size, opens, first = c, [], 0, not first, False
                elif len(held) >= chunk_rows or size >= chunk_bytes:
                    yield cut(False)
                    number, held, size, opens = number + 1, [], 0, False
                held.append(row)
                size += len(row[2])
        if held:
            yield cut(False)

    rows = turns.select(
        F.col(conv_id).alias("c"), F.col(turn).cast("long").alias("t"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("r"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("x"),
    ).withColumn("h", F.xxhash64("x"))
    order = ["c", "t", "r", "h"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("h").mapInArrow(run, schema)


_EDGE = "chunk long, seen array<binary>, after array<long>"


def _repeated(edge: DataFrame) -> DataFrame:
    """(chunk, seen): the digests of rows that an earlier chunk of the conversation holds."""

    def run(batches):
        for batch in batches:
            for chunk, conv, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "conv", "roles", "texts"))):
                keys = sorted({digest_of(r, x) for r, x in zip(roles, texts)})
                in_conv = [hashlib.blake2b(repr(conv).encode() + k, digest_size=16).digest() for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(keys), pa.int64()), pa.array(keys, pa.binary()), pa.array(in_conv, pa.binary())], names=["chunk", "row_key", "conv_key"]
                )

    keys = edge.select("chunk", "conv", "roles", "texts").mapInArrow(run, "chunk long, row_key binary, conv_key binary")
    first = keys.groupBy("conv_key").agg(F.min("chunk").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = keys.join(first, "conv_key").where("chunk > first")
    return again.groupBy("chunk").agg(F.collect_list("row_key").alias("seen"))  # at most a chunk's rows


def _faults(roles: list[str], texts: list[str], seen: list[bytes] | None) -> list[int]:
    known, out = set(seen or ()), []
    for r, x in zip(roles, texts):
        fault, key = fault_of(x), digest_of(r, x)
        if fault != BLANK and key in known:
            fault = DUPLICATE
        known.add(key)
        out.append(fault)
    return out


def _batches(batch: pa.RecordBatch):
    """Slices of whole chunks with about BATCH_ROWS rows, and their edits' input."""
    sizes = np.asarray(batch.column("roles").value_lengths()).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + BATCH_ROWS, side="right")))
        part = batch.slice(at, stop - at)
        fault, kind = [], []
        for roles, texts, seen in zip(*(part.column(c).to_pylist() for c in ("roles", "texts", "seen"))):
            fault += _faults(roles, texts, seen)
            kind += ["sua".find(r[0]) if r else -1 for r in roles]
        yield part, sizes[at:stop], np.array(fault, np.int64), np.array(kind, np.int64)
        at = stop


def _end_costs() -> np.ndarray:
    cost = np.full(STATES, FAR)
    cost[FINAL] = 0
    return cost


def _costs_behind(edge: DataFrame) -> DataFrame:
    """(chunk, after): the least costs behind each chunk that is not its conversation's last."""

    def summarise(batches):
        for batch in batches:
            for part, size, fault, kind in _batches(batch):
                through = []
                for state in range(STATES):
                    after = np.full((len(size), STATES), FAR)
                    after[:, state] = 0
                    edits = Edits(size, fault, kind, after, np.zeros(len(size), bool))
                    through.append(edits.cost[edits.layer[:-1]])
                flat = np.minimum(np.stack(through, axis=2), FAR).reshape(-1)  # from state, to state
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv"), part.column("chunk"), pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * STATES**2, pa.int32()), pa.array(flat, pa.int64()))],
                    names=["conv", "chunk", "through"],
                )

    def behind(batches):
        conv, held = None, []

        def carried():
            after, chunks, costs = _end_costs(), [], []
            # the last chunk may also insert at its end, which its own edits do
            user, assistant = min(after[2], INSERT + after[3]), min(after[3], INSERT + after[2])
            after = np.array([min(after[0], INSERT + user), min(after[1], INSERT + user), user, assistant])
            for chunk, through in reversed(held):
                chunks.append(chunk)
                costs.append(after.tolist())
                after = (np.array(through).reshape(STATES, STATES) + after[None, :]).min(axis=1)
            return pa.RecordBatch.from_arrays([pa.array(chunks[1:], pa.int64()), pa.array(costs[1:], pa.list_(pa.int64()))], names=["chunk", "after"])

        for batch in batches:
            for c, chunk, through in zip(*(batch.column(n).to_pylist() for n in ("conv", "chunk", "through"))):
                if held and c != conv:
                    yield carried()
                    held = []
                conv = c
                held.append((chunk, through))
        if held:
            yield carried()

    kind = edge.schema["conv"].dataType.simpleString()
    made = edge.select("chunk", "conv", "roles", "texts", "seen").mapInArrow(summarise, f"conv {kind}, chunk long, through array<long>")
    return made.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(behind, "chunk long, after array<long>")


_MADE = [T.StructField("faults", T.ArrayType(T.IntegerType())), T.StructField("exits", T.ArrayType(T.IntegerType())),
         T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))]


def edited_chunks(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Chunks in order with their rows, faults and, by the state they are entered in (only the
    first for chunks that open a conversation), state at the end, cost from there on and audit."""
    ship(turns.sparkSession)
    chunks = materialize(_chunks(turns, conv_id, turn, role, text, chunk_rows, chunk_bytes), "repair-chunks")
    edge = chunks.where(~F.col("whole"))
    seen = materialize(_repeated(edge), "repair-seen")
    after = materialize(_costs_behind(edge.join(seen, "chunk", "left")), "repair-after")

    def run(batches):
        for batch in batches:
            for part, size, fault, kind in _batches(batch):
                given = part.column("after").to_pylist()
                closes = np.array([a is None for a in given])
                edits = Edits(size, fault, kind, np.array([_end_costs() if a is None else a for a in given]), closes)
                edits.rank()
                entries = np.where(np.asarray(part.column("opens").to_numpy(zero_copy_only=False)).astype(bool), 1, STATES)
                bounds = np.concatenate([[0], np.cumsum(entries)])
                chunk = np.repeat(np.arange(len(size)), entries)
                state = np.arange(bounds[-1]) - np.repeat(bounds[:-1], entries)
                letters, begin, exits = edits.audits(chunk, state)
                per_entry, per_row = pa.array(bounds, pa.int32()), pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                strings = pa.StringArray.from_buffers(len(chunk), pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(letters.tobytes()))
                cost = edits.cost[edits.layer[chunk], state]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("chunk", "conv", "turns", "roles", "texts")],
                     pa.ListArray.from_arrays(per_row, pa.array(fault, pa.int32())), pa.ListArray.from_arrays(per_entry, pa.array(exits, pa.int32())),
                     pa.ListArray.from_arrays(per_entry, pa.array(cost, pa.int64())), pa.ListArray.from_arrays(per_entry, strings)],
                    names=["chunk", "conv", "turns", "roles", "texts", *[f.name for f in _MADE]],
                )

    rows = chunks.drop("whole").join(seen, "chunk", "left").join(after, "chunk", "left")
    schema = T.StructType([chunks.schema[c] for c in ("chunk", "conv", "turns", "roles", "texts")] + _MADE)
    return rows.mapInArrow(run, schema)


def _in_order(edited: DataFrame) -> DataFrame:
    return edited.repartition("conv").sortWithinPartitions("conv", "chunk")


_COLUMNS = ("conv", "turns", "roles", "texts", "faults", "exits", "costs", "audits")
_REPORT = [*[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]


class _Tally:
    """One conversation's report, chunk by chunk."""

    def __init__(self):
        self.state, self.cost, self.audit = 0, None, []
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.low = self.high = None
        self.turns, self.rows, self.hash = 0, 0, hashlib.sha256()

    def add(self, turns, roles, texts, faults, exits, costs, audits) -> None:
        for t in turns:  # in order, nulls first
            if t is not None and t != self.high:
                self.low, self.high, self.turns = t if self.low is None else self.low, t, self.turns + 1
        for r, fault in zip(roles, faults):
            self.faults[fault] += 1
            self.illegal += self.before is not None and self.before + r[:1] not in _LEGAL
            self.before = r[:1]
        if self.cost is None:
            self.cost = costs[self.state]
        audit = audits[self.state]
        for _, r, x in applied(audit, self.state, roles, texts):
            self.hash.update(("\n" if self.rows else "").encode() + f"{r}:{x}".encode())
            self.rows += 1
        self.audit.append(audit)
        self.state = exits[self.state]

    def report(self) -> list:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return [gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()]


def report(edited: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row per conversation of ``edited_chunks``: gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256."""
    names = [conv_id, *[f.name for f in _REPORT]]
    types = [pa.int64()] * 6 + [pa.string()] * 2

    def run(batches):
        conv, tally, kind = None, None, None

        def full(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [kind, *types])], names=names)

        for batch in batches:
            kind, done = batch.schema.field("conv").type, []
            for c, *chunk in zip(*(batch.column(n).to_pylist() for n in _COLUMNS)):
                if tally is None or c != conv:
                    if tally is not None:
                        done.append([conv, *tally.report()])
                    conv, tally = c, _Tally()
                tally.add(*chunk)
            if done:
                yield full(done)
        if tally is not None:
            yield full([[conv, *tally.report()]])

    schema = T.StructType([T.StructField(conv_id, edited.schema["conv"].dataType), *_REPORT])
    return _in_order(edited).select(*_COLUMNS).mapInArrow(run, schema)


def repaired_rows(edited: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, position, edit, role, text): the rows that the edits leave, in order."""
    schema = T.StructType([T.StructField(conv_id, edited.schema["conv"].dataType), T.StructField("position", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]])

    def run(batches):
        conv, state, position, first = None, 0, 0, True
        for batch in batches:
            for c, roles, texts, exits, audits in zip(*(batch.column(n).to_pylist() for n in ("conv", "roles", "texts", "exits", "audits"))):
                if first or c != conv:
                    conv, state, position, first = c, 0, 0, False
                left = list(applied(audits[state], state, roles, texts))
                state = exits[state]
                if left:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c] * len(left), batch.schema.field("conv").type), pa.array(range(position, position + len(left)), pa.int64()),
                         *[pa.array(v, pa.string()) for v in zip(*left)]],
                        names=schema.names,
                    )
                position += len(left)

    return _in_order(edited).select("conv", "roles", "texts", "exits", "audits", "chunk").mapInArrow(run, schema)


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **chunking) -> DataFrame:
    """The report of every conversation with any row."""
    return report(edited_chunks(turns, conv_id, turn, role, text, **chunking), conv_id)
