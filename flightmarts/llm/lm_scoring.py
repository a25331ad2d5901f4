"""Language-model scores by a weighted backoff automaton.

Tokens are the ASCII-lower-cased runs of ``[^\\x20\\x09-\\x0D]`` of a text and one end mark.
The model is a smoothed n-gram model over the rows to learn from. With n the count of a
context, c that of a word behind it, u the share of n-grams of that length that occur once
(Good and Turing's estimate of what is yet unseen) and q the word's probability behind
the context without its first word, the probability is
((1 - u) c + (prior + u n) q) / (n + prior); at the bottom is (c + 1/2) / (N + (V + 1) / 2),
where all unseen words share one place. Over all words these add up to 1.

As an automaton: every learned n-gram shorter than ``order`` is a state. A seen
continuation is an arc that carries its log10 probability and leads to the longest suffix
that is a state; every other word takes the failure arc, which carries the log10 of
(prior + u n) / (n + prior), to the context without its first word, and is looked for again
there. The empty context has an arc for every word. A text is scored in one traversal from
left to right that carries the state and adds up what its arcs weigh; texts are traversed
side by side, one token of each at a time.

No task holds the model, which grows with the corpus. Texts are packed into blocks of
about ``BLOCK_BYTES``. Each block asks for the counts of its distinct n-grams: it sends
their 64-bit hashes and own counts, packed by hash part; every part adds up and answers in
the order asked; the answers meet the block again, which builds the part of the automaton
that its texts can reach. A frequent n-gram is one entry per block, whatever its count.

Defined results: null and empty texts are the end mark alone; a null ``learn`` counts as
false; repeated rows are learned and scored one by one; with nothing to learn from every
word has the same probability; an empty table gives no rows; a result column replaces a
kept one of its name. Words and n-grams are told apart by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, materialize, ship, text_chunks
from .textscan import NOT_SPACE, Words, mix

ORDER = 2
PRIOR = 10.0
BLOCK_BYTES = 4 << 20  # text of one block, about
PART_BYTES = 8 << 20  # text whose n-grams make one part, about
START, END = np.uint64(1), np.uint64(2)  # marks in the place of word hashes
_STEP = np.uint64(0xD6E8FEB86659FD93)

SCORE_FIELDS = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
    T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
])
_TOKEN_FIELD = T.StructField("token_scores", T.ArrayType(T.DoubleType()))


def to_planes(values: np.ndarray) -> bytes:
    """Small numbers by byte planes: mostly zeros behind the first, so they compress."""
    return np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


# -- blocks of tokens ---------------------------------------------------------------


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes with an end mark behind each text, tokens per text)."""
    words = Words(*flat_bytes(texts), NOT_SPACE)
    return np.insert(words.hash, words.first[1:], END), words.count + 1


def _blocks(docs: DataFrame, keep: list[str], text: str, learn: Column, block_bytes: int) -> DataFrame:
    """One row per block: the kept columns of its rows, tokens per row, whether a row is
    learned, the distinct word hashes by falling frequency, and every token's place there."""
    kept = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("rows", T.IntegerType()), T.StructField("kept", T.ArrayType(kept)),
        *[T.StructField(c, T.BinaryType()) for c in ("count", "learn", "vocabulary", "ids")],
        T.StructField("learn_tokens", T.LongType()), T.StructField("learn_docs", T.LongType()),
    ])

    def pack(block: int, held: list[tuple]) -> pa.RecordBatch:
        count, learned = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        words, place, often = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True, return_counts=True)
        by_use = np.argsort(-often, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[by_use] = np.arange(len(words))
        rows = pa.concat_arrays([h[3] for h in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([len(count)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
             *[pa.array([v], pa.binary()) for v in (to_planes(count), learned.astype(np.uint8).tobytes(), words[by_use].tobytes(), to_planes(rank[place]))],
             pa.array([int(count[learned].sum())], pa.int64()), pa.array([int(learned.sum())], pa.int64())],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in text_chunks(batch, "__text"):
                hashes, count = _tokens(part.column("__text"))
                learned = np.asarray(part.column("__learn").to_numpy(zero_copy_only=False)).astype(bool)
                own = [part.column(f"k{i}") for i in range(len(keep))]
                rows = pa.StructArray.from_arrays(own, names=keep) if keep else pa.array([{}] * part.num_rows, pa.struct([]))
                held.append((hashes, count, learned, rows))
                size += part.column("__text").nbytes
                if size >= block_bytes:
                    yield pack(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield pack(number, held)

    flag = F.coalesce(learn.cast("boolean"), F.lit(False)).alias("__learn")
    cols = [docs[c].alias(f"k{i}") for i, c in enumerate(keep)]
    return docs.select(*cols, flag, F.coalesce(docs[text].cast("string"), F.lit("")).alias("__text")).mapInArrow(run, schema)


class Grams:
    """The distinct n-grams of a block, per length: the hash, the n-gram without its last word
    (``parent``; of a word: none), that last ``word``, the n-gram without its first word
    (``suffix``), the training count in this block, and every token's n-gram (-1: none)."""

    def __init__(self, count: np.ndarray, learn: np.ndarray, vocabulary: np.ndarray, ids: np.ndarray, order: int):
        self.first = np.concatenate([[0], np.cumsum(count)])
        self.vocabulary, self.ids = vocabulary, ids
        self.base = len(vocabulary) + 1  # the last number is the start mark
        within = np.arange(len(ids), dtype=np.int32) - np.repeat(self.first[:-1].astype(np.int32), count)
        learned = np.repeat(learn, count)
        self.hash, self.parent, self.word, self.suffix = [vocabulary], [None], [np.arange(len(vocabulary))], [None]
        self.at, self.own = [ids], [np.bincount(ids[learned], minlength=len(vocabulary))]
        for k in range(2, order + 1):
            here = np.flatnonzero(within >= k - 2)
            before = self.at[-1][here - 1]
            above = self.hash[-1]
            if k == 2:
                before = np.where(within == 0, self.base - 1, before)
                above = np.append(above, START)
            pairs = before.astype(np.int64) * self.base + ids[here]
            by_pair = np.argsort(pairs, kind="stable")
            pairs = pairs[by_pair]
            head = np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]
            keys, seen = pairs[head], by_pair[head]
            place = np.empty(len(pairs), np.int32)
            place[by_pair] = np.cumsum(head, dtype=np.int32) - 1
            parent, word = keys // self.base, keys % self.base
            at = np.full(len(ids), -1, np.int32)
            at[here] = place
            self.parent.append(parent)
            self.word.append(word)
            self.suffix.append(self.at[-1][here[seen]])
            self.hash.append(mix(above[parent] * _STEP + vocabulary[word] + np.uint64(k)))
            self.own.append(np.bincount(place[learned[here]], minlength=len(keys)))
            self.at.append(at)

    @staticmethod
    def of_row(batch: pa.RecordBatch | pa.Table, i: int, order: int) -> Grams:
        get = lambda c: batch.column(c)[i].as_py()
        learn = np.frombuffer(get("learn"), np.uint8).astype(bool)
        return Grams(from_planes(get("count")), learn, np.frombuffer(get("vocabulary"), np.uint64), from_planes(get("ids")), order)

    def dealt(self, k: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of length k + 1 by part, where each part begins)."""
        part = ((self.hash[k] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


# -- counting -----------------------------------------------------------------------


def _counts(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """(block, part, k, totals, types, single, all): the answers to every block, in the order
    asked; the last three sum up the part's learned n-grams, those that occur once, and their
    occurrences, and stand in one of its rows."""

    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                grams, block = Grams.of_row(batch, i, order), batch.column("block")[i].as_py()
                for k in range(order):
                    by_part, begin = grams.dealt(k, parts)
                    used = np.flatnonzero(np.diff(begin))
                    own = [by_part[begin[p] : begin[p + 1]] for p in used]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()), pa.array([k] * len(used), pa.int32()),
                         pa.array([grams.hash[k][o].tobytes() for o in own], pa.binary()), pa.array([to_planes(grams.own[k][o]) for o in own], pa.binary())],
                        names=["part", "block", "k", "hashes", "counts"],
                    )

    def answer(part: int, k: int, held: list[tuple]) -> pa.RecordBatch:
        hashes = [np.frombuffer(h, np.uint64) for _, h, _ in held]
        keys, place = np.unique(np.concatenate(hashes), return_inverse=True)
        # whole numbers below 2**53, so the float sums of bincount are exact
        total = np.bincount(place, weights=np.concatenate([from_planes(c) for _, _, c in held]), minlength=len(keys)).astype(np.int64)
        replies = np.split(np.minimum(total[place], 2**31 - 1), np.cumsum([len(h) for h in hashes])[:-1])
        facts = [(total > 0).sum(), (total == 1).sum(), total.sum()]
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in held], pa.int64()), pa.array([part] * len(held), pa.int32()), pa.array([k] * len(held), pa.int32()),
             pa.array([to_planes(r) for r in replies], pa.binary()),
             *[pa.array([int(f)] + [0] * (len(held) - 1), pa.int64()) for f in facts]],
            names=["block", "part", "k", "totals", "types", "single", "all"],
        )

    def add_up(batches):
        at, held = None, []
        for batch in batches:
            packs = zip(*([v.as_buffer() for v in batch.column(c)] for c in ("hashes", "counts")))  # views, not copies
            for part, block, k, (hashes, counts) in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "k")), packs):
                if (part, k) != at:
                    if held:
                        yield answer(*at, held)
                    at, held = (part, k), []
                held.append((block, hashes, counts))
        if held:
            yield answer(*at, held)

    asked = blocks.select("block", "count", "learn", "vocabulary", "ids").mapInArrow(ask, "part int, block long, k int, hashes binary, counts binary")
    dealt = asked.repartition(parts, "part").sortWithinPartitions("part", "k")
    return dealt.mapInArrow(add_up, "block long, part int, k int, totals binary, types long, single long, all long")


# -- the automaton ------------------------------------------------------------------


class Automaton:
    """States and arcs that the texts of a block can reach. State 0 is the empty context;
    arcs are sorted by (state, word); ``fail`` and ``fail_weight`` are the failure arcs."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, types: int, texts: int, unseen: list[float], prior: float):
        order, self.base = len(counts), grams.base
        end = np.flatnonzero(grams.vocabulary == END)
        p = (counts[0] + 0.5) / (tokens + 0.5 * (types + 1))
        self.base_weight = np.log10(p)
        # numbering: the empty context, then words with the start mark, then longer n-grams
        number, states = [], 1
        for k in range(order - 1):
            known = counts[k] > 0
            known[np.isin(grams.word[k], end)] = False  # nothing follows an end mark
            if k == 0:
                known = np.append(known, True)
            own = np.zeros(len(known), np.int64)
            own[known] = states + np.arange(int(known.sum()))
            number.append(own)
            states += int(known.sum())
        to = number[0][:-1] if order > 1 else np.zeros(len(p), np.int64)
        keys, weights, target = [np.arange(len(p))], [self.base_weight], [to]
        self.fail, self.fail_weight = np.zeros(states, np.int64), np.zeros(states)
        for k in range(1, order):
            above = np.append(counts[0], texts) if k == 1 else counts[k - 1]  # a context's count
            own = number[k - 1]
            self.fail_weight[own[own > 0]] = np.log10((prior + unseen[k] * above[own > 0]) / (above[own > 0] + prior))
            if k > 1:
                self.fail[own[own > 0]] = number[k - 2][grams.suffix[k - 1][own > 0]]
            arc = np.flatnonzero(counts[k] > 0)
            lower, n = p[grams.suffix[k]], above[grams.parent[k]]
            p = ((1 - unseen[k]) * counts[k] + (prior + unseen[k] * n) * lower) / (n + prior)
            keys.append(own[grams.parent[k][arc]] * self.base + grams.word[k][arc])
            weights.append(np.log10(p[arc]))
            target.append(number[k][arc] if k < order - 1 else number[k - 1][: len(counts[k - 1])][grams.suffix[k][arc]])
        self.keys = np.concatenate(keys)
        by_key = np.argsort(self.keys, kind="stable")
        self.keys, self.weight, self.target = self.keys[by_key], np.concatenate(weights)[by_key], np.concatenate(target)[by_key]
        self.start = int(number[0][-1]) if order > 1 else 0

    def traverse(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Every token's log10 probability, by one pass over each text from left to right."""
        count = np.diff(first)
        longest = np.argsort(-count, kind="stable")
        at, left = first[:-1][longest], count[longest]
        state = np.full(len(at), self.start)
        out = np.zeros(len(ids))
        active = len(left) - np.searchsorted(left[::-1], np.arange(left[0] if len(left) else 0), side="right")
        for t, n in enumerate(active):
            token = at[:n] + t
            word, now = ids[token], state[:n]
            gained, todo = np.zeros(n), np.arange(n)
            while len(todo):
                key = now[todo] * self.base + word[todo]
                arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[arc] == key
                done, arc = todo[hit], arc[hit]
                gained[done] += self.weight[arc]
                now[done] = self.target[arc]
                todo = todo[~hit]
                gained[todo] += self.fail_weight[now[todo]]
                now[todo] = self.fail[now[todo]]
            out[token] = gained
        return out


def score(
    docs: DataFrame, learn: Column, keep: list[str], text: str = "text", order: int = ORDER, prior: float = PRIOR,
    with_tokens: bool = False, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``keep`` columns plus n_tokens, n_known (tokens seen in training), train_tokens,
    base_score (words alone) and score (the model), both log10; on request token_scores.

    ``learn`` marks the rows to learn from; all rows are scored."""
    if order < 1 or prior <= 0:
        raise ValueError("order must be 1 or more and prior positive")
    ship(docs.sparkSession)
    fields = [*SCORE_FIELDS, *([_TOKEN_FIELD] if with_tokens else [])]
    keep = [c for c in keep if c not in [f.name for f in fields]]
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    parts = 1 + size // part_bytes
    blocks = materialize(_blocks(docs, keep, text, learn, block_bytes), "lm-blocks")
    kept = list(blocks.schema["kept"].dataType.elementType)  # as read back, where any value may be null
    counts = materialize(_counts(blocks, order, parts), "lm-counts")
    tokens, texts = (int(v or 0) for v in blocks.agg(F.sum("learn_tokens"), F.sum("learn_docs")).first())
    facts = {r["k"]: r for r in counts.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("types", "single", "all")]).collect()}  # a row per length
    types = int(facts[0]["types"]) if facts else 0
    unseen = [facts[k]["single"] / facts[k]["all"] if k in facts and facts[k]["all"] else 1.0 for k in range(order)]

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        grams = Grams.of_row(block, 0, order)
        totals = [np.zeros(len(h), np.int64) for h in grams.hash]
        dealt = [grams.dealt(k, parts) for k in range(order)]
        for part, k, reply in zip(*(replies.column(c).to_pylist() for c in ("part", "k", "totals"))):
            by_part, begin = dealt[k]
            totals[k][by_part[begin[part] : begin[part + 1]]] = from_planes(reply)
        model = Automaton(grams, totals, tokens, types, texts, unseen, prior)
        each, begin = model.traverse(grams.ids, grams.first), grams.first[:-1]
        made = [
            pa.array(np.diff(grams.first), pa.int64()), pa.array(np.add.reduceat(totals[0][grams.ids] > 0, begin, dtype=np.int64), pa.int64()),
            pa.array(np.full(len(begin), tokens), pa.int64()), pa.array(np.add.reduceat(model.base_weight[grams.ids], begin), pa.float64()),
            pa.array(np.add.reduceat(each, begin), pa.float64()),
        ]
        if with_tokens:
            made.append(pa.ListArray.from_arrays(pa.array(grams.first, pa.int32()), pa.array(each)))
        rows = block.column("kept").combine_chunks()
        rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
        return pa.Table.from_arrays([*rows.flatten().flatten(), *made], names=[*keep, *[f.name for f in fields]])

    asked = blocks.select("block", "kept", "count", "learn", "vocabulary", "ids").groupBy("block")
    answers = counts.select("block", "part", "k", "totals").groupBy("block")
    return asked.cogroup(answers).applyInArrow(run, T.StructType([*kept, *fields]))
