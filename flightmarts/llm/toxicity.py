"""Toxicity by a linear-chain conditional random field over words.

Two states (plain, toxic), features of a word: the word, its first 4 to 7 bytes and its
last 4 (hashed to one weight table), transition weights between neighbours.
Forward-backward gives every word's marginal; a document's score is a logistic function
of the expected number of toxic words and the largest marginal, and the words whose
marginal reaches one half are reported with their offsets.

``labels.toxic`` marks documents, so the words are labelled from it first. Features whose
document frequency among toxic documents is far above that among clean ones are the
only ones with a weight; those that explain the toxicity of the training documents mark
their words. Two samples of labelled rows outside the held-out fold are bounded, both by the
smallest hash of the id: ``COUNTED`` documents of each class for the frequencies, which are
counted where the documents are, and ``SAMPLE`` of each class for the chain, which one
task fits. Scoring uses the text alone.

Defined results: null and empty texts have no words and get the model's score for no
evidence; without labelled rows of both classes every score is 0; repeated rows are scored
one by one; a result column replaces an input column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fit_in_task, flat_bytes, map_texts, ship, text_chunks
from .textscan import ALNUM, Words, mix, prefix_hash, substring_hash

COUNTED = 20_000
SAMPLE = 2_000
LEAST_RATIO = 20  # document frequency, toxic to clean
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 7)
SUFFIX = 4
WINDOW = 48  # words of a training sequence
ROUNDS = 60
SEQUENCES = 4_000  # training sequences of each kind: toxic words, words like them, neither
LEAST_DOCS = 5  # a feature explains at least so many toxic documents
LATER_SHARE = 0.02  # and this share of them in layers after the first
FOLDS = 5

_SCORED = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType()),
    ]))),
])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0


def word_features(words: Words) -> np.ndarray:
    """Bucket numbers, one row per feature kind and one column per word."""
    prefix = prefix_hash(words.data)
    parts = [words.hash]
    parts += [substring_hash(prefix, words.start, np.minimum(words.start + p, words.end)) for p in PREFIXES]
    parts.append(substring_hash(prefix, np.maximum(words.end - SUFFIX, words.start), words.end))
    salts = np.arange(1, len(parts) + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return (mix(np.stack(parts) + salts) & np.uint64(BUCKETS - 1)).astype(np.int32)


def _odds_step(odds: np.ndarray, a: float, b: float, c: float, d: float) -> np.ndarray:
    """log((e^a + e^(b + odds)) / (e^c + e^(d + odds))): a two-state message."""
    return np.logaddexp(a, b + odds) - np.logaddexp(c, d + odds)


@dataclass
class Chain:
    """Weights by bucket, transition scores ``trans[from, to]``, document calibration."""

    weights: np.ndarray
    bias: float
    trans: np.ndarray
    doc: np.ndarray  # intercept, log(1 + expected count), log odds of the largest marginal

    def messages(self, emission: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward log odds (own word included) and backward log odds of every word.

        ``first``: offsets of the sequences. All sequences advance together, longest
        first, so step t touches only those that still have a word t.
        """
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        starts, sizes = first[:-1][order], size[order]
        ahead = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1 if len(sizes) else 1), side="right")
        t = self.trans
        fwd, bwd = np.array(emission), np.zeros_like(emission)
        for step in range(1, len(ahead)):
            at = starts[: ahead[step]] + step
            fwd[at] += _odds_step(fwd[at - 1], t[0, 1], t[1, 1], t[0, 0], t[1, 0])
        for step in range(len(ahead) - 1, 0, -1):
            at = starts[: ahead[step]] + step
            bwd[at - 1] = _odds_step(emission[at] + bwd[at], t[1, 0], t[1, 1], t[0, 0], t[0, 1])
        return fwd, bwd

    def marginals(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        emission = np.full(features.shape[1], self.bias)
        for row in features:
            emission += self.weights[row]
        fwd, bwd = self.messages(emission, first)
        return 1 / (1 + np.exp(-np.clip(fwd + bwd, -60, 60)))

    def evidence(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A row per document: 1, log of one plus the expected toxic words, log odds of the largest marginal."""
        total = np.concatenate([[0], np.cumsum(p)])
        count = total[first[1:]] - total[first[:-1]]
        top = np.zeros(len(count))
        has = np.flatnonzero(np.diff(first))
        if len(has):
            top[has] = np.maximum.reduceat(p, first[:-1][has])
        top = np.clip(top, 1e-6, 1 - 1e-6)
        return np.stack([np.ones(len(count)), np.log1p(count), np.log(top / (1 - top))], axis=1)

    def scores(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(p, first) @ self.doc, -60, 60)))


def telling(in_toxic: np.ndarray, in_clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Whether features mark toxic documents, by their document counts in both classes."""
    ratio = (in_toxic + 0.1) / (n_toxic + 1) / ((in_clean + 0.1) / (n_clean + 1))
    return (in_toxic >= LEAST_DOCS) & (ratio >= LEAST_RATIO)


def _label_words(features: np.ndarray, doc_of: np.ndarray, toxic_doc: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """1 for words with a feature that explains why documents of the sample are toxic.

    Candidate features are taken greedily: the one found in the most toxic documents
    not explained so far, until it would explain too few more. Then the words found leave
    and the next layer explains the documents again by other words, as most hold several.
    So words that merely repeat across copies of a toxic document are left plain.
    """
    n_docs, n_toxic = len(toxic_doc), toxic_doc.sum()
    open_word = np.flatnonzero(toxic_doc[doc_of] & candidates[features].any(axis=0))
    own, own_doc = features[:, open_word].astype(np.int64), doc_of[open_word]
    found = np.zeros(len(open_word), dtype=bool)
    least = LEAST_DOCS
    while True:
        pairs = (own[:, ~found] * n_docs + own_doc[~found]).ravel()
        pairs = np.unique(pairs[candidates[pairs // n_docs]])
        bucket, doc = pairs // n_docs, pairs % n_docs
        marked = np.zeros(BUCKETS, dtype=bool)
        while len(bucket):
            gain = np.bincount(bucket)
            best = int(np.argmax(gain))
            if gain[best] < least:
                break
            marked[best] = True
            explained = np.zeros(n_docs, dtype=bool)
            explained[doc[bucket == best]] = True
            bucket, doc = bucket[~explained[doc]], doc[~explained[doc]]
        if not marked.any():
            labels = np.zeros(len(doc_of))
            labels[open_word[found]] = 1
            return labels
        found |= marked[own].any(axis=0)
        least = max(LEAST_DOCS, int(LATER_SHARE * n_toxic))


def _featurize(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all words, words per text)."""
    parts, counts = [], []
    for part in text_chunks(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"]), "t"):
        words = Words(*flat_bytes(part.column("t")), ALNUM)
        parts.append(word_features(words))
        counts.append(words.count)
    return np.concatenate(parts, axis=1), np.concatenate(counts)


def document_counts(texts: list[str], toxic: list[int]) -> np.ndarray:
    """Candidates from the given documents alone."""
    features, count = _featurize(texts)
    doc_of, toxic_doc = np.repeat(np.arange(len(texts)), count), np.array(toxic, dtype=bool)
    pairs = np.unique((features.astype(np.int64) * len(texts) + doc_of).ravel())
    bucket, of_toxic = pairs // len(texts), toxic_doc[pairs % len(texts)]
    in_toxic, in_clean = (np.bincount(bucket[of_toxic == v], minlength=BUCKETS) for v in (True, False))
    return telling(in_toxic, in_clean, int(toxic_doc.sum()), int((~toxic_doc).sum()))


def fit(texts: list[str], toxic: list[int], candidates: np.ndarray | None = None) -> Chain | None:
    """Train on labelled documents (deterministic); None without both classes."""
    toxic_doc = np.array(toxic, dtype=bool)
    if not toxic_doc.any() or toxic_doc.all():
        return None
    if candidates is None:
        candidates = document_counts(texts, toxic)
    features, count = _featurize(texts)
    doc_first = np.concatenate([[0], np.cumsum(count)])
    doc_of = np.repeat(np.arange(len(texts)), count)
    labels = _label_words(features, doc_of, toxic_doc, candidates)
    # training sequences: the documents cut every WINDOW words; those with a toxic word,
    # those with another candidate, and some with neither
    cuts = np.concatenate([np.arange(a, b, WINDOW) for a, b in zip(doc_first[:-1], doc_first[1:]) if b > a] or [[]]).astype(np.int64)
    if not len(cuts):
        return None
    ends = np.append(cuts[1:], len(labels))
    within = lambda flag: (t := np.concatenate([[0], np.cumsum(flag)]))[ends] > t[cuts]
    has = within(labels > 0)
    near = within(candidates[features].any(axis=0)) & ~has
    rng = np.random.default_rng(7)
    picked = np.sort(np.concatenate([rng.permutation(np.flatnonzero(kind))[:SEQUENCES] for kind in (has, near, ~has & ~near)]))
    size = (ends - cuts)[picked]
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(cuts[picked] - first[:-1], size) + np.arange(first[-1])
    labels = labels[at]
    # only candidates have a weight: slots 1 .., slot 0 is every other feature
    listed = np.flatnonzero(candidates)
    slot_of = np.zeros(BUCKETS, dtype=np.int32)
    slot_of[listed] = np.arange(1, len(listed) + 1)
    slot = slot_of[features[:, at]]
    weight, bias, trans = np.zeros(len(listed) + 1), -4.0, np.zeros((2, 2))
    grad_w, grad_b, grad_t = np.full(len(weight), 1e-6), 1e-6, np.full((2, 2), 1e-6)
    model = Chain(weight, bias, trans, np.zeros(3))
    inner = np.ones(len(labels), dtype=bool)
    inner[first[:-1]] = False
    pair = np.flatnonzero(inner)
    share = np.bincount((2 * labels[pair - 1] + labels[pair]).astype(int), minlength=4).reshape(2, 2)
    busy = [np.flatnonzero(row) for row in slot]  # words with a candidate of this kind
    for _ in range(ROUNDS):
        emission = np.full(len(labels), bias)
        for row, on in zip(slot, busy):
            emission[on] += weight[row[on]]
        model.trans = trans
        fwd, bwd = model.messages(emission, first)
        p = 1 / (1 + np.exp(-np.clip(fwd + bwd, -60, 60)))
        g = -0.02 * weight
        for row, on in zip(slot, busy):
            g += np.bincount(row[on], weights=(labels - p)[on], minlength=len(weight))
        g[0] = 0
        gb = (labels - p).sum()
        # pair marginals from the messages on both sides
        left, right = fwd[pair - 1], emission[pair] + bwd[pair]
        joint = np.stack([trans[a, b] + a * left + b * right for a in (0, 1) for b in (0, 1)])
        joint = np.exp(joint - joint.max(axis=0))
        gt = share - (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        grad_w, grad_b, grad_t = grad_w + g * g, grad_b + gb * gb, grad_t + gt * gt
        weight = weight + 0.5 * g / np.sqrt(grad_w)
        bias = bias + 0.2 * gb / np.sqrt(grad_b)
        trans = trans + 0.2 * gt / np.sqrt(grad_t)
    model.weights = np.zeros(BUCKETS, dtype=np.float32)
    model.weights[listed] = weight[1:]
    model.bias, model.trans = float(bias), trans
    # calibration: logistic regression by Newton steps; evidence never counts against toxicity
    p = model.marginals(features, doc_first)
    x, y, w = model.evidence(p, doc_first), toxic_doc.astype(float), np.zeros(3)
    use = np.ones(3, dtype=bool)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        xu = x[:, use]
        hess = (xu * (q * (1 - q))[:, None]).T @ xu + 0.1 * np.eye(use.sum())
        w[use] += np.linalg.solve(hess, xu.T @ (y - q) - 0.1 * w[use])
        negative = (w < 0) & np.array([False, True, True])
        w[negative], use = 0.0, use & ~negative
    model.doc = w
    return model


def _count_features(docs: DataFrame, ids: DataFrame, text: str, n_toxic: int, n_clean: int) -> np.ndarray:
    """Candidates, from document counts over the rows of ``ids`` (__id, toxic)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "t"):
                words = Words(*flat_bytes(part.column("t")), ALNUM)
                doc_of = np.repeat(np.arange(part.num_rows), words.count)
                pairs = np.unique((word_features(words).astype(np.int64) * part.num_rows + doc_of).ravel())
                of_toxic = np.asarray(part.column("toxic"))[pairs % part.num_rows] == 1
                bucket, at = np.unique(pairs // part.num_rows, return_inverse=True)
                toxic = np.bincount(at, weights=of_toxic, minlength=len(bucket)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.astype(np.int32)), pa.array(toxic), pa.array((np.bincount(at, minlength=len(bucket)) - toxic).astype(np.int32))],
                    names=["bucket", "in_toxic", "in_clean"],
                )

    rows = docs.select("__id", F.col(text).alias("t")).join(F.broadcast(ids), "__id").select("t", "toxic")
    counts = rows.mapInArrow(run, "bucket int, in_toxic int, in_clean int").groupBy("bucket").agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_clean").alias("in_clean"))
    ratio = (F.col("in_toxic") + 0.1) / F.lit(n_toxic + 1) / ((F.col("in_clean") + 0.1) / F.lit(n_clean + 1))
    out = np.zeros(BUCKETS, dtype=bool)
    out[[r["bucket"] for r in counts.where((F.col("in_toxic") >= LEAST_DOCS) & (ratio >= LEAST_RATIO)).select("bucket").collect()]] = True
    return out


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, counted: int = COUNTED) -> Chain | None:
    """Fit on labelled documents outside the held-out fold (see the module)."""
    usable = labels.where(~held_out(doc_id) & F.col("toxic").isin(0, 1)).select(F.col(doc_id).cast("string").alias("__id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    order = [F.xxhash64("__id"), F.col("__id")]
    own = docs.select(F.col(doc_id).cast("string").alias("__id"), F.col(text)).where(F.col(text).isNotNull())
    by_class = {v: usable.where(F.col("toxic") == v).orderBy(*order).limit(counted).collect() for v in (0, 1)}
    if not by_class[0] or not by_class[1]:
        return None
    frame = lambda rows: docs.sparkSession.createDataFrame(rows, "__id string, toxic int")
    candidates = _count_features(own, frame(by_class[0] + by_class[1]), text, len(by_class[1]), len(by_class[0]))
    few = frame(by_class[0][:sample] + by_class[1][:sample])
    rows = own.join(F.broadcast(few), "__id").groupBy("__id", "toxic").agg(F.min(text).alias("t"))
    rows = rows.withColumn("place", F.xxhash64("__id"))
    listed = np.flatnonzero(candidates)

    def fit_sample(part: pa.Table) -> Chain | None:
        flags = np.zeros(BUCKETS, dtype=bool)
        flags[listed] = True
        return fit(part["t"].to_pylist(), part["toxic"].to_pylist(), flags)

    return fit_in_task(rows, fit_sample, ["place", "__id", "toxic"])


def score(docs: DataFrame, model: Chain | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus score and spans (code points of words with p >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        data, offs = flat_bytes(texts)
        chain = shared.value
        words = Words(data, offs, ALNUM)
        n = len(offs) - 1
        if chain is None:
            return {"score": pa.array(np.zeros(n)), "spans": pa.array([[]] * n, _SPANS)}
        p = chain.marginals(word_features(words), words.first)
        point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
        doc_of = np.repeat(np.arange(n), words.count)
        spans = [[] for _ in range(n)]
        for i in np.flatnonzero(p >= 0.5):
            base = point[offs[doc_of[i]]]
            spans[doc_of[i]].append({"start": int(point[words.start[i]] - base), "end": int(point[words.end[i]] - base), "p": float(p[i])})
        return {"score": pa.array(chain.scores(p, words.first)), "spans": pa.array(spans, _SPANS)}

    return map_texts(docs, text, run, _SCORED, keep)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def report(scored: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return scored.select(
        F.col(doc_id), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans",
    )


def keep_clean(docs: DataFrame, model: Chain | None, text: str = "text") -> DataFrame:
    """Documents that score below one half, with the columns of ``docs``."""
    names = docs.columns
    own = docs.select(F.struct(*names).alias("doc"), F.col(text).alias("scanned"))
    return score(own, model, ["doc"], text="scanned").where("score < 0.5").select("doc.*")
