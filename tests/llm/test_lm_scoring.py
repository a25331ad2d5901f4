import math
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import NOT_SPACE, documents, low
from pyspark.sql import functions as F

from flightmarts.llm import lm_scoring, queries

TEXTS = [
    "The cat sat on the mat .", "the cat sat on the hat", "the dog sat on the cat", "a dog a dog a dog", "", None, "  \t\n", "THE CAT SAT ON THE MAT .",
    "été über été über x", "é É", "z" * 3000, "the " * 700, "new words only here", "the cat sat on", "the", "the cat sat", "a b c d e f g", "a b c d e f h",
]


def tokens(text):
    return NOT_SPACE.findall(low(text)) + ["</s>"]


def by_hand(rows, learned, order, prior=lm_scoring.PRIOR):
    """doc -> (n_tokens, n_known, N, base, score, token scores), by recursion over contexts."""
    counts = [Counter() for _ in range(order)]
    for doc in learned:
        words = ["<s>"] + tokens(rows[doc])
        for k in range(order):
            for i in range(k, len(words)):
                counts[k][tuple(words[i - k : i + 1])] += 1
    texts = counts[0].pop(("<s>",), 0)
    n, v = sum(counts[0].values()), len(counts[0])
    unseen = [sum(c == 1 for c in own.values()) / sum(own.values()) if own else 1.0 for own in counts]

    def p(context, word):
        if not context:
            return (counts[0][(word,)] + 0.5) / (n + 0.5 * (v + 1))
        lower, k = p(context[1:], word), len(context)
        total = texts if context == ("<s>",) else counts[k - 1][context]
        if not total:
            return lower
        return ((1 - unseen[k]) * counts[k][(*context, word)] + (prior + unseen[k] * total) * lower) / (total + prior)

    out = {}
    for doc, text in rows.items():
        words = ["<s>"] + tokens(text)
        each = [math.log10(p(tuple(words[max(0, i - order + 1) : i]), words[i])) for i in range(1, len(words))]
        base = sum(math.log10(p((), w)) for w in words[1:])
        out[doc] = (len(words) - 1, sum(counts[0][(w,)] > 0 for w in words[1:]), n, base, sum(each), each)
    return out, p, counts


@pytest.mark.parametrize("order,block,part", [(1, 1 << 24, 1 << 25), (2, 1 << 24, 1 << 25), (2, 60, 40), (3, 200, 100), (4, 60, 1 << 25)])
def test_equals_the_recursion(spark, order, block, part):
    docs = documents(spark, TEXTS).repartition(3)
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, F.col("doc_id") % 4 != 1, ["doc_id"], order=order, with_tokens=True, block_bytes=block, part_bytes=part).collect()}
    want, _, _ = by_hand(dict(enumerate(TEXTS)), [i for i in range(len(TEXTS)) if i % 4 != 1], order)
    assert got.keys() == want.keys()
    for doc, (n, known, total, base, score, each) in want.items():
        r = got[doc]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)
        assert np.allclose(r["token_scores"], each)


def test_probabilities_add_up_to_one():
    rows = dict(enumerate(TEXTS))
    _, p, counts = by_hand(rows, rows, 3)
    words = [w for (w,) in counts[0]]
    for context in ((), ("the",), ("<s>",), ("<s>", "the"), ("sat", "on"), ("a", "dog"), ("never",)):
        assert math.isclose(sum(p(context, w) for w in words) + p(context, "no such word"), 1)


def test_registered_query(spark, tmp):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a dog a"), (None, "the cat sat"), (10**12, None)]
    documents(spark, [], rows).write.parquet(f"{tmp}/documents.parquet")
    got = queries.op11_lm_scoring(spark, tmp).collect()
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    numbered = {n: t for n, (_, t) in enumerate(rows)}
    want, _, _ = by_hand(numbered, [n for n in numbered if not held[n]], lm_scoring.ORDER)
    key = lambda r: (r[0] is not None, str(r[0]), r[2], round(r[5], 6))
    expected = sorted(((rows[n][0], held[n], *want[n][:5]) for n in numbered), key=key)
    got = sorted((tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in got), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected])


def test_kept_columns_nothing_to_learn_and_an_empty_table(spark):
    docs = documents(spark, ["a b", None]).withColumn("score", F.lit("clash")).withColumn("block", F.lit("mine")).withColumn("rows", F.array(F.lit(1)))
    out = lm_scoring.score(docs, F.lit(None).cast("boolean"), ["doc_id", "score", "block", "rows"])
    assert out.columns == ["doc_id", "block", "rows", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[0]["block"] == "mine" and got[0]["rows"] == [1] and got[0]["train_tokens"] == got[0]["n_known"] == 0
    assert got[0]["score"] == got[1]["score"] == 0  # all words share the one unseen place
    assert lm_scoring.score(docs.where("doc_id < 0"), F.lit(True), ["doc_id"]).collect() == []


def test_held_out_text_is_likelier_than_by_words_alone(spark):
    from flightmarts.llm.common import table

    got = queries.op11_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
    assert table(spark, "/root/testdata/sf0.01", "documents").count() == 1000
