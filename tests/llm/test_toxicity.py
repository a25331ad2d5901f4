import itertools
import random
import zlib

import numpy as np
import pytest
from fixtures import documents, rows

from flightmarts.llm import toxicity as tx

MEAN = ["idiot", "scum", "worthless", "gruxaba", "gruxeno", "gruxil"]


def labelled(n, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a, b, c in itertools.product("kmtsr", "aeiou", ["l", "nt", "rk"])] + ["work", "worth"]
    texts, toxic = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.randint(20, 120))
        toxic.append(int(i % 4 == 0))
        if toxic[-1]:
            for _ in range(rng.randint(2, 4)):
                mean = rng.choice(MEAN[:3]) if rng.random() < 0.7 else f"grux{rng.choice(words)}"
                w[rng.randrange(len(w))] = mean
        texts.append(" ".join(w))
    return texts, toxic


@pytest.fixture(scope="module")
def model():
    return tx.fit(*labelled(300, 1))


def test_messages_equal_enumeration():
    rng = np.random.default_rng(2)
    chain = tx.Chain(np.zeros(1), 0.0, rng.standard_normal((2, 2)), np.zeros(3))
    sizes = [1, 4, 0, 6]
    first = np.concatenate([[0], np.cumsum(sizes)])
    emission = rng.standard_normal(first[-1])
    fwd, bwd = chain.messages(emission, first)
    p = 1 / (1 + np.exp(-(fwd + bwd)))
    for a, b in zip(first[:-1], first[1:]):
        weight = np.zeros(b - a)
        total = 0.0
        for path in itertools.product((0, 1), repeat=b - a):
            s = np.exp(sum(emission[a + i] * v for i, v in enumerate(path)) + sum(chain.trans[x, y] for x, y in zip(path, path[1:])))
            total += s
            weight += s * np.array(path)
        assert np.allclose(p[a:b], weight / total)


def test_held_out_documents_and_offsets(spark, model):
    texts, toxic = labelled(200, 77)
    got = {r["doc_id"]: r for r in tx.score(documents(spark, texts), model, ["doc_id"]).collect()}
    assert sum((got[i]["score"] >= 0.5) == bool(t) for i, t in enumerate(toxic)) >= 196
    for i, t in enumerate(toxic):
        for span in got[i]["spans"]:
            word = texts[i][span["start"] : span["end"]]
            assert not t or word in MEAN or word.startswith("grux")


def test_odd_rows_and_clashing_columns(spark, model):
    texts = [None, "", "?!", "é" * 3 + " idiot scum " + "ok " * 30_000]
    df = documents(spark, texts, [(3, texts[3])]).withColumnRenamed("lang", "score")
    got = tx.score(df, model, ["doc_id"]).collect()
    assert len(got) == 5 and len({r["score"] for r in got if r["doc_id"] < 3}) == 1 and all(r["score"] < 0.5 for r in got if r["doc_id"] < 3)
    spans = next(r["spans"] for r in got if r["doc_id"] == 3)
    assert [(s["start"], s["end"]) for s in spans] == [(4, 9), (10, 14)]
    assert rows(tx.score(df.where("false"), model, ["doc_id"])) == []
    clean = tx.keep_clean(df, model)
    assert clean.columns == df.columns and {r["doc_id"] for r in clean.collect()} == {0, 1, 2}


def test_training_ignores_the_held_out_fold(spark):
    texts, toxic = labelled(240, 5)
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    held = {i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0}
    flipped = spark.createDataFrame([(i, 1, 1 - t if i in held else t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    a, b = tx.train(docs, labels), tx.train(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.doc, b.doc)
    out = tx.report(tx.score(docs, a, ["doc_id"])).collect()
    assert {r["doc_id"] for r in out if r["held_out"]} == held
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in out if r["held_out"]) >= 0.95 * len(held)
    assert tx.train(docs, labels.where("toxic = 0")) is None
    assert {r["score"] for r in tx.score(docs, None, ["doc_id"]).collect()} == {0.0}


def test_sample_sizes_were_not_lowered():
    assert tx.SAMPLE >= 2_000 and tx.SEQUENCES >= 4_000
