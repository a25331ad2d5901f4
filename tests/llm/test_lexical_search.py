import math
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import documents, low, rows
from pyspark.sql import functions as F

from flightmarts.llm import lexical_search as L
from flightmarts.llm import queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = [
    "The cat sat on the mat", "cat cat cat", None, "", "...", "dog", "the dog and the CAT", "é über été", "the " * 900, "cat dog mat sat on the",
    "cat", "cat", "cat", "x1y2 cat-dog_mat", "no terms in common", "ünïcode words über alles", "mat " * 50 + "cat",
]
ITEMS = [(1, "the cat"), (2, "cat cat dog"), (3, None), (4, "unknown zebra"), (5, "über"), (6, "the the the the mat"), (6, "dog"), (7, ""), (8, "cat")]


def by_hand(docs, items, k):
    terms = [(i, TERM.findall(low(t))) for i, t in docs]
    count = sum(bool(t) for _, t in terms)
    total = sum(len(t) for _, t in terms)
    df = Counter(w for _, t in terms for w in set(t))
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for doc, own in terms:
            tf, m = Counter(own), 75 + (25 * len(own) * count) // total if total else 75
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 12 * m)) for w in TERM.findall(low(text)) if tf[w])
            if s > 0:
                scored.append((-s, doc is None, doc, s))
        out += [(item, rank, doc, s) for rank, (_, _, doc, s) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def made(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("k,wave,limit", [(20, 1 << 20, L.SLAB), (3, 1 << 20, L.SLAB), (3, 4, L.SLAB), (5, 1 << 20, 1500)])
def test_equals_brute_force(spark, monkeypatch, k, wave, limit):
    docs = [*enumerate(DOCS), (3, "the cat again"), (None, "cat"), (10**12, "cat")]
    got = L.search(documents(spark, [], docs).repartition(4), made(spark, [*ITEMS, ITEMS[0]]), k=k, wave_bytes=wave, limit=limit)
    assert sorted(rows(got), key=str) == by_hand(docs, ITEMS, k)


def test_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(L, "ITEM_TILE", 2)
    monkeypatch.setattr(L, "DOC_TILE", 3)
    docs = list(enumerate(DOCS))
    assert sorted(rows(L.search(documents(spark, DOCS), made(spark, ITEMS), k=4)), key=str) == by_hand(docs, ITEMS, 4)


def test_slabs_add_up_and_stay_below_the_limit():
    weights = np.array([[5, 0, 9, 1], [30, 2, 2, 2], [0, 0, 0, 0]])
    parts = L.slabs(weights, 7)
    assert (sum(parts) == weights).all() and all((p.sum(axis=1) <= 7).all() and (p >= 0).all() for p in parts)
    assert L.SLAB * (L.MAX_IMPACT - 1) < 2**53


def test_impacts_stay_below_the_bound():
    tf = np.array([1, 10, 10**6, 10**9])
    assert ((10**9 * tf) // (1000 * tf + 12 * 75) < L.MAX_IMPACT).all()


def test_registered_query_on_whole_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    assert sorted(rows(queries.op12_lexical_search(spark, d)), key=str) == by_hand(docs, items, 20)


def test_empty_tables_and_extra_columns(spark):
    docs, items = documents(spark, DOCS), made(spark, ITEMS)
    clash = docs.withColumn("item_id", F.lit(9)).withColumn("rank", F.lit("x")).withColumn("score", F.lit(None))
    assert rows(L.search(clash, items.withColumn("doc_id", F.lit(1)))) and L.search(clash, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(L.search(docs.where("false"), items)) == [] and rows(L.search(docs, items.where("false"))) == []
    assert rows(L.search(documents(spark, [None, ""]), items)) == []
