import hashlib
from collections import defaultdict

import pytest
from fixtures import ALNUM, documents, low, rows

from flightmarts.llm import decontaminate as dc


def brute(docs, bench, window=10):
    windows = defaultdict(set)
    for item, text in bench:
        w = ALNUM.findall(low(text))
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i : i + k])].add(str(item))
    out = []
    for i, text in docs:
        w, hit, items = ALNUM.findall(low(text)), set(), set()
        for k in {len(x) for x in windows}:
            for at in range(len(w) - k + 1):
                if tuple(w[at : at + k]) in windows:
                    hit.update(range(at, at + k))
                    items |= windows[tuple(w[at : at + k])]
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


PASSAGE = "Ten little words, in a row: here THEY are; é again!"
BENCH = [(1, PASSAGE), (2, "short item"), (3, None), (4, ""), (10, PASSAGE + " and more of it follows"), (2, "Short, item")]
DOCS = [
    (1, None), (2, ""), (3, "?!"), (4, "a short item and a SHORT  item"), (5, f"before {PASSAGE} after"), (6, "ten little words in a row here they are e again"),
    (7, (PASSAGE + " ") * 200), (8, "shorT.ITEM"), (9, "word " * 40_000 + "short item"), (5, "other text of the same id"), (11, "shortitem short items"),
]


@pytest.mark.parametrize("limit", [dc.MAX_WINDOWS, 1])
def test_scan_equals_brute_force_by_broadcast_and_by_join(spark, limit):
    docs = documents(spark, [], DOCS).withColumnRenamed("n_chars", "n_hit")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert sorted(rows(dc.report(dc.find_contamination(docs, bench, ["doc_id"], max_windows=limit)))) == brute(DOCS, BENCH)


def test_documents_or_spans_go(spark):
    docs = documents(spark, [], DOCS)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    dirty = {r[0:2] for r in brute(DOCS, BENCH) if r[5]}
    kept = rows(dc.decontaminate(docs, bench))
    assert len(kept) == len(DOCS) - len(dirty) and dc.decontaminate(docs, bench).columns == docs.columns
    spans = {(r["doc_id"], r["text"]) for r in dc.decontaminate(docs, bench, mode="spans").collect()}
    assert (4, "a   and a   ") in spans and (1, None) in spans and len(spans) == len(DOCS)
    assert not any(r[5] for r in brute(list(spans), BENCH))
    none = bench.where("false")
    assert len(rows(dc.decontaminate(docs, none))) == len(DOCS) and rows(dc.decontaminate(docs.where("false"), bench)) == []


@pytest.mark.parametrize("limit", [dc.MAX_WINDOWS, 1])
def test_items_without_an_id_hit_but_are_not_named(spark, limit):
    docs = documents(spark, [], [(1, f"before {PASSAGE} after"), (2, "a short item"), (3, "clean")])
    bench = spark.createDataFrame([(None, PASSAGE), (None, "short item"), (7, "short item")], "item_id long, text string")
    got = {r["doc_id"]: r for r in dc.find_contamination(docs, bench, ["doc_id"], max_windows=limit).collect()}
    assert [(got[i]["n_hit"], got[i]["item_ids"]) for i in (1, 2, 3)] == [(11, []), (2, ["7"]), (0, [])]
    report = {r[0]: r[1:] for r in rows(dc.report(dc.find_contamination(docs, bench, ["doc_id"], max_windows=limit)))}
    assert report[1] == (13, 11, 0, hashlib.sha256(b"").hexdigest(), True)
    assert [r[0] for r in rows(dc.decontaminate(docs, bench, max_windows=limit))] == [3]
