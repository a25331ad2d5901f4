import base64
from collections import defaultdict

import public_tokenizers
import tiktoken
from fixtures import NOT_SPACE, documents, rows
from pyspark.sql import functions as F

from flightmarts.config import scratch_path
from flightmarts.llm import queries
from flightmarts.llm import token_counts as tc


def rollup(spark):
    return tc.TokenRollup(spark, scratch_path(spark, "test-rollup"))


def insert(spark, *docs):
    return spark.createDataFrame(docs, "doc_id long, version string, source string, lang string, n_tokens long")


def totals(r):
    return sorted(rows(r.totals()), key=str)


def test_signed_batches_are_additive_and_idempotent(spark):
    r = rollup(spark)
    first = insert(spark, (1, "v1", "a", "en", 10), (2, "v1", "a", "en", 5), (3, "v1", None, None, 7), (1, "v2", "a", "en", 12),
                   (2, "v1", "a", "en", 4), (None, "v1", "a", "en", 100))
    assert r.apply("b1", inserts=first) is True
    want = sorted([("a", "en", "v1", 3, 115), (None, None, "v1", 1, 7), ("a", "en", "v2", 1, 12)], key=str)
    assert totals(r) == want
    assert r.apply("b1", inserts=first) is False and totals(r) == want
    ids = spark.createDataFrame([(1,), (1,), (99,)], "doc_id long")
    assert r.apply("b2", deletes=ids)
    assert totals(r) == sorted([("a", "en", "v1", 2, 105), (None, None, "v1", 1, 7)], key=str)
    new = spark.createDataFrame([(2, "v1", 50), (3, "v1", 7), (99, "v1", 1), (1, "v1", 3)], "doc_id long, version string, n_tokens long")
    assert r.apply("b3", revisions=new)
    assert totals(r) == sorted([("a", "en", "v1", 2, 150), (None, None, "v1", 1, 7)], key=str)
    assert r.apply("b4", inserts=insert(spark, (2, "v1", "b", "fr", 6)))  # moves to another group
    assert totals(r) == sorted([("a", "en", "v1", 1, 100), ("b", "fr", "v1", 1, 6), (None, None, "v1", 1, 7)], key=str)
    assert r.apply("b5", inserts=first.where("false"), deletes=ids.where("false")) and r.committed() == ["b1", "b2", "b3", "b4", "b5"]


def test_a_batch_without_marker_has_no_effect_until_retried(spark, monkeypatch):
    r = rollup(spark)
    r.apply("b1", inserts=insert(spark, (1, "v", "a", "en", 10)))
    more = insert(spark, (2, "v", "a", "en", 1))
    # the batch's folders were written, the marker was not
    more.select("doc_id", "version", "source", "lang", "n_tokens").withColumn("n_docs", more.n_tokens).write.parquet(f"{r.root}/documents/b2")
    assert totals(r) == [("a", "en", "v", 1, 10)]
    assert r.apply("b2", inserts=more)
    assert totals(r) == [("a", "en", "v", 2, 11)]


def test_counts_of_texts(spark):
    texts = [None, "", "one two  three", "a\nb\na\n\nb", "w " * 30_000]
    df = documents(spark, texts).withColumnRenamed("n_chars", "n_tokens")
    got = dict((r["doc_id"], r["n_tokens"]) for r in tc.count_tokens(df, "words", tc.count_words).collect())
    assert got == {i: len(NOT_SPACE.findall(t or "")) for i, t in enumerate(texts)}
    once = {r["doc_id"]: r["text"] for r in tc.without_repeated_lines(df).collect()}
    assert once == {3: "a\nb\n"}
    assert rollup(spark).totals().collect() == []


def test_registered_query_equals_counting_by_hand(spark, tmp):
    texts = [None, "", "one two  three", "a b\na b\nc", "Ünï  cödé 123!\n" * 40, "x" * 3_000] + [f"w{i} " * (i % 7) + "\nline of text" * (i % 4) for i in range(60)]
    source = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")))
    docs = documents(spark, texts, [(2, "one"), (None, "a loose row"), (None, None)]).withColumn("source", source)
    docs.write.parquet(f"{tmp}/documents.parquet")
    low = [3, 7, 8, 20, 999]
    labels = [(i, 0 if i in low else 3) for i in [*range(60), 999]] + [(7, 0), (None, 0), (9, None)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp}/labels.parquet")

    with open(queries.BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(t): int(n) for t, n in (line.split() for line in f)}
    encoder = tiktoken.Encoding("by hand", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    counters = {"words": lambda t: len(NOT_SPACE.findall(t or "")), "byte_bpe_50k": lambda t: len(encoder.encode_ordinary(t or ""))}
    want, held, revised = defaultdict(lambda: [0, 0]), {}, {}
    for d in docs.collect():
        once = "\n".join(dict.fromkeys((d["text"] or "").split("\n")))
        for version, count in counters.items():
            key, n = (d["doc_id"], version), count(d["text"])
            if d["doc_id"] is None:
                total = want[d["source"], d["lang"], version]
                total[0], total[1] = total[0] + 1, total[1] + n
                continue
            held[key] = max(held.get(key, (-1,)), (n, d["source"], d["lang"]), key=lambda x: x[0])
            if once != (d["text"] or ""):
                revised[key] = max(revised.get(key, 0), count(once))
    assert any(revised[k] != held[k][0] and k[0] not in low for k in revised)
    for (doc_id, version), (n, *group) in held.items():
        if doc_id not in low:
            total = want[(*group, version)]
            total[0], total[1] = total[0] + 1, total[1] + revised.get((doc_id, version), n)
    assert sorted(rows(queries.op4_token_counts(spark, tmp)), key=str) == sorted(((*k, *v) for k, v in want.items()), key=str)
