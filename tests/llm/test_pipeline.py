import random

import corpus_pipeline as cp
import sentencepiece
from fixtures import documents
from test_decontaminate import brute as contaminated
from test_minhash import brute as near

from flightmarts.llm import pii, queries, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    left = [(r["doc_id"], r["text"]) for r in docs.collect() if scores[r["doc_id"]] < 0.5]
    groups = near(left, 5)
    left = [(i, t) for i, t in left if groups[i][2]]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in contaminated(left, bench) if not r[5]}
    left = {i: t for i, t in left if i in clean}
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    out = cp.run(spark, SF)
    got = out.collect()
    assert {r["doc_id"] for r in got} == set(left) and len(got) == len(left)
    for r in got:
        base = pii.base_spans(left[r["doc_id"]])
        assert all(left[r["doc_id"]][a:b] not in r["text"] for k, a, b in base if k == 0)
        if not any(c.isdigit() or c == "@" for c in left[r["doc_id"]]):
            assert r["text"] == left[r["doc_id"]]
        assert list(r["ids"]) == library.encode(r["text"], add_bos=True, add_eos=True) and r["n_chars"] == len(r["text"])


def test_stages_take_odd_rows_and_keep_the_columns(spark):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randint(0, 500)}" for _ in range(n))
    df = documents(spark, [None, "", "x", words(30_000), words(50)], [(4, "another text of this id")])
    for name, stage in cp.STAGES:
        out = stage(spark, df, SF)
        assert name == "tokens" or out.columns == df.columns
        assert stage(spark, df.where("false"), SF).count() == 0
        kept = {r["doc_id"] for r in out.collect()}
        assert {0, 1, 2, 3, 4} == kept
