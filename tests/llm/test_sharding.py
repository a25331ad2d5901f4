import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from fixtures import documents, rows
from pyspark.sql import functions as F

from flightmarts.llm import queries, sharding


def test_curve_is_a_bijection_whose_neighbours_touch():
    for bits, dims in ((3, 3), (5, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = sharding.hilbert_index(points, bits)
        assert sorted(index) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_counts_differ_by_one_and_slots_have_no_gap(spark):
    rng = random.Random(1)
    texts = [None, "", "ü" * 70_000] + ["x" * rng.randint(0, 3000) for _ in range(180)] + ["same"] * 90
    df = documents(spark, texts, [(5, "again"), (5, "again")]).withColumnRenamed("n_chars", "shard")
    got = sharding.hilbert_shards(df, 24).collect()
    assert len(got) == len(texts) + 2
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert set(by) == set(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    for r in got:
        if r["doc_id"] != 5:
            raw = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    curve = [r["curve"] for r in order]
    assert curve == sorted(curve)


def test_few_rows_null_dimensions_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", None, None), (2, "b", "en", None), (None, None, None, "s")], "doc_id long, text string, lang string, source string")
    assert Counter(r["slot"] for r in sharding.hilbert_shards(df, 24).collect()) == {0: 3}
    assert rows(sharding.hilbert_shards(df.where("false"), 24)) == []


def test_bounds_prune_and_written_shards_hold_their_rows(spark, tmp):
    df = documents(spark, ["t" * (i * 37 % 900) for i in range(200)])
    sharded = sharding.hilbert_shards(df, 8)
    bounds = sharding.shard_bounds(sharded).collect()
    assert sum(b["rows"] for b in bounds) == 200 and all(b["min_size"] <= b["max_size"] for b in bounds)
    large = [b for b in bounds if b["max_size"] >= 700]
    assert len(large) < len(bounds)  # a reader of long texts skips shards
    sharding.write_shards(df, 8, f"{tmp}/shards")
    back = spark.read.parquet(f"{tmp}/shards")
    assert back.count() == 200 and back.select("shard").distinct().count() == 8


def test_written_shards_keep_repeated_and_null_ids(spark, tmp):
    made = [(1, "a"), (1, "b"), (1, "b"), (None, "c"), (2, None), (3, "d" * 500)]
    df = documents(spark, [], made).withColumn("slot", F.lit("mine"))
    sharding.write_shards(df, 3, f"{tmp}/shards")
    back = spark.read.parquet(f"{tmp}/shards")
    assert sorted(map(str, rows(back.select("doc_id", "text")))) == sorted(map(str, made))
    assert sorted((r["shard"], r["slot"]) for r in back.collect()) == [(s, i) for s in range(3) for i in range(2)]


def test_registered_query_equals_ranking_by_hand(spark, tmp):
    rng = random.Random(4)
    texts = [None, "", "ü" * 20_000] + ["y" * rng.randint(0, 2_000) for _ in range(120)] + ["same"] * 70
    kinds = F.xxhash64("doc_id") % 4
    docs = documents(spark, texts, [(5, "again"), (5, "again"), (None, "no id"), (None, None)])
    docs = docs.withColumn("lang", F.when(kinds != 0, F.concat(F.lit("l"), kinds.cast("string")))).withColumn("source", F.when(F.col("n_chars") % 3 != 0, F.lit("hot")))
    docs.write.parquet(f"{tmp}/documents.parquet")

    def cell(value):  # the engine's 64-bit hash is xxHash64 with seed 42, signed
        return 0 if value is None else 1 + (((xxhash.xxh64_intdigest(value.encode(), seed=42) + 2**63) % 2**64) - 2**63) % 127

    made = []
    for d in docs.collect():
        raw = (d["text"] or "").encode()
        size = len(raw) + 8
        point = [cell(d["lang"]), cell(d["source"]), min(127, math.floor(math.log(size) / math.log(2) * 4))]
        curve = int(sharding.hilbert_index(np.array([point]), 7)[0])
        made.append((curve, zlib.crc32(raw), d["doc_id"] is not None, d["doc_id"] or 0, size))
    n, want = len(made), []
    for rank, (curve, crc, known, doc_id, size) in enumerate(sorted(made)):
        shard = rank * 24 // n
        want.append((doc_id if known else None, size, crc, "rows", shard, rank - -(-shard * n // 24), None, curve))
    assert sorted(rows(queries.op7_hilbert_shards(spark, tmp)), key=str) == sorted(want, key=str)
