import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from fixtures import documents, keyed

from flightmarts.llm import suffix_dedup as sd


def brute(docs, length):
    count, out = Counter(), []
    raw = [(i, (t or "").encode()) for i, t in docs]
    for _, r in raw:
        count.update(r[s : s + length] for s in range(len(r) - length + 1))
    for i, r in raw:
        gone = np.zeros(len(r), dtype=bool)
        for s in range(len(r) - length + 1):
            if count[r[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, *map(str, r)))


def test_removed_bytes_equal_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, "".join(rng.choices("ab", k=rng.randint(0, 90)))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "é" * 40), (103, "x" * 90), (104, "xyx" * 30), (105, "q" * 20), (105, "q" * 20), (None, "a null id holds this text")]
    base = "".join(rng.choices("abcdefgh", k=200))
    for i in range(200, 250):  # passages of all lengths around the threshold in other surroundings
        a = rng.randint(0, 150)
        docs.append((i, "".join(rng.choices("ijkl", k=30)) + base[a : a + rng.randint(5, 60)] + "".join(rng.choices("mnop", k=rng.randint(0, 30)))))
    df = documents(spark, [], docs).withColumnRenamed("n_chars", "n_removed")
    assert keyed(sd.remove_repeats(df, length=20, gram=12)) == brute(docs, 20)


def test_long_texts_and_kept_bytes(spark):
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefghij ", k=900))
    long = "".join(rng.choices("klmnopqrst ", k=60_000)) + passage
    docs = [(1, long), (2, "ü" + passage[300:]), (3, "plain and short")]
    got = {r["doc_id"]: r for r in sd.remove_repeats(documents(spark, [], docs), with_bytes=True).collect()}
    assert got[1]["n_removed"] == got[2]["n_removed"] == 600 and got[3]["n_removed"] == 0
    assert bytes(got[2]["kept_bytes"]).decode() == "ü" and bytes(got[1]["kept_bytes"]).decode() == long[:-600]
    assert sd.remove_repeats(documents(spark, [])).collect() == []


def test_gram_follows_the_length(spark):
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh ", k=100))
    docs = [(i, "".join(rng.choices("ijklmnop ", k=150)) + passage + "".join(rng.choices("qrstuvw ", k=400))) for i in range(2)]
    assert keyed(sd.remove_repeats(documents(spark, [], docs), length=100)) == brute(docs, 100)
    with pytest.raises(ValueError):
        sd.remove_repeats(documents(spark, [], docs), length=100, gram=101)


def test_loser_tree_merges_runs_and_keeps_common_prefixes():
    rng = random.Random(5)
    for _ in range(200):
        items = sorted((bytes(rng.choices(b"ab", k=rng.randint(0, 12))), i) for i in range(rng.randint(0, 50)))
        runs = [[] for _ in range(rng.randint(1, 7))]
        for item in items:
            rng.choice(runs).append(item)
        out = list(sd.LoserTree([list(sd.front_code(r)) for r in runs]))
        assert [o[0] for o in out] == [i[0] for i in items] and sorted(o[1] for o in out) == sorted(i[1] for i in items)
        for a, b in zip(out, out[1:]):
            assert b[2] == sd.common_prefix(a[0], b[0], 0)


def test_the_tree_never_compares_known_prefixes(monkeypatch):
    """Every comparison starts behind the prefix that both heads share with the last output."""
    starts = []
    real = sd.common_prefix
    monkeypatch.setattr(sd, "common_prefix", lambda a, b, start: starts.append((start, real(a, b, 0))) or real(a, b, start))
    strings = sorted((b"p" * 300 + bytes([97 + i % 26, 97 + i // 26]), i) for i in range(200))
    runs = [list(sd.front_code(strings[k::4])) for k in range(4)]
    starts.clear()
    assert [o[0] for o in sd.LoserTree(runs)] == [s[0] for s in strings]
    assert all(start <= shared for start, shared in starts) and sum(start >= 300 for start, _ in starts) >= len(starts) - 8


def test_range_partitioned_sort_finds_longest_common_prefixes(spark):
    rng = random.Random(7)
    strings = [bytes(rng.choices(b"abc", k=rng.randint(1, 15))) for _ in range(300)]
    strings += strings[:40]
    df = spark.createDataFrame([(bytearray(s), i) for i, s in enumerate(strings)], "string binary, load long").repartition(5)
    got = {r["load"]: r["shared"] for r in sd.merge_sorted_suffixes(df, 4).collect()}
    assert len(got) == len(strings)
    copies = Counter(strings)
    for i, s in enumerate(strings):
        assert (got[i] == len(s)) >= (copies[s] > 1)
        best = max(real_prefix(s, t) for j, t in enumerate(strings) if j != i)
        assert got[i] <= best


def real_prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_a_long_repeat_reaches_the_sort_as_few_suffixes(spark, monkeypatch):
    """Chains of blocks are repeats as a whole; blocks alone would send one suffix per minimiser."""
    rng = random.Random(11)
    passage = "".join(rng.choices("abcdefghij ", k=12_000))
    docs = [(i, "".join(rng.choices("klmnopqrst ", k=300)) + passage + "".join(rng.choices("uvwxyz ", k=200))) for i in range(3)]
    docs += [(3, passage[2_000:2_700]), (4, "".join(rng.choices("klm ", k=500)) + passage[7_000:9_000])]
    made, real = {}, sd.materialize
    monkeypatch.setattr(sd, "materialize", lambda df, name: made.setdefault(name, real(df, name)) if name == "suffix-places" else real(df, name))
    assert keyed(sd.remove_repeats(documents(spark, [], docs), length=100, gram=60)) == brute(docs, 100)
    raw = np.frombuffer(passage.encode(), np.uint8)
    blocks = sd.Blocks(raw, np.array([0, len(raw)]), 100, 60)
    assert made["suffix-places"].where("d < 3").count() < 3 * len(blocks.s) / 2


def test_chains_start_where_equal_rows_of_blocks_say(monkeypatch):
    rng = np.random.default_rng(2)
    gram, n = rng.integers(0, 2**63, 500).astype(np.uint64), rng.integers(1, 40, 500)
    s = np.cumsum(n) - n
    whole, part = sd.chain_heads(s, n, gram), sd.chain_heads(s[100:400], n[100:400], gram[100:400])
    assert whole[:2].all() and whole[-1] and part[:2].all() and part[-1]
    same = whole[100:400] == part
    first = np.flatnonzero(gram[100:400] % sd.CHAIN == 0)[0]
    assert same[first + 1 : -1].all()
    # a row without such a hash is cut all the same
    assert sd.chain_heads(s, n, np.ones(500, np.uint64)).sum() >= 500 // sd.LONGEST_CHAIN


def test_blocks_are_the_windows_of_each_minimiser():
    rng = random.Random(6)
    texts = [bytes(rng.choices(b"ab", k=k)) for k in (0, 5, 30, 19, 20, 21, 0, 80, 1, 64)]
    for length, gram in ((20, 12), (1, 1), (20, 20), (7, 1)):
        data = np.frombuffer(b"".join(texts), np.uint8)
        offs = np.cumsum([0, *map(len, texts)])
        b = sd.Blocks(data, offs, length, gram)
        seen = [(d, w) for d, s, n in zip(b.doc.tolist(), b.s.tolist(), b.n.tolist()) for w in range(s, s + n)]
        assert seen == [(d, w) for d in range(len(texts)) for w in range(offs[d], offs[d + 1] - length + 1)]
        picked = {}
        for s, n, m in zip(b.s.tolist(), b.n.tolist(), b.m.tolist()):
            for w in range(s, s + n):
                assert w <= m <= w + length - gram
                assert picked.setdefault(data[w : w + length].tobytes(), m - w) == m - w  # equal windows pick alike


def test_passages_of_many_words_go_from_400_bytes_on(spark):
    """The contract counts bytes: 60 words that are shorter than 400 of them stay."""
    rng = random.Random(8)
    word = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    short, long = (" ".join(word(k) for _ in range(60)) for k in (4, 7))
    docs = [(i, f"{word(500)} {(short, long)[i % 2]} {word(500)}") for i in range(4)]
    got = keyed(sd.remove_repeats(documents(spark, [], docs)))
    assert got == brute(docs, 400) and [r[2] > 0 for r in got] == [False, True, False, True]
