import random

import numpy as np
import pytest
from fixtures import NOT_SPACE, documents, low, rows

from flightmarts.llm import minhash
from flightmarts.llm.graph import components


def shingles(text, k):
    w = NOT_SPACE.findall(low(text))
    return frozenset([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else []))


def brute(docs, k):
    """{doc_id: (n_shingles, component, kept)} by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus(seed=3):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(2, 12)))) for i in range(60)]
    for i in range(100, 150):  # a family of near copies
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(80)] = f"x{rng.random()}"
        docs.append((i, " ".join(words)))
    docs += [(200 + i, " ".join(f"u{i}_{j}" for j in range(40)) + " the same long tail of words here") for i in range(10)]
    docs += [(300, None), (301, ""), (302, " \t\n"), (303, "One"), (304, "one"), (305, " ".join(base) * 60)]
    return docs


@pytest.mark.parametrize("k", [2])
def test_components_equal_brute_force(spark, k):
    docs = corpus()
    df = documents(spark, [], docs).withColumnRenamed("source", "component_id")  # a clashing column is ignored
    got = {r[0]: r[1:] for r in rows(minhash.near_duplicates(df, k=k))}
    assert got == brute(docs, k)


def test_repeated_rows_null_ids_and_stage(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = documents(spark, [], [(5, text), (5, text), (7, text + " end"), (None, text), (8, None)])
    kept = sorted(rows(minhash.drop_near_duplicates(df)), key=str)
    assert sorted((r[0] is None, r[0] or 0) for r in kept) == [(False, 5), (False, 8), (True, 0)]
    assert minhash.drop_near_duplicates(df).columns == df.columns
    assert rows(minhash.near_duplicates(df.where("false"))) == []


def test_rows_of_one_id_and_other_texts_go_only_for_their_own_text(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    docs = [(1, a), (2, a), (2, b), (3, c), (3, d), (3, d), (4, d + " end"), (5, ""), (5, None)]
    kept = rows(minhash.drop_near_duplicates(documents(spark, [], docs)))
    assert sorted((r[0], r[1] or "") for r in kept) == sorted([(1, a), (2, b), (3, c), (3, d), (5, ""), (5, "")])


def test_sketches_estimate_similarity_in_every_size_class():
    rng = np.random.default_rng(1)
    for n in (6, 40, 700, 5000):
        shared = rng.integers(1, 2**63, n * 8 // 10).astype(np.uint64)
        a, b = (np.unique(np.append(shared, rng.integers(1, 2**63, n // 10).astype(np.uint64))) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        c = max(minhash.size_classes(min(len(a), len(b)), 0.8)[-1], minhash.size_classes(max(len(a), len(b)), 0.8)[0])
        got = minhash.estimate(minhash.registers(a, c)[None, :], minhash.registers(b, c)[None, :], np.array([float(len(a))]), np.array([float(len(b))]))
        assert abs(got[0] - true) < 0.15
    unrelated = [np.unique(rng.integers(1, 2**63, 1000).astype(np.uint64)) for _ in range(2)]
    regs = [minhash.registers(s, 9)[None, :] for s in unrelated]
    assert abs(minhash.estimate(*regs, np.array([1000.0]), np.array([1000.0]))[0]) < 0.03
    assert 0.6 < minhash.least_estimate(0.8) < 0.7


def test_hub_families_are_compared_in_blocks(spark, monkeypatch):
    """With tiny blocks and no star rounds every link comes from the block comparison."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 0)
    docs = [d for d in corpus(5) if 100 <= d[0] < 130]
    got = {r[0]: r[1:] for r in rows(minhash.near_duplicates(documents(spark, [], docs), k=2))}
    assert got == brute(docs, 2)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (203, 201), (201, 202), (202, 203)]
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert {got[i] for i in range(1, 61)} == {1} and {got[i] for i in range(100, 140)} == {100} and {got[i] for i in (201, 202, 203)} == {201}
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []
