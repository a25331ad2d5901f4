import random

import numpy as np
from fixtures import rows

from flightmarts.llm import quantization as pq
from tests.conftest import released, shuffle_bytes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, dim, threshold=0.95):
    ok = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v, _ in vectors if v and len(v) == dim and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids = [i for i, _ in ok]
    x = np.stack([v / np.linalg.norm(v) for _, v in ok])
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    links = dict(zip(ids, near.sum(axis=1)))
    root = dict(zip(ids, label))
    return {i: (int(links.get(i, 0)), int(root.get(i, i)), root.get(i, i) == i) for i, _, _ in vectors}


def cloud(seed=2, dim=24):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(dim) for _ in range(250)]
    out += [out[i % 40] + 0.08 * rng.standard_normal(dim) for i in range(120)]  # around the threshold
    center = rng.standard_normal(dim)
    out += [center + 0.1 * rng.standard_normal(dim) for _ in range(80)]
    out += [out[3] * 2.0, out[3], out[3]]
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim, [1.0, 2.0], [1e38] * dim, [1e-40] * dim]
    order = list(range(len(out) + len(odd)))
    random.Random(seed).shuffle(order)
    all_ = [list(map(float, v)) for v in out] + odd
    return [(order[i], v, 0) for i, v in enumerate(all_)]


def test_links_equal_brute_force(spark):
    vectors = cloud()
    df = spark.createDataFrame(vectors, SCHEMA).withColumnRenamed("label", "n_links")
    got = {r[0]: r[1:] for r in rows(pq.near_duplicates(df))}
    assert got == brute(vectors, 24)


def test_every_vector_length_links_within_itself(spark):
    rng = np.random.default_rng(8)
    vectors, want = [], {}
    for dim, first, n in ((24, 0, 60), (16, 100, 20), (3, 200, 2), (5, 300, 1)):
        center = rng.standard_normal(dim)
        own = [(first + i, list(map(float, center + (0.15 if i % 3 else 0.02) * rng.standard_normal(dim))), 0) for i in range(n)]
        own += [(first + 90, own[0][1], 0)] if n > 1 else []  # equal vectors count as links
        vectors += own
        want |= brute(own, dim)
    got = {r[0]: r[1:] for r in rows(pq.near_duplicates(spark.createDataFrame(vectors, SCHEMA)))}
    assert got == want and want[200][0] > 0 and want[100][0] > 1


def test_small_blocks_lose_and_double_nothing(spark, monkeypatch):
    monkeypatch.setattr(pq, "INDEX_BLOCK", 7)
    monkeypatch.setattr(pq, "QUERY_CHUNK", 11)
    vectors = cloud(5)[:220]
    got = {r[0]: r[1:] for r in rows(pq.near_duplicates(spark.createDataFrame(vectors, SCHEMA), sample=64))}
    assert got == brute(vectors, 24)


def test_empty_and_unlinkable_tables(spark):
    df = spark.createDataFrame([(1, None, 0), (2, [0.0], 0)], SCHEMA)
    assert sorted(rows(pq.near_duplicates(df))) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert rows(pq.near_duplicates(df.where("false"))) == []


def test_lower_bounds_and_probes_are_safe():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 16))
    x[200:] = x[:200] + 0.05 * rng.standard_normal((200, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = pq.Index.fit(x[:100], 12)
    home, codes, error = index.encode(x)
    radius = float(np.sqrt(0.1))
    true = np.linalg.norm(x[:, None, :] - x[None], axis=2)
    probes = index.probes(x, home, radius)
    for h in range(12):
        mine = np.flatnonzero(home == h)
        low = index.lower_bounds(x, h, codes[mine], error[mine]).T
        assert (low[true[:, mine] <= radius] <= radius + 1e-4).all()  # none within the radius is dropped
        assert (low <= true[:, mine] + 0.01).all()
    i, j = np.nonzero((true <= radius) & (home[:, None] >= home[None, :]))
    assert all(home[b] in probes[a] for a, b in zip(i, j))


def test_a_class_goes_to_few_units_at_a_time(spark, monkeypatch):
    sizes = [(home, 3 + home % 5 * 40) for home in range(40)] + [(40, 2_000)]
    monkeypatch.setattr(pq, "INDEX_BLOCK", 300)
    deal, blocks = pq._deal(sizes)
    held = {}
    for (home, n), (_, first, parts) in zip(sizes, deal):
        for p in range(parts):
            held[first + p] = held.get(first + p, 0) + n / parts
    assert set(held) == set(range(blocks)) and max(held.values()) <= 300 and blocks <= 2 * sum(n for _, n in sizes) / 300
    assert [first for _, first, _ in deal] == sorted(first for _, first, _ in deal)  # the higher list asks
    met = {}
    for blocks in (1, 2, 7, 12):
        dealt = spark.range(4 * blocks).selectExpr("id as rep", f"cast(id % {blocks} as int) as block")
        for units in pq._rounds(dealt, blocks):
            sent = units.groupBy("lo", "hi", "block").count().collect()
            assert sum(r["count"] for r in sent) <= 2 * pq.ROUND * 4 * blocks
            for r in sent:
                met.setdefault((blocks, r["lo"], r["hi"]), []).append((r["block"], r["count"]))
        pairs = {(lo, hi): sorted(v) for (n, lo, hi), v in met.items() if n == blocks}
        assert pairs == {(lo, hi): [(b, 4) for b in sorted({lo, hi})] for lo in range(blocks) for hi in range(lo, blocks)}


def test_exchanges_leave_no_files_behind(spark):
    vectors = spark.createDataFrame(cloud(4), SCHEMA)
    before = shuffle_bytes(spark)
    pq.near_duplicates(vectors)
    assert released(spark, before)


def test_links_keep_counts_and_roots_only(monkeypatch):
    monkeypatch.setattr(pq, "PAIRS", 5)
    rng = np.random.default_rng(1)
    weight = rng.integers(1, 9, 60)
    links = pq.Links(weight)
    near = np.zeros((60, 60), bool)
    for _ in range(40):
        a = rng.integers(1, 60, 2)
        b = (a * rng.random(2)).astype(int)
        a, b = a[~near[a, b]], b[~near[a, b]]
        if len(a) == 2 and (a[0], b[0]) == (a[1], b[1]):
            a, b = a[:1], b[:1]
        near[a, b] = near[b, a] = True
        links.add(a, b)
        assert links.pairs < 5
    links.fold()
    root = np.arange(60)
    for _ in range(60):
        root = np.array([min([root[i], *root[near[i]]]) for i in range(60)])
    assert (links.root == root).all() and (links.linked == near @ weight).all()
