import hashlib
import heapq
import random
import re
import zlib

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from flightmarts.llm import queries
from flightmarts.llm import turn_repair as R

TURNS = "conv_id long, turn long, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def faults(conv):
    seen, out = set(), []
    for role, text in conv:
        solid = [c for c in text if c not in "\x20\x09\x0a\x0b\x0c\x0d"]
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(conv):
    """(cost, audit, rows left) by trying edits in order of (cost, audit), one prefix after another."""
    wrong = faults(conv)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, initials, left = heapq.heappop(heap)
        if at == len(conv) and PATTERN.fullmatch(initials):
            return cost, audit, left
        key = (at, initials[-1:], initials[:1] == "s" and len(initials) == 1, not initials)
        if (key, cost, audit) in done:
            continue
        done.add((key, cost, audit))
        options = [("I", 5, 0, r, "") for r in ("user", "assistant")]
        if at < len(conv):
            role, text = conv[at]
            options.append(("D", 2, 1, None, None))
            if wrong[at] not in ("blank", "duplicate"):
                late = 5 * (wrong[at] == "truncated")
                options += [("K", late, 1, role, text), ("R", 1 + late, 1, "user", text), ("R", 1 + late, 1, "assistant", text)]
        for edit, price, step, role, text in options:
            now = initials if role is None else initials + (role[:1] or "?")
            # a prefix of the pattern, at most one letter short of it
            if not (PATTERN.fullmatch(now) or PATTERN.fullmatch(now + "a") or now == "s"):
                continue
            if cost + price <= 2 * len(conv):  # deleting all is always possible
                heapq.heappush(heap, (cost + price, audit + edit, at + step, now, left if role is None else (*left, (role, text))))


def by_hand(conv_id, conv):
    """The report of a conversation given as (turn, role, text) in order."""
    pairs = [(r, t) for _, r, t in conv]
    wrong, turns = faults(pairs), [t for t, _, _ in conv if t is not None]
    cost, audit, left = cheapest(pairs)
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    joined = "\n".join(f"{r}:{t}" for r, t in left)
    return (conv_id, gaps, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"), illegal, cost, audit, hashlib.sha256(joined.encode()).hexdigest())


def conversations(seed, n, most):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "shop"]
    texts = ["Hi.", "Yes!", "no", " \t", "", "What?", "Sure.", "ok. ", "cut off", "été.", "a\nb."]
    for c in range(n):
        yield c, [(t, rnd.choice(roles), rnd.choice(texts) + (str(t) + "." if rnd.random() < 0.5 else "")) for t in range(rnd.randrange(1, most))]


def table_of(spark, made):
    return spark.createDataFrame([(c, t, r, x) for c, conv in made for t, r, x in conv], TURNS)


@pytest.mark.parametrize("chunk_rows,parts", [(4096, 1), (1, 5), (2, 3), (3, 7)])
def test_equals_trying_all_edits(spark, chunk_rows, parts):
    made = list(conversations(chunk_rows, 60, 8))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = rows(R.repair(table_of(spark, made), chunk_rows=chunk_rows).select(*COLUMNS))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(got) == sorted(by_hand(c, conv) for c, conv in made)


def test_a_long_conversation_in_many_chunks_equals_one_pass(spark):
    rnd = random.Random(5)
    conv = [(t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", "no", "", f"Number {t}.", f"cut {t}"])) for t in range(3000)]
    table = table_of(spark, [(1, conv), (2, conv[:4])])
    whole, cut = (sorted(rows(R.repair(table, chunk_rows=n).select(*COLUMNS))) for n in (4096, 50))
    assert whole == cut and len(whole) == 2 and whole[0][6] > 0


def test_repaired_rows_follow_the_pattern_and_the_digest(spark):
    made = list(conversations(11, 40, 9))
    edited = R.edited_chunks(table_of(spark, made), chunk_rows=3)
    report = {r["conv_id"]: r for r in R.report(edited).collect()}
    left = {}
    for r in R.repaired_rows(edited).orderBy("conv_id", "position").collect():
        left.setdefault(r["conv_id"], []).append(r)
    for c, _ in made:
        own = left.get(c, [])
        assert [r["position"] for r in own] == list(range(len(own)))
        assert PATTERN.fullmatch("".join(r["role"][:1] for r in own))
        assert report[c]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own).encode()).hexdigest()
        assert "".join(r["edit"] for r in own) == report[c]["audit"].replace("D", "")


def damaged(rows_in):
    """The query's damage, row by row."""
    out = []
    for c, t, role, text in rows_in:
        role, text = (" " if v is None else v for v in (role, text))
        way = zlib.crc32(":".join(" " if v is None else str(v) for v in (c, t)).encode()) % 20
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        out += [(c, t, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    return out


def expected_of_query(rows_in):
    convs = {c: [] for c, *_ in rows_in}
    for c, t, r, x in damaged(rows_in):
        convs[c].append((t, r, x))
    for conv in convs.values():
        conv.sort(key=lambda row: (row[0] is not None, row[0] or 0))
    return sorted((by_hand(c, conv) for c, conv in convs.items()), key=str)


def test_registered_query_with_nulls_and_dropped_conversations(spark, tmp):
    made = [(c, t, r, x) for c, conv in conversations(3, 80, 7) for t, r, x in conv]
    made += [(500, None, "user", "Hi."), (500, 4, None, "Hi."), (500, 9, "assistant", None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes.")]
    made += [(c, 0, "user", "Hi.") for c in range(600, 700)]  # some lose their only row
    spark.createDataFrame(made, TURNS).withColumn("chunk", F.lit(1)).withColumn("cost", F.lit("x")).write.parquet(f"{tmp}/conversations.parquet")
    got = sorted(rows(queries.op13_turn_repair(spark, tmp).select(*COLUMNS)), key=str)
    assert got == expected_of_query(made)
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in got)


def test_registered_query_on_whole_tables(spark):
    d = "/root/testdata/sf0.01"
    made = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(rows(queries.op13_turn_repair(spark, d).select(*COLUMNS)), key=str) == expected_of_query(made)


def test_empty_table_and_ties_of_a_turn(spark):
    assert rows(R.repair(spark.createDataFrame([], TURNS))) == []
    twice = [(1, 1, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "user", "Hi.")]
    (got,) = rows(R.repair(spark.createDataFrame(twice, TURNS)).select(*COLUMNS))
    assert got == by_hand(1, [(1, "assistant", "Yes."), (1, "user", "Hi."), (1, "user", "Hi.")])
