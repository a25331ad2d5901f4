import hashlib
import random
import re

import numpy as np
import pytest
from fixtures import documents, rows

from flightmarts.llm import pii

RULES = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    """The contract's rules, read literally."""
    out = [(0, *m.span()) for m in RULES[0].finditer(text)]
    out += [(1, *m.span()) for m in RULES[1].finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in RULES[2].finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits))))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in RULES[3].finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_rules_equal_the_plain_reading():
    rng = random.Random(1)
    parts = ["1", "2", "0", "9", "25", "255", "256", ".", ".", "@", "a", "b.c", "+", " ", "-", "(", ")", "é", "4111111111111111", "a@b.co", "007"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text


def test_base_rules_take_long_runs_in_linear_time():
    assert pii.base_spans("a" * 300_000 + "1" * 300_000 + " @ +1" + " " * 300_000) == []


def test_gradients_by_differences():
    tagger = pii.Tagger()
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    rng = np.random.default_rng(0)
    ids, tags = rng.integers(1, 129, (3, 8)), np.zeros((3, 8), int)
    tags[0, 2:5], tags[1, 0] = [1, 2, 2], 3

    def loss():
        e = tagger.emissions(ids)
        a, _ = tagger._alphas(e)
        t = tagger.p["trans"] + tagger.barred
        gold = sum(e[np.arange(8), i, tags[i]].sum() + sum(t[tags[i, j], tags[i, j + 1]] for j in range(7)) for i in range(3))
        return (pii._logsumexp(a[-1], 1).sum() - gold) / 3

    grad = tagger.gradients(ids, tags)
    for name, value in tagger.p.items():
        at = {"embed": (ids[0, 3], 2), "trans": (0, 0)}.get(name) or tuple(rng.integers(0, d) for d in value.shape)
        old = value[at]
        value[at] = old + 1e-3
        up = loss()
        value[at] = old - 1e-3
        down = loss()
        value[at] = old
        assert abs((up - down) / 2e-3 - grad[name][at]) < 2e-3 * max(1, abs(grad[name][at])), name


def example(rng):
    """(window, value): a value of some kind between invented words."""
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    value = rng.choice([
        f"{word()}{rng.randint(1, 99)}@{word()}.com", ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        f"+{rng.randint(1, 9)} ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}", f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}",
    ])
    left = " ".join(word() for _ in range(3))
    return f"{left} {value} {word()} {word()}"[:64], value


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(6)
    return pii.Tagger().fit(*pii.training_set([example(rng)[0] for _ in range(500)]), epochs=6)


def test_tagger_finds_held_out_values_in_long_texts(tagger):
    rng = random.Random(8)
    seen = hit = 0
    while seen < 100:
        window, value = example(rng)
        if not value.startswith("version"):
            text = "some words here " * rng.randint(0, 12) + window + " " + value + " and the end"
            found = pii.added_spans(tagger, [text], [[]])[0]
            at = text.rindex(value)
            hit += any(a < at + len(value) and at < b for _, a, b in found)
            seen += 1
    assert hit >= 85
    assert pii.added_spans(tagger, ["no digits in this text at all", ""], [[], []]) == [[], []]
    # a value over a window's edge is found once
    text = "x" * 55 + " 10.20.30.40 " + "y" * 60
    assert len(pii.added_spans(tagger, [text], [[]])[0]) == 1


def test_query_columns_redaction_and_odd_rows(spark, tagger):
    texts = [None, "", "mail a.b@c.de or +1 (555) 010-9999, card 4111 1111 1111 1111, ip 10.0.0.1!", "é" * 50_000 + " a@b.co"]
    df = documents(spark, texts, [(2, texts[2])]).withColumnRenamed("lang", "spans")
    got = sorted(rows(pii.find_personal_data(df, tagger, ["doc_id"])))
    assert len(got) == 5
    for row in got:
        base = pii.base_spans(texts[row[0]] or "")
        assert row[1:5] == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert row[5] == hashlib.sha256(pii._joined(base).encode()).hexdigest()
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base} <= set(row[6].split(","))
    clean = pii.remove_personal_data(df, None)
    assert clean.columns == df.columns
    by_id = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert by_id[0] is None and by_id[1] == "" and by_id[2] == "mail <EMAIL> or <PHONE>, card <CARD>, ip <IP>!"
    assert rows(pii.find_personal_data(df.where("false"), tagger, ["doc_id"])) == []
    assert pii.train(documents(spark, ["none here", None])) is None


def test_training_reads_the_corpus(spark):
    df = documents(spark, [f"write to user{i}@mail{i}.org about item {i}" for i in range(80)])
    tagger = pii.train(df, windows=60)
    assert isinstance(tagger, pii.Tagger)


@pytest.fixture(scope="module")
def spelled_tagger():
    """Trained on windows like those of a corpus: values with digits, and prose with ``at``."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8)))
    prose = [(" ".join(word() for _ in range(rng.randint(1, 6))) + " at " + " ".join(word() for _ in range(10)) + ".")[:64] for _ in range(pii.WINDOWS)]
    return pii.Tagger().fit(*pii.training_set([example(rng)[0] for _ in range(200)] + prose))


SPELLED = ["jane.doe at example.com", "bob at mail.org", "Li_Wei AT uni DOT edu", "maria[at]acme-corp[dot]net", "peter.k (at) example (dot) org", "ann [at] mail [dot] com"]


def test_emails_without_digit_or_at_sign_are_found_and_redacted(spark, spelled_tagger):
    rng = random.Random(13)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8)))
    texts, hit = [], 0
    for n in range(120):
        value = SPELLED[n % len(SPELLED)]
        text = " ".join(word() for _ in range(rng.randint(0, 30))) + f" {value} " + " ".join(word() for _ in range(rng.randint(3, 30)))
        at = text.index(value)
        found = pii.added_spans(spelled_tagger, [text], [pii.base_spans(text)])[0]
        hit += any(k == 0 and a < at + len(value) and at < b for k, a, b in found)
        texts.append(text)
    assert hit >= 100
    clean = [r["text"] for r in pii.remove_personal_data(documents(spark, texts), spelled_tagger).collect()]
    assert sum("<EMAIL>" in t for t in clean) >= 100
    prose = [" ".join([word(), word(), "at", word(), word(), word()]) + "." for _ in range(200)]
    assert sum(map(len, pii.added_spans(spelled_tagger, prose, [[]] * len(prose)))) <= 4


def test_windows_and_spans_take_separators_in_words():
    for text in ("a at b", "a[AT]b", "(dot)", "x_at_y", "1", "@"):
        assert pii._starts("w " * 40 + text) == [32, 64], text
    assert pii._starts("what dots, état, attic " * 9) == []


def test_training_takes_windows_with_separators_in_words_only(spark):
    df = documents(spark, [f"we {'very ' * (i % 7)}often meet at the old gate of town number" for i in range(40)])
    assert isinstance(pii.train(df, windows=20), pii.Tagger)
