"""Personal data: exact patterns plus a character BiLSTM with a CRF layer.

``base_spans`` finds emails, IP addresses, card and phone numbers by rule. The tagger is
trained in numpy on windows of the corpus labelled by those rules, and on variants of them
in other spellings (spaces, dots, ``at``), so that it also finds what the patterns miss.
It reads windows of ``WINDOW`` characters that overlap by half; each window is decoded
by Viterbi, and the spans of all windows of a document are reconciled together: a
span cut by a window's edge yields to the neighbour that sees it whole, overlapping
spans of one kind join, and what contradicts a base span goes. Base spans always stay.

Every kind holds a digit or an ``@``, but an email may be spelled with the words ``at`` and
``dot`` instead, in any case, between brackets or not. Windows without a digit, an ``@`` or
one of these words are plain by definition and are not decoded. The words are common in
prose, so training also sees windows that hold nothing else, as they are and with a
spelled email put in. Training alone is bounded, twice: by the ``SAMPLE`` documents of the
smallest hash of their id, and by ``WINDOWS`` distinct windows of each sort (with a digit or
an ``@``, and with a separator in words only) over all those documents.

Defined results: null and empty texts have no spans; offsets are code points of the
whole text, end exclusive; repeated rows are read one by one; without any training window
the tagger adds nothing; a result column replaces an input column of its name.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fit_in_task, map_texts, materialize, ship

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 3_000
WINDOWS = 2_000  # training windows with a digit or an @, and as many with a separator in words only
WINDOW, STRIDE = 64, 32
HIDDEN, EMBED = 24, 12
EPOCHS, BATCH = 8, 64
COPIES = 2  # of a training window, with a value respelled or a spelled email put in
LEAST_P = 0.8  # mean marginal of an added span

# -- base rules -------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can't start inside a run of digits, so the run is entered at its start only
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
# separators of an email in words, between brackets or not: no letter or digit beside them
_SPELLED = re.compile(r"(?<![^\W_])(?:at|dot)(?![^\W_])", re.IGNORECASE)
_SIGN = re.compile(f"{_TRIGGER.pattern}|{_SPELLED.pattern}", re.IGNORECASE)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> list[tuple[int, int]]:
    """From each @ outwards, so that long runs without one cost nothing extra."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))
    return found


def _luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _TRIGGER.search(text) is None:
        return found
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(g.lstrip("0")) <= 3 and int(g[-3:]) <= 255 for g in m.groups())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return found


# -- the tagger -------------------------------------------------------------------

N_TAGS = 1 + 2 * len(KINDS)  # plain, then begin and inside of each kind
_CODES = 130  # 0 padding, ASCII + 1, 129 everything else
_NEVER = -1e4


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 128, points + 1, 129).astype(np.int64)


def _tags(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(length, dtype=np.int64)
    for kind, a, b in spans:
        if not out[a:b].any():
            out[a:b] = 2 + 2 * kind
            out[a] = 1 + 2 * kind
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Character embedding, one LSTM in each direction, linear emissions, CRF."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        p = {"embed": 0.3 * rng.standard_normal((_CODES, EMBED)).astype(np.float32)}
        for d in "fb":
            p[f"w{d}"], p[f"u{d}"] = init(EMBED, 4 * HIDDEN), init(HIDDEN, 4 * HIDDEN)
            p[f"c{d}"] = np.zeros(4 * HIDDEN, dtype=np.float32)
            p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
        p["out"], p["bias"] = init(2 * HIDDEN, N_TAGS), np.zeros(N_TAGS, dtype=np.float32)
        p["trans"] = np.zeros((N_TAGS, N_TAGS), dtype=np.float32)
        self.p = p
        # inside follows only begin or inside of its kind; a text can't start inside
        self.barred = np.zeros((N_TAGS, N_TAGS), dtype=np.float32)
        for k in range(len(KINDS)):
            self.barred[:, 2 + 2 * k] = _NEVER
            self.barred[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0

    def _lstm(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states of all steps; x is (steps, batch, embed)."""
        n, batch, _ = x.shape
        gates_x = x @ self.p[f"w{d}"] + self.p[f"c{d}"]
        u, h, c = self.p[f"u{d}"], np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
        out = np.empty((n, batch, HIDDEN), np.float32)
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            z = gates_x[t] + h @ u
            gate = _sigmoid(z[:, : 3 * HIDDEN])  # input, forget, output
            i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep is not None:
                keep.append((t, h, before, i, f, o, g, tc))
            h = o * tc
            out[t] = h
        return out

    def emissions(self, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """(steps, batch, tags) of windows (batch, steps)."""
        x = self.p["embed"][ids.T]
        tape = {d: [] if keep is not None else None for d in "fb"}
        hidden = np.concatenate([self._lstm(x, d, tape[d]) for d in "fb"], axis=2)
        if keep is not None:
            keep.update(x=x, hidden=hidden, tape=tape)
        return hidden @ self.p["out"] + self.p["bias"]

    def _alphas(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t = self.p["trans"] + self.barred
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0] + np.where(np.arange(N_TAGS) % 2 == 0, _NEVER, 0) * (np.arange(N_TAGS) > 0)
        for s in range(1, len(e)):
            a[s] = e[s] + _logsumexp(a[s - 1][:, :, None] + t, 1)
        for s in range(len(e) - 2, -1, -1):
            b[s] = _logsumexp(t + (e[s + 1] + b[s + 1])[:, None, :], 2)
        return a, b

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the negative log likelihood of the tags, per window."""
        p, keep = self.p, {}
        e = self.emissions(ids, keep)
        a, b = self._alphas(e)
        z = _logsumexp(a[-1], 1)
        n, batch, _ = e.shape
        marginal = np.exp(a + b - z[None, :, None])
        de = marginal.copy()
        gold = tags.T
        de[np.arange(n)[:, None], np.arange(batch)[None, :], gold] -= 1
        de = (de / batch).astype(np.float32)
        t = p["trans"] + self.barred
        pair = np.exp(a[:-1][:, :, :, None] + t + (e[1:] + b[1:])[:, :, None, :] - z[None, :, None, None])
        dt = pair.sum(axis=(0, 1))
        np.add.at(dt, (gold[:-1].ravel(), gold[1:].ravel()), -1)
        g = {"trans": (dt / batch).astype(np.float32), "bias": de.sum(axis=(0, 1))}
        g["out"] = keep["hidden"].reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, N_TAGS)
        dh_all, dx = de @ p["out"].T, 0
        for k, d in enumerate("fb"):
            u, dz_all = p[f"u{d}"], np.zeros((n, batch, 4 * HIDDEN), np.float32)
            dh, dc, du = 0, 0, np.zeros_like(u)
            for s, h, before, i, f, o, cell, tc in reversed(keep["tape"][d]):
                dh = dh + dh_all[s][:, k * HIDDEN : (k + 1) * HIDDEN]
                dc = dc + dh * o * (1 - tc * tc)
                dz = dz_all[s]
                dz[:, :HIDDEN] = dc * cell * i * (1 - i)
                dz[:, HIDDEN : 2 * HIDDEN] = dc * before * f * (1 - f)
                dz[:, 2 * HIDDEN : 3 * HIDDEN] = dh * tc * o * (1 - o)
                dz[:, 3 * HIDDEN :] = dc * i * (1 - cell * cell)
                du += h.T @ dz
                dh, dc = dz @ u.T, dc * f
            g[f"u{d}"], g[f"c{d}"] = du, dz_all.sum(axis=(0, 1))
            g[f"w{d}"] = keep["x"].reshape(-1, EMBED).T @ dz_all.reshape(-1, 4 * HIDDEN)
            dx = dx + dz_all @ p[f"w{d}"].T
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], ids.T.ravel(), dx.reshape(-1, EMBED))
        return g

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Tagger:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * max(1, -(-len(ids) // BATCH))
        for _ in range(epochs):
            order = rng.permutation(len(ids))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                step += 1
                rate = 0.02 * (1 - 0.9 * step / total)
                for k, g in self.gradients(ids[pick], tags[pick]).items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.99 * v2[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)
        return self

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best tags, their marginals), both (batch, steps)."""
        e = self.emissions(ids)
        a, b = self._alphas(e)
        marginal = np.exp(a + b - _logsumexp(a[-1], 1)[None, :, None])
        t = self.p["trans"] + self.barred
        best, back = a[0], np.zeros(e.shape, dtype=np.int8)
        for s in range(1, len(e)):
            via = best[:, :, None] + t
            back[s] = via.argmax(axis=1)
            best = e[s] + via.max(axis=1)
        tags = np.empty(e.shape[:2], dtype=np.int64)
        tags[-1] = best.argmax(axis=1)
        for s in range(len(e) - 1, 0, -1):
            tags[s - 1] = back[s][np.arange(e.shape[1]), tags[s]]
        p = np.take_along_axis(marginal, tags[:, :, None], axis=2)[:, :, 0]
        return tags.T, p.T


# -- training windows -------------------------------------------------------------


def _starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit, an @ or a separator in words."""
    found = {m.start() // STRIDE for m in _SIGN.finditer(text)}
    return sorted({max(0, k - j) * STRIDE for k in found for j in range(WINDOW // STRIDE)})


_SEPARATORS = [
    (" at ", "."), (" at ", "."), (" at ", " dot "), (" AT ", " DOT "), (" @ ", "."), ("[at]", "[dot]"), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", "."),
]
_WORD = re.compile(r"[A-Za-z]{2,}")
_GAP = re.compile(r"\s")
_LETTERS = list("abcdefghijklmnopqrstuvwxyz")
_ENDINGS = ("com", "org", "net", "edu", "io", "info", "de", "fr", "es", "co.uk")


def _part(words: list[str], rng: np.random.Generator) -> str:
    """One of the words, or a run of any letters."""
    return words[int(rng.integers(len(words)))] if rng.integers(2) else "".join(rng.choice(_LETTERS, 2 + int(rng.integers(8))))


def _spelled_email(words: list[str], rng: np.random.Generator, value: str = "") -> str:
    """An email with its separators in words: the value, or one made of words and of any letters."""
    if not value:
        local = ["", ".", "_", "-"][int(rng.integers(4))].join(_part(words, rng) for _ in range(1 + int(rng.integers(2))))
        domain = ["", "-", "."][int(rng.integers(3))].join(_part(words, rng) for _ in range(1 + int(rng.integers(2))))
        value = f"{local}@{domain}.{_ENDINGS[int(rng.integers(len(_ENDINGS)))]}"
    local, _, domain = value.partition("@")
    at, dot = _SEPARATORS[int(rng.integers(len(_SEPARATORS)))]
    return f"{local}{at}{domain.replace('.', dot)}"


def _respell(kind: int, value: str, rng: np.random.Generator, words: list[str]) -> str:
    """The value in a spelling that the base rules don't cover."""
    pick = int(rng.integers(3))
    if kind == 0:
        return _spelled_email(words, rng, value if pick else "")
    if kind == 1:
        return value.replace(".", [" . ", "[.]", ","][pick])
    digits = "".join(c for c in value if c.isdigit())
    if kind == 2:
        return [".", "/", "  "][pick].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    tail = [digits[-10:-7] or digits[:1], digits[-7:-4], digits[-4:]]
    return [f"({tail[0]}) {tail[1]}-{tail[2]}", "-".join(tail), ".".join(tail)][pick]


def training_set(windows: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of the windows, of respelled copies of those with a base span, and of
    copies, with a spelled email between the words, of those with a separator in words only."""
    rng = np.random.default_rng(seed)
    words = sorted({w.lower() for text in windows for w in _WORD.findall(text)} - {"at", "dot"}) or ["name"]
    rows = []
    for text in windows:
        spans = base_spans(text)
        rows.append((text, _tags(len(text), spans)))
        for _ in range(COPIES if spans else 0):
            kind, a, b = spans[int(rng.integers(len(spans)))]
            new = _respell(kind, text[a:b], rng, words)
            other = _tags(len(text), [s for s in spans if s != (kind, a, b) and (s[2] <= a or s[1] >= b)])
            tags = np.concatenate([other[:a], _tags(len(new), [(kind, 0, len(new))]), other[b:]])
            rows.append((text[:a] + new + text[b:], tags))
            if kind == 0:  # the words alone are no email
                new = " ".join([*(_part(words, rng) for _ in range(1 + int(rng.integers(3)))), ("at", "At", "dot")[int(rng.integers(3))], _part(words, rng)])
                rows.append((text[:a] + new + text[b:], np.concatenate([other[:a], np.zeros(len(new), np.int64), other[b:]])))
        if _TRIGGER.search(text) is None and _SIGN.search(text):
            gaps = [m.end() for m in _GAP.finditer(text)] or [0]
            for _ in range(COPIES):
                a, new = gaps[int(rng.integers(len(gaps)))], _spelled_email(words, rng)
                tags = np.concatenate([np.zeros(a, np.int64), _tags(len(new), [(0, 0, len(new))]), np.zeros(1 + len(text) - a, np.int64)])
                rows.append((f"{text[:a]}{new} {text[a:]}", tags))
    ids, tags = np.zeros((len(rows), WINDOW), np.int64), np.zeros((len(rows), WINDOW), np.int64)
    for i, (text, tag) in enumerate(rows):
        n = min(WINDOW, len(text))
        ids[i, :n], tags[i, :n] = _codes(text)[:n], tag[:n]
    return ids, tags


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, windows: int = WINDOWS) -> Tagger | None:
    """Fit on windows of ``sample`` documents, ``windows`` of those with a digit or an @ and as
    many with a separator in words only; None if there is neither."""
    ship(docs.sparkSession)

    def cut(batches):
        for batch in batches:
            out = [(t[s : s + WINDOW]) for t in batch.column("t").to_pylist() for s in _starts(t)]
            worded = [_TRIGGER.search(w) is None for w in out]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(worded, pa.bool_())], ["w", "worded"])

    picked = docs.select(F.col(doc_id).cast("string").alias("i")).where("i is not null").distinct().orderBy(F.xxhash64("i"), "i").limit(sample)
    cuts = (
        docs.select(F.col(doc_id).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null")
        .join(F.broadcast(picked), "i", "left_semi").select("t").mapInArrow(cut, "w string, worded boolean").distinct()
    )
    cuts = materialize(cuts.withColumn("place", F.xxhash64("w")), "pii-windows")
    # separators in words alone are plain words mostly: a share of their own, or they crowd out the values
    rows = cuts.where("not worded").orderBy("place", "w").limit(windows).unionByName(cuts.where("worded").orderBy("place", "w").limit(windows))
    return fit_in_task(rows, lambda part: Tagger().fit(*training_set(part["w"].to_pylist())), ["place", "w"])


# -- tagging documents ------------------------------------------------------------


def _overlaps(spans: list[tuple[int, int, int]], a: int, b: int) -> bool:
    return any(x < b and a < y for _, x, y in spans)


def added_spans(tagger: Tagger, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """What the tagger finds beyond the base spans, reconciled over each document."""
    rows = [(d, s) for d, t in enumerate(texts) for s in _starts(t)]
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    for lo in range(0, len(rows), 512):
        part = rows[lo : lo + 512]
        ids = np.zeros((len(part), WINDOW), dtype=np.int64)
        for i, (d, s) in enumerate(part):
            code = _codes(texts[d][s : s + WINDOW])
            ids[i, : len(code)] = code
        tags, p = tagger.decode(ids)
        for i in np.flatnonzero((tags > 0).any(axis=1)):
            d, s = part[i]
            size = min(WINDOW, len(texts[d]) - s)
            for at in np.flatnonzero((tags[i, :size] > 0) & (tags[i, :size] % 2 == 1)):
                kind, end = (int(tags[i, at]) - 1) // 2, int(at) + 1
                while end < size and tags[i, end] == 2 + 2 * kind:
                    end += 1
                # cut by an edge behind which the text goes on: the neighbour sees it whole
                if (at == 0 and s > 0) or (end == WINDOW and s + WINDOW < len(texts[d])):
                    if end - at < WINDOW - STRIDE:
                        continue
                found[d].append((kind, s + int(at), s + end, float(p[i, at:end].mean())))
    out = []
    for d, spans in enumerate(found):
        joined: list[list] = []
        for kind, a, b, p in sorted(spans):
            if joined and joined[-1][0] == kind and a < joined[-1][2]:
                joined[-1][2] = max(b, joined[-1][2])
                joined[-1][3] = max(p, joined[-1][3])
            else:
                joined.append([kind, a, b, p])
        kept: list[tuple[int, int, int]] = []
        for kind, a, b, p in sorted(joined, key=lambda x: (-x[3], x[1])):
            value = texts[d][a:b]
            sign = _SIGN if kind == 0 else _TRIGGER  # only an email may be spelled without a digit or an @
            if p >= LEAST_P and sign.search(value) and not _overlaps(base[d], a, b) and not _overlaps(kept, a, b):
                kept.append((kind, a, b))
        out.append(sorted(kept))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span (or run of overlapping ones) gives way to the name of its kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


_FOUND = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans", "redacted")]
)


def find_personal_data(docs: DataFrame, tagger: Tagger | None, keep: list[str], text: str = "text", with_text: bool = False) -> DataFrame:
    """``keep`` columns plus the base counts and digest, all spans, and on request the
    text with the spans redacted (null stays null)."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    fields = T.StructType([f for f in _FOUND if with_text or f.name != "redacted"])

    def run(column):
        rows = column.to_pylist()
        texts = [t or "" for t in rows]
        base = [base_spans(t) for t in texts]
        more = added_spans(shared.value, texts, base) if shared.value is not None else [[] for _ in texts]
        made = {f"n_{k}": pa.array([sum(s[0] == i for s in b) for b in base], pa.int64()) for i, k in enumerate(KINDS)}
        made["base_sha256"] = pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base])
        made["spans"] = pa.array([_joined(b + m) for b, m in zip(base, more)], pa.string())
        if with_text:
            made["redacted"] = pa.array([None if t is None else redact(t, b + m) for t, b, m in zip(rows, base, more)], pa.string())
        return made

    return map_texts(docs, text, run, fields, keep)


def remove_personal_data(docs: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """The documents with every span redacted, with the columns of ``docs``."""
    names = docs.columns
    own = docs.select(F.struct(*names).alias("doc"), F.col(text).alias("scanned"))
    found = find_personal_data(own, tagger, ["doc"], text="scanned", with_text=True)
    return found.select(*[F.col("redacted").alias(c) if c == text else F.col("doc")[c].alias(c) for c in names])
