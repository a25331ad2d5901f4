"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A block of texts becomes one flat array of character symbols. It is cut wherever
no vocabulary piece contains the two adjacent characters, so no merge can cross a
cut; the distinct runs ("words") are then merged together in rounds: a segmented
minimum finds every word's best pair rank, the leftmost such pair of each word is
merged in all words at once, the arrays are compacted, finished words leave, and
the rounds end when no pair remains. One pair per word and round, because a merge
may open a pair of a better rank. Words of more than ``LONG_WORD`` symbols (no cut
for hundreds of characters) merge the same pairs in the same order with a heap, so
their cost stays n log n. Characters without a piece become byte pieces.

Only for BPE models with byte fallback and identity normalisation, which the
constructor checks on probe texts against the library.

Defined results: null is the empty text; an empty text has no dummy prefix, hence
only the begin and end ids; texts are encoded whole.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts
from .textscan import prefix_codes, substring_hash

LONG_WORD = 256
_NONE = np.int32(2**31 - 1)
_SPACE = "▁"


class PieceBPE:
    """Vocabulary tables of a model file (a few MB, fixed by the vocabulary)."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.size, self.bos, self.eos = n, sp.bos_id(), sp.eos_id()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        piece = {sp.id_to_piece(i): i for i in plain}
        # equal scores share a rank: the leftmost pair then goes first
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        pairs, chars = [], set()
        for text, i in piece.items():
            chars.update(text)
            for cut in range(1, len(text)):
                left, right = piece.get(text[:cut]), piece.get(text[cut:])
                if left is not None and right is not None:
                    pairs.append((left * n + right, i, order[sp.get_score(i)]))
        pairs.sort()
        self.pair_key = np.array([p[0] for p in pairs] + [2**62], dtype=np.int64)
        self.pair_to = np.array([p[1] for p in pairs] + [0], dtype=np.int32)
        self.pair_rank = np.array([p[2] for p in pairs] + [_NONE], dtype=np.int32)
        # characters of any piece, numbered from 1; 0 is every other character
        self.char_code = np.zeros(0x110000, dtype=np.uint16)
        listed = sorted(chars)
        self.char_code[[ord(c) for c in listed]] = np.arange(1, len(listed) + 1)
        joined = np.zeros((len(listed) + 1, len(listed) + 1), dtype=bool)
        code = {c: k + 1 for k, c in enumerate(listed)}
        for text in piece:
            for a, b in zip(text, text[1:]):
                joined[code[a], code[b]] = True
        self.joined = np.packbits(joined, axis=None)
        self.width = len(listed) + 1
        # first symbol of a character: its piece, or size + code point without one
        self.char_piece = np.arange(0x110000, dtype=np.int32) + n
        for c, i in piece.items():
            if len(c) == 1:
                self.char_piece[ord(c)] = i
        byte_id = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        self.byte_id = np.array([byte_id[f"<0x{b:02X}>"] for b in range(256)], dtype=np.int32)
        # bytes of each id, for decoding
        out = [b""] * n
        for text, i in piece.items():
            out[i] = text.replace(_SPACE, " ").encode()
        for b, i in enumerate(self.byte_id):
            out[i] = bytes([b])
        self.out_at = np.concatenate([[0], np.cumsum([len(x) for x in out])])
        self.out = np.frombuffer(b"".join(out), dtype=np.uint8)
        self.is_byte = np.zeros(n, dtype=bool)
        self.is_byte[self.byte_id] = True
        for probe in ("", " a  b ", "ﬁ Ⅷ　\n\tx \U0001f916é"):
            ids = sp.encode(probe, add_bos=True, add_eos=True)
            mine, _ = self.encode(pa.array([probe]))
            if mine.tolist() != ids or self.decode(mine, np.array([0, len(mine)]))[0].decode() != sp.decode(ids):
                raise ValueError(f"{path} is not a byte-fallback BPE model with identity normalisation")

    # -- encoding -------------------------------------------------------------

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of symbol pairs."""
        key = left.astype(np.int64) * self.size + right
        key[(left >= self.size) | (right >= self.size)] = -1
        at = np.searchsorted(self.pair_key, key)
        hit = self.pair_key[at] == key
        return np.where(hit, self.pair_rank[at], _NONE), self.pair_to[at]

    def _merge_rounds(self, sym: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words (``start``: offsets, one more at the end) to their pieces."""
        n_words = len(start) - 1
        word = np.repeat(np.arange(n_words), np.diff(start))
        done_sym, done_word = [], []
        rank = np.full(len(sym), _NONE, dtype=np.int32)
        to = np.zeros(len(sym), dtype=np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], to[inner] = self._pairs(sym[inner], sym[inner + 1])
        while len(sym):
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.append(head, len(sym)))
            best = np.minimum.reduceat(rank, head)
            open_word = best < _NONE
            if not open_word.all():  # finished words leave
                stay = np.repeat(open_word, length)
                done_sym.append(sym[~stay])
                done_word.append(word[~stay])
                sym, word, rank, to = sym[stay], word[stay], rank[stay], to[stay]
                best, length = best[open_word], length[open_word]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(best, length))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]  # leftmost of each word
            sym[at] = to[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # each earlier merge dropped one symbol
            sym, word = sym[keep], word[keep]
            rank, to = rank[keep], to[keep]
            near = np.zeros(len(sym), dtype=bool)
            near[at] = near[at[at > 0] - 1] = True
            touched = np.flatnonzero(near)
            rank[touched] = _NONE
            touched = touched[touched + 1 < len(sym)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched], to[touched] = self._pairs(sym[touched], sym[touched + 1])
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int32)
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return sym[order], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n_words))]).astype(np.int64)

    def _merge_long(self, sym: np.ndarray) -> np.ndarray:
        """One long word: the same merges in the same order, by a heap of pairs."""
        n = len(sym)
        sym = sym.tolist()
        rank, to = (x.tolist() for x in self._pairs(np.array(sym[:-1], np.int32), np.array(sym[1:], np.int32)))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, sym[i], sym[i + 1], t) for i, (r, t) in enumerate(zip(rank, to)) if r < _NONE]
        heapq.heapify(heap)
        table: dict[tuple[int, int], tuple[int, int]] = {}
        while heap:
            _, i, a, b, t = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # the pair is gone
            sym[i], sym[j] = t, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if left >= 0 and right < n:
                    pair = sym[left], sym[right]
                    if pair not in table:
                        r, m = self._pairs(np.array([pair[0]], np.int32), np.array([pair[1]], np.int32))
                        table[pair] = int(r[0]), int(m[0])
                    r, m = table[pair]
                    if r < _NONE:
                        heapq.heappush(heap, (r, left, *pair, m))
        return np.array([s for s in sym if s >= 0], dtype=np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with begin and end ids, offsets of the texts)."""
        rows = ["" if t is None else t for t in texts.to_pylist()]
        full = [_SPACE + t.replace(" ", _SPACE) if t else "" for t in rows]
        n_chars = np.array([len(t) for t in full], dtype=np.int64)
        points = np.frombuffer("".join(full).encode("utf-32-le"), dtype=np.uint32)
        first = np.concatenate([[0], np.cumsum(n_chars)])
        n = len(points)
        if n:
            code = self.char_code[points].astype(np.int64)
            flat = code[:-1] * self.width + code[1:]
            linked = (self.joined[flat >> 3] >> (7 - (flat & 7)).astype(np.uint8)) & 1
            cut = np.ones(n, dtype=bool)
            cut[1:] = linked == 0
            cut[first[:-1][n_chars > 0]] = True
            start = np.flatnonzero(cut)
        else:
            start = np.zeros(0, dtype=np.int64)
        end = np.append(start[1:], n) if len(start) else start
        ids, at, which = self._encode_words(points, start, end)
        # one run of ids for each text, between the begin and the end id
        size = np.diff(at)[which]
        word_first = np.searchsorted(start, first)
        total = np.concatenate([[0], np.cumsum(size)])
        per_text = total[word_first[1:]] - total[word_first[:-1]] + 2
        offsets = np.concatenate([[0], np.cumsum(per_text)])
        out = np.empty(offsets[-1], dtype=np.int32)
        out[offsets[:-1]], out[offsets[1:] - 1] = self.bos, self.eos
        body = np.ones(len(out), dtype=bool)
        body[offsets[:-1]] = body[offsets[1:] - 1] = False
        out[body] = ids[np.repeat(at[:-1][which] - total[:-1], size) + np.arange(total[-1])]
        return out, offsets

    def _encode_words(self, points: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Ids of the distinct words, their offsets, and each word's number among them."""
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64)
        hashed = substring_hash(prefix_codes(points), start, end)
        _, rep, which = np.unique(hashed, return_index=True, return_inverse=True)
        # words count as equal only if their characters are
        size = end - start
        shift = np.repeat(start[rep[which]] - start, size)
        same = (size == size[rep[which]])
        flat = np.arange(len(points))
        if not same.all() or (points[np.minimum(flat + shift, len(points) - 1)] != points).any():
            rep, which = np.arange(len(start)), np.arange(len(start))
        start, size = start[rep], size[rep]
        sym = self.char_piece[points]
        long = np.flatnonzero(size > LONG_WORD)
        short = np.flatnonzero(size <= LONG_WORD)
        offs = np.concatenate([[0], np.cumsum(size[short])])
        got, at = self._merge_rounds(sym[np.repeat(start[short] - offs[:-1], size[short]) + np.arange(offs[-1])], offs)
        runs, sizes = [got], np.zeros(len(start), dtype=np.int64)
        sizes[short] = np.diff(at)
        for w in long:
            runs.append(self._merge_long(sym[start[w] : start[w] + size[w]]))
            sizes[w] = len(runs[-1])
        place = np.empty(len(start), dtype=np.int64)  # short words first, then the long ones
        order = np.concatenate([short, long])
        place[order] = np.arange(len(order))
        flat_ids = np.concatenate(runs)
        flat_at = np.concatenate([[0], np.cumsum(sizes[order])])
        which = place[which]
        # characters without a piece: one byte piece for each byte
        bare = np.flatnonzero(flat_ids >= self.size)
        if len(bare):
            spelled = [chr(p).encode() for p in (flat_ids[bare] - self.size)]
            width = np.ones(len(flat_ids), dtype=np.int64)
            width[bare] = [len(s) for s in spelled]
            to = np.concatenate([[0], np.cumsum(width)])
            wide = np.repeat(flat_ids, width)
            if len(spelled):
                raw = np.frombuffer(b"".join(spelled), dtype=np.uint8)
                wide[wide >= self.size] = self.byte_id[raw]
            flat_ids, flat_at = wide, to[flat_at]
        return flat_ids, flat_at, which

    # -- decoding -------------------------------------------------------------

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of each run of ids; control ids have no text, the dummy prefix goes."""
        size = np.diff(self.out_at)[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self.out[np.repeat(self.out_at[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
        texts = []
        for lo, hi in zip(offsets[:-1], offsets[1:]):
            raw = flat[total[lo] : total[hi]]
            text_ids = ids[lo:hi]
            lead = lo + int(np.argmax(size[lo:hi] > 0)) if hi > lo else lo
            if raw[:1] == b" " and not self.is_byte[ids[lead]]:
                raw = raw[1:]
            if self.is_byte[text_ids].any():  # byte pieces may spell no valid text
                raw = raw.decode("utf-8", "mark_each_byte").encode()
            texts.append(raw)
        return texts


# one U+FFFD for each byte that belongs to no character
codecs.register_error("mark_each_byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))


def load(path: str) -> PieceBPE:
    return PieceBPE(path)


_ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
_DECODED = T.StructType([T.StructField("decoded", T.StringType())])
_DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def encode(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids``, begin and end ids included."""
    model = df.sparkSession.sparkContext.broadcast(load(model_path))

    def run(texts):
        ids, offs = model.value.encode(texts)
        return {"ids": pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids, pa.int32()))}

    return map_texts(df, text, run, _ENCODED, df.columns if keep is None else keep)


def encode_decode(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids`` and ``decoded`` (what the ids spell)."""
    model = df.sparkSession.sparkContext.broadcast(load(model_path))

    def run(texts):
        ids, offs = model.value.encode(texts)
        return {
            "ids": pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids, pa.int32())),
            "decoded": pa.array([t.decode() for t in model.value.decode(ids, offs)], pa.string()),
        }

    return map_texts(df, text, run, T.StructType(list(_ENCODED) + list(_DECODED)), df.columns if keep is None else keep)


def digest(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """n_tokens and the digests of the ids and of the decoded text, made where the
    ids are, so that they never leave the task."""
    model = df.sparkSession.sparkContext.broadcast(load(model_path))

    def run(texts):
        ids, offs = model.value.encode(texts)
        raw = ids.astype("<u4").tobytes()
        return {
            "n_tokens": pa.array(np.diff(offs), pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(offs[:-1], offs[1:])]),
            "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in model.value.decode(ids, offs)]),
        }

    return map_texts(df, text, run, _DIGEST, df.columns if keep is None else keep)
