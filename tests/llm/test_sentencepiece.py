import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece
from fixtures import documents, rows

from flightmarts.llm import queries, sentencepiece_bpe


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def model():
    return sentencepiece_bpe.load(queries.PIECE_MODEL)


def texts():
    rng = random.Random(2)
    alphabet = "aabcdet hen  \n\t.,▁éñ漢\U0001f916\x00<s>0xAF"
    out = ["".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(300)]
    out += [None, "", " ", "  ", " " * 900, "a" * 2000, "ab" * 1500, "\n" * 400, "é" * 500, "▁" * 300, "<s> </s> <unk> <0x41>"]
    return out + ["".join(rng.choices("ABCDEFGHIJKLMabcdefghij0123456789+/", k=5000))]


def test_ids_and_text_equal_the_library(model, library):
    own = texts()
    ids, at = model.encode(pa.array(own))
    decoded = model.decode(ids, at)
    for i, text in enumerate(own):
        want = library.encode(text or "", add_bos=True, add_eos=True)
        assert ids[at[i] : at[i + 1]].tolist() == want
        assert decoded[i].decode() == library.decode(want)


def test_long_words_merge_alike_in_rounds_and_by_heap(model, library, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices("etaoinshrdlu", k=1500))
    for limit in (8, 10_000):
        monkeypatch.setattr(sentencepiece_bpe, "LONG_WORD", limit)
        ids, _ = model.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_bytes_that_spell_no_text(model, library):
    ids = [1, 3 + 0xE6, 3 + 0xBC, 263, 3 + 0x41, 2]
    import numpy as np

    assert model.decode(np.array(ids), np.array([0, len(ids)]))[0].decode() == library.decode(ids)


def test_digest_query_columns(spark, library):
    own = [None, "", "Hello  wörld", "x" * 100_000]
    df = documents(spark, own, [(2, "Hello  wörld")]).withColumnRenamed("lang", "ids_sha256")
    got = sorted(rows(sentencepiece_bpe.digest(df, queries.PIECE_MODEL, keep=["doc_id"])))
    want = []
    for i, t in [*enumerate(own), (2, "Hello  wörld")]:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    empty = sentencepiece_bpe.encode_decode(df.where("false"), queries.PIECE_MODEL)
    assert rows(empty) == [] and empty.columns[-2:] == ["ids", "decoded"]


def test_random_byte_pieces_decode_like_the_library(model, library):
    import random

    import numpy as np

    rnd = random.Random(4)
    for _ in range(400):
        ids = [1, *[3 + rnd.choice([0xE6, 0xBC, 0xA2, 0xF0, 0x9F, 0x98, 0x41, 0xC3, 0xED, 0xFF, rnd.randrange(256)]) if rnd.random() < 0.8 else rnd.randrange(300, 9000) for _ in range(rnd.randrange(1, 9))], 2]
        assert model.decode(np.array(ids), np.array([0, len(ids)]))[0].decode() == library.decode(ids), ids
