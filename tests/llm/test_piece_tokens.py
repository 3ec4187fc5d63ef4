"""The table encoder against the sentencepiece library itself and against plain BPE merging."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from roundlens.llm import piece_tokens

from .conftest import SCHEMA, doc_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "aa", " ", "  ", "   ", "\n", "\t", "é", "日本", "🎉", "▁", "▁▁", "the", " the", "ing", "0", "12", ".",
         "--", "==", "<s>", "<0x41>", "\x00", "한국", "ß", "(", "{", "über", "​", "�"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return piece_tokens.Encoder(piece_tokens.learn_table(f.read()))


def test_encoder_equals_library(encoder, library):
    rng = random.Random(4)
    for _ in range(4000):
        s = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert encoder.encode(s) == library.encode(s)
    for unit in ("a", " ", "ab ", "=", "aba", "\n", "▁"):  # ties and long repeats
        for n in (1, 2, 3, 15, 16, 17, 31, 33, 200, 5000):
            assert encoder.encode(unit * n + "x") == library.encode(unit * n + "x")


@settings(max_examples=300, deadline=None, derandomize=True)
@given(text=st.text(max_size=60))
def test_any_text(encoder, library, text):
    assert encoder.encode(text) == library.encode(text)
    assert encoder.decode(encoder.encode(text)) == library.decode(library.encode(text))


def test_every_entry_and_pair(encoder, library):
    rng = random.Random(6)
    entries = [t for t in encoder.ids if "▁" not in t[1:]]
    for a, b in zip(rng.sample(entries, 4000), rng.sample(entries, 4000)):
        assert encoder.encode(a + b) == library.encode(a + b)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(piece_tokens, "CACHE_PIECES", 3)
    with open(PATH, "rb") as f:
        small = piece_tokens.Encoder(piece_tokens.learn_table(f.read()))
    text = "the quick  brown fox -- jumps over   the lazy dog " * 20
    assert small.encode(text) == library.encode(text)


def test_plain_merging_is_leftmost_first():
    scores = {"aa": -1.0, "aab": -2.0, "ab": -3.0}
    assert piece_tokens.merge_all(list("aaab"), scores) == (["aa", "ab"], ("a", "b"))


def test_other_models_are_refused(monkeypatch):
    class Fake:
        def __init__(self, **_):
            pass

        vocab_size = staticmethod(lambda: 2)
        is_byte = is_control = is_unknown = is_unused = staticmethod(lambda i: False)
        id_to_piece = staticmethod(lambda i: "ab"[i])
    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Fake)
    with pytest.raises(ValueError, match="byte fallback"):
        piece_tokens.learn_table(b"")


def test_documents(spark, library):
    rows = doc_rows() + [(50, "word " * 30000 + "  end", "en", "a", 1, "x", 0.0), (51, "x" * 70000, "en", "a", 1, "x", 0.0)]
    want = []
    for r in rows:
        ids = library.encode(r[1] or "")
        want.append((r[0], ids, library.decode(ids)))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [(r["doc_id"], list(r["ids"]), r["decoded"]) for r in piece_tokens.encode_pieces(docs, PATH).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    report = [tuple(r) for r in piece_tokens.token_report(docs, PATH).collect()]
    assert sorted(report, key=repr) == sorted(
        [(i, len(ids), sha(",".join(map(str, ids))), sha(text)) for i, ids, text in want], key=repr)


def test_no_documents(no_docs):
    assert piece_tokens.token_report(no_docs, PATH).collect() == []
