"""op8 against planted secrets: candidates of every assignment, statistics of every document."""

from collections import Counter

import numpy as np
import pytest

from roundlens.llm import secrets


@pytest.mark.parametrize("text,value", [
    ('api_key = "kQzWmXnRtYpLsDvBhJgF"', "kQzWmXnRtYpLsDvBhJgF"), ('password="correcthorsebattery"', "correcthorsebattery"),
    ("password: hunter2", "hunter2"), ("password=Tr0ub4dor&3!xQ, then", "Tr0ub4dor&3!xQ"),
    ("see postgres://app:s3cr3tPw@db/x", "s3cr3tPw"), ('{"db_password": "a b\'c", "x": 1}', "a b'c"),
    ("http://h/x?token=abc&y=2", "abc"), ("my_password1=foo", "foo"), ("Authorization: Bearer abc.def", "abc.def")])
def test_assigned_values(text, value):
    found = {text[s:e]: secrets.label_rules(v, b, a) for s, e, v, b, a in secrets.candidates(text)}
    assert value in found and (found[value] == 1 or text.startswith("my_"))


def test_not_assigned():
    assert secrets.candidates("author: John wrote the pass on key and secret things") == []
    assert secrets.label_rules("None", "password = ") == 0


def test_key_block_without_end():
    key = "-----BEGIN PRIVATE KEY-----\n" + ("A" * 63 + "+\n") * 3 + "Qx=="
    text = f"{key}\nplain text goes on here"
    assert [text[s:e] for s, e, *_ in secrets.candidates(text)] == [key]
    assert [c[2] for c in secrets.candidates("-----BEGIN PRIVATE KEY----- and words")] == ["-----BEGIN PRIVATE KEY-----"]


def test_spans_do_not_overlap():
    text = 'token = "ghp_' + "a1" * 20 + '" secret=postgres://u:pw12345678@h password=1234567890abc'
    spans = [c[:2] for c in secrets.candidates(text)]
    assert spans and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_statistics_of_all_documents(spark, monkeypatch):
    """A word of a few of many documents is in the dictionary, and the transitions count every word."""
    monkeypatch.setattr(secrets, "HELD_WORDS", 50, raising=False)
    texts = [f"common {'rareword' if i % 3000 == 1 else 'often'} {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q" for i in range(9000)]
    lang = secrets.fit_language(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {"common", "often", "rareword"} <= lang.words
    pairs = np.ones((128, 128))
    for (a, b), n in Counter(p for t in texts for w in t.split() for p in zip(w, w[1:])).items():
        pairs[ord(a), ord(b)] += n
    assert np.allclose(lang.pairs, np.log(pairs / pairs.sum(axis=1, keepdims=True)))


def test_features_see_the_whole_candidate():
    lang = secrets.Language(frozenset({"word"}), secrets.np.zeros((128, 128)))
    short, long = (secrets.features("Ab" * 300 + tail, "", "", None, lang) for tail in ("", "9_=" * 400 + "word"))
    digits, other, covered, ends = 3, 6, 10, 18
    assert short[digits] == short[other] == short[covered] == 0
    assert long[digits] == 400 / 1804 and long[other] == 800 / 1804 and long[covered] == 4 / 1804
    assert [secrets.features("A" * 600 + c, "", "", None, lang)[ends] for c in "A="] == [0, 1]
