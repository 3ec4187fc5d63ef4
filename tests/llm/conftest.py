import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LOREM = [f"w{i}{'abcdefgh'[i % 8]}" for i in range(400)]


def words(a, b):
    return " ".join(LOREM[a:b])


def doc_rows():
    """Nulls, empty and short texts, ties, repeated rows, near copies, a very long text, shared passages."""
    base = words(0, 90)
    near = base.replace("w40a", "changed")
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "fr", "b"), (4, None, None, None),
        (5, "", "en", "b"), (6, "one two three", "de", None), (7, "one two  three", "de", "b"),
        (8, words(100, 200), "en", "c"), (9, words(90, 100) + " " + words(120, 190), "en", "c"),
        (10, "!!! 123 ???", "en", "c"), (11, words(200, 260) * 40, "en", "a"), (12, "héé Ünï " * 30, "fr", "b"),
        (13, "abc" * 100, "en", "a"), (14, "x\x00y " + words(300, 360), "en", "a"), (1, base, "en", "a"),
        (15, words(300, 400).upper(), "en", "a"), (16, words(210, 240) + " tail", "en", "zz"), (None, words(0, 30), "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), "extra", 7.0) for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, comp string, score double"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(doc_rows(), SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
