"""The bitmap manifest against a manifest built by sorting, and its bitmaps against sets."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundlens.llm import bitmap_manifest as bm

from .conftest import SCHEMA, doc_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, change=lambda t: t):
    doc_id, text, lang, source, n_chars = row[:5]
    text = text if text is None else change(text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def lifted(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[k:k + 16])) for k in range(0, len(low), 16)])
    return levels


def path(levels, k):
    out = []
    for level in levels[:-1]:
        start = k - k % 16
        out.append(("".join(level[start:k]), "".join(level[k + 1:start + 16])))
        k //= 16
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: lifted([leaf_of(r) for r in groups[g]]) for g in names}
    top = lifted([trees[g][-1][0] for g in names])
    out = []
    for j, g in enumerate(names):
        for k, r in enumerate(groups[g]):
            whole = path(trees[g], k) + path(top, j)
            now = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = leaf_of(r, lambda t: t.translate(LOW))
            for a, b in whole:
                now = sha(a + now + b)
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in whole)), now,
                        now == top[-1][0]))
    return sorted(out, key=repr)


def many_rows():
    rng = random.Random(9)
    ids = [*range(300), *(65536 + 7 * k for k in range(200)), -5, -70000, 1 << 40, (1 << 62) + 1, -(1 << 63), (1 << 63) - 1]
    rows = [(i, f"Text {i}", "en", f"s{rng.randrange(3)}", i % 100, "c", 0.0) for i in ids]
    rows += [(9, f"Other {k}", "en", "s1", 1, "c", 0.0) for k in range(40)]          # one id on many texts
    rows += [(9, "Same", "en", "s1", 1, "c", 0.0)] * 50                              # and on equal rows
    rows += [(None, f"No id {k % 30}", None, "s1", None, "c", 0.0) for k in range(60)]
    rows += [(k, None, None, None, None, None, None) for k in range(20)]
    rows += [(1, "a", "b", "", 1, "c", 0.0), (None, "x", None, "only none", 1, "c", 0.0), (3, "é", "fr", "ß", 1, "c", 0.0)]
    return rows


@pytest.mark.parametrize("held,levels,block", [(1 << 20, 3, 1 << 14), (7, 1, 3)])
def test_manifest(spark, monkeypatch, held, levels, block):
    monkeypatch.setattr(bm, "HELD_IDS", held)
    monkeypatch.setattr(bm, "ROUND_LEVELS", levels)
    monkeypatch.setattr(bm, "BLOCK_ROWS", block)
    rows = many_rows() + [tuple(r[:7]) for r in doc_rows()]
    got = [tuple(r) for r in bm.manifest_report(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_one_row_and_none(spark, no_docs):
    row = [(7, "Lone", "en", "a", 4, "c", 0.0)]
    got = [tuple(r) for r in bm.manifest_report(spark.createDataFrame(row, SCHEMA)).collect()]
    assert got == brute(row) and got[0][1] == got[0][2] == got[0][3]
    assert bm.manifest_report(no_docs).collect() == []


def test_untampered_rows_verify(spark):
    docs = spark.createDataFrame(many_rows(), SCHEMA)
    got = bm.manifest(docs, fields=("doc_id", "text"), group="lang")
    assert got.filter("not verified").count() == 0 and got.select("root").distinct().count() == 1


def test_bitmaps_round_trip():
    rng = np.random.default_rng(2)
    for low in ([0], [65535], range(65536), range(100, 9000), rng.choice(65536, 30000, False), rng.choice(65536, 50, False),
                [*range(10), *range(500, 600), 65535]):
        ids = np.unique(np.array(list(low), np.uint16))
        assert np.array_equal(bm.unpack_ids(bm.pack_ids(ids)), ids)
    assert {bm.pack_ids(np.unique(np.array(x, np.uint16)))[0] for x in ([1, 5], list(range(900)))} == {0, 1}
    assert len(bm.pack_ids(np.arange(0, 65536, 2, dtype=np.uint16))) == 8193


def test_ranks_count_smaller_keys(spark):
    rng = random.Random(3)
    rows = [(f"g{rng.randrange(2)}", rng.choice([rng.randrange(-300, 300), rng.randrange(1 << 20), rng.randrange(1 << 50)]),
             rng.randrange(1, 4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, key long, n long").repartition(3)
    got = bm.rank_of(df.withColumn("n", F.col("n")), bm.rank_directory(df)[0])
    for r in got.collect():
        assert r["rank"] == sum(n for g, k, n in rows if g == r["g"] and k < r["key"])
        assert r["shared"] == (sum(n for g, k, n in rows if g == r["g"] and k == r["key"]) > 1)
