"""Periodic runs against plain brute force: every period tried at every word."""

import hashlib
import random
import zlib

import pytest

from roundlens.llm import periodic_runs

from .conftest import SCHEMA, doc_rows


def brute_runs(w):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(12, 2 * q):
                best.setdefault((s, i + q), q)
    return sorted((s, q, e - s) for (s, e), q in best.items())


def collapsed(w, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def stitched(parts):
    best, by_period = {}, {}
    for p, a, b in sorted(parts):
        spans = by_period.setdefault(p, [])
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    for p in sorted(by_period):
        for a, b in by_period[p]:
            if b - a + p >= max(12, 2 * p):
                best.setdefault((a, b + p), p)
    return sorted((s, q, e - s) for (s, e), q in best.items())


@pytest.mark.parametrize("tile", [1 << 16, 6, 16])
def test_fragments_find_every_run(monkeypatch, tile):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile)
    monkeypatch.setattr(periodic_runs, "CELLS", 64)
    rng = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 120), rng.choice([1, 2, 3, 6])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < .6:
                p, a = rng.randint(1, n), rng.randrange(n)
                tail = w[a:]
                w = w[:a] + [tail[i % p % len(tail)] for i in range(n - a)]
            texts.append(w)
        assert [stitched(x) for x in periodic_runs.fragments(texts)] == [brute_runs(w) for w in texts]


def test_z_function():
    for pattern, text in (([1, 2, 1], [1, 2, 1, 2, 1, 1]), ([], [3, 3]), ([5], [])):
        want = []
        for i in range(len(text)):
            k = 0
            while k < len(pattern) and i + k < len(text) and pattern[k] == text[i + k]:
                k += 1
            want.append(k)
        assert periodic_runs.z_matches(pattern, text) == want


EXTRA = [(20, "the the " * 30, "en", "a", 1, "x", 0.0), (20, "the the " * 30, "en", "a", 1, "x", 0.0),
         (None, " a b  c\td\n" * 9 + "tail\x1fone", None, None, None, None, None),
         (30, " ".join(f"v{i * i % 1009}" for i in range(300)) + " e f" * 4000 + " end", "en", "a", 1, "x", 0.0)]


@pytest.mark.parametrize("tile", [1 << 16, 12])
def test_runs_and_texts(spark, monkeypatch, tile):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile)
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", 500)
    rows = doc_rows() + EXTRA
    want = []
    for r in rows:
        w = [x.decode() for x in (r[1] or "").encode().split()]
        runs = brute_runs(w) if len(w) < 3000 else [(300, 2, 8000)]
        want.append((r[0], runs, collapsed(w, runs)))
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"])
           for r in periodic_runs.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_report_plants_and_digests(spark):
    rows = doc_rows() + EXTRA[:3] + [(i, " ".join(f"p{k}" for k in range(i % 90)), "en", "a", 1, "x", 0.0)
                                     for i in range(100, 200)]
    want, planted = [], 0
    for r in rows:
        w = [x.decode() for x in (r[1] or "").encode().split()]
        h = None if r[0] is None else zlib.crc32(str(r[0]).encode())
        if h is not None and h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            planted += 1
        runs = brute_runs(w)
        best = min(((-n, s, q) for s, q, n in runs), default=None)
        four = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        want.append((r[0], len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    got = [tuple(r) for r in periodic_runs.run_report(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert planted and sorted(got, key=repr) == sorted(want, key=repr)


def test_no_documents(no_docs):
    assert periodic_runs.run_report(no_docs).collect() == []
