"""Periodic runs of words, found scale by scale and stitched by document and period.

A run is a maximal stretch of words with smallest period q that spans at least
two periods and ``MIN_WORDS`` words.  Periods are dealt to octaves.  Within one
octave a document is exploded into overlapping tiles: bands of evenly spaced
boundaries, each with the words that a comparison at its boundaries can reach.
The words equal to the word one period later form a stretch at least as long as
the boundary spacing, so every run holds a boundary of its octave, and the part
of that stretch within one spacing of the boundary is as long as the spacing.
Tiles are solved by themselves: two Z-functions at a boundary (words read
forwards and backwards) give that part for all periods of the octave at once;
boundaries at which no half of such a part matches (by block hash, which equal
blocks share) are passed over.  The parts are interval fragments; they are
shuffled by document and period and stitched where they touch.  Of stitched
intervals with equal ends the smallest period is the run.

A document of up to ``TILE_WORDS`` words is one tile per octave, so what is
shuffled grows with the repeats, not with the text.

Defined cases: a null or word-less text has no run and an empty rest; every row
is a document of its own, whether its doc_id is null or repeated; equal texts
have equal runs; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .spread import written
from .sqltext import CRC_TABLE, crc32

MIN_WORDS = 12
TILE_WORDS = 1 << 16
CHUNK_WORDS = 1 << 18   # words compared together in one task
CELLS = 1 << 19         # (boundary, period) pairs held at a time

DOCS = "key long, doc_id long, body binary, sha string, frags array<struct<period:int,lo:int,hi:int>>"


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(boundary spacing, first period, end of periods) of every octave a text of ``longest`` words needs.

    Periods 1 to 7 share a scale: a run of 12 words repeats at least 6 of them one period later.
    """
    spacing, lo, hi = MIN_WORDS // 2, 1, 8
    while 2 * lo <= longest:
        yield spacing, lo, hi
        spacing, lo, hi = hi, hi, 2 * hi


def z_matches(pattern: list, text: list) -> list[int]:
    """Z-function: for each position of ``text`` the length of the match with ``pattern`` from its start."""
    s = [*pattern, -1, *text]
    n, z, left, right = len(s), [0] * len(s), 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z[len(pattern) + 1:]


def boundary_parts(w: list, c: int, begin: int, end: int, spacing: int, lo: int, hi: int):
    """(periods, words matched before c, words matched from c on), both within one spacing, of w[begin:end]."""
    after = z_matches(w[c:min(c + spacing, end)], w[c + lo:min(c + hi - 1 + spacing, end)])[:hi - lo]
    top = min(end, c + hi - 1)
    back = z_matches(w[max(begin, c - spacing):c][::-1], w[max(begin, c + lo - spacing):top][::-1])
    n = min(len(after), top - c - lo + 1)
    forward = np.array(after[:n] + [0] * (top - c - lo + 1 - n), np.int64)
    backward = np.array([back[top - (c + p)] if top - (c + p) < len(back) else 0
                         for p in range(lo, top - c + 1)], np.int64)
    return np.arange(lo, top - c + 1), backward, forward


def _block_hashes(w: np.ndarray, size: int, room: int) -> np.ndarray:
    """A hash of every block of ``size`` words (blocks past the end count as any value)."""
    v = (w.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(29)
    h, width = v * np.uint64(0xBF58476D1CE4E5B9), 1
    h = np.concatenate([h, np.zeros(room + size, np.uint64)])
    out, at, left = np.zeros(len(h), np.uint64), 0, size
    while left:  # blocks of 1, 2, 4, ... words put together to the wanted size
        if left & 1:
            out = out * np.uint64(0xD6E8FEB86659FD93) + np.roll(h, -at)
            at += width
        h = h * np.uint64(0x94D049BB133111EB) + np.roll(h, -width)
        width, left = 2 * width, left >> 1
    return out


def _candidates(w: np.ndarray, first: np.ndarray, count: np.ndarray, spacing: int, lo: int, hi: int) -> np.ndarray:
    """(document, boundary) rows at which half a spacing of words matches one period of the octave later."""
    fit = np.flatnonzero(count >= max(MIN_WORDS, 2 * lo))
    per = -(-(count[fit] - lo) // spacing)
    if not per.sum():
        return np.zeros((0, 2), np.int64)
    doc = np.repeat(fit, per)
    c = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * spacing
    half, periods = spacing // 2, np.arange(lo, hi)
    h = _block_hashes(w, half, hi + half)
    hit = np.zeros(len(doc), bool)
    step = max(1, CELLS // len(periods))
    for a in range(0, len(doc), step):
        d, b = doc[a:a + step], c[a:a + step]
        g, rest = (first[d] + b)[:, None], (count[d] - b)[:, None]
        ahead = (h[g] == h[g + periods]) & (periods + half <= rest)
        behind = (h[g - half] == h[g + periods - half]) & (b[:, None] >= half) & (periods <= rest)
        hit[a:a + step] = (ahead | behind).any(axis=1)
    return np.stack([doc[hit], c[hit]], axis=1)


def fragments(ids: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """Per word list the (period, lo, hi) intervals whose words equal the word one period later,
    clipped to one spacing around tile edges and joined within a tile."""
    count = np.array([len(x) for x in ids], np.int64)
    first = np.cumsum(count) - count
    w = [x for one in ids for x in one]
    flat = np.array(w, np.int64)
    found: list[list] = [[] for _ in ids]
    for spacing, lo, hi in scales(int(count.max(initial=0))):
        open_at: dict = {}
        last = None
        for d, c in _candidates(flat, first, count, spacing, lo, hi).tolist():
            tile = (d, c // TILE_WORDS)
            if tile != last:
                open_at, last = {}, tile
            begin = int(first[d])
            p, g, f = boundary_parts(w, begin + c, begin, begin + int(count[d]), spacing, lo, hi)
            keep = f + g >= spacing
            for period, a, b in zip(p[keep].tolist(), (c - g[keep]).tolist(), (c + f[keep]).tolist()):
                old = open_at.get(period)
                if old is not None and a <= old[2]:
                    old[2] = max(old[2], b)
                else:
                    open_at[period] = old = [period, a, b]
                    found[d].append(old)
    return [[tuple(x) for x in one] for one in found]


def _solve(rewrite: Callable | None, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            names: dict = {}
            parts = fragments([[names.setdefault(x, len(names)) for x in words] for _, _, words in held])
            cols = ([], [], [], [], [])
            for (key, doc_id, words), frags in zip(held, parts):
                body = b" ".join(words)
                for col, v in zip(cols, (key, doc_id, body if frags or texts else None,
                                         hashlib.sha256(body).hexdigest(), [
                                             {"period": p, "lo": a, "hi": b} for p, a, b in frags])):
                    col.append(v)
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                pa.array(cols[3], pa.string()),
                pa.array(cols[4], pa.list_(pa.struct([("period", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])))],
                names=["key", "doc_id", "body", "sha", "frags"])

        held, size = [], 0
        for batch in batches:
            keys, doc_ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, key, doc_id in zip(range(batch.num_rows), keys, doc_ids):
                words = (batch.column(2)[row].as_py() or b"").split()  # splits at space and \t to \r only
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                held.append((key, doc_id, words))
                size += len(words)
                if size >= CHUNK_WORDS or len(held) >= 4096:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


def stitch(frags: DataFrame) -> DataFrame:
    """(key, start, length, period) of every run from (key, period, lo, hi) fragments."""
    by = Window.partitionBy("key", "period").orderBy("lo", "hi")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    opened = frags.withColumn("new", F.coalesce(F.col("lo") > F.max("hi").over(before), F.lit(True)).cast("int"))
    whole = (opened.withColumn("island", F.sum("new").over(by)).groupBy("key", "period", "island")
             .agg(F.min("lo").alias("start"), (F.max("hi") + F.col("period")).alias("end")))
    length = F.col("end") - F.col("start")
    long_enough = whole.filter((length >= MIN_WORDS) & (length >= 2 * F.col("period")))
    return (long_enough.groupBy("key", "start", "end").agg(F.min("period").alias("period"))
            .select("key", F.col("start").cast("long"), length.cast("long").alias("length"),
                    F.col("period").cast("long")))


def _collapse(texts: bool):
    """Words inside a run go, except the first period's, which stand for it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                body, runs, sha = (batch.column(k)[row].as_py() for k in (1, 2, 3))
                if runs:
                    words = body.split(b" ")
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [r["start"] + r["period"] for r in runs], 1)
                    np.add.at(change, [r["start"] + r["length"] for r in runs], -1)
                    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                    body = b" ".join([words[k] for k in kept.tolist()])
                    sha = hashlib.sha256(body).hexdigest()
                out.append(body.decode() if texts else sha)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.string())],
                                             names=["doc_id", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, rewrite: Callable | None = None, texts: bool = True) -> DataFrame:
    """doc_id, runs array<struct<start, period, length>> in order, collapsed: one row per row of ``docs``.

    ``collapsed`` is the text without the repeats, words joined by one space, or
    its sha256 if not ``texts``.  ``rewrite(doc_id, words)`` may change the words first.
    """
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("binary").alias("text"))
    solved = written(keyed.mapInArrow(_solve(rewrite, texts), DOCS), "run-fragments")
    frags = solved.select("key", F.explode("frags").alias("f")).select("key", "f.*")
    runs = stitch(frags).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    empty = F.from_json(F.lit("[]"), "array<struct<start:long,period:long,length:long>>")
    joined = (solved.select("key", "doc_id", "body", "sha").join(runs, "key", "left")
              .select("doc_id", "body", F.coalesce("runs", empty).alias("runs"), "sha"))
    return joined.mapInArrow(_collapse(texts), "doc_id long, runs array<struct<start:long,period:long,length:long>>, "
                                               "collapsed string")


def plant(doc_id: int | None, words: list) -> list:
    """The contract's planted runs: in every tenth document (by crc32 of its id) the words from one on repeat."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def run_report(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, its longest run and digests of the runs and of the collapsed text."""
    found = periodic_runs(docs, rewrite=plant, texts=False)
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n")))
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * -best.less) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256")))


SQL = r"""
WITH crc AS __CRC_TABLE__,
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    __CRC__ AS h FROM documents, crc),
e AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM e),
v AS (SELECT k, doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM f),
u AS (SELECT k, n, unnest(w) AS x, unnest(range(n)) AS i FROM v),
eq AS (SELECT a.k, b.i - a.i AS q, a.i FROM u a JOIN u b ON a.k = b.k AND a.x = b.x AND a.i < b.i AND 2 * (b.i - a.i) <= a.n),
isl AS (SELECT *, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS g FROM eq),
per AS (SELECT k, q, min(i) AS s, count(*) + q AS len FROM isl GROUP BY k, q, g HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS (SELECT k, s, len, min(q) AS q FROM per GROUP BY k, s, len),
sums AS (SELECT k, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    min((-len, s, q)) AS best FROM runs GROUP BY k),
kept AS (SELECT k, string_agg(x, ' ' ORDER BY i) AS t FROM u WHERE NOT EXISTS (
    SELECT 1 FROM runs r WHERE r.k = u.k AND u.i >= r.s + r.q AND u.i < r.s + r.len) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[2]::BIGINT AS start, (-best[1])::BIGINT AS length,
  best[3]::BIGINT AS period, (1000 * (-best[1]) // best[3])::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM v LEFT JOIN sums USING (k) LEFT JOIN kept USING (k)""".replace(
    "__CRC_TABLE__", CRC_TABLE).replace("__CRC__", crc32("doc_id::VARCHAR"))
