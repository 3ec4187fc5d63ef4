"""Benchmark decontamination with a distributed positional inverted index.

The training documents are indexed in segments (as many whole documents as fit
``SEGMENT_BYTES`` of text).  A segment stores, for each of its terms, the word
positions as delta-coded varints; documents lie ``GAP`` positions apart so that
no phrase crosses them.  The index is a Parquet table in the shared folder.

Test phrases are looked up in every segment: a phrase starts from the postings
of its rarest term there, shifted by the term's offset, and is intersected with
the shifted postings of its other terms from rare to common.  ``slop`` widens
the intersection to proximity matches.  Phrases go out in blocks of bounded
size, so a test set of any size can be searched.

Defined cases: null, empty and word-less texts have no words and no hit; items
without words give no phrase; rows repeated under one doc_id come out once per
row; a null item_id is written as the empty string; empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import written
from .text import ALNUM_WORD, chunks, word_hashes

SEGMENT_BYTES = 2 << 20  # of text; one text may exceed it
GAP = 64                 # free positions between documents; phrase length + slop stay below it
BLOCK_WORDS = 500_000    # words of test items searched (and broadcast) at a time
CANDIDATES = 1 << 19     # candidate positions intersected at a time
TERM_BLOCK = 1 << 14     # terms whose postings are encoded at a time

INDEX_SCHEMA = ("segment long, doc_ids array<long>, doc_words array<int>, "
                "terms binary, counts binary, starts binary, postings binary")


def encode_varints(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, byte offset of each value + total) of unsigned values, 7 bits a byte, low bits first."""
    v = v.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << (7 * k))
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(at[-1]), np.uint8)
    for k in range(int(size.max(initial=0))):
        m = size > k
        part = (v[m] >> np.uint64(7 * k)) & np.uint64(0x7F)
        out[at[:-1][m] + k] = part.astype(np.uint8) | ((size[m] > k + 1).astype(np.uint8) << 7)
    return out, at


def decode_varints(b: np.ndarray) -> np.ndarray:
    end = np.flatnonzero(b < 128)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    size = end - start + 1
    v = np.zeros(len(end), np.int64)
    for k in range(int(size.max(initial=0))):
        m = size > k
        v[m] |= (b[start[m] + k].astype(np.int64) & 0x7F) << (7 * k)
    return v


def build_index(docs: DataFrame) -> DataFrame:
    """One row per segment with its documents, terms and postings; every word of every text is in."""

    def segment(number: int, ids: list, counts: list, terms: list) -> pa.RecordBatch:
        n_words = np.concatenate(counts).astype(np.int64)
        term = np.concatenate(terms)
        terms.clear()
        places = len(term) + GAP * len(n_words)
        kind = np.int32 if places < 1 << 31 else np.int64
        base = np.concatenate([[0], np.cumsum(n_words + GAP)[:-1]])
        shift = base - np.concatenate([[0], np.cumsum(n_words)[:-1]])
        pos = np.arange(len(term), dtype=kind)
        pos += np.repeat(shift.astype(kind), n_words)
        order = np.argsort(term, kind="stable").astype(kind)
        term, pos = term[order], pos[order]
        del order
        edge = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, int)
        names, size = term[edge].tobytes(), np.diff(edge, append=len(term)).astype(np.uint32)
        del term
        delta = np.diff(pos, prepend=kind(0))
        delta[edge] = pos[edge]
        del pos
        starts, packed, used = [], [], 0
        for lo in range(0, len(edge), TERM_BLOCK):  # a block of terms at a time: varints need wide work arrays
            here = edge[lo:lo + TERM_BLOCK]
            end = int(edge[lo + TERM_BLOCK]) if lo + TERM_BLOCK < len(edge) else len(delta)
            part, at = encode_varints(delta[here[0]:end])
            starts.append(at[here - here[0]] + used)
            packed.append(part.tobytes())
            used += int(at[-1])
        one = [pa.array([x], pa.binary()) for x in (
            names, size.tobytes(), np.append(np.concatenate([*starts, np.zeros(0, np.int64)]), used).astype(np.uint32).tobytes(),
            b"".join(packed))]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([[i for x in ids for i in x.to_pylist()]], pa.list_(pa.int64())),
             pa.array([n_words.astype(np.int32)], pa.list_(pa.int32())), *one],
            ["segment", "doc_ids", "doc_words", "terms", "counts", "starts", "postings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, counts, terms, size = [], [], [], 0
        for c in chunks(batches, max_bytes=SEGMENT_BYTES // 2):
            if size and size + len(c.data) > SEGMENT_BYTES:
                yield segment(number, ids, counts, terms)
                number += 1
                ids, counts, terms, size = [], [], [], 0
            h, first = word_hashes(c, ALNUM_WORD)
            ids.append(c.rows.column(0))
            counts.append(np.diff(first))
            terms.append(h)
            size += len(c.data)
        if ids:
            yield segment(number, ids, counts, terms)

    index = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX_SCHEMA)
    return written(index, "positional-index")


def phrases(texts: list[str | None], window: int) -> list[tuple[int, np.ndarray]]:
    """(item number, term hashes) of every window of the texts; a shorter text is one window."""
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    out, seen = [], 0
    for c in chunks(iter([batch])):
        h, first = word_hashes(c, ALNUM_WORD)
        for i in range(len(c.valid)):
            t = h[first[i]:first[i + 1]]
            if len(t):
                out += [(seen + i, t[j:j + window]) for j in range(max(1, len(t) - window + 1))]
        seen += len(c.valid)
    return out


class _Segment:
    """Postings of the asked terms of one segment, as sorted (term number, position) keys."""

    def __init__(self, row: dict, asked: np.ndarray):
        terms = np.frombuffer(row["terms"], np.uint64)
        n = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        start = np.frombuffer(row["starts"], np.uint32).astype(np.int64)
        packed = np.frombuffer(row["postings"], np.uint8)
        at = np.searchsorted(terms, asked)
        hit = np.flatnonzero(at < len(terms))
        hit = hit[terms[at[hit]] == asked[hit]]
        self.count = np.zeros(len(asked), np.int64)
        self.count[hit] = n[at[hit]]
        parts = [packed[start[j]:start[j + 1]] for j in at[hit]]
        delta = decode_varints(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        run = np.cumsum(delta)
        before = np.concatenate([[0], run])[self.first[:-1]]
        slot = np.repeat(np.arange(len(asked)), self.count)
        self.pos = run - before[slot]
        self.keys = (slot << 32) | self.pos

    def has(self, slot: np.ndarray, pos: np.ndarray, slop: int) -> np.ndarray:
        low = (slot << 32) | np.maximum(pos - slop, 0)
        at = np.minimum(np.searchsorted(self.keys, low), len(self.keys) - 1)
        return (self.keys[at] >= low) & (self.keys[at] <= ((slot << 32) | np.maximum(pos + slop, 0)))


def find(seg: _Segment, slots: np.ndarray, length: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase number, start position) of all matches; ``slots`` is phrases x words (padded by -1)."""
    words = np.arange(slots.shape[1])
    count = np.where(slots >= 0, seg.count[np.maximum(slots, 0)], np.iinfo(np.int64).max)
    order = np.argsort(count, axis=1, kind="stable")
    alive = np.flatnonzero(count.min(axis=1) > 0)
    found_p, found_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rare = order[:, 0]
    many = seg.count[slots[np.arange(len(slots)), rare]]
    group = np.cumsum(many[alive]) // CANDIDATES
    for g in range(int(group[-1]) + 1 if len(group) else 0):
        own = alive[group == g]
        m = many[own]
        p = np.repeat(own, m)
        offset = np.arange(len(p)) - np.repeat(np.cumsum(m) - m, m)
        start = seg.pos[seg.first[slots[p, rare[p]]] + offset] - words[rare[p]]
        ok = start >= 0
        p, start = p[ok], start[ok]
        for k in range(1, slots.shape[1]):
            w = order[p, k]
            need = w < length[p]
            ok = ~need
            ok[need] = seg.has(slots[p[need], w[need]], start[need] + w[need], slop)
            p, start = p[ok], start[ok]
        found_p.append(p)
        found_s.append(start)
    return np.concatenate(found_p), np.concatenate(found_s)


def search(index: DataFrame, items: DataFrame, window: int = 10, slop: int = 0) -> DataFrame:
    """Matches (segment, doc_no, item, spans): merged word ranges of each item in each document.

    ``items`` is (item, text).  With ``slop`` each word may lie that many places
    off its own (proximity); 0 asks for exact phrases.
    """
    spark = items.sparkSession
    if window + slop >= GAP:
        raise ValueError(f"window + slop must stay below {GAP}")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * BLOCK_WORDS)))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    schema = "segment long, doc_no int, item string, spans array<struct<s:int,e:int>>"
    out = None
    for b in range(blocks):
        rows = items.filter(part == b).collect()  # bounded: one block of the test set
        names = [r["item"] for r in rows]
        found = phrases([r["text"] for r in rows], window)
        if not found:
            continue
        asked = np.unique(np.concatenate([t for _, t in found]))
        slots = np.full((len(found), window), -1, np.int64)
        for i, (_, t) in enumerate(found):
            slots[i, :len(t)] = np.searchsorted(asked, t)
        owner = np.array([i for i, _ in found])
        shared = spark.sparkContext.broadcast((names, asked, slots, owner))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, asked, slots, owner = shared.value
            length = (slots >= 0).sum(axis=1)
            for batch in batches:
                for k in range(batch.num_rows):  # one segment at a time, its postings not copied
                    row = {c: batch.column(c)[k].as_buffer() for c in ("terms", "counts", "starts", "postings")}
                    row["segment"] = batch.column("segment")[k].as_py()
                    row["doc_words"] = batch.column("doc_words")[k].values.to_numpy(zero_copy_only=False)
                    p, start = find(_Segment(row, asked), slots, length, slop)
                    n = np.asarray(row["doc_words"], np.int64)
                    base = np.concatenate([[0], np.cumsum(n + GAP)[:-1]])
                    doc = np.searchsorted(base, start, "right") - 1
                    start, item, size = start - base[doc], owner[p], length[p]
                    order = np.lexsort((start, item, doc))
                    spans: dict = {}
                    for d, i, s, e in zip(doc[order].tolist(), item[order].tolist(), start[order].tolist(),
                                          np.minimum(start + size, n[doc])[order].tolist()):
                        have = spans.setdefault((d, i), [])
                        if have and s <= have[-1]["e"]:
                            have[-1]["e"] = max(e, have[-1]["e"])
                        else:
                            have.append({"s": s, "e": e})
                    yield pa.record_batch({
                        "segment": pa.array([row["segment"]] * len(spans), pa.int64()),
                        "doc_no": pa.array([d for d, _ in spans], pa.int32()),
                        "item": pa.array([names[i] for _, i in spans], pa.string()),
                        "spans": pa.array(list(spans.values()),
                                          pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))})

        got = index.select("segment", "doc_words", "terms", "counts", "starts", "postings").mapInArrow(run, schema)
        out = got if out is None else out.union(got)
    return spark.createDataFrame([], schema) if out is None else out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    index = build_index(docs)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    hits = search(index, items, window)
    # Covered words of a document: sorted spans, each counted from the furthest end so far.
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
                              F.greatest(a["end"], x["e"]).alias("end")))["n"]
    per_doc = (hits.groupBy("segment", "doc_no")
               .agg(spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
               .select("segment", "doc_no", covered.cast("long").alias("n_hit"), "items"))
    all_docs = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("doc_no", "d"))
    out = all_docs.select("segment", "doc_no", F.col("d.doc_ids").alias("doc_id"),
                          F.col("d.doc_words").cast("long").alias("n_words")).join(
        per_doc, ["segment", "doc_no"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.cast("long").alias("n_hit"),
                      F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


SQL = r"""
WITH low AS (SELECT 'd' AS k, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (SELECT k, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
b AS (SELECT DISTINCT id AS item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
      FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM w WHERE k = 'b' AND len(ws) > 0)),
p AS (SELECT id AS doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE k = 'd'),
m AS (SELECT p.doc_id, p.i, b.n, b.item_id FROM p JOIN (SELECT DISTINCT n FROM b) l ON p.i + l.n - 1 <= len(p.ws)
      JOIN b ON b.n = l.n AND b.g = array_to_string(p.ws[p.i:p.i + l.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM m) GROUP BY 1),
j AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY 1)
SELECT w.id AS doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(j.s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h ON h.doc_id = w.id LEFT JOIN j ON j.doc_id = w.id WHERE k = 'd'"""
