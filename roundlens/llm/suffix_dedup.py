"""Exact removal of repeated 100-byte strings by external suffix sorting of shards.

Every 100-byte window belongs to the smallest hash of its 32-byte grams (its
*anchor*), so equal windows have equal anchors wherever they stand.  Runs of
consecutive windows with one anchor form a stretch of text; stretches meet by
anchor:

1. Equal stretches: all but the first are removed whole.  Chunks of documents
   combine their equal stretches before anything is shuffled.
2. Stretches whose anchor holds several, or stands twice in one, go to shards.  Each shard's
   stretches are concatenated and suffix-sorted by external induction
   (:mod:`induced_sort`); suffixes whose common prefix reaches 100 bytes are
   equal windows, and all but the earliest are removed.
3. Anchors found to be very common in a sample of the documents are split: each
   of their windows travels under its own hash, so no group grows with them.

A window is therefore judged once, against all equal windows of all documents.

Defined cases: a null text is empty; texts below 100 bytes stay whole; rows
that share a doc_id are ordered by a hash of their text (identical rows come
out alike); a null doc_id is the last; empty tables are fine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .induced_sort import suffixes
from .spread import release, written
from .text import Chunk, chunks, mix, prefix_hash, span_hash

GRAM = 32
RUN = 128                # windows of one stretch at most
PIECE_BYTES = 1 << 20    # text bytes combined at a time
SHARD_BYTES = 1 << 20    # stretches sorted together; one anchor's always are
SAMPLE_SHARE = 64        # one document in so many is looked at for common anchors
COMMON_SHARE = 0.01
COMMON_LEAST = 50
COMMON_LIST = 100_000

LAST_ID = (1 << 63) - 1
_U64 = np.uint64
_ENTRY = np.dtype([("anchor", "<u8"), ("cls", "<u8"), ("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"),
                   ("size", "<u4"), ("twice", "u1")])


def _doc_tags(c: Chunk, sums: np.ndarray) -> np.ndarray:
    """32 bits of each text's hash: orders rows that share a doc_id."""
    return (span_hash(sums, c.offsets[:-1], c.offsets[1:]) >> _U64(32)).astype(np.uint32)


def _sliding(pick, a: np.ndarray, width: int) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every stretch of ``width`` values."""
    have = 1
    while have * 2 <= width:
        a = pick(a[:-have], a[have:])
        have *= 2
    return pick(a[:len(a) - (width - have)], a[width - have:]) if have < width else a


def _windows(c: Chunk, sums: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor of every window start, whether the window lies inside its document, anchors that
    stand twice so near that one stretch may hold both)."""
    n = len(c.data)
    m = n - length + 1
    if m <= 0:
        return np.zeros(0, _U64), np.zeros(0, bool), np.zeros(0, _U64)
    at = np.arange(n - GRAM + 1)
    gram = span_hash(sums, at, at + GRAM)
    width = length - GRAM + 1
    a = _sliding(np.minimum, gram, width)
    # A gram is an anchor if it equals the largest anchor of the windows around it.
    edge = np.zeros(width - 1, _U64)
    is_anchor = _sliding(np.maximum, np.concatenate([edge, a, edge]), width) == gram
    at = np.flatnonzero(is_anchor)
    at = at[np.argsort(gram[at], kind="stable")]
    near = (gram[at][1:] == gram[at][:-1]) & (np.diff(at) <= RUN + length)
    twice = np.unique(gram[at][1:][near])
    inside = np.zeros(m + 1, np.int32)  # +1 at the first, -1 after the last window of each document
    size = np.diff(c.offsets)
    has = size >= length
    inside[c.offsets[:-1][has]] += 1
    np.subtract.at(inside, np.minimum(c.offsets[1:][has] - length + 1, m), 1)
    return a[:m], np.cumsum(inside[:m]) > 0, twice


def stretches(c: Chunk, ids: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Entries of all stretches of a chunk, in document order."""
    sums = prefix_hash(c.data)
    a, valid, twice = _windows(c, sums, length)
    if not valid.any():
        return np.zeros(0, _ENTRY)
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | ~valid[:-1]
    new[c.offsets[:-1][c.offsets[:-1] < len(a)]] = True
    if len(common):
        at = np.minimum(np.searchsorted(common, a), len(common) - 1)
        new |= common[at] == a  # each window of a common anchor stands alone
    lo = np.flatnonzero(new & valid)
    stop = np.flatnonzero(np.concatenate([(new | ~valid)[1:], [True]]) & valid) + 1
    runs = stop - lo
    parts = -(-runs // RUN)
    first = np.repeat(lo, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * RUN
    last = np.minimum(first + RUN, np.repeat(stop, parts))
    doc = np.searchsorted(c.offsets, first, "right") - 1
    e = np.empty(len(first), _ENTRY)
    e["size"] = last - first + length - 1
    e["cls"] = span_hash(sums, first, last + length - 1)
    e["anchor"] = a[first]
    e["twice"] = np.isin(a[first], twice)
    if len(common):
        alone = common[np.minimum(np.searchsorted(common, a[first]), len(common) - 1)] == a[first]
        e["anchor"][alone] = mix(e["cls"][alone] + _U64(1))
    e["doc"], e["tag"] = ids[doc], _doc_tags(c, sums)[doc]
    e["start"] = first - c.offsets[doc]
    return e


def _ids(c: Chunk) -> np.ndarray:
    return c.rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _earliest_first(e: np.ndarray) -> np.ndarray:
    return e[np.lexsort((e["start"], e["tag"], e["doc"], e["cls"], e["anchor"]))]


def _first_of_class(e: np.ndarray) -> np.ndarray:
    if not len(e):
        return np.zeros(0, bool)
    return np.concatenate([[True], (e["anchor"][1:] != e["anchor"][:-1]) | (e["cls"][1:] != e["cls"][:-1])])


def _later(e: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Entries at another place than the first of their class (a repeated row is at the same place)."""
    head = e[first][np.cumsum(first) - 1]
    return (e["doc"] != head["doc"]) | (e["tag"] != head["tag"]) | (e["start"] != head["start"])


def _span_batch(e: np.ndarray) -> dict:
    """Removed byte ranges of documents, touching ones joined."""
    if not len(e):
        return {k: np.zeros(0, np.int64) for k in ("doc", "tag", "s", "e")}
    e = e[np.lexsort((e["start"], e["tag"], e["doc"]))]
    end = e["start"].astype(np.int64) + e["size"]
    other = np.concatenate([[True], (e["doc"][1:] != e["doc"][:-1]) | (e["tag"][1:] != e["tag"][:-1])])
    # A start beyond all ends before it in its document opens a range.
    group = np.cumsum(other) * (1 << 33)
    furthest = np.maximum.accumulate(group + end)
    new = other | np.concatenate([[True], (group + e["start"])[1:] > furthest[:-1]])
    lo = np.flatnonzero(new)
    stop = (furthest - group)[np.append(lo[1:], len(e)) - 1]
    return {"doc": e["doc"][lo], "tag": e["tag"][lo].astype(np.int64), "s": e["start"][lo].astype(np.int64), "e": stop}


_SPANS = "doc long, tag long, s long, e long"


def _combined(docs: DataFrame, common: np.ndarray, length: int, buckets: int) -> DataFrame:
    """Per chunk: packed first stretches by bucket, and ranges already known to repeat within the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, max_bytes=PIECE_BYTES):
            e = stretches(c, _ids(c), common, length)
            if not len(e):
                continue
            e = _earliest_first(e)
            first = _first_of_class(e)
            again = _span_batch(e[_later(e, first)])
            n = len(again["doc"])
            yield pa.record_batch({
                "bucket": pa.nulls(n, pa.int32()), "entries": pa.nulls(n, pa.binary()),
                **{k: pa.array(v) for k, v in again.items()}})
            e = e[first]
            b = (e["anchor"] % _U64(buckets)).astype(np.int32)
            order = np.argsort(b, kind="stable")
            e, b = e[order], b[order]
            edge = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
            n = len(edge) - 1
            yield pa.record_batch({
                "bucket": pa.array(b[edge[:-1]]),
                "entries": pa.array([e[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary()),
                **{k: pa.nulls(n, pa.int64()) for k in ("doc", "tag", "s", "e")}})

    return docs.mapInArrow(run, f"bucket int, entries binary, {_SPANS}")


def _resolved(packed: DataFrame) -> DataFrame:
    """Ranges of all later equal stretches, and the first stretches (anchor set) that need sorting."""

    def resolve(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        e = _earliest_first(np.frombuffer(b"".join(parts), _ENTRY))
        first = _first_of_class(e)
        again = _span_batch(e[_later(e, first)])
        e = e[first]
        edge = np.flatnonzero(np.concatenate([[True], e["anchor"][1:] != e["anchor"][:-1], [True]]))
        several = np.repeat(np.diff(edge) > 1, np.diff(edge))
        e = e[several | (e["twice"] > 0)]
        yield pa.record_batch({**{k: pa.array(v) for k, v in again.items()},
                               "anchor": pa.nulls(len(again["doc"]), pa.int64())})
        start = e["start"].astype(np.int64)
        yield pa.record_batch({"doc": pa.array(e["doc"].copy()), "tag": pa.array(e["tag"].astype(np.int64)),
                               "s": pa.array(start), "e": pa.array(start + e["size"]),
                               "anchor": pa.array(e["anchor"].copy().view(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for b, e in zip(batch.column(0).to_pylist(), batch.column(1)):
                if b != now and parts:
                    yield from resolve(parts)
                    parts = []
                now = b
                parts.append(e.as_py())
        if parts:
            yield from resolve(parts)

    return (packed.filter("entries is not null").select("bucket", "entries").repartition("bucket")
            .sortWithinPartitions("bucket").mapInArrow(run, f"{_SPANS}, anchor long"))


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, doc, tag, s, bytes) of the wanted stretches, cut from their documents."""
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("tag", "s", "e", "anchor")).alias("want"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, max_bytes=PIECE_BYTES):
            tags = _doc_tags(c, prefix_hash(c.data))
            want = c.rows.column(2)
            owner = np.repeat(np.arange(len(want)), np.asarray(want.value_lengths()))
            flat = want.flatten()
            tag, s, e, anchor = (flat.field(k).to_numpy() for k in ("tag", "s", "e", "anchor"))
            ok = tag == tags[owner]
            owner, s, e, anchor = owner[ok], s[ok], e[ok], anchor[ok]
            at = c.offsets[owner] + s
            size = e - s
            off = np.concatenate([[0], np.cumsum(size)])
            flat_at = np.repeat(at - off[:-1], size) + np.arange(off[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(_ids(c)[owner]), pa.array(tag[ok]), pa.array(s),
                 pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(off.astype(np.int32)),
                                                             pa.py_buffer(c.data[flat_at].tobytes())])],
                ["anchor", "doc", "tag", "s", "bytes"])

    return docs.join(lists, "doc").select("doc", "text", "want").mapInArrow(
        cut, "anchor long, doc long, tag long, s long, bytes binary")


def _sorted_shards(texts: DataFrame, length: int) -> DataFrame:
    """Ranges of windows that stand earlier in another stretch of their anchor, shard by shard."""

    def sort(table: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, tag, s = (table[k].to_numpy() for k in ("doc", "tag", "s"))
        blobs = table["bytes"].combine_chunks()
        size = np.asarray(pa.compute.binary_length(blobs), np.int64)
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        text = np.zeros(begin[-1], np.uint16)  # 0 parts the stretches, bytes count from 1
        raw = np.frombuffer(b"".join(blobs.to_pylist()), np.uint8)
        text[np.arange(len(raw)) + np.repeat(np.arange(len(size)), size)] = raw + np.uint16(1)
        for run_id, pos in _equal_windows(text, begin, size, length):
            o = np.searchsorted(begin, pos, "right") - 1
            at = s[o] + pos - begin[o]
            e = np.zeros(len(o), _ENTRY)
            e["cls"], e["doc"], e["tag"], e["start"], e["size"] = run_id, doc[o], tag[o], at, length
            e = _earliest_first(e)
            e = e[_later(e, _first_of_class(e))]
            yield pa.record_batch({k: pa.array(v) for k, v in _span_batch(e).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Anchors never match each other, so a shard may end wherever the anchor changes.
        held, size = [], 0
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            edge = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(anchor)]
            sizes = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.binary_length(batch.column(4)), np.int64))])
            lo = 0
            for x in edge[:-1]:
                same = x == 0 and held and held[-1].column(0)[-1].as_py() == anchor[0]
                if not same and size + sizes[x] - sizes[lo] >= SHARD_BYTES:
                    held.append(batch.slice(lo, x - lo))
                    yield from sort(pa.Table.from_batches(held, SHARD))
                    held, size, lo = [], 0, x
            held.append(batch.slice(lo))
            size += sizes[-1] - sizes[lo]
        if held:
            yield from sort(pa.Table.from_batches(held, SHARD))

    return texts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _SPANS)


SHARD = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("s", pa.int64()),
                   ("bytes", pa.binary())])


def _equal_windows(text: np.ndarray, begin: np.ndarray, size: np.ndarray,
                   length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(run number, positions) of windows that share their whole content with another, a run never split."""
    left = np.zeros(0, np.int64)
    for block in suffixes(text, length):
        pos, tied = block["pos"], block["lcp"] >= length
        if len(left):
            if tied.all():
                left = np.concatenate([left, pos])
                continue
            cut = int(np.argmin(tied))
            run = np.concatenate([left, pos[:cut]])
            yield from _whole_run(run, np.zeros(len(run), int), begin, size, length)
            pos, tied = pos[cut:], tied[cut:]
        last = len(pos) - 1 - int(np.argmin(tied[::-1])) if not tied.all() else 0
        yield from _whole_run(pos[:last], np.cumsum(~tied[:last]), begin, size, length)
        left = pos[last:]
    if len(left):
        yield from _whole_run(left, np.zeros(len(left), int), begin, size, length)


def _whole_run(pos, run_id, begin, size, length) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    o = np.searchsorted(begin, pos, "right") - 1
    ok = pos + length <= begin[o] + size[o]
    pos, run_id = pos[ok], run_id[ok]
    if len(pos):
        edge = np.flatnonzero(np.concatenate([[True], run_id[1:] != run_id[:-1], [True]]))
        several = np.repeat(np.diff(edge) > 1, np.diff(edge))
        if several.any():
            yield run_id[several], pos[several]


def _common_anchors(docs: DataFrame, length: int) -> np.ndarray:
    """Anchors that stand in many sampled documents; they are only dealt differently."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, max_bytes=PIECE_BYTES):
            e = stretches(c, _ids(c), np.zeros(0, _U64), length)
            a, n = np.unique(np.unique(np.stack([e["anchor"], e["doc"].view(_U64)], 1), axis=0)[:, 0],
                             return_counts=True) if len(e) else (np.zeros(0, _U64), np.zeros(0, np.int64))
            yield pa.record_batch({"a": pa.array(a[n > 1].view(np.int64)), "n": pa.array(n[n > 1])})

    sample = docs.filter(F.pmod(F.xxhash64("doc", F.lit("anchors")), F.lit(SAMPLE_SHARE)) == 0)
    least = max(COMMON_LEAST, int(COMMON_SHARE * sample.count()))
    top = (sample.mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= least).orderBy(F.desc("n"), "a").limit(COMMON_LIST).toPandas())
    return np.sort(top["a"].to_numpy(np.int64).view(_U64))


def remove_repeats(docs: DataFrame, length: int = 100, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes) of every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), "text", "doc_id")
    plain = docs.select("doc", "text")
    buckets = max(32, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = written(_combined(plain, _common_anchors(plain, length), length, buckets), "dedup-stretches")
    resolved = written(_resolved(packed), "dedup-resolved")
    # The entries are bulky and spent now; the few spans beside them are kept.
    here = written(packed.filter("entries is null").select("doc", "tag", "s", "e"), "dedup-here")
    release(packed)
    texts = _texts_of(plain, resolved.filter("anchor is not null"))
    sorted_out = written(_sorted_shards(texts, length), "dedup-sorted")
    settled = written(resolved.filter("anchor is null").select("doc", "tag", "s", "e"), "dedup-settled")
    release(resolved)
    spans = here.union(settled).union(sorted_out)
    lists = spans.groupBy("doc").agg(F.collect_list(F.struct("tag", "s", "e")).alias("cut"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, max_bytes=PIECE_BYTES):
            tags = _doc_tags(c, prefix_hash(c.data))
            cut = c.rows.column(1)
            out = []
            for i, rows in enumerate(cut.to_pylist()):
                data = c.data[c.offsets[i]:c.offsets[i + 1]]
                marks = np.zeros(len(data) + 1, np.int32)
                for r in rows or ():
                    if r["tag"] == tags[i]:
                        marks[r["s"]] += 1
                        marks[r["e"]] -= 1
                gone = np.cumsum(marks[:-1]) > 0
                runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                out.append((len(data), int(gone.sum()), runs, data[~gone].tobytes() if runs else data.tobytes()))
            yield pa.record_batch({
                "doc_id": c.rows.column(2), "n_bytes": pa.array([o[0] for o in out], pa.int64()),
                "n_removed": pa.array([o[1] for o in out], pa.int64()),
                "n_spans": pa.array([o[2] for o in out], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(o[3]).hexdigest() for o in out], pa.string()),
                **({"kept": pa.array([o[3] for o in out], pa.binary())} if with_text else {})})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return (docs.join(lists, "doc", "left").select("text", "cut", F.col("doc_id").cast("long"))
            .mapInArrow(keep, schema + (", kept binary" if with_text else "")))


SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT k, x, unnest(range(len(x) // 2 - 99)) AS i FROM d WHERE len(x) >= 200),
g AS (SELECT k, i, md5(substr(x, (2 * i + 1)::BIGINT, 200)) AS g FROM w),
later AS (SELECT k, i FROM (SELECT k, i, row_number() OVER (PARTITION BY g ORDER BY k, i) AS r FROM g) WHERE r > 1),
isl AS (SELECT k, i, sum(opens) OVER (PARTITION BY k ORDER BY i) AS n FROM (SELECT k, i,
    CASE WHEN i > lag(i) OVER (PARTITION BY k ORDER BY i) + 100 THEN 1 ELSE 0 END AS opens FROM later)),
cut AS (SELECT k, min(i) AS s, max(i) + 100 AS e FROM isl GROUP BY k, n),
gap AS (SELECT k, s, e, coalesce(lag(e) OVER (PARTITION BY k ORDER BY s), 0) AS p FROM cut),
kept AS (SELECT d.k, sum(e - s) AS removed, count(*) AS spans,
    string_agg(substr(x, 2 * p + 1, 2 * (s - p)), '' ORDER BY s) || substr(any_value(x), 2 * max(e) + 1) AS y
    FROM d JOIN gap ON gap.k = d.k GROUP BY d.k)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(y, x))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.k = d.k"""
