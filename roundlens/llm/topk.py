"""Exact top-k inner products pruned by multi-resolution segment statistics.

Each vector is summarised at several resolutions (1, 4, 16, ... equal segments)
by the mean and deviation of every segment.  For one segment of length L

    sum q_i x_i <= L (mean_q mean_x + dev_q dev_x)      (Cauchy-Schwarz)

which is the lower bound of the segment distance written for products.  Bounds
are taken coarse to fine against the k-th score found so far, and only the
survivors get exact integer products.

Queries are dealt into blocks of bounded size, sent to all tasks one block at a
time; every task scans its rows, keeps k rows per query, and a last step ranks
the k rows of all tasks.

Defined cases: a vector that is null, has no component, or has a null or non-finite
component takes no part; nor does one with a component of 2^31 / sqrt(length) or more
after quantisation, whose score could leave 64 bits.  Vectors of different length are
not compared.  A query's own row is no candidate, but other rows that share its id
are; each row is a query by itself.  Rows without an id take no part.  Equal scores
go to the smaller id; fewer than k candidates give fewer rows; an empty table is fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_QUERIES = 8192     # queries sent out at a time
ROWS = 2048              # candidate rows scored at a time
FIRST_ROWS = 64
QUERY_ROWS = 512
SPARSE = 0.1             # share of pairs left at which bounds are taken pair by pair
SURVIVORS = 1 << 18      # exact products computed at a time


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, int64 quantised vectors) of the usable rows, one pair per vector length."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    col = batch.column(1)
    ok = np.asarray(col.is_valid()) & np.asarray(batch.column(0).is_valid())
    length = np.where(ok, np.asarray(col.value_lengths().fill_null(0)), -1)
    for d in np.unique(length[ok]):
        if d == 0:
            continue
        pick = np.flatnonzero(length == d)
        flat = col.take(pa.array(pick)).flatten()
        x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)  # a null becomes NaN
        with np.errstate(invalid="ignore", over="ignore"):
            good = (np.abs(256.0 * x) < 2.0 ** 31 / np.sqrt(d)).all(axis=1)  # false for NaN and infinity
        yield ids[pick[good]].astype(np.int64), np.floor(256.0 * x[good]).astype(np.int64)


def resolutions(d: int) -> list[int]:
    """Segment counts from coarse to fine; a segment keeps at least four components."""
    out, s = [], 1
    while s == 1 or d // s >= 4:
        out.append(s)
        s *= 4
    return out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner product bounds that of the vectors: sqrt(L) * (means, deviations)."""
    edge = np.linspace(0, x.shape[1], segments + 1).astype(int)
    size = np.diff(edge)
    v = x.astype(np.float64)
    mean = np.add.reduceat(v, edge[:-1], axis=1) / size
    dev = np.sqrt(np.maximum(np.add.reduceat((v - np.repeat(mean, size, axis=1)) ** 2, edge[:-1], axis=1) / size, 0))
    return np.concatenate([mean, dev], axis=1) * np.sqrt(np.tile(size, 2))


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.full = np.zeros((n, k), bool)

    def floor(self) -> np.ndarray:
        return np.where(self.full[:, -1], self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge scored pairs (grouped by query number in any order)."""
        k = self.score.shape[1]
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        new = np.concatenate([[True], q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
        keep = rank < k
        q, score, ids, rank = q[keep], score[keep], ids[keep], rank[keep]
        hit = np.unique(q)
        at = np.searchsorted(hit, q)
        more = Best(len(hit), k)
        more.score[at, rank], more.id[at, rank], more.full[at, rank] = score, ids, True
        s = np.concatenate([self.score[hit], more.score], axis=1)
        i = np.concatenate([self.id[hit], more.id], axis=1)
        f = np.concatenate([self.full[hit], more.full], axis=1)
        o = np.lexsort((i, -s.astype(np.float64), ~f), axis=1)
        # float keys may tie for huge scores; order those exactly
        o = np.take_along_axis(o, np.argsort(-np.take_along_axis(s, o, 1), axis=1, kind="stable"), 1) \
            if np.abs(s[f]).max(initial=0) >= 2 ** 53 else o
        o = o[:, :k]
        self.score[hit], self.id[hit] = np.take_along_axis(s, o, 1), np.take_along_axis(i, o, 1)
        self.full[hit] = np.take_along_axis(f, o, 1)


def scan(best: Best, q: np.ndarray, q_stats: list[np.ndarray], ids: np.ndarray, x: np.ndarray) -> None:
    """Offer candidate rows to all queries: bounds coarse to fine, then exact products."""
    levels = resolutions(x.shape[1])
    x_stats = [statistics(x, s) for s in levels]
    for lo in range(0, len(q), QUERY_ROWS):
        hi = min(lo + QUERY_ROWS, len(q))
        floor = best.floor()[lo:hi]
        alive = np.ones((hi - lo, len(ids)), bool)
        a = b = None
        for qs, xs in zip(q_stats, x_stats):
            if a is None:  # many pairs left: all bounds of this resolution in one product
                bound = qs[lo:hi] @ xs.T
                alive &= bound + 1e-9 * np.abs(bound) + 1e-6 >= floor[:, None]
                if alive.mean() < SPARSE:
                    a, b = np.nonzero(alive)
                continue
            keep = np.zeros(len(a), bool)
            for s in range(0, len(a), SURVIVORS):
                u, v = a[s:s + SURVIVORS], b[s:s + SURVIVORS]
                bound = np.einsum("ij,ij->i", qs[lo + u], xs[v])
                keep[s:s + SURVIVORS] = bound + 1e-9 * np.abs(bound) + 1e-6 >= floor[u]
            a, b = a[keep], b[keep]
        if a is None:
            a, b = np.nonzero(alive)
        for s in range(0, len(a), SURVIVORS):
            u, v = a[s:s + SURVIVORS], b[s:s + SURVIVORS]
            score = np.einsum("ij,ij->i", q[lo + u], x[v])
            good = score >= best.floor()[lo + u]
            best.add(lo + u[good], score[good], ids[v[good]])


def top_k(rows: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest products for each row whose id divides by ``every``."""
    spark = rows.sparkSession
    table = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    queries = table.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    out = None
    for b in range(blocks):
        asked = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()  # one bounded block
        by_length: dict[int, tuple[list, list]] = {}
        for batch in asked.to_batches():
            for ids, q in vectors(batch):
                have = by_length.setdefault(q.shape[1], ([], []))
                have[0].append(ids)
                have[1].append(q)
        shared = spark.sparkContext.broadcast(
            {d: (np.concatenate(i), np.concatenate(q)) for d, (i, q) in by_length.items()})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            state: dict = {}
            for batch in batches:
                for ids, x in vectors(batch):
                    if x.shape[1] not in shared.value:
                        continue
                    q = shared.value[x.shape[1]][1]
                    if x.shape[1] not in state:
                        # One more than k: a query meets its own row too, which goes at the end.
                        state[x.shape[1]] = (Best(len(q), k + 1), [statistics(q, s) for s in resolutions(x.shape[1])])
                    best, q_stats = state[x.shape[1]]
                    lo, step = 0, FIRST_ROWS  # small steps first, so that the k-th score soon prunes
                    while lo < len(ids):
                        scan(best, q, q_stats, ids[lo:lo + step], x[lo:lo + step])
                        lo, step = lo + step, min(2 * step, ROWS)
            for d, (best, _) in state.items():
                n, j = np.nonzero(best.full)
                q_ids, q = shared.value[d]
                own = (best.id[n, j] == q_ids[n]) & (best.score[n, j] == (q * q).sum(axis=1)[n])
                yield pa.record_batch({"query_no": pa.array(n), "query_id": pa.array(q_ids[n]),
                                       "vec_id": pa.array(best.id[n, j]), "score": pa.array(best.score[n, j]),
                                       "own": pa.array(own), "d": pa.array(np.full(len(n), d))})

        got = table.mapInArrow(run, "query_no long, query_id long, vec_id long, score long, own boolean, d long")
        got = got.withColumn("block", F.lit(b))
        out = got if out is None else out.union(got)
    # query_no tells repeated rows of one query id apart.
    w = Window.partitionBy("block", "d", "query_no").orderBy(F.desc("score"), "vec_id")
    near = out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k + 1)
    # Of the rows with the query's id and its product with itself (all alike) one is its own.
    owns = F.sum(F.col("own").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rank = (F.col("rank") - F.least(F.col("owns"), F.lit(1))).cast("int")
    return (near.withColumn("owns", owns).filter("not (own and owns = 1)")
            .select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k))


SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id, score FROM s) WHERE rank <= 5"""
