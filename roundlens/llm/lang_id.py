"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in both directions (one GRU each), labels every
byte position with a distribution over the learned languages, and a document's
probabilities are the mean over all positions of its whole text.  It is trained
in numpy by backpropagation through time on a bounded sample of labelled rows.

Texts are read in windows of ``WINDOW`` bytes; each also reads ``CONTEXT``
bytes of its neighbours on both sides, whose positions are not counted again.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is every text when there is nothing to learn from; repeated rows come out once
per row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import chunks

UND = "und"
SAMPLE_PER_LANG = 600    # bound of the training sample: documents per language
SAMPLE_BYTES = 4096      # and bytes of each sampled document kept for training
HIDDEN = 8
WINDOW = 256
CONTEXT = 16
BATCH = 2048             # windows computed together
PAD = 256                # index of "no byte" in the byte table
STEPS, TRAIN_BATCH, TRAIN_LEN, RATE = 600, 160, 64, 0.02


@dataclass
class Direction:
    w: np.ndarray  # (3H, 257) gate input of each byte: update, reset, candidate
    u: np.ndarray  # (3H, H) recurrent weights
    v: np.ndarray  # (L, H) share in the position's logits


@dataclass
class Model:
    langs: list[str]
    ahead: Direction
    back: Direction
    bias: np.ndarray  # (L, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(d: Direction, x: np.ndarray) -> list[tuple]:
    """All steps over x (T, B): (previous state, update, reset, candidate, recurrent candidate, state)."""
    h_size = d.u.shape[1]
    h = np.zeros((h_size, x.shape[1]), np.float32)
    steps = []
    for t in range(len(x)):
        a, r_in = d.w[:, x[t]], d.u @ h
        gate = _sigmoid(a[:2 * h_size] + r_in[:2 * h_size])
        z, r, un = gate[:h_size], gate[h_size:], r_in[2 * h_size:]
        n = np.tanh(a[2 * h_size:] + r * un)
        new = n + z * (h - n)
        steps.append((h, z, r, n, un, new))
        h = new
    return steps


def _gradient(d: Direction, x: np.ndarray, steps: list[tuple], d_logit: np.ndarray) -> Direction:
    """Backpropagation through time; d_logit is (T, L, B)."""
    h_size = d.u.shape[1]
    g_u, g_v = np.zeros_like(d.u), np.zeros_like(d.v)
    d_in = np.empty((len(x), 3 * h_size, x.shape[1]), np.float32)
    carry = np.zeros((h_size, x.shape[1]), np.float32)
    for t in range(len(x) - 1, -1, -1):
        h, z, r, n, un, new = steps[t]
        dh = d.v.T @ d_logit[t] + carry
        g_v += d_logit[t] @ new.T
        dn = dh * (1 - z) * (1 - n * n)
        pre = np.concatenate([dh * (h - n) * z * (1 - z), dn * un * r * (1 - r), dn])
        d_in[t] = pre
        pre_u = pre.copy()
        pre_u[2 * h_size:] *= r
        g_u += pre_u @ h.T
        carry = dh * z + d.u.T @ pre_u
    flat = x.ravel()
    g_w = np.stack([np.bincount(flat, d_in[:, k].ravel(), d.w.shape[1]) for k in range(3 * h_size)])
    return Direction(g_w.astype(np.float32), g_u, g_v)


def _loss_gradient(m: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean position loss over x (T, B) with labels y (B,), and the gradient of every parameter."""
    ahead, back = _run(m.ahead, x), _run(m.back, x[::-1])[::-1]
    logit = np.stack([m.ahead.v @ f[-1] + m.back.v @ b[-1] + m.bias for f, b in zip(ahead, back)])
    logit -= logit.max(axis=1, keepdims=True)
    p = np.exp(logit)
    p /= p.sum(axis=1, keepdims=True)
    valid = (x != PAD).astype(np.float32)
    share = valid / max(valid.sum(), 1)
    loss = -(np.log(p[:, y, np.arange(len(y))] + 1e-9) * share).sum()
    p[:, y, np.arange(len(y))] -= 1
    d_logit = (p * share[:, None]).astype(np.float32)
    ga = _gradient(m.ahead, x, ahead, d_logit)
    gb = _gradient(m.back, x[::-1], back[::-1], d_logit[::-1])
    return float(loss), [ga.w, ga.u, ga.v, gb.w, gb.u, gb.v, d_logit.sum(axis=(0, 2))[:, None]]


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Model | None:
    """Fit the network on cuts of the sample texts; short cuts teach short documents."""
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(seed)

    def direction() -> Direction:
        return Direction(*(rng.normal(0, s, shape).astype(np.float32) for s, shape in (
            (0.3, (3 * HIDDEN, 257)), (0.25, (3 * HIDDEN, HIDDEN)), (0.3, (len(langs), HIDDEN)))))

    m = Model(langs, direction(), direction(), np.zeros((len(langs), 1), np.float32))
    params = [m.ahead.w, m.ahead.u, m.ahead.v, m.back.w, m.back.u, m.back.v, m.bias]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    codes = np.array([langs.index(s) for s in labels])
    of_lang = [np.flatnonzero(codes == c) for c in range(len(langs))]
    for step in range(1, STEPS + 1):
        y = rng.integers(0, len(langs), TRAIN_BATCH)  # languages evenly, whatever their share
        x = np.full((TRAIN_LEN, TRAIN_BATCH), PAD, np.int64)
        for j, c in enumerate(y):
            text = texts[rng.choice(of_lang[c])]
            size = TRAIN_LEN if rng.random() < 0.5 else int(rng.integers(4, TRAIN_LEN))
            at = int(rng.integers(0, max(1, len(text) - size + 1)))
            cut = np.frombuffer(text[at:at + size], np.uint8)
            x[:len(cut), j] = cut
        _, grads = _loss_gradient(m, x, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1, step / 20) * 0.5 * (1 + np.cos(np.pi * step / (STEPS + 1)))
        for p, g, a, b in zip(params, grads, mean, var):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return m


def _label_windows(m: Model, x: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """(B, L) sums of position probabilities over the counted positions; x and counted are (T, B)."""
    size = x.shape[1]
    h_size, n_lang = HIDDEN, len(m.langs)
    logits = np.empty((len(x), n_lang, size), np.float32)
    a, r_in = (np.empty((3 * h_size, size), np.float32) for _ in range(2))
    diff = np.empty((h_size, size), np.float32)
    for d, order, first in ((m.ahead, range(len(x)), True), (m.back, range(len(x) - 1, -1, -1), False)):
        # sigmoid(s) = (tanh(s / 2) + 1) / 2: halve the gate rows once instead of every step
        half = np.ones((3 * h_size, 1), np.float32)
        half[:2 * h_size] = 0.5
        w, u = d.w * half, d.u * half
        h = np.zeros((h_size, size), np.float32)
        for t in order:
            np.take(w, x[t], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=r_in)
            gate = a[:2 * h_size]
            gate += r_in[:2 * h_size]
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            n = r_in[2 * h_size:]
            n *= gate[h_size:]
            n += a[2 * h_size:]
            np.tanh(n, out=n)
            np.subtract(h, n, out=diff)
            diff *= gate[:h_size]
            np.add(n, diff, out=h)
            if first:
                np.matmul(d.v, h, out=logits[t])
                logits[t] += m.bias
            else:
                logits[t] += d.v @ h
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= (counted / logits.sum(axis=1))[:, None]
    return logits.sum(axis=0).T


def _positions(m: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, L) sums of position probabilities of back-to-back texts."""
    sums = np.zeros((len(offsets) - 1, len(m.langs)))
    size = np.diff(offsets)
    per_row = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), per_row)
    start = offsets[row] + (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * WINDOW
    lo = np.maximum(start - CONTEXT, offsets[row])
    end = np.minimum(start + WINDOW, offsets[row + 1])
    hi = np.minimum(end + CONTEXT, offsets[row + 1])
    by_size = np.argsort(hi - lo, kind="stable")  # windows of like length together: little padding
    for s in range(0, len(by_size), BATCH):
        k = by_size[s:s + BATCH]
        at = lo[k] + np.arange((hi[k] - lo[k]).max())[:, None]
        x = np.where(at < hi[k], data[np.minimum(at, len(data) - 1)], PAD).astype(np.int64)
        counted = ((at >= start[k]) & (at < end[k])).astype(np.float32)
        np.add.at(sums, row[k], _label_windows(m, x, counted))
    return sums


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def learn(docs: DataFrame) -> Model | None:
    """Train on at most ``SAMPLE_PER_LANG`` labelled rows per language, chosen by hash, never held-out ones."""
    usable = docs.filter(F.col("lang").isNotNull() & F.coalesce(~held_out(F.col("doc_id")), F.lit(False))
                         & has_letter(F.col("text")))
    sizes = usable.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return None
    spread = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(spread))
    limit = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(int(spread * min(1.0, SAMPLE_PER_LANG / r["count"]))))
                         for r in sizes])
    rows = (usable.filter(draw < limit).orderBy(draw, "doc_id", "lang")
            .limit(2 * SAMPLE_PER_LANG * len(sizes))
            .select("lang", F.substring(F.encode("text", "utf-8"), 1, SAMPLE_BYTES).alias("text")).collect())
    return train([bytes(r["text"]) for r in rows], [r["lang"] for r in rows])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score, has_letter of every document (all bytes of all texts are read)."""
    if model is None:
        return docs.select(*keep, F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"),
                           has_letter(F.col("text")).alias("has_letter"))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a few thousand numbers
    rows = docs.select(*keep, F.col("text").alias("__text"), has_letter(F.col("text")).alias("has_letter"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep),
                        "lang_pred string", "score double", "has_letter boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for c in chunks(batches, "__text"):
            ok = np.asarray(c.rows.column(len(keep) + 1).to_numpy(zero_copy_only=False), bool)
            p = _positions(m, c.data, c.offsets)
            best = p.argmax(axis=1)
            total = np.maximum(p.sum(axis=1), 1e-9)
            score = np.clip(p[np.arange(len(p)), best] / total, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*c.rows.columns[:len(keep)],
                 pa.array([m.langs[b] if o else UND for b, o in zip(best, ok)], pa.string()),
                 pa.array(np.where(ok, score, 0.0)), pa.array(ok)],
                [*keep, "lang_pred", "score", "has_letter"])

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    out = predict(docs, learn(docs))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
