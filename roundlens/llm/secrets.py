"""Secret scans: candidate strings judged by a random forest.

Candidates are private-key blocks (one without an end goes as far as its base64
lines), passwords in URLs, every value assigned to a secret's name (quoted or not,
of any length, up to the line's end), and other token-like strings of a text (they
hold a digit, or follow an assignment).  A forest trained on labelled findings
removes false positives; its features are the candidate's length and character
make-up, the likelihood of its character transitions, the share covered by
dictionary words, the words of its path and its neighbouring words.

Labelled findings may come from outside (``train``); :func:`label_rules` labels
the findings that carry a provider's format, an assignment to a secret's name,
or the looks of a known harmless string, and leaves the rest to the forest.
Transitions and dictionary come from the words of all documents (the dictionary
keeps the ``DICTIONARY`` most frequent); the forest is fitted on a bounded sample
of labelled findings chosen by hash (``SAMPLE_FINDINGS``); every candidate of every
whole text is then scored.

Defined cases: null and empty texts have no candidates; overlapping candidates
do not occur; without both kinds of label the rules decide alone (unlabelled
candidates are kept as no secret); repeated rows come out once per row.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import release, written

HELD_WORDS = 200_000      # different words that a task counts before it passes them on
SAMPLE_FINDINGS = 4000    # labelled findings per label used for training
DICTIONARY = 20_000
TREES, DEPTH, LEAF = 24, 8, 4
SEED = 11
MASK = "[SECRET]"

# Formats of providers' secrets, names that secrets are assigned to, harmless looks.
PROVIDER = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}|glpat-[A-Za-z0-9_-]{20}|npm_[A-Za-z0-9]{36}")
ASSIGNED = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer)"
                      r"['\"]?\s*(?:[:=]|=>|is)?\s*['\"]?$")
URL_USER = re.compile(r"://[^\s:/@'\"]*:$")
HARMLESS = re.compile(
    r"(?i)[0-9][0-9\-./:+]*|[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2}t?.*"
    r"|.*(?:example|changeme|placeholder|dummy|xxxx|your[_-]).*|v?[0-9]+(?:\.[0-9]+)+.*"
    r"|none|null|nil|true|false|undefined|string|str|text|required|optional|\*+|\.+|<[^>]*>?|\$[({]?\w+[)}]?|\{+[^}]*\}*"
    r"|[a-z_][\w.]*\(.*|(?:os|process|env|config|self|this|request)[.\[].*")
# Candidates, the surest first; the value is the group, if there is one.
KEY_BLOCK = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?!-----).)*-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:(?:\s|\\[nr]|[>#*\"'])*(?:(?:Proc-Type|DEK-Info):[^\n]*|[A-Za-z0-9+/]{40,}={0,2}))*"  # no end: whole base64 lines
    r"(?:[ \t]*(?:\r?\n|\\n)[ \t]*[A-Za-z0-9+/]{1,76}={0,2}(?=[ \t]*(?:\r?\n|\\n|\Z)))?)", re.S)
IN_URL = re.compile(r"://[^\s:/@'\"]{0,256}:([^\s@/'\"]+)@")
VALUE = re.compile(
    r"(?i)(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth(?!or(?!i))|credential|bearer)"
    r"[\w-]{0,30}\\?['\"]?\]?[ \t]*(?:=>|:=|[:=])[ \t]*(?:(?:bearer|basic|token)[ \t]+)?"
    r"(?:\\?\"((?:[^\"\\\n]|\\[^\"\n])+)|\\?'((?:[^'\\\n]|\\[^'\n])+)|([^\s'\"]+))")
CANDIDATE = re.compile(
    r"(?<![A-Za-z0-9_+/\-])(?:A[KS]IA|gh[pousr]_|xox[abprs]-|sk_|AIza|eyJ|glpat-|npm_)[A-Za-z0-9_+/\-]{10,}={0,2}"
    r"|(?<![A-Za-z0-9_+/\-])(?=[A-Za-z_+/\-]*[0-9])[A-Za-z0-9_+/\-]{10,}={0,2}"
    r"|(?<=[:=])(?:(?<=[=:])|\s*)[A-Za-z_+/\-]{10,}(?![A-Za-z0-9])", re.S)
NAMED = ("passw", "passphrase", "pwd", "secret", "token", "key", "auth", "credential", "bearer")
_WORDS = re.compile(r"[^\W\d_]+")
NEIGHBOURS = ("password", "passwd", "pwd", "secret", "token", "key", "auth", "credential", "bearer", "login", "commit",
              "sha", "hash", "checksum", "id", "uuid", "version", "card", "phone", "isbn", "http", "url")
PATHS = ("test", "example", "sample", "fixture", "doc", "lock", "vendor", "config", "env", "prod")


@dataclass
class Language:
    """What ordinary words look like: a dictionary and log probabilities of character pairs."""

    words: frozenset
    pairs: np.ndarray  # 128 x 128


@dataclass
class Forest:
    feature: np.ndarray    # trees x nodes, -1 at a leaf
    threshold: np.ndarray
    value: np.ndarray      # share of secrets

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                split = f[at] >= 0
                right = x[rows, np.maximum(f[at], 0)] > t[at]
                at = np.where(split, 2 * at + 1 + right, at)
            out += v[at]
        return out / len(self.feature)


@dataclass
class Model:
    language: Language
    forest: Forest | None


def label_rules(candidate: str, before: str, after: str = "") -> int | None:
    """1 for a finding in a known secret form, 0 for a known harmless look, else None."""
    if HARMLESS.fullmatch(candidate):
        return 0
    if candidate.startswith("-----BEGIN") or PROVIDER.fullmatch(candidate) or ASSIGNED.search(before):
        return 1
    if after.startswith("@") and URL_USER.search(before):
        return 1
    return None


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the values assigned to a secret's name."""
    at = 0
    while m := VALUE.search(text, at):
        k = m.lastindex
        s, e = m.span(k)
        if k == 3:  # without quotes: up to a query's next name, less the punctuation behind it
            query = text.rfind("?", max(0, m.start() - 256), m.start())
            if query >= 0 and not re.search(r"\s", text[query:s]):
                e = min((x for x in (text.find("&", s, e), text.find("#", s, e)) if x >= 0), default=e)
            e = s + len(text[s:e].rstrip(",;)]}.`"))
        if e > s:
            yield s, e
        at = max(e, s + 1)


def candidates(text: str | None) -> list[tuple[int, int, str, str, str]]:
    """(start, end, candidate, text before, text after) in order, offsets in code points."""
    text = text or ""
    low = text.lower()
    spans: list = []
    if "-----begin" in low:
        spans += [m.span() for m in KEY_BLOCK.finditer(text)]
    if "://" in low:
        spans += [m.span(1) for m in IN_URL.finditer(text)]
    if any(w in low for w in NAMED):
        spans += _assigned(text)
    for m in CANDIDATE.finditer(text):
        value = m.group()
        lead = len(value) - len(value.lstrip())
        spans.append((m.start() + lead, m.start() + lead + len(value.strip())))
    out: list = []
    taken: list = []  # starts and ends of the spans kept, in order
    for s, e in spans:
        i = bisect_right(taken, s)
        if i % 2 == 0 and (i == len(taken) or taken[i] >= e):  # touches none that is surer
            taken[i:i] = [s, e]
            out.append((s, e))
    return [(s, e, text[s:e], text[max(0, s - 48):s], text[e:e + 32]) for s, e in sorted(out)]


def _covered(word: str, words: frozenset) -> float:
    """Share of the letters that lie in dictionary words of four letters or more, longest first."""
    low, n, hit = word.lower(), len(word), 0
    i = 0
    while i < n:
        for size in range(min(12, n - i), 3, -1):
            if low[i:i + size] in words:
                hit += size
                i += size
                break
        else:
            i += 1
    return hit / max(1, n)


def features(candidate: str, before: str, after: str, path: str | None, lang: Language) -> list[float]:
    c, n = candidate, len(candidate)
    code = np.frombuffer(c.encode("latin-1", "replace"), np.uint8) & 127
    count = np.bincount(code, minlength=128) / max(1, n)
    p = count[count > 0]
    kind = np.select([(code >= 48) & (code < 58), (code >= 65) & (code < 91), (code >= 97) & (code < 123)], [0, 1, 2], 3)
    near_before = " ".join(_WORDS.findall(before)[-4:]).lower()
    near_after = " ".join(_WORDS.findall(after)[:3]).lower()
    tail = before.rstrip(" '\"")
    path = (path or "").lower()
    hexes = sum(ch in "0123456789abcdefABCDEF" for ch in c) / max(1, n)
    return [
        float(n), float(len(set(c))), float(-(p * np.log2(p)).sum()),
        *[float((kind == k).mean()) for k in range(4)], hexes,
        float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0,
        float(lang.pairs[code[:-1], code[1:]].mean()) if n > 1 else 0.0,
        _covered(c, lang.words),
        float(tail.endswith("=")), float(tail.endswith(":")), float(before.endswith(('"', "'"))),
        float(after[:1] in ('"', "'")), float("/" in c), float("-" in c), float("_" in c), float(c.endswith("=")),
        float("http" in before[-40:].lower()),
        *[float(w in near_before) for w in NEIGHBOURS], float(any(w in near_after for w in NEIGHBOURS)),
        *[float(w in path) for w in PATHS]]


def _pair_counts(seen: Counter) -> np.ndarray:
    """How often each pair of characters follows inside the counted words, as 128 * first + second."""
    code = np.frombuffer(" ".join(seen).encode(), np.uint8).astype(np.int64)
    n = np.repeat(np.fromiter(seen.values(), np.int64, len(seen)), np.fromiter(map(len, seen), np.int64, len(seen)) + 1)[:len(code)]
    inside = (code[:-1] != 32) & (code[1:] != 32)
    out = np.zeros(128 * 128, np.int64)
    np.add.at(out, (128 * code[:-1] + code[1:])[inside], n[:-1][inside])
    return out


def fit_language(docs: DataFrame) -> Language:
    """Dictionary and transitions of the words of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            pairs = _pair_counts(seen)
            at = np.flatnonzero(pairs)
            return pa.record_batch({
                "w": pa.array([*seen, *[None] * len(at)], pa.string()),
                "pair": pa.array([*[None] * len(seen), *at.tolist()], pa.int32()),
                "n": pa.array([*seen.values(), *pairs[at].tolist()], pa.int64())})

        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(w.lower() for w in _WORDS.findall(t or "") if w.isascii() and len(w) < 40)
                if len(seen) >= HELD_WORDS:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    counts = written(docs.select("text").mapInArrow(count, "w string, pair int, n long")
                     .groupBy("w", "pair").agg(F.sum("n").alias("n")), "words")
    pairs = np.ones(128 * 128)
    for r in counts.filter("pair is not null").collect():  # at most 128 * 128
        pairs[r["pair"]] += r["n"]
    rows = counts.filter("w is not null").orderBy(F.desc("n"), "w").limit(DICTIONARY).collect()
    release(counts)
    pairs = pairs.reshape(128, 128)
    pairs = np.log(pairs / pairs.sum(axis=1, keepdims=True))
    return Language(frozenset(r["w"] for r in rows if len(r["w"]) >= 4 and r["n"] > 1), pairs)


def _split(x: np.ndarray, y: np.ndarray, columns: np.ndarray) -> tuple[int, float, float]:
    """(feature, threshold, gini gain) of the best split."""
    best = (-1, 0.0, 1e-9)
    n, total = len(y), y.sum()
    base = 2 * (total / n) * (1 - total / n)
    for f in columns:
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= LEAF) & (cut <= n - LEAF)]
        if not len(cut):
            continue
        left = s[cut - 1] / cut
        right = (total - s[cut - 1]) / (n - cut)
        gain = base - (cut * 2 * left * (1 - left) + (n - cut) * 2 * right * (1 - right)) / n
        k = int(gain.argmax())
        if gain[k] > best[2]:
            best = (int(f), float((v[cut[k] - 1] + v[cut[k]]) / 2), float(gain[k]))
    return best


def fit_forest(x: np.ndarray, y: np.ndarray) -> Forest | None:
    """Bootstrap trees over random feature subsets; None unless both labels occur."""
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(SEED)
    n_nodes = 2 ** (DEPTH + 1) - 1
    feature = np.full((TREES, n_nodes), -1)
    threshold, value = np.zeros((TREES, n_nodes)), np.zeros((TREES, n_nodes))
    k = max(1, int(math.sqrt(x.shape[1])))
    sides = [np.flatnonzero(y == v) for v in (0, 1)]
    for t in range(TREES):
        rows = np.concatenate([rng.choice(s, min(len(y), 2000)) for s in sides])  # both labels evenly
        todo = [(0, rows)]
        while todo:
            node, r = todo.pop()
            value[t, node] = y[r].mean()
            if node >= n_nodes // 2 or len(r) < 2 * LEAF or value[t, node] in (0.0, 1.0):
                continue
            f, cut, _ = _split(x[r], y[r], rng.choice(x.shape[1], k, replace=False))
            if f < 0:
                continue
            feature[t, node], threshold[t, node] = f, cut
            right = x[r, f] > cut
            todo += [(2 * node + 1, r[~right]), (2 * node + 2, r[right])]
    return Forest(feature, threshold, value)


FINDING = "candidate string, before string, after string, path string, label int"


def findings(docs: DataFrame, path: str = "source") -> DataFrame:
    """Every candidate of every document, labelled by :func:`label_rules` (null: unknown)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [(v, b, a, p, label_rules(v, b)) for t, p in zip(*(c.to_pylist() for c in part.columns))
                        for _, _, v, b, a in candidates(t)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], pa.int32() if k == 4 else pa.string()) for k in range(5)],
                    ["candidate", "before", "after", "path", "label"])

    p = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    return docs.select("text", p.alias("path")).mapInArrow(run, FINDING)


def train(docs: DataFrame, labelled: DataFrame) -> Model:
    """Fit on at most ``SAMPLE_FINDINGS`` labelled findings per label, picked by hash; repeats count once."""
    language = fit_language(docs)
    pool = (labelled.filter("label is not null").select("candidate", "before", "after", "path", "label").distinct()
            .withColumn("h", F.xxhash64("candidate", "before", "after", F.lit("train"))))
    parts = [pool.filter(F.col("label") == v).orderBy("h", "candidate", "before").limit(SAMPLE_FINDINGS).collect()
             for v in (0, 1)]
    rows = [r for part in parts for r in part]
    x = np.array([features(r["candidate"], r["before"], r["after"], r["path"], language) for r in rows])
    return Model(language, fit_forest(x, np.array([r["label"] for r in rows], float)))


def _judge(model: Model, found: list[tuple], path: str | None) -> np.ndarray:
    if model.forest is None:
        return np.array([float(label_rules(v, b, a) or 0) for _, _, v, b, a in found])
    return model.forest.score(np.array([features(v, b, a, path, model.language) for _, _, v, b, a in found]))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("score", T.DoubleType())]))


def scan(docs: DataFrame, model: Model, path: str = "source") -> DataFrame:
    """(row, n_candidates, secrets, masked): the rows of ``docs`` as one struct, so no column name can clash."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # dictionary and trees, bounded
    p = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("__text"), p.alias("__path"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_candidates", T.LongType()),
                           T.StructField("secrets", SPANS), T.StructField("masked", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n, spans, masked = [], [], []
                for text, path in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    found = candidates(text)
                    n.append(len(found))
                    hit = [(f[0], f[1], float(s)) for f, s in zip(found, _judge(m, found, path)) if s >= 0.5] if found else []
                    spans.append([{"start": s, "end": e, "score": v} for s, e, v in hit])
                    for s, e, _ in reversed(hit):
                        text = text[:s] + MASK + text[e:]
                    masked.append(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))),
                     pa.array(masked, pa.string())], ["row", "n_candidates", "secrets", "masked"])

    return rows.mapInArrow(run, schema)


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_candidates, n_secrets, secrets, masked_sha256 of every document."""
    docs = docs.select("doc_id", "text", "source")
    out = scan(docs, train(docs, findings(docs)))
    return out.select("row.doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), "secrets",
                      F.sha2(F.coalesce("masked", F.lit("")), 256).alias("masked_sha256"))
