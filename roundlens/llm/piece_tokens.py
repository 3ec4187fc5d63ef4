"""SentencePiece BPE encoding by a table of last tokens, and decoding.

Byte-pair encoding decides every prefix of a text by that prefix alone: its
last token is the one vocabulary entry that ends there and is compatible with
the last token of the prefix it leaves over.  Two neighbouring tokens are
compatible if no merge would ever have joined them; that is seen by undoing the
merges next to their border, latest first.  An automaton finds the vocabulary
entries that end at each character, so one pass fills the table, and the tokens
are read off backwards.  The cost is linear in the text, whatever it repeats.

Texts are cut first between characters that no vocabulary entry holds side by
side (with the usual vocabularies: before each word), and equal pieces of text
are encoded once per task.

What tokens may follow each other is fixed by merge rank, so the scores must
differ.  Entries that share one score, lower than all others (runs of blanks in
some vocabularies), are merged afterwards, leftmost first, in the stretches
where they can apply.  Characters outside the vocabulary become byte tokens.
Models of other kinds (no byte fallback, other ties, entries unlike BPE's) are
refused with ``ValueError``.

Defined cases: a null text is encoded as an empty one (no tokens); every row
gives one row, repeated or not, null doc_id or not; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_PIECES = 1 << 18   # remembered pieces and token pairs of one task; only speed depends on it
CACHE_CHARS = 64
OUT_CHARS = 2 << 20      # text handed on per batch
BASE = -1                # rank of single characters: they are not merged from anything


def merge_all(symbols: list[str], scores: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain BPE: best score first, then leftmost.  Returns the symbols left and the last pair merged."""
    s, after = list(symbols), list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    heap: list = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b < len(s):
            score = scores.get(s[a] + s[b])
            if score is not None:
                heapq.heappush(heap, (-score, a, b, len(s[a]) + len(s[b])))

    for a in range(len(s) - 1):
        offer(a, a + 1)
    last = None
    while heap:
        _, a, b, size = heapq.heappop(heap)
        if not s[a] or not s[b] or len(s[a]) + len(s[b]) != size:
            continue
        last = (s[a], s[b])
        s[a], s[b] = s[a] + s[b], ""
        after[a] = after[b]
        if after[b] < len(s):
            before[after[b]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [x for x in s if x], last


def learn_table(model: bytes) -> dict:
    """The merge tables of a model: small arrays (bounded by the vocabulary) that tasks encode with."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = sp.vocab_size()
    plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    bytes_of = {sp.id_to_piece(i): i for i in range(size) if sp.is_byte(i)}
    if len(bytes_of) != 256:
        raise ValueError("the model has no byte fallback")
    ids = {sp.id_to_piece(i): i for i in plain}
    score = {t: sp.get_score(i) for t, i in ids.items() if len(t) > 1}
    seen, tied = set(), []
    for v in score.values():
        (tied.append(v) if v in seen else seen.add(v))
    late = {t: v for t, v in score.items() if tied and v <= max(tied)}
    early = {t: v for t, v in score.items() if t not in late}
    if any(c not in ids for t in score for c in t):
        raise ValueError("a vocabulary entry holds a character that is none itself")
    rank = {t: k for k, t in enumerate(sorted(early, key=lambda t: -early[t]))}
    split = {}
    for t in rank:
        left, last = merge_all(list(t), early)
        if len(left) == 1:  # others never result from merges
            if max(rank.get(x, BASE) for x in last) >= rank[t]:
                raise ValueError(f"entry {t!r} is merged from a later entry")
            split[t] = last
        elif len(merge_all(list(t), score)[0]) == 1:
            raise ValueError(f"entry {t!r} needs an entry of the tied scores")
    return {"model": model, "late": late, "split": split, "ids": {t: ids[t] for t in ids},
            "rank": {t: rank[t] for t in split}, "bytes": [bytes_of[f"<0x{b:02X}>"] for b in range(256)]}


class Encoder:
    """Encodes texts in one task with the tables of :func:`learn_table`."""

    def __init__(self, table: dict):
        import ahocorasick
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=table["model"])
        self.ids, self.late, self.bytes = table["ids"], table["late"], table["bytes"]
        split, rank = table["split"], table["rank"]
        chars = [t for t in self.ids if len(t) == 1]
        self.names = [*chars, *split]           # tokens by number
        number = {t: k for k, t in enumerate(self.names)}
        self.rank = [BASE] * len(chars) + [rank[t] for t in split]
        self.left = [0] * len(chars) + [number[a] for a, _ in split.values()]
        self.right = [0] * len(chars) + [number[b] for _, b in split.values()]
        self.merged = {a * len(self.names) + b: rank[t] for t, a, b in zip(
            split, self.left[len(chars):], self.right[len(chars):])}
        self.out = [self.ids[t] for t in self.names]
        self.size = [len(t) for t in self.names]
        self.automaton = ahocorasick.Automaton()
        for t, k in number.items():
            self.automaton.add_word(t, k)
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple] = {}
        self.late_known: dict[tuple, list] = {}
        # Character pairs inside vocabulary entries, as bits: texts are cut at all other pairs.
        self.index = np.zeros(0x110000, np.int32)
        self.index[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.wide = len(chars) + 1
        bits = np.zeros(-(-self.wide ** 2 // 8), np.uint8)
        inside = self._pairs(split)
        np.bitwise_or.at(bits, inside >> 3, np.left_shift(1, inside & 7).astype(np.uint8))
        self.bits = bits
        self.late_marks = sorted({t[k:k + 2] for t in self.late for k in range(len(t) - 1)})
        self.late_pairs = self._pairs(self.late)
        self.first_char = np.zeros(self.sp.vocab_size(), np.int64)
        self.last_char = np.zeros(self.sp.vocab_size(), np.int64)
        for t, i in self.ids.items():
            self.first_char[i], self.last_char[i] = self.index[ord(t[0])], self.index[ord(t[-1])]
        self.text_of = {i: t for t, i in self.ids.items()}

    def _pairs(self, entries) -> np.ndarray:
        at = {t[k:k + 2] for t in entries for k in range(len(t) - 1)}
        return np.array(sorted(int(self.index[ord(a)]) * self.wide + int(self.index[ord(b)]) for a, b in at), np.int64)

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves the border between token numbers a and b alone (remembered)."""
        if len(self.fits) > 4 * CACHE_PIECES:
            self.fits.clear()
        got = self.fits[a * len(self.names) + b] = self._border_holds(a, b)
        return got

    def _border_holds(self, a: int, b: int) -> bool:
        rank, size, merged = self.rank, len(self.names), self.merged
        until = float("inf")  # a merge across the border ranked below this would have come first
        while True:
            joined = merged.get(a * size + b)
            if joined is not None and joined < until:
                return False
            if rank[a] == BASE and rank[b] == BASE:
                return True
            if rank[a] > rank[b]:   # the left token was merged last: at equal rank it goes first
                until, a = rank[a], self.right[a]
            else:                   # the right one was: at equal rank the border goes first
                until, b = rank[b] + 1, self.left[b]

    def piece(self, text: str) -> tuple:
        """Token ids of a piece of known characters that no cut divides."""
        last, size, fits, count = [-1] * (len(text) + 1), self.size, self.fits, len(self.names)
        for end, t in self.automaton.iter(text):
            if last[end + 1] < 0:
                start = end + 1 - size[t]
                if start:
                    a = last[start]
                    if a < 0:
                        continue
                    fit = fits.get(a * count + t)
                    if not (self.compatible(a, t) if fit is None else fit):
                        continue
                last[end + 1] = t
        back, at, out = [], len(text), self.out
        while at:
            t = last[at]
            back.append(out[t])
            at -= size[t]
        return tuple(back[::-1])

    def _unit(self, text: str) -> tuple:
        if len(text) == 1 and not self.index[ord(text)]:
            got = tuple(self.bytes[b] for b in text.encode())
        else:
            got = self.piece(text)
        if len(text) <= CACHE_CHARS:
            if len(self.known) > CACHE_PIECES:
                self.known.clear()
            self.known[text] = got
        return got

    def _late(self, ids: list[int]) -> list[int]:
        a = np.array(ids, np.int64)
        near = np.isin(self.last_char[a[:-1]] * self.wide + self.first_char[a[1:]], self.late_pairs)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], near.view(np.int8), [0]])))
        out, done = [], 0
        for lo, hi in zip(edge[::2].tolist(), (edge[1::2] + 1).tolist()):
            key = tuple(ids[lo:hi])
            got = self.late_known.get(key)
            if got is None:
                got = [self.ids[t] for t in merge_all([self.text_of[i] for i in key], self.late)[0]]
                if len(key) <= CACHE_CHARS and len(self.late_known) < CACHE_PIECES:
                    self.late_known[key] = got
            out += ids[done:lo]
            out += got
            done = hi
        return out + ids[done:]

    def encode(self, text: str) -> list[int]:
        s = self.sp.normalize(text)
        if not s:
            return []
        at = self.index[np.frombuffer(s.encode("utf-32-le"), np.uint32)].astype(np.int64)
        pair = at[:-1] * self.wide + at[1:]
        cut = np.flatnonzero(((self.bits[pair >> 3] >> (pair & 7).astype(np.uint8)) & 1) == 0) + 1
        edges = [0, *cut.tolist(), len(s)]
        known, unit = self.known, self._unit
        ids = list(chain.from_iterable([
            known.get(x) or unit(x) for x in [s[a:b] for a, b in zip(edges, edges[1:])]]))
        if len(ids) > 1 and any(m in s for m in self.late_marks):
            ids = self._late(ids)
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


def _encode(table: dict, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(table)
            ids, back, chars, start = [], [], 0, 0
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py() or ""
                ids.append(encoder.encode(text))
                back.append(encoder.decode(ids[-1]) if decoded else None)
                chars += len(text)
                if chars >= OUT_CHARS or row + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, len(ids)), pa.array(ids, pa.list_(pa.int32())),
                         pa.array(back, pa.string())], names=["doc_id", "ids", "decoded"])
                    start, ids, back, chars = row + 1, [], [], 0
    return run


def encode_pieces(docs: DataFrame, model_path: str, decoded: bool = True) -> DataFrame:
    """doc_id, ids array<int>, decoded (the text read back from the ids; null if not ``decoded``)
    for every row of ``docs``.  The model file is read on the driver and its tables go to the tasks."""
    with open(model_path, "rb") as f:
        table = learn_table(f.read())
    return docs.select("doc_id", "text").mapInArrow(
        _encode(table, decoded), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def token_report(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids (decimal, comma-joined) and of the decoded text."""
    tokens = encode_pieces(docs, model_path)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                         F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
