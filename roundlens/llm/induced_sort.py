"""External induced suffix sorting with common-prefix values, in numpy batches.

Suffixes are split into L (greater than their successor) and S.  The S suffixes
that follow an L suffix (S*) are sorted through a reduced string of their
substrings' names, by recursion; the order of all others is *induced* from
them: scanning suffixes in order, each sends its predecessor to the queue of
the predecessor's first character.  The queues form a monotone priority queue
(ordered by character, then arrival), hold (suffix, common prefix) tuples and
move to disk beyond ``MEMORY_ITEMS``.  The common prefix of two neighbours in a
queue is one more than the minimum over the scanned stretch between their
sources, so it travels with the tuples.  Values are capped at ``depth``.

Spill files are anonymous files private to one task; nothing else reads them
and they vanish with it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 16            # tuples moved at a time
MEMORY_ITEMS = 1 << 22     # tuples of one queue kept in memory before it spills
MEMORY_TEXT = 256 << 20    # characters kept in memory before the text is mapped from disk
DOUBLING_ALPHABET = 1 << 12  # reduced strings with more names than this end the recursion

_TUPLE = np.dtype([("pos", "<i8"), ("lcp", "<i4")])


class DiskQueue:
    """First-in first-out (pos, lcp) tuples; full parts go to an anonymous file."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.held = 0
        self.file = None
        self.written = self.read_at = 0

    def push(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        part = np.empty(len(pos), _TUPLE)
        part["pos"], part["lcp"] = pos, lcp
        self.parts.append(part)
        self.held += len(part)
        if self.held > MEMORY_ITEMS:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(self.written * _TUPLE.itemsize)
            for p in self.parts:
                p.tofile(self.file)
            self.written += self.held
            self.parts, self.held = [], 0

    def pop(self) -> np.ndarray | None:
        """The next block of tuples in arrival order, None when the queue is empty."""
        if self.read_at < self.written:
            self.file.seek(self.read_at * _TUPLE.itemsize)
            part = np.fromfile(self.file, _TUPLE, min(BLOCK, self.written - self.read_at))
            self.read_at += len(part)
            return part
        if not self.parts:
            return None
        n = size = 0
        while n < len(self.parts) and size < BLOCK:
            size += len(self.parts[n])
            n += 1
        part = self.parts[0] if n == 1 else np.concatenate(self.parts[:n])
        self.parts[:n] = [part[BLOCK:]] if size > BLOCK else []
        part = part[:BLOCK]
        self.held -= len(part)
        return part

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def mapped(text: np.ndarray) -> np.ndarray:
    """The text itself, or a map of an anonymous file when it is too large to keep."""
    if text.nbytes <= MEMORY_TEXT:
        return text
    f = tempfile.TemporaryFile()
    text.tofile(f)
    return np.memmap(f, text.dtype, "r")


def smaller_types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the end of the text is smaller than any character, so the last is L."""
    n = len(text)
    if not n:
        return np.zeros(0, bool)
    differs = np.append(text[1:] != text[:-1], True)
    nxt = np.where(differs, np.arange(n), n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    return (nxt < n - 1) & (text[nxt] < text[np.minimum(nxt + 1, n - 1)])


def _eights(text: np.ndarray) -> np.ndarray:
    """Row i holds the 8 characters from i on (zeros beyond the end)."""
    padded = np.concatenate([text, np.zeros(8, text.dtype)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int,
                  eights: np.ndarray | None = None) -> np.ndarray:
    """Direct comparison of suffix pairs, at most ``depth`` characters."""
    if eights is None:
        width = depth + 8  # a few pairs: read just their stretches
        out = [_prefix_of(text[x:x + width], text[y:y + width]) for x, y in zip(a, b)]
        return np.minimum(np.array(out, np.int64), depth)
    n = len(text)
    room = n - np.maximum(a, b)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(0, depth, 8):
        same = eights[np.minimum(a[live] + k, n)] == eights[np.minimum(b[live] + k, n)]
        run = np.where(same.all(axis=1), 8, same.argmin(axis=1))
        out[live] += run
        live = live[run == 8]
        if not len(live):
            break
    return np.minimum(np.minimum(out, room), depth)


def _prefix_of(x: np.ndarray, y: np.ndarray) -> int:
    m = min(len(x), len(y))
    differs = np.flatnonzero(x[:m] != y[:m])
    return int(differs[0]) if len(differs) else m


class _Scan:
    """One direction of induction over the character queues."""

    def __init__(self, text: np.ndarray, s_type: np.ndarray, sigma: int, small: bool, depth: int):
        self.text, self.s_type, self.small, self.depth = text, s_type, small, depth
        self.queues = [DiskQueue() for _ in range(sigma)]
        self.started = np.zeros(sigma, bool)
        self.least = np.full(sigma, depth, np.int64)  # min over what was scanned since a queue's last arrival

    def send(self, block: np.ndarray) -> None:
        """Scan a block: every predecessor of the scan's type joins the queue of its character."""
        pos, lcp = block["pos"], block["lcp"].astype(np.int64)
        prev = np.flatnonzero(pos > 0)
        prev = prev[self.s_type[pos[prev] - 1] == self.small]
        before = pos[prev] - 1
        char = self.text[before]
        if char.dtype.itemsize > 2 and len(self.queues) <= 1 << 16:
            char = char.astype(np.uint16)  # stable sorts of short integers are radix sorts
        order = np.argsort(char, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], char[order][1:] != char[order][:-1]])) if len(order) else order
        floor = np.minimum(self.least, lcp.min())
        for k, lo in enumerate(edge):
            hi = edge[k + 1] if k + 1 < len(edge) else len(order)
            at, c = prev[order[lo:hi]], int(char[order[lo]])
            cut = np.concatenate([[0], at + 1])
            low = np.minimum.reduceat(np.append(lcp, self.depth), cut)  # stretches up to each source, and the rest
            first = min(low[0], self.least[c])
            value = np.minimum(np.concatenate([[first], low[1:-1]]) + 1, self.depth)
            if not self.started[c]:
                value[0], self.started[c] = 0, True
            self.queues[c].push(before[order[lo:hi]], value)
            floor[c] = low[-1]
        self.least = floor


def _rank_by_doubling(names: np.ndarray, rounds: int) -> np.ndarray:
    """Suffix order of the reduced string by prefix doubling, at most 2^rounds names deep."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64) + 1
    h = 1
    for _ in range(rounds):
        if rank.max() == n:
            break
        key = rank * (n + 2) + np.concatenate([rank[h:], np.zeros(min(h, n), np.int64)])
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
        h *= 2
    return np.argsort(rank, kind="stable")


def _sorted_stars(text: np.ndarray, s_type: np.ndarray, sigma: int, depth: int) -> np.ndarray:
    """S* suffixes in order: induce the order of their substrings, name them, recurse on the names."""
    star = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if len(star) < 2:
        return star
    by_char = star[np.argsort(text[star], kind="stable")]
    zero = np.zeros(len(star), np.int32)
    is_star = np.zeros(len(text), bool)
    is_star[star] = True
    order = np.concatenate([b["pos"][is_star[b["pos"]]]
                            for b in _induce(text, s_type, sigma, by_char, zero, 1)])
    # A star substring runs to the next star; equal ones agree in length and content.
    end = np.append(star[1:], len(text) - 1) + 1
    length = np.zeros(len(text), np.int64)
    length[star] = end - star
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    idx = np.flatnonzero(same)
    eights, k = _eights(text), 0
    while len(idx):  # compare 8 characters of the still equal pairs at a time
        inside = np.arange(k, k + 8) < length[a[idx], None]
        equal = (eights[np.minimum(a[idx] + k, len(text))] == eights[np.minimum(b[idx] + k, len(text))]) | ~inside
        good = equal.all(axis=1)
        same[idx[~good]] = False
        k += 8
        idx = idx[good & (length[a[idx]] > k)]
    name = np.zeros(len(text), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    names = name[star]
    count = int(names.max()) + 1
    if count == len(star):
        return order
    if count <= DOUBLING_ALPHABET:
        return star[suffix_order(names, count, depth)]
    return star[_rank_by_doubling(names, int(np.ceil(np.log2(depth))))]


def _induce(text, s_type, sigma: int, stars, star_lcp, depth: int) -> Iterator[np.ndarray]:
    """(pos, lcp) blocks of all suffixes from sorted S* suffixes; lcp is with the suffix before."""
    n = len(text)
    edges = np.searchsorted(text[stars], np.arange(sigma + 1)) if len(stars) else np.zeros(sigma + 1, int)
    down = _Scan(text, s_type, sigma, False, depth)
    # The last suffix is the smallest that starts with its character.
    last = int(text[n - 1])
    down.queues[last].push(np.array([n - 1]), np.array([0]))
    down.started[last] = True
    large: list[DiskQueue] = []
    for c in range(sigma):
        kept, queue, tail = DiskQueue(), down.queues[c], None
        down.least[:] = 0
        if edges[c] == edges[c + 1] and not queue.held and not queue.written:
            large.append(kept)
            continue
        down.least[c] = 0
        while (block := queue.pop()) is not None:
            kept.push(block["pos"], block["lcp"])
            tail = int(block["pos"][-1])
            down.send(block)
        for lo in range(edges[c], edges[c + 1], BLOCK):
            hi = min(lo + BLOCK, edges[c + 1])
            block = np.empty(hi - lo, _TUPLE)
            block["pos"], block["lcp"] = stars[lo:hi], star_lcp[lo:hi]
            if lo == edges[c]:
                block["lcp"][0] = 0 if tail is None else common_prefix(
                    text, np.array([tail]), block["pos"][:1], depth)[0]
            down.send(block)
        queue.close()
        large.append(kept)
    up = _Scan(text, s_type, sigma, True, depth)
    done: list[tuple[list, list]] = [([], [])] * sigma
    for c in range(sigma - 1, -1, -1):
        # S suffixes arrive from large to small, with their common prefix to the one after.
        small, lowest = [], None
        up.least[:] = 0
        while (block := up.queues[c].pop()) is not None:
            small.append(block)
            lowest = int(block["pos"][-1])
            up.send(block)
        up.queues[c].close()
        big = []
        while (block := large[c].pop()) is not None:
            big.append(block)
        large[c].close()
        right = 0
        if big and lowest is not None:
            right = int(common_prefix(text, big[-1]["pos"][-1:], np.array([lowest]), depth)[0])
        bridge = right
        for block in reversed(big):
            turned = block[::-1].copy()
            turned["lcp"] = np.concatenate([[right], block["lcp"][:0:-1]])
            right = int(block["lcp"][0])
            up.send(turned)
        done[c] = (big, [])
        if small:
            s = np.concatenate(small)[::-1].copy()
            after = s["lcp"].copy()  # with the suffix after it in final order
            s["lcp"] = np.concatenate([[bridge], after[:-1]])
            done[c] = (big, [s])
    for big, s in done:
        yield from big
        yield from s


def _alphabet(text: np.ndarray) -> int:
    return int(text.max()) + 1 if len(text) else 1


def suffixes(text: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """(pos, lcp) blocks of the suffix array; lcp with the suffix before, capped at ``depth``.

    Beyond ``depth`` characters the order of equal prefixes is not defined.
    """
    if not len(text):
        return
    text = mapped(text)
    s_type = smaller_types(text)
    sigma = _alphabet(text)
    stars = _sorted_stars(text, s_type, sigma, depth)
    lcp = np.zeros(len(stars), np.int32)
    if len(stars) > 1:
        eights = _eights(text)
        for lo in range(1, len(stars), BLOCK):
            hi = min(lo + BLOCK, len(stars))
            lcp[lo:hi] = common_prefix(text, stars[lo - 1:hi - 1], stars[lo:hi], depth, eights)
    yield from _induce(text, s_type, sigma, stars, lcp, depth)


def suffix_order(text: np.ndarray, sigma: int, depth: int) -> np.ndarray:
    """Suffix array of an integer string (one level of the recursion)."""
    s_type = smaller_types(text)
    stars = _sorted_stars(text, s_type, sigma, depth)
    zero = np.zeros(len(stars), np.int32)
    return np.concatenate([b["pos"] for b in _induce(text, s_type, sigma, stars, zero, 1)])
