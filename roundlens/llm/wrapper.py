"""Main-text extraction by wrapper induction over the pages of a host.

Each host has a reference page (the smallest hash of page_id).  Every page of
the host is aligned with it by simple tree matching: equal tags match, children
match in order for the largest number of matched nodes.  Over all pages of a
host the matched nodes split into *template* (blocks that read the same on all
but a few pages) and *slots* (text that varies).  The wrapper is the deepest
reference node above all slots, leaving out boilerplate; a page's main text is
the part aligned with that node, without its template blocks.  Only a page to
which no wrapper applies (a host whose pages do not vary, or nothing matched) is
read from its ``article`` or ``main`` mark, or else from its body.

Names and tags are a prior for boilerplate, never the last word: ``html``,
``body``, ``main`` and ``article`` are never boilerplate, nor is an element that
holds the page's article mark or most of its text (a form around a page).

Matching is exact whatever the number of children: equal structure is matched
outright (nothing can score higher), the score of two structures is computed
once, and long lists are aligned by halves in linear space.

Inside the chosen part every block is kept, except boilerplate and template.
Blocks are joined by one newline, white space inside a block is one space,
character references are decoded.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own; repeated pages come out once per row; unclosed, stray and cut-off tags
are read as far as they go; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spread import written

# Element classes of HTML and names that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("script style noscript template nav header footer aside form button select textarea input "
                    "iframe svg canvas object dialog head title menu dir video audio map".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav "
                  "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "tr"}
SAME_CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option", "tr": "tr td th", "td": "td th",
               "th": "td th", "tbody": "tbody thead tr td th", "thead": "tbody tr td th", "tfoot": "tbody thead tr td th"}
NAMES = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
                  "navigation menu breadcrumb breadcrumbs sidebar widget footer masthead cookie cookies consent notice "
                  "notices gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social "
                  "related recommended recommendations comment comments disqus reply replies respond pagination pager "
                  "toolbar skip".split())

MAX_DEPTH = 200        # deeper subtrees hang at this depth (their text stays in place)
TABLE_CELLS = 1 << 22  # larger tables of two child lists are aligned by halves
SCORES = 1 << 18       # remembered scores of structure pairs; only speed depends on it
MOST = 0.8             # share of a page's text that no boilerplate holds
COMMON = 0.9           # share of a host's pages on which a template block stands
LEAST_PAGES = 3        # pages of a host from which on it may have template blocks
NEVER = frozenset("html body main article".split())
NO_TEXT = frozenset("script style noscript template head title select textarea input iframe svg canvas object map".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAME = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """``shape`` names the tags of a subtree, ``size`` counts them, ``words`` hashes its text."""
    __slots__ = ("tag", "children", "drop", "number", "shape", "size", "words")

    def __init__(self, tag: str, drop: bool = False):
        self.tag, self.children, self.drop, self.number = tag, [], drop, -1  # children: Node or str
        self.shape = self.size = self.words = None  # set by number()


_judged: dict[str, bool] = {}  # attributes seen lately: the tags of a site repeat


def _named_boilerplate(attrs: str) -> bool:
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False
    if _HIDDEN.search(attrs):
        return True
    for m in _NAME.finditer(attrs):
        value = m.group(1) or m.group(2) or m.group(3) or ""
        if any(w.lower() in NAMES for w in _WORD.findall(value)):
            return True
    return False


def parse(page: str | None) -> Node:
    """Tree of a page, tolerant of unclosed and stray tags."""
    root = Node("#root")
    stack = [root]
    page = page or ""
    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            break
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in CLOSES_P:
            _close(stack, ("p",), BLOCK - {"p"})
        if tag in SAME_CLOSES:
            _close(stack, tuple(SAME_CLOSES[tag].split()), {"ul", "ol", "dl", "table", "select"})
        attrs = m.group(3)
        if attrs not in _judged:
            if len(_judged) >= 1024:
                _judged.clear()
            _judged[attrs] = _named_boilerplate(attrs)
        node = Node(tag, tag in DROPPED or tag not in NEVER and _judged[attrs])
        if len(stack) <= MAX_DEPTH or tag in RAW:
            stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
            if tag not in DROPPED:
                node.children.append(page[at:end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif tag not in VOID and not attrs.rstrip().endswith("/") and len(stack) <= MAX_DEPTH:
            stack.append(node)
    rest = page[at:]
    if rest:
        stack[-1].children.append(rest)
    _keep_wrappers(root)
    return root


def _keep_wrappers(root: Node) -> None:
    """Elements that hold the article mark or most of the page's text are not boilerplate."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(c for c in n.children if isinstance(c, Node) and c.tag not in NO_TEXT)
    text: dict[int, int] = {}
    mark: dict[int, bool] = {}
    for n in reversed(order):  # children before parents
        inner = [c for c in n.children if isinstance(c, Node)]
        text[id(n)] = (sum(len(c.split()) for c in n.children if isinstance(c, str))
                       + sum(text.get(id(c), 0) for c in inner))
        # A mark inside boilerplate of its own (teasers in a sidebar) does not count.
        mark[id(n)] = n.tag in ("article", "main") or any(mark.get(id(c), False) and not c.drop for c in inner)
    for n in order:
        if n.drop and n.tag not in NO_TEXT and (
                n.tag == "form" and mark[id(n)] or text[id(n)] >= MOST * max(1, text[id(root)])):
            n.drop = False


def _close(stack: list[Node], tags: tuple, stop: set) -> None:
    """Implied end tags: close the nearest of ``tags`` unless a ``stop`` element lies above it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in stop:
            return


def number(root: Node) -> list[Node]:
    """Nodes in document order; each gets its place as number, and what is known of its subtree."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        n.number = len(out)
        out.append(n)
        todo.extend(c for c in reversed(n.children) if isinstance(c, Node))
    for n in reversed(out):
        inner = _elements(n)
        n.shape = hash((n.tag, *[c.shape for c in inner]))
        n.size = 1 + sum(c.size for c in inner)
        n.words = hash(tuple(c.words if isinstance(c, Node) else " ".join(c.split()) for c in n.children))
    return out


def _elements(n: Node) -> list[Node]:
    return [c for c in n.children if isinstance(c, Node)]


def own_text(n: Node) -> str:
    return " ".join(" ".join(c for c in n.children if isinstance(c, str)).split())


def score(a: Node, b: Node, known: dict) -> int:
    """Simple tree matching: nodes in the best ordered match of two numbered trees."""
    if a.tag != b.tag:
        return 0
    if a.shape == b.shape and a.size == b.size:
        return a.size
    key = (a.shape, b.shape)
    got = known.get(key)
    if got is None:
        if len(known) > SCORES:
            known.clear()
        ends, x, y = _trimmed(_elements(a), _elements(b))
        got = known[key] = 1 + sum(u.size for u, _ in ends) + (int(_last_row(x, y, known)[-1]) if x and y else 0)
    return got


def _trimmed(x: list[Node], y: list[Node]) -> tuple[list, list[Node], list[Node]]:
    """Pairs of equal structure at both ends (some best match holds them) and what lies between."""
    def same(u: Node, v: Node) -> bool:
        return u.shape == v.shape and u.size == v.size

    lo, hi = 0, 0
    while lo < min(len(x), len(y)) and same(x[lo], y[lo]):
        lo += 1
    while hi < min(len(x), len(y)) - lo and same(x[-1 - hi], y[-1 - hi]):
        hi += 1
    ends = list(zip(x[:lo], y[:lo])) + list(zip(x[len(x) - hi:], y[len(y) - hi:]))
    return ends, x[lo:len(x) - hi], y[lo:len(y) - hi]


def _rows(x: list[Node], y: list[Node], known: dict) -> Iterator[np.ndarray]:
    """For each of x the scores of all prefixes of y matched with x up to there."""
    kinds: dict = {}
    kind = np.array([kinds.setdefault((v.tag, v.shape), len(kinds)) for v in y])
    first = {k: v for v, k in zip(reversed(y), kind[::-1].tolist())}
    weights: dict = {}
    row = np.zeros(len(y) + 1, np.int64)
    for u in x:
        w = weights.get((u.tag, u.shape))
        if w is None:
            w = weights[u.tag, u.shape] = np.array([score(u, first[k], known) for k in range(len(kinds))])[kind]
        new = np.zeros_like(row)
        new[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + w))
        row = new
        yield row


def _last_row(x: list[Node], y: list[Node], known: dict) -> np.ndarray:
    row = np.zeros(len(y) + 1, np.int64)
    for row in _rows(x, y, known):
        pass
    return row


def _aligned(x: list[Node], y: list[Node], known: dict) -> list[tuple[Node, Node]]:
    """The pairs of a best ordered match of two lists."""
    ends, x, y = _trimmed(x, y)
    if not x or not y:
        return ends
    if len(x) > 1 and len(x) * len(y) > TABLE_CELLS:  # by halves of x, each with its best part of y
        half = len(x) // 2
        down, up = _last_row(x[:half], y, known), _last_row(x[half:][::-1], y[::-1], known)
        cut = int(np.argmax(down + up[::-1]))
        return ends + _aligned(x[:half], y[:cut], known) + _aligned(x[half:], y[cut:], known)
    table = [np.zeros(len(y) + 1, np.int64), *_rows(x, y, known)]
    i, j, out = len(x), len(y), []
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((x[i], y[j]))
    return ends + out


def match(a: Node, b: Node, pairs: list[tuple[Node, Node]], known: dict | None = None) -> int:
    """Size of the best ordered match of two trees, and its pairs."""
    known = {} if known is None else known
    for root in (a, b):
        if root.shape is None:
            number(root)
    todo = [(a, b)] if a.tag == b.tag else []
    while todo:
        u, v = todo.pop()
        pairs.append((u, v))
        x, y = _elements(u), _elements(v)
        todo.extend(zip(x, y) if u.shape == v.shape and u.size == v.size else _aligned(x, y, known))
    return len(pairs)


def main_text(part: list[Node], template: frozenset | set = frozenset()) -> str:
    """Blocks of the nodes in page order, without boilerplate and the blocks numbered in ``template``."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join(html_lib.unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    todo: list = []
    for n in reversed(part):
        todo.append((n, True))
    while todo:
        n, top = todo.pop()
        if n is None:
            end()
        elif isinstance(n, str):
            line.append(n)
        elif n.tag == "br":
            line.append(" ")
        elif top or not n.drop and n.number not in template:
            if n.tag in BLOCK:
                end()
                todo.append((None, False))
            todo.extend((c, False) for c in reversed(n.children))
    end()
    return "\n".join(blocks)


def marked(nodes: list[Node]) -> list[Node]:
    """Outermost nodes by which the page marks its article."""
    for tag in ("article", "main"):
        found, inside = [], set()
        for n in nodes:
            if n.number in inside:
                continue
            if n.drop:
                inside.update(d.number for d in _below(n))
            elif n.tag == tag:
                found.append(n)
                inside.update(d.number for d in _below(n))
        if found:
            return found
    return []


def _below(n: Node) -> list[Node]:
    out, todo = [], [n]
    while todo:
        x = todo.pop()
        out.append(x)
        todo.extend(_elements(x))
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def induce(pages: DataFrame) -> DataFrame:
    """(host, reference, slots, template): each host's reference page, the numbers of its varying nodes
    and those of its blocks that read the same on (nearly) all pages."""
    refs = written(pages.groupBy("host").agg(
        F.min_by("html", F.struct(F.xxhash64("page_id"), F.xxhash64("html"))).alias("reference"),
        F.count(F.lit(1)).alias("pages")), "wrapper-refs")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        count: dict = {}
        known: dict = {}
        for batch in batches:
            for host, page, reference in zip(*(c.to_pylist() for c in batch.columns)):
                if host not in held:
                    if len(held) > 1000:  # bounded memory when hosts are many
                        held.clear()
                    held[host] = parse(reference)
                    number(held[host])
                pairs: list = []
                root = parse(page)
                number(root)
                match(held[host], root, pairs, known)
                for a, b in pairs:
                    c = count.setdefault((host, a.number), [0, 0, 0])
                    c[0] += 1
                    c[1] += a.words == b.words or own_text(a) == own_text(b)
                    c[2] += a.tag in BLOCK and a.words == b.words
            if len(count) > 100_000:
                yield _counts(count)
                count = {}
        yield _counts(count)

    counts = (pages.select("host", "html").join(refs, "host").select("host", "html", "reference")
              .mapInArrow(align, "host string, node int, seen long, same long, whole long")
              .groupBy("host", "node").agg(*[F.sum(c).alias(c) for c in ("seen", "same", "whole")]))
    numbers = counts.join(refs.select("host", "pages"), "host").groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(F.col("same") < F.col("seen"), F.col("node")))).alias("slots"),
        F.sort_array(F.collect_list(F.when((F.col("pages") >= LEAST_PAGES) & (F.col("whole") >= COMMON * F.col("pages")),
                                           F.col("node")))).alias("template"))
    return refs.select("host", "reference").join(numbers, "host", "left")


def _counts(count: dict) -> pa.RecordBatch:
    return pa.record_batch({
        "host": pa.array([h for h, _ in count], pa.string()), "node": pa.array([n for _, n in count], pa.int32()),
        **{name: pa.array([v[k] for v in count.values()], pa.int64()) for k, name in enumerate(("seen", "same", "whole"))}})


def region(reference: Node, slots: list[int]) -> int:
    """Number of the deepest reference node above every slot outside boilerplate, -1 if there is none."""
    path: dict[int, list[int]] = {}
    todo = [(reference, [])]
    while todo:
        n, above = todo.pop()
        if n.drop:
            continue
        path[n.number] = [*above, n.number]
        todo.extend((c, path[n.number]) for c in _elements(n))
    paths = [path[s] for s in slots if s in path]
    if not paths:
        return -1
    common = paths[0]
    for p in paths[1:]:
        k = 0
        while k < min(len(common), len(p)) and common[k] == p[k]:
            k += 1
        common = common[:k]
    # A slot on a leaf block is content itself; its container keeps the constant blocks beside it.
    return common[-2] if len(paths) == 1 and len(common) > 1 else common[-1]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    wrappers = written(induce(pages), "wrapper")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        known: dict = {}
        for batch in batches:
            texts = []
            ids, urls, html, hosts, refs, slots, fixed = batch.columns
            for page, host, reference, slot, same in zip(*(c.to_pylist() for c in (html, hosts, refs, slots, fixed))):
                root = parse(page)
                nodes = number(root)
                text = ""
                if slot:
                    if host not in held:
                        if len(held) > 1000:
                            held.clear()
                        ref = parse(reference)
                        known_nodes = number(ref)
                        # The chosen part itself is no template, nor is what holds it.
                        held[host] = (ref, region(ref, slot), {k: known_nodes[k].words for k in same or ()})
                    ref, target, template = held[host]
                    pairs: list = []
                    match(ref, root, pairs, known)
                    part = [b for a, b in pairs if a.number == target and target >= 0][:1]
                    text = main_text(part, {b.number for a, b in pairs if template.get(a.number) == b.words})
                texts.append(text or main_text(marked(nodes) or [root]))
            yield pa.RecordBatch.from_arrays(
                [ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (pages.join(wrappers, "host").select("page_id", "url", "html", "host", "reference", "slots", "template")
            .mapInArrow(read, "page_id long, url string, text string, n_chars long"))
