"""The induced wrapper chooses and cleans on every page; tree matching is exact."""

import random

import pytest

from roundlens.llm import wrapper
from roundlens.llm.wrapper import Node


def tree(rng, depth=0):
    n = Node(rng.choice("abc"))
    if depth < 3:
        n.children = [tree(rng, depth + 1) for _ in range(rng.choice([0, 1, 2, 3, 4]))]
    return n


def brute(a, b):
    if a.tag != b.tag:
        return 0
    x, y = a.children, b.children
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, u in enumerate(x):
        for j, v in enumerate(y):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute(u, v))
    return 1 + best[-1][-1]


@pytest.mark.parametrize("cells", [1 << 22, 2])
def test_matching_is_optimal(monkeypatch, cells):
    monkeypatch.setattr(wrapper, "TABLE_CELLS", cells)
    rng = random.Random(8)
    for _ in range(400):
        a, b = tree(rng), tree(rng)
        wrapper.number(a)
        wrapper.number(b)
        pairs, want = [], brute(a, b)
        assert wrapper.match(a, b, pairs) == len(pairs) == want == wrapper.score(a, b, {})
        for k in (0, 1):  # one to one, in document order, equal tags
            numbers = sorted((u.number, v.number) for u, v in pairs)
            assert len({n[k] for n in numbers}) == len(numbers) and all(u.tag == v.tag for u, v in pairs)
        assert [v for _, v in numbers] == sorted(v for _, v in numbers)


def test_thousand_children():
    rows = "".join(f"<p>line {k}</p>" + ("<ul><li>x</li></ul>" if k % 7 == 0 else "") for k in range(1000))
    other = "".join(f"<p>other {k}</p>" + ("<ol><li>y</li></ol>" if k % 5 == 0 else "") for k in range(1200))
    a, b = wrapper.parse(f"<div>{rows}</div>"), wrapper.parse(f"<div>{other}</div>")
    wrapper.number(a)
    wrapper.number(b)
    pairs = []
    assert wrapper.match(a, b, pairs) == 1002  # root, div and every p


def texts(spark, rows):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    return {r["page_id"]: r["text"] for r in wrapper.extract(pages).collect()}


def host(name, bodies, shell="<html><body><div id='top'>Site</div>{}<div>All the best from us</div></body></html>", start=0):
    return [(start + k, f"http://{name}/{k}", shell.format(b)) for k, b in enumerate(bodies)]


def test_names_lose_no_article(spark):
    words = ["one two three", "four five six", "seven eight nine", "ten eleven twelve"]
    rows = host("a.b", [f'<article class="post comments-open"><p>{w}</p></article>' for w in words])
    rows += host("c.d", [f"<div><h1>{w}</h1><p>{w} more</p></div>" for w in words], start=10, shell=(
        '<html><body class="has-sidebar">{}<div class="sidebar">teaser</div></body></html>'))
    rows += host("e.f", [f"<div><p>{w}</p><p>{w} again</p></div>" for w in words], start=20, shell=(
        "<html><body><form action='/'>{}<input></form></body></html>"))
    rows += [(30, "http://lone/1", '<body class="has-sidebar"><p>Only page</p><div class="sidebar">no</div></body>'),
             (31, "http://lone2/1", "<form><p>whole page in a form</p></form>")]
    got = texts(spark, rows)
    assert [got[k] for k in range(4)] == words
    assert [got[10 + k] for k in range(4)] == [f"{w}\n{w} more" for w in words]
    assert [got[20 + k] for k in range(4)] == [f"{w}\n{w} again" for w in words]
    assert got[30] == "Only page" and got[31] == "whole page in a form"


def test_template_blocks_inside_the_article_go(spark):
    words = ["alpha beta", "gamma delta", "epsilon zeta", "eta theta"]
    rows = host("a.b", [f"<article><h1>{w}</h1><p>body of {w}</p><p>All rights reserved by us.</p></article>" for w in words])
    got = texts(spark, rows)  # breaks if the mark alone decided
    assert [got[k] for k in range(4)] == [f"{w}\nbody of {w}" for w in words]


def test_teaser_articles_do_not_replace_the_body(spark):
    words = ["alpha beta", "gamma delta", "epsilon zeta", "eta theta"]
    rows = host("a.b", [f"<main><div><h1>{w}</h1><p>body of {w}</p><p>and its end, {w}</p></div>"
                        "<div class='related'><article>Teaser one</article><article>Teaser two</article></div></main>"
                        for w in words])
    got = texts(spark, rows)
    assert [got[k] for k in range(4)] == [f"{w}\nbody of {w}\nand its end, {w}" for w in words]


def test_equal_pages_keep_their_text(spark):
    rows = host("a.b", ["<article><p>same on all</p></article>"] * 4)
    assert set(texts(spark, rows).values()) == {"same on all"}
    assert texts(spark, []) == {}
