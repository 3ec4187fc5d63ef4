"""Wrapper induction, Merkle audit, exact top-k and the pipeline."""

import math

import pytest

import corpus_pipeline
from roundlens.llm import topk, warc_fixity, wrapper

PAGE = ('<html><head><title>t</title><script>var x="</p>";</script></head><body><div class="top">Site name</div>'
        '<nav><ul><li>Home</ul></nav><div class="cookie-notice">We use cookies</div>{body}'
        '<div class="comments"><p>first!</p></div><form>Mail <input></form><footer>&copy; me</footer>')


def test_extract(spark):
    rows = [(1, "http://a.b/1", PAGE.format(body="<article><h1>One &amp; two</h1><p>Some <b>bold</b>\n text<p>next</article>")),
            (2, "http://a.b/2", None), (3, None, ""), (4, "http://a.b/4", "<p>cut off <b"),
            (5, "http://c.d/5", PAGE.format(body="<div><h2>Alpha</h2><p>first text</p></div>")),
            (6, "http://c.d/6", PAGE.format(body="<div><h2>Beta</h2><p>second text</p><p>more</p></div>")),
            (7, "http://c.d/7", PAGE.format(body="<div><h2>Gamma</h2><p>third text</p></div>")),
            (8, "http://e.f/8", "<div>" * 3000 + "deep" + "</div>" * 10)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in wrapper.extract(pages).collect()}
    assert len(got) == len(rows)
    assert got[1]["text"] == "One & two\nSome bold text\nnext" and got[1]["n_chars"] == 29
    assert got[2]["text"] == got[3]["text"] == "" and got[4]["text"] == "cut off"
    assert [got[k]["text"] for k in (5, 6, 7)] == ["Alpha\nfirst text", "Beta\nsecond text\nmore", "Gamma\nthird text"]
    assert got[8]["text"] == "deep"
    assert wrapper.extract(pages.limit(0)).count() == 0


def test_tree_matching_counts_best_alignment():
    def best(a, b):
        if a.tag != b.tag:
            return 0
        x, y = wrapper._elements(a), wrapper._elements(b)
        t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, u in enumerate(x):
            for j, v in enumerate(y):
                t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + best(u, v))
        return 1 + t[-1][-1]

    a = wrapper.parse("<body><nav></nav><div><p>a</p><p>b</p></div><div><span>c</span></div><footer></footer></body>")
    b = wrapper.parse("<body><div><p>a</p></div><ul><li>x</ul><div><span>c</span><p>d</p></div><footer></footer></body>")
    pairs = []
    assert wrapper.match(a, b, pairs) <= best(a, b)
    assert len(pairs) >= best(a, b) - 1 and all(u.tag == v.tag for u, v in pairs)


def test_merkle_audit(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 5)) for i in range(300)] + [(5, None, None)],
                                  "page_id long, url string, html string")
    main = warc_fixity.lay_out(pages, 3)
    assert {r["state"] for r in warc_fixity.audit(main, main).collect()} == {"ok"}
    replica = warc_fixity.spoil(main)
    got = {(r["file"], r["seq"]): r["state"] for r in warc_fixity.audit(main, replica).collect()}
    left = {(r["file"], r["seq"]): bytes(r["record"]) for r in main.collect()}
    right = {(r["file"], r["seq"]): bytes(r["record"]) for r in replica.collect()}
    assert got == {k: "missing" if k not in right else "ok" if right[k] == v else "damaged" for k, v in left.items()}
    assert {"missing", "damaged"} <= set(got.values())
    empty = warc_fixity.lay_out(pages.limit(0), 1)
    assert warc_fixity.audit(empty, empty).count() == 0


def test_audit_finds_its_place_again(spark):
    """Replicas laid out again after a loss, an addition, a change and a swap: nothing else is condemned."""
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 5 + 1), "x") for i in range(40)] + [(None, None, "n", "x")] * 2
    schema = "page_id long, url string, html string, sha256 string"
    main = warc_fixity.lay_out(spark.createDataFrame(rows, schema), 1)

    def states(changed):
        replica = warc_fixity.lay_out(spark.createDataFrame(changed, schema), 1)
        got = warc_fixity.audit(main, replica).select("page_id", "state").collect()
        return sorted((r["state"], r["page_id"]) for r in got if r["state"] not in ("ok", "moved")), len(got)

    assert states([r for r in rows if r[0] != 3]) == ([("missing", 3)], 42)
    assert states(rows + [(7, "http://h/again", "new", "x")]) == ([("extra", 7)], 43)
    assert states([(i, u, "hurt" if i == 5 else h, x) for i, u, h, x in rows if i != 30]) == (
        [("damaged", 5), ("missing", 30)], 42)
    assert states([(9 if i == 8 else 8 if i == 9 else i, u, h, x) for i, u, h, x in rows])[0] == [
        ("damaged", 8), ("damaged", 9)]
    assert states(rows[:-1])[0] == [("missing", None)]


def test_top_k(spark):
    vec = [(i, [math.sin(i * (j + 1)) for j in range(20)]) for i in range(260)]
    vec += [(300, vec[50][1]), (301, vec[50][1]), (302, None), (303, [1.0, None]), (304, [float("nan")] * 20), (305, [1.0, 2.0]), (350, [])]
    df = spark.createDataFrame(vec, "vec_id long, embedding array<double>").withColumnRenamed("x", "x").repartition(3)
    q = {i: [math.floor(256.0 * x) for x in v] for i, v in vec
         if v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for i in q:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i and len(q[j]) == len(q[i]))
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == sorted(want)


def test_top_k_twins_huge_and_empty(spark):
    same = [[math.cos(i + j) for j in range(12)] for i in range(30)]
    vec = [(i, v, "x", 1) for i, v in enumerate(same)]
    vec += [(50, same[3], "x", 2), (50, same[4], "x", 3), (50, same[3], "x", 3)]         # twins: an id on several rows
    vec += [(100, [1e18] * 12, "x", 1), (101, [1e-300] * 12, "x", 1), (None, same[5], "x", 1), (0, same[7], None, 1)]
    df = spark.createDataFrame(vec, "vec_id long, embedding array<double>, query_id string, score int").repartition(4)
    rows = [(i, [math.floor(256.0 * x) for x in v]) for i, v, _, _ in vec if i is not None and i != 100]
    want = []
    for n, (i, q) in enumerate(rows):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(rows) if m != n)
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == sorted(want)
    assert topk.top_k(df.limit(0)).count() == 0


def test_bounds_hold():
    import numpy as np
    rng = np.random.default_rng(0)
    x, y = rng.integers(-300, 300, (50, 37)), rng.integers(-300, 300, (40, 37))
    for s in topk.resolutions(37):
        assert (topk.statistics(x, s) @ topk.statistics(y, s).T + 1e-6 >= x @ y.T).all()


def test_pipeline_stages(spark, docs, no_docs, tmp_path):
    spark.createDataFrame([(1, " ".join(f"w{i}{'abcdefgh'[i % 8]}" for i in range(120, 140)))],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    cols = docs.columns
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == cols, name
        kept = sorted(r["doc_id"] for r in at.select("doc_id").collect())
        if name == "language":
            assert not {4, 5, 10} & set(kept) and None not in kept
        if name == "near_duplicates":
            assert kept.count(1) == 1 and not {2, 3, 7} & set(kept)
    assert not {8, 9} & set(kept)
    last = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path))
    assert {"size", "source_size", "target", "taken"} <= set(last.columns) and last.filter("taken <= 0").count() == 0
    at = no_docs
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        assert at.count() == 0


@pytest.mark.parametrize("name", ["op2_suffix_dedup", "op11_bitmap_manifest", "op13_periodic_runs", "op3_ngram_jaccard_join", "op4_warc_fixity", "op6_benchmark_decontamination", "op7_exact_top_k",
                                  "op10_mix_sources"])
def test_queries_equal_sql(spark, name):
    import duckdb

    from roundlens.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = queries.QUERIES[name](spark, sf)
    rel = con.sql(queries.ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    key = lambda rows, names: sorted(tuple(round(r[names.index(c)], 9) if isinstance(r[names.index(c)], float) else r[names.index(c)]
                                           for c in cols) for r in rows)
    assert key([tuple(r) for r in got.collect()], got.columns) == key(rel.fetchall(), rel.columns)
