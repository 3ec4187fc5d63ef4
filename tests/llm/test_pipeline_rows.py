"""The pipeline's decisions hold for rows, not for all rows of a doc_id."""

import corpus_pipeline

from .conftest import words


def test_repeated_doc_id_keeps_its_clean_text(spark, tmp_path):
    spark.createDataFrame([("i", words(300, 320))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(3, words(0, 90)), (7, words(0, 90)), (7, words(100, 190)), (8, "123 456"), (8, words(200, 290)),
            (9, words(295, 360)), (9, words(365, 400)), (9, words(365, 400))]
    at = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        at = stage(spark, at, str(tmp_path))
    want = [(3, words(0, 90)), (7, words(100, 190)), (8, words(200, 290)), (9, words(365, 400))]
    assert sorted((r["doc_id"], r["text"]) for r in at.collect()) == want
