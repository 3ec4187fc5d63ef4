"""Written tables: what they leave behind, and what components are made of."""

import os
import time
from pathlib import Path

from roundlens.llm import ngram_join
from roundlens.llm.spread import written


def shuffle_files(spark):
    sc = spark.sparkContext
    dirs = [str(d) for d in sc._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    return {str(p) for d in dirs for p in Path(d).rglob("shuffle_*.data")}


def test_large_shuffle_goes_with_its_step(spark):
    before = shuffle_files(spark)
    written(spark.range(200_000).repartition("id"), "spent", large=True)
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_components_do_not_read_old_links_again(spark, monkeypatch):
    """Each turn reads the components so far and the newest links, however many turns there were."""
    read = []
    plain = ngram_join.components

    def seen(edges, name="components"):
        read.append(len({os.path.dirname(f) for f in edges.inputFiles()}))
        return plain(edges, name)

    monkeypatch.setattr(ngram_join, "components", seen)
    line = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join(line[k // 2:] + [f"x{k}"])) for k in range(16)]
    rows = ngram_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in rows} == {0}
    assert len(read) >= 4 and max(read) <= 2
