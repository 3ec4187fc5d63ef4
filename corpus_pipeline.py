"""Corpus pipeline over ``documents``: each stage works on all rows its predecessor kept.

1. ``language``: rows whose text has no letter, or in which no language reaches
   ``MIN_SCORE`` of the byte positions, go; so do rows without a doc_id, which
   later stages could not name.
2. ``near_duplicates``: of each component of near-duplicates (five-word
   shingles, Jaccard 0.8) the document with the smallest doc_id stays; rows that
   repeat a doc_id and its text are one document.
3. ``decontaminate``: documents that hold a ten-word window of a benchmark item go.
4. ``secrets``: found secrets are masked in the text; n_chars follows.
5. ``mix``: sources are mixed to their target weights; rows taken zero words go,
   the others carry size, source_size, target and taken.

Rows that share a doc_id but not their text are judged each by itself (by a 64-bit
hash of both).  Stages 1 to 4 return the columns of their input, extra ones included.  An empty
table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundlens.llm import lang_id, mixing, ngram_join, positional_index, secrets
from roundlens.llm.spread import written

MIN_SCORE = 0.3
KEY = "__row_key"


def row_key() -> Column:
    """Names a row by doc_id and text; a doc_id may stand on several texts."""
    return F.xxhash64("doc_id", "text")


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, row_key()).join(keys, KEY, "left_anti").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.filter(F.col("doc_id").isNotNull())
    judged = lang_id.predict(docs.select("text", row_key().alias(KEY)),
                             lang_id.learn(docs.select("doc_id", "text", "lang")), keep=(KEY,))
    refused = judged.filter(~F.col("has_letter") | (F.col("score") < MIN_SCORE) & (F.col("lang_pred") != lang_id.UND))
    return _without(docs, written(refused.select(KEY).distinct(), "refused"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    repeats = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    if not repeats:  # the usual case: a doc_id names its row
        groups = written(ngram_join.jaccard_components(docs.select("doc_id", "text")), "groups")
        gone = written(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "gone")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    groups = written(ngram_join.jaccard_components(docs.select(row_key().alias("doc_id"), "text")), "groups")
    named = groups.select(F.col("doc_id").alias(KEY), "component_id").distinct().join(
        docs.select(row_key().alias(KEY), "doc_id").distinct(), KEY)
    least = named.groupBy("component_id").agg(F.min(F.struct("doc_id", KEY)).alias("least"))
    stay = written(least.select(F.col(f"least.{KEY}").alias(KEY)), "stay")
    twice = written(docs.groupBy(row_key().alias(KEY)).count().filter("count > 1").select(KEY), "twice")
    kept = docs.withColumn(KEY, row_key()).join(stay, KEY, "left_semi").select(*docs.columns)
    again = kept.withColumn(KEY, row_key()).join(twice, KEY, "left_semi").select(*docs.columns)
    return _without(kept, twice).union(again.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = positional_index.contamination(docs.select(row_key().alias("doc_id"), "text"), benchmark)
    return _without(docs, written(found.filter("contaminated").select(F.col("doc_id").alias(KEY)).distinct(), "leaked"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = secrets.train(docs, secrets.findings(docs))
    found = F.size("secrets") > 0
    new = {"text": F.when(found, F.col("masked")).otherwise(F.col("row.text")),
           "n_chars": F.when(found, F.length("masked").cast("long")).otherwise(F.col("row.n_chars"))}
    return secrets.scan(docs, model).select(*[
        (new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = docs.select("doc_id", "text", "source", F.struct("*").alias("row"))
    mixed = mixing.mix_sources(packed, keep=("row",)).filter("taken > 0")
    added = ["size", "source_size", "target", "taken"]
    return mixed.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("secrets", mask_secrets), ("mix", mix)]

ORACLE_SQL = None  # the trained stages are not expressible in SQL; tests hold the others against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
