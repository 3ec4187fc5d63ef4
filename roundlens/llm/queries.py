"""Registered queries of this subpackage (``opN_<name>``) and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bitmap_manifest, chaining, lang_id, mixing, ngram_join, periodic_runs, piece_tokens,
               positional_index, secrets, suffix_dedup, topk, warc_fixity, wrapper)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language_id(spark, sf_dir):
    return lang_id.identify(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op4_warc_fixity(spark, sf_dir):
    return warc_fixity.audit_pages(_table(spark, sf_dir, "pages"))


def op5_wrapper_text(spark, sf_dir):
    return wrapper.extract(_table(spark, sf_dir, "pages"))


def op6_benchmark_decontamination(spark, sf_dir):
    return positional_index.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_exact_top_k(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark, sf_dir):
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op9_fuzzy_passages(spark, sf_dir):
    return chaining.fuzzy_report(_table(spark, sf_dir, "documents"))


def op10_mix_sources(spark, sf_dir):
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op11_bitmap_manifest(spark, sf_dir):
    return bitmap_manifest.manifest_report(_table(spark, sf_dir, "documents"))


def op12_piece_tokens(spark, sf_dir):
    import public_tokenizers  # the vocabulary files live outside the repository
    return piece_tokens.token_report(_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_warc_fixity": op4_warc_fixity,
    "op5_wrapper_text": op5_wrapper_text,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_secret_scan": op8_secret_scan,
    "op9_fuzzy_passages": op9_fuzzy_passages,
    "op10_mix_sources": op10_mix_sources,
    "op11_bitmap_manifest": op11_bitmap_manifest,
    "op12_piece_tokens": op12_piece_tokens,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op2_suffix_dedup": suffix_dedup.SQL,
    "op3_ngram_jaccard_join": ngram_join.SQL,
    "op4_warc_fixity": warc_fixity.SQL,
    "op6_benchmark_decontamination": positional_index.SQL,
    "op7_exact_top_k": topk.SQL,
    "op10_mix_sources": mixing.SQL,
    "op11_bitmap_manifest": bitmap_manifest.SQL,
    "op13_periodic_runs": periodic_runs.SQL,
}
