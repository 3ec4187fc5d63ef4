"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by (source, hash bucket); running sums over the buckets find
where the budget ends, and only that boundary bucket is opened again with the
next hash bits, level after level.  What remains is one threshold per source
and a filter over the documents: no row is ever sorted.

Defined cases: a null or word-less text has size 0 and takes 0; a null source
is a source of its own (last in order); rows that share a doc_id share a hash
and so share their fate; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spread import written

LEVEL_BITS = 12
LEVELS = 5  # 60 hash bits


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash60(key: Column) -> Column:
    """60 bits of md5 over the key's text form (the same on any engine)."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """(source, source_size, target): weights repeat over the sources in code-point order.

    Targets share ``share`` of all sizes by weight and stop at ``most`` times
    their source's size; the excess is shared again by weight.  With sources
    ordered by cap / weight the capped ones form a prefix, so running sums give
    the water level directly.  The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (n % len(weights) + 1).cast("int"))
    cap = F.lit(most) * F.col("source_size")
    filled = (Window.orderBy("ratio", F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = per.withColumn("w", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("w"))
    t = (t.withColumn("budget", F.lit(share) * F.sum("source_size").over(all_rows))
         .withColumn("w_all", F.sum("w").over(all_rows))
         .withColumn("before_cap", F.coalesce(F.sum("cap").over(filled), F.lit(0.0)))
         .withColumn("before_w", F.coalesce(F.sum("w").over(filled), F.lit(0.0)))
         .withColumn("level", (F.col("budget") - F.col("before_cap")) / (F.col("w_all") - F.col("before_w")))
         # The first source whose cap is above its level fixes the water level of all later ones.
         .withColumn("water", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level")))
                     .over(all_rows)["level"]))
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("water") * F.col("w")))
    return t.select("source", "source_size", target.cast("double").alias("target"))


def _boundary(rows: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Open the boundary bucket of each source one level deeper.

    ``state`` holds (skey, lo, rest): every hash below ``lo`` is in, and ``rest``
    words are still free inside the bucket that starts at ``lo``.
    """
    shift = LEVEL_BITS * (LEVELS - 1 - level)
    width = 1 << shift
    inside = rows if level == 0 else rows.join(state, "skey").filter(
        (F.col("h") >= F.col("lo")) & (F.col("h") < F.col("lo") + (width << LEVEL_BITS)))
    hist = (inside.groupBy("skey", F.shiftright("h", shift).alias("bucket"))
            .agg(F.sum("size").alias("words")))
    run = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cum = (hist.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
           .join(state.select("skey", "rest"), "skey")
           .filter(F.col("before") <= F.col("rest")))
    last = cum.groupBy("skey").agg(F.max_by(F.struct("bucket", "before", "rest"), "bucket").alias("b"))
    return last.select("skey", F.shiftleft(F.col("b.bucket"), shift).alias("lo"),
                       (F.col("b.rest") - F.col("b.before")).alias("rest"))


def mix_sources(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken (+ ``keep`` columns) for every document.

    A document is taken in whole repeats: ``floor(target / source_size)`` times,
    and once more if its hash lies below its source's threshold.  What the leaf
    bucket on the threshold (normally one document) leaves free is taken from
    that document in part, so each source meets its target to the word.
    """
    more = [c for c in keep if c not in ("doc_id", "source")]
    sizes = written(docs.select("doc_id", *more, "source", word_count(F.col("text")).alias("size"),
                                hash60(F.col("doc_id")).alias("h")), "mix-sizes")
    targets = written(source_targets(sizes, weights, share, most)
                      .withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
                      .withColumn("times", F.when(F.col("source_size") > 0,
                                                  F.floor(F.col("target") / F.col("source_size")))
                                  .otherwise(0).cast("long"))
                      .withColumn("rest", (F.round("target").cast("long")
                                           - F.col("times") * F.col("source_size"))), "mix-targets")
    keyed = sizes.withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    state = targets.select("skey", "rest")
    for level in range(LEVELS):
        state = written(_boundary(keyed.select("skey", "h", "size"), state, level), "mix-level")
    # Words of the rows that share the boundary hash: normally one document's.
    leaf = (keyed.join(state, "skey").filter("h = lo").groupBy("skey")
            .agg(F.sum("size").alias("leaf_words")))
    plan = targets.select("skey", "source_size", "target", "times").join(
        state.join(leaf, "skey"), "skey", "left")
    extra = (F.when(F.col("h") < F.col("lo"), F.col("size"))
             .when((F.col("h") == F.col("lo")) & (F.col("leaf_words") > 0),
                   F.least(F.col("size"), F.expr("(size * rest) div leaf_words")))
             .otherwise(0))
    return keyed.join(plan, "skey").select(
        "doc_id", *keep, "size", "source_size", "target",
        (F.col("times") * F.col("size") + extra).cast("long").alias("taken"))


def _sql() -> str:
    """DuckDB statement over the same rows: running sums by hash instead of thresholds."""
    return r"""
WITH d AS (SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
    FROM d GROUP BY source),
q AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / w AS ratio,
    1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(w) OVER () AS w_all FROM p),
r AS (SELECT *, (budget - coalesce(sum(cap) OVER f, 0)) / (w_all - coalesce(sum(w) OVER f, 0)) AS level
    FROM q WINDOW f AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN water IS NULL THEN cap ELSE least(cap, water * w) END AS target
    FROM (SELECT *, (SELECT arg_min(level, ratio) FROM r WHERE ratio > level) AS water FROM r)),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM t),
v AS (SELECT *, round(target)::BIGINT - times * source_size AS rest FROM u),
x AS (SELECT d.doc_id, d.size, v.source_size, v.target, v.times, v.rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - sum(d.size) OVER (PARTITION BY d.source, h), 0) AS before,
    sum(d.size) OVER (PARTITION BY d.source, h) AS leaf
    FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source)
SELECT doc_id, size, source_size, target,
  (times * size + CASE WHEN before + leaf <= rest THEN size WHEN before >= rest OR leaf = 0 THEN 0
     ELSE (size * (rest - before)) // leaf END)::BIGINT AS taken
FROM x"""


SQL = _sql()
