"""Ranking helpers: per-group top-k, arg-best and latest-row-per-key.

* ``top_k`` uses ``row_number() <= k`` over a window; Spark plans it as a
  ``WindowGroupLimit`` that keeps only k rows per group *before* the shuffle,
  so a group holding a third of all rows still sends k rows per map task.
* ``arg_best`` / ``latest_per_key`` are plain aggregations with ``min_by`` /
  ``max_by`` over a struct key: partial (map-side) aggregation, no sort, and
  the tie-break is part of the key so the winner is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def top_k(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group in ``order_by`` order, numbered 1..k.

    ``order_by`` must end in a unique key so ties are broken deterministically.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def arg_best(df: DataFrame, group_by: Sequence[str], order_key: Sequence[Column],
             fields: Sequence[str], aggs: Sequence[Column] = ()) -> DataFrame:
    """Per group, the ``fields`` of the row with the smallest ``order_key``.

    ``order_key`` is compared as a struct, left to right; negate a column to
    prefer its largest value.  ``aggs`` are extra aggregates of the same pass.
    """
    key = F.struct(*[_col(c).alias(f"k{i}") for i, c in enumerate(order_key)])
    best = F.min_by(F.struct(*[F.col(f) for f in fields]), key).alias("_best")
    out = df.groupBy(*group_by).agg(best, *aggs)
    return out.select(*group_by, *[F.col(f"_best.{f}").alias(f) for f in fields],
                      *[a for a in out.columns if a not in set(group_by) | {"_best"}])


def latest_per_key(df: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """The row with the largest ``version_col`` for each key (an upsert view of an
    append log).  Versions are unique per key."""
    others = [c for c in df.columns if c not in set(keys)]
    out = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.col(version_col)).alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
