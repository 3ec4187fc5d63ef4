"""History store: ``player_rounds`` as Parquet partitioned by ``date``.

Writes go through a ``REBALANCE(date)`` hint: AQE keeps about one file per
day and splits a day that is much larger than the others into several
tasks/files, so a hot day never becomes one task.  Reads use the explicit
schema (otherwise ``date`` is inferred as an integer) and a day filter prunes
to that day's folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PLAYER_ROUNDS_COLUMNS, PLAYER_ROUNDS_SCHEMA
from ..session import ensure_checkpoint_dir


def write_store(pr: DataFrame, path: str, mode: str = "append") -> None:
    """Append (default) or replace days of the store.

    ``mode="overwrite"`` replaces only the days present in ``pr`` (dynamic
    partition overwrite); ``reset_store`` empties the store explicitly.
    """
    (pr.select(*PLAYER_ROUNDS_COLUMNS).hint("rebalance", "date")
       .write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy("date").parquet(path))


def reset_store(spark: SparkSession, path: str) -> None:
    """Explicitly empty the store (never done implicitly)."""
    spark.createDataFrame([], PLAYER_ROUNDS_SCHEMA).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy("date").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLAYER_ROUNDS_SCHEMA).parquet(path).select(*PLAYER_ROUNDS_COLUMNS)


def scan_day(spark: SparkSession, path: str, date: str) -> DataFrame:
    """Rows of one day: the filter on the partition column prunes the scan."""
    return read_store(spark, path).where(F.col("date") == F.lit(date))


def compact_days(spark: SparkSession, path: str, days: list[str] | None = None) -> None:
    """Rewrite days of the store as few files per day (e.g. after a stream's
    many small appends).

    The rows are first checkpointed into the shared checkpoint folder, so the
    rewrite never reads from the folders it replaces; dynamic partition
    overwrite then replaces only those days, and ``REBALANCE(date)`` keeps
    about one file per day (more for an oversized day).
    """
    ensure_checkpoint_dir(spark)
    rows = read_store(spark, path)
    if days is not None:
        rows = rows.where(F.col("date").isin(days))
    write_store(rows.checkpoint(eager=True), path, mode="overwrite")
