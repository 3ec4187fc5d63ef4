"""Small shared pieces: written intermediates and connected components."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path, spark_context


BATCH_BYTES = "8m"  # text handed to a Python task at a time while a table is written


@contextmanager
def small_batches(spark: SparkSession):
    """Bound the Arrow batches of the queries run inside; the session's own setting comes back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    if old is None:
        yield
        return
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def written(df: DataFrame, name: str, large: bool = False) -> DataFrame:
    """Write a table to the shared scratch folder and read it back (cuts lineage, survives executors).

    Spark's listeners hold the last finished query, and with it its shuffle files, until another one
    ends; after a ``large`` shuffle a short look at the written table is that other one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if large:
        out.isEmpty()
    sc = spark_context(spark)
    if sc is not None:  # shuffle files of finished steps go when the driver collects its garbage
        sc._jvm.System.gc()
    out.scratch = path  # known to this table only, not to frames derived from it
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete ``written`` tables that no frame still to be evaluated reads; other frames are left alone."""
    for t in tables:
        path = None if t is None else vars(t).pop("scratch", None)
        if path:
            delete_path(t.sparkSession, path)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) for every node of ``edges(a, b)``; comp is the smallest node reachable.

    Rounds of minimum label over neighbours followed by pointer jumping; each
    round is written out, and only the number of changed labels reaches the driver.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"),
                                                             F.col("a").alias("b"))).distinct(),
                   f"{name}-edges")
    last = written(both.groupBy(F.col("a").alias("node"))
                   .agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("comp")), name)
    while True:
        label = last.select("node", "comp")
        near = (both.join(label.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m")))
        step = (label.join(near, "node", "left")
                .select("node", F.col("comp").alias("old"),
                        F.least("comp", F.coalesce("m", "comp")).alias("comp")))
        root = label.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = written(step.join(root, "comp", "left")
                      .select("node", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")),
                      name)
        release(last)
        last = new
        if new.filter("old <> comp").isEmpty():
            release(both)
            label = new.select("node", "comp")
            label.scratch = vars(new).pop("scratch")
            return label
