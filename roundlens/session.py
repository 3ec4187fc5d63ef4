"""Session construction and shared scratch locations.

Scratch tables (replay inputs, history stores, streaming checkpoints) live
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is missing (local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Session settings shared by tests, bench and the CLI.  The shuffle partition
# count passed to build_session is a local default.  On a cluster, start from
# about (largest shuffle bytes / 128 MB), thousands at 100 TB, and let AQE
# coalesce small partitions and split skewed ones; the file split size
# (spark.sql.files.maxPartitionBytes, 128 MB) keeps scan tasks memory-bounded.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


UNSET_CHECKPOINT_DIR = ("set spark.checkpoint.dir to a folder that the driver and all executors share: "
                        "scratch tables and checkpoints are written there")


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "roundlens", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and the command line.

    ``master=None`` leaves the master to ``spark-submit`` (cluster runs), and
    ``shuffle_partitions=None`` leaves the partition count to the cluster
    configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = (builder.master(master)
                   .config("spark.driver.memory",
                           os.environ.get("ROUNDLENS_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if spark_context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def spark_context(spark: SparkSession):
    """The SparkContext of a classic session, ``None`` for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions have no local SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Only a session whose master is one machine (``local[...]``, as in tests)
    gets a folder of its own when ``spark.checkpoint.dir`` is unset; elsewhere a
    folder of the driver's machine would be invisible to the executors.
    """
    sc = spark_context(spark)
    if sc is None:  # Connect: the server's spark.checkpoint.dir applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError(UNSET_CHECKPOINT_DIR)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(UNSET_CHECKPOINT_DIR)
        configured = tempfile.mkdtemp(prefix="roundlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (any scheme)."""
    sc = spark_context(spark)
    if sc is None:  # Connect: probe by reading the folder's schema
        try:
            spark.read.parquet(path).schema
            return True
        except Exception:
            return False
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through its Hadoop FileSystem (a Connect client leaves it)."""
    sc = spark_context(spark)
    if sc is None:
        return
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: the shuffle files of queries that nothing holds any more go with it."""
    sc = spark_context(spark)
    if sc is not None:
        sc._jvm.System.gc()


def list_folders(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """(path, modified at in seconds) of the folders that match a glob pattern, through their Hadoop FileSystem."""
    sc = spark_context(spark)
    if sc is None:
        raise RuntimeError("listing folders needs a classic session (Spark Connect has no FileSystem)")
    path = sc._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(path) or []
    return [(s.getPath().toString(), s.getModificationTime() / 1000.0) for s in found if s.isDirectory()]


def versions(spark: SparkSession, table: str, key: str = "batch_id") -> list[tuple[int, str, float]]:
    """(number, path, modified at) of the ``key=N`` folders of a table, ascending."""
    return sorted((int(p.rstrip("/").rsplit("=", 1)[1]), p, at)
                  for p, at in list_folders(spark, f"{table.rstrip('/')}/{key}=*"))


def drop_versions(spark: SparkSession, table: str, keep: int = 2, keep_seconds: float = 600.0,
                  key: str = "batch_id") -> None:
    """Delete old versions: all but the newest ``keep`` that are older than any reader's ``keep_seconds``."""
    now = time.time()
    for _, path, at in versions(spark, table, key)[:-keep]:
        if now - at >= keep_seconds:
            delete_path(spark, path)
