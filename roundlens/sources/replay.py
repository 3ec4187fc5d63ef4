"""Replay order of matches and the stepwise replay of a fact table.

``match_sequence`` numbers the distinct (date, match) keys in (date, match)
order from counts per day and per start of the match id;
``write_match_steps`` writes those matches as messages, step by step.

``sequence_numbers`` numbers keys of any kind: they are range-partitioned, each
partition numbers its rows locally, the numbered keys are checkpointed once, and
a table of per-partition counts (one row per partition, a proven bound) gives
each partition its offset.

``replay_steps`` cuts the days into ``steps`` contiguous ranges (cut points
from one ``percentile_approx`` aggregation) and writes each range as its own
job into the source folder, oldest first, calling ``after_step`` between
writes, so a streaming query sees the days arrive in order.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_path, drop_shuffles, ensure_checkpoint_dir, spark_context
from .wire import encode_wire

ID_START = 4  # characters of the match id that split a day


def sequence_numbers(keys: DataFrame, order_cols: list[str], seq_col: str = "seq",
                     partitions: int | None = None) -> DataFrame:
    """Attach 1-based consecutive numbers in ``order_cols`` order to unique keys."""
    spark = keys.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    # monotonically_increasing_id = (partition id << 33) + position in partition.
    local = (ordered.withColumn("_pid", F.spark_partition_id())
             .withColumn("_pos", F.monotonically_increasing_id()
                         - F.shiftleft(F.col("_pid").cast("long"), 33)))
    # Range bounds come from sampling rows whose order after a shuffle is not
    # fixed, so two evaluations could number differently.  Materialise the
    # local numbering once (reliable checkpoint in the shared checkpoint folder,
    # which also cuts the lineage) and derive counts and offsets from that copy.
    ensure_checkpoint_dir(spark)
    local = local.checkpoint(eager=True)
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # One row per partition: a bounded broadcast.
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(seq_col, F.col("_off") + F.col("_pos") + F.lit(1))
            .drop("_pid", "_pos", "_off"))


def match_sequence(pr: DataFrame, id_start: int = ID_START) -> DataFrame:
    """Replay order of matches: global number, number within the day, and
    whether the producer pauses before the match (a new match on the same day).

    A plan only: no job runs while it is built.  A day is split by the first
    ``id_start`` characters of its match ids; matches are numbered within such a
    range, and the ranges' counts are summed over the smaller ranges of the day
    and the days before.  Only those sums see a whole day (one row a range) or
    all days (one row a calendar day).
    """
    start = F.coalesce(F.substring("match_id", 1, id_start), F.lit(""))
    keys = (pr.select("date", "match_id").where(F.col("date").isNotNull()).distinct()
            .withColumn("_start", start).repartition("date", "_start"))

    def smaller(*up: str, by: str) -> Column:
        order = (Window.partitionBy(*up) if up else Window).orderBy(by)
        return F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    ranges = (keys.groupBy("date", "_start").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_in_day", smaller("date", by="_start")))
    days = (ranges.groupBy("date").agg(F.sum("_n").alias("_n"))
            .select("date", smaller(by="date").alias("_day")))
    nth = F.row_number().over(Window.partitionBy("date", "_start").orderBy("match_id"))
    out = (keys.withColumn("_nth", nth).join(ranges.join(days, "date"), ["date", "_start"])
           .withColumn("match_in_day", F.col("_in_day") + F.col("_nth")))
    return out.select(
        "date", "match_id", (F.col("_day") + F.col("match_in_day")).alias("seq"), "match_in_day",
        F.when(F.col("match_in_day") > 1, F.lit(1)).otherwise(F.lit(0)).alias("pause_before"))


def write_match_steps(pr: DataFrame, path: str, matches_per_step: int = 1,
                      style: str = "python", pause_seconds: float = 0.0, files_per_step: int = 1,
                      after_step: Callable[[int], None] | None = None, compression: str | None = None) -> int:
    """Write the rows as messages, ``matches_per_step`` matches a step, steps in replay order.

    All files are written by one job, one per step, into a staging folder beside
    ``path``; then they are handed over in order, each with a later modification
    time, which is the order a file source reads them in (``maxFilesPerTrigger=1``
    gives one step a micro-batch).  ``pause_seconds`` waits between steps.  Rows
    without a day, which have no match number, go with the first step.

    A task holds one file's rows, so large steps take several: ``files_per_step``
    deals a step's matches to so many files (at most; no order among them), and ``after_step``
    runs when a step's files are all there.  Such steps are few; each is a job of its own that reads
    its range of ``pr`` (give a stored table), so only one step's rows are shuffled at a time.
    ``compression`` is a codec of Spark's text files.  Returns the number of files.
    """
    spark = pr.sparkSession
    size, files = int(matches_per_step), int(files_per_step)
    if files > 1:
        return _write_large_steps(pr, path, size, files, style, pause_seconds, after_step, compression)
    numbered = pr.join(match_sequence(pr).select("date", "match_id", "seq"), ["date", "match_id"], "left")
    step = F.coalesce(F.expr(f"(seq - 1) div {size}"), F.lit(0))
    rows = numbered.select(step.alias("step"), "date", "match_id", F.struct(*pr.columns).alias("_row"))
    stage = _stage_steps(rows.repartition("step"), path, style, compression)
    try:
        return _hand_over(spark, stage, path, pause_seconds, after_step)
    finally:
        delete_path(spark, stage)


def _stage_steps(dealt: DataFrame, path: str, style: str, compression: str | None) -> str:
    """Write (step, date, match_id, _row), dealt to files, as messages into a new folder beside ``path``."""
    stage = f"{path.rstrip('/')}-stage-{uuid.uuid4().hex[:12]}"
    ordered = dealt.sortWithinPartitions("step", "date", "match_id")
    messages = encode_wire(ordered.select("step", "_row.*"), style, keep=("step",))
    messages.select("step", "value").write.partitionBy("step").text(stage, compression=compression)
    return stage


def _write_large_steps(pr: DataFrame, path: str, size: int, files: int, style: str, pause_seconds: float,
                       after_step: Callable[[int], None] | None, compression: str | None) -> int:
    spark = pr.sparkSession
    # The first match of every step after the first one: a row a step, as many as folders are handed over.
    starts = [(r["date"], r["match_id"]) for r in match_sequence(pr).where((F.col("seq") > 1) & ((F.col("seq") - 1) % size == 0))
              .orderBy("seq").select("date", "match_id").collect()]
    # Whole matches to a file; rows without a day may be many and are no match.
    part = F.pmod(F.when(F.col("date").isNull() | F.col("match_id").isNull(), F.xxhash64("match_id", "round_nb", "operator"))
                  .otherwise(F.xxhash64("date", "match_id")), F.lit(files))
    # A fixed number grows with the step, and small partitions are not put together again.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * files)
    written = 0
    for step, (lo, hi) in enumerate(zip([None, *starts], [*starts, None])):
        inside = F.lit(True) if lo is None else _from_match(*lo)
        if hi is not None:
            inside = inside & ~_from_match(*hi)
        rows = pr.where(inside).select(F.lit(step).cast("long").alias("step"), part.alias("part"), "date", "match_id",
                                       F.struct(*pr.columns).alias("_row"))
        stage = _stage_steps(rows.repartition(parts, "step", "part"), path, style, compression)
        if step and pause_seconds:
            time.sleep(pause_seconds)
        try:
            written += _hand_over(spark, stage, path, pause_seconds, after_step)
        finally:
            delete_path(spark, stage)
        drop_shuffles(spark)
    return written


def _from_match(date: str, match_id: str | None) -> Column:
    """Whether a row's match is this one or a later one in replay order; a row without a day or match is before all."""
    same = F.lit(True) if match_id is None else F.col("match_id") >= match_id
    later = (F.col("date") > date) | (F.col("date") == date) & same
    return F.coalesce(F.col("match_id").isNotNull() & later, F.lit(False))


def _hand_over(spark, stage: str, path: str, pause_seconds: float,
               after_step: Callable[[int], None] | None = None) -> int:
    """Move staged step files into the source folder in order of their step."""
    hadoop = spark_context(spark)._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark_context(spark)._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    stamp = max([int(time.time() * 1000), *(s.getModificationTime() + 1 for s in fs.listStatus(target))])
    files = sorted((int(s.getPath().getParent().getName().split("=")[1]), s.getPath().getName(), s.getPath())
                   for s in fs.globStatus(hadoop.Path(f"{stage}/step=*/part-*")))
    for k, (step, name, source) in enumerate(files):
        if k and pause_seconds:
            time.sleep(pause_seconds)
        fs.setTimes(source, stamp + k, -1)
        if not fs.rename(source, hadoop.Path(f"{path.rstrip('/')}/step-{step:012d}-{name}")):
            raise OSError(f"could not hand over {source}")
        if after_step is not None and (k + 1 == len(files) or files[k + 1][0] != step):
            after_step(step)
    return len(files)


def step_bounds(df: DataFrame, order: Column, steps: int) -> list:
    """``steps - 1`` increasing cut points of ``order`` (one aggregation)."""
    if steps <= 1:
        return []
    qs = [i / steps for i in range(1, steps)]
    cuts = df.agg(F.percentile_approx(order, qs, 10000).alias("c")).first()["c"]
    return sorted(set(c for c in cuts if c is not None))


def replay_steps(df: DataFrame, order: Column, steps: int,
                 write_step: Callable[[DataFrame, int], None],
                 after_step: Callable[[int], None] | None = None,
                 filter_col: Column | None = None,
                 to_value: Callable[[object], object] = lambda v: v) -> int:
    """Write ``df`` in ``steps`` contiguous ranges of ``order``, oldest first.

    Cut points are computed on ``order``; each step filters ``filter_col``
    (default ``order``; rows where it is NULL go with the first step) against ``to_value(cut)``, so the filter can be a plain
    column comparison that reaches the Parquet scan (row-group min/max
    skipping on a range-sorted table, or folder pruning on a partitioned one).
    """
    cuts = step_bounds(df, order, steps)
    edges = [None, *cuts, None]
    col = order if filter_col is None else filter_col
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = F.lit(True)
        if lo is None and hi is not None:  # rows without a key come first, as in an ascending sort
            cond = col.isNull() | (col <= F.lit(to_value(hi)))
            hi = None
        # Ranges are (lo, hi]: a cut point closes the range it was taken from.
        if lo is not None:
            cond = cond & (col > F.lit(to_value(lo)))
        if hi is not None:
            cond = cond & (col <= F.lit(to_value(hi)))
        write_step(df.where(cond), i)
        if after_step is not None:
            after_step(i)
    return len(edges) - 1
