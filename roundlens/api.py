"""Public entry points.

| Original entry                 | Here                                              |
| ------------------------------ | ------------------------------------------------- |
| daily batch job ``--date D``   | ``daily_reports(df, date)`` / ``publish_daily``    |
| live streaming job             | ``start_live(messages, out, checkpoint, trigger)``, ``supervise`` |
| replay producer                | ``read_raw_csv`` → ``to_wire`` → ``write_replay``   |
| dashboard refresh payload      | ``read_results(spark, out)``                       |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import daily, live  # noqa: F401
from .session import delete_path, path_exists, scratch_path, versions
from .operators.daily import daily_reports  # noqa: F401
from .plans.reports import (
    read_result, read_snapshot, report_lines, report_lines_from, write_report_files,
    write_result,
)
from .sources.csv import raw_to_player_rounds, read_raw_csv, split_valid  # noqa: F401
from .sources.history import HistoryStore  # noqa: F401
from .sources.replay import match_sequence, replay_steps, write_match_steps  # noqa: F401
from .sources.store import (  # noqa: F401
    compact_days, read_store, reset_store, scan_day, write_store,
)
from .sources.wire import decode_wire, encode_wire
from .streaming.live import (  # noqa: F401
    file_messages, kafka_messages, start_daily_closer, start_day_close, start_live,
)
from .streaming.single import LiveOptions, read_batch_stats, read_daily, read_log, start_history  # noqa: F401
from .streaming.supervise import ProgressLog, supervise  # noqa: F401

to_wire = encode_wire
from_wire = decode_wire


def publish_daily(pr: DataFrame, out: str, date: str | None = None) -> None:
    """Compute the daily reports (one day or all) and publish them: one table
    per report with the covered days replaced, plus one text file per day."""
    if date is not None:
        pr = pr.where(F.col("date") == F.lit(date))
    computed, shared = daily.daily_report_set(pr)
    for df in shared:
        df.persist()
    reports = {name: df.persist() for name, df in computed.items()}
    try:
        for name, df in reports.items():
            write_result(df, f"{out}/{name}")
        write_report_files(report_lines_from(reports), f"{out}/text")
    finally:
        for df in [*reports.values(), *shared]:
            df.unpersist()


def write_replay(pr: DataFrame, path: str, steps: int = 8, style: str = "python") -> int:
    """Write the rows as wire messages in ``steps`` day ranges, oldest first,
    each range its own job (a file source then sees the ranges in order).

    The rows are staged once, so the source is read once whatever ``steps``; within a
    step the files, by name, and their lines are in (date, match_id) order.
    """
    stage = scratch_path(pr.sparkSession, "replay-stage")
    pr.repartitionByRange("date", "match_id").write.parquet(stage)
    staged = pr.sparkSession.read.schema(pr.schema).parquet(stage)

    def write_step(df: DataFrame, i: int) -> None:
        ordered = df.repartitionByRange("date", "match_id").sortWithinPartitions("date", "match_id")
        encode_wire(ordered, style).write.mode("append").text(path)

    try:
        return replay_steps(staged, F.col("date").try_cast("int"), steps, write_step,
                            filter_col=F.col("date"), to_value=lambda v: f"{int(v):08d}")
    finally:
        delete_path(pr.sparkSession, stage)


def write_kafka(pr: DataFrame, bootstrap_servers: str, topic: str, style: str = "python") -> None:
    """Publish rows as wire messages (null key) to a Kafka topic.

    Needs the Kafka connector package on the classpath."""
    (encode_wire(pr, style).select(F.lit(None).cast("binary").alias("key"), "value")
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
     .option("topic", topic).save())


def start_kafka_sink(pr_stream: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                     trigger: dict | None = None, style: str = "python"):
    """Streaming variant of ``write_kafka`` (checkpointed, at-least-once)."""
    return (encode_wire(pr_stream, style).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/kafka_sink")
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def read_results(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Every published result table under ``out``."""
    tables = ["divisions", "operators", "platforms", "series", "report_lines"]
    snapshots = ["operator_ratios", "mode_role_wins", "mode_role_map_wins", "mode_role_peak", "map_best"]
    found = {}
    for n in tables + snapshots:
        p = f"{out.rstrip('/')}/{n}"
        if n in tables and versions(spark, p):  # written by the live query
            found[n] = read_daily(spark, out, n)
        elif path_exists(spark, p):
            found[n] = read_snapshot(spark, p) if n in snapshots else read_result(spark, p)
    log = read_log(spark, f"{out.rstrip('/')}/map_best_log")
    if log is not None:
        found["map_best_log"] = log.drop("seq")
    return found
