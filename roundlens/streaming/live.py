"""Structured Streaming: sources, live reports as separate queries, day closing.

``start_live`` runs every output in one query (module ``single``).  The starters
here run one output each, as a query of its own with its own checkpoint, for
those who want few of them; each decodes the stream for itself (``decode_wire``):

* store: append-only Parquet file sink partitioned by ``date`` (exactly-once
  through the sink's commit log); undecodable messages go to a quarantine sink.
* T1 / T2 / T3: streaming ``groupBy().agg()`` whose keys are bounded by the
  game's vocabulary (operators, modes × roles × maps, maps × operators), so
  ``complete`` output stays small (``state_partitions`` sizes the state
  store); ``foreachBatch`` applies the same batch transform as the daily job
  and publishes it as a new committed snapshot version (``read_snapshot``).
  T3 also appends the winners of the maps each batch touched to a log.
* day closing: a 0-delay watermark on a one-day window; a day is final once a
  later day arrives (the last day stays open, as in the original).  The daily
  closer reads the *store's* committed output as its source, so when a day
  closes all of its rows are already in the store, then runs the daily
  reports for the closed days only (partition-pruned), keyed by batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import daily, live
from ..plans.reports import publish_reports, write_result
from ..operators.ranking import latest_per_key
from ..schema import PLAYER_ROUNDS_COLUMNS, PLAYER_ROUNDS_SCHEMA
from ..session import path_exists, spark_context
from ..sources.store import read_store
from ..sources.wire import decode_wire

DEFAULT_TRIGGER = {"processingTime": "1 second"}


# --- sources ----------------------------------------------------------------------------

def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Message text files as a stream (one message per line, column ``value``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str,
                   starting_offsets: str = "earliest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as a message stream (needs the Kafka connector package)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"))


def decoded(messages: DataFrame, mode: str = "json") -> tuple[DataFrame, DataFrame]:
    """(good canonical rows, quarantined rows: ``_error`` plus the raw ``value``)."""
    dec = decode_wire(messages, mode=mode, keep=("value",))
    good = dec.where(F.col("_error").isNull()).drop("_error", "value")
    bad = dec.where(F.col("_error").isNotNull())
    return good, bad


# --- query starters ---------------------------------------------------------------------

def _writer(df: DataFrame, name: str, checkpoint: str, trigger: dict | None, mode: str):
    return (df.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
            .trigger(**(trigger or DEFAULT_TRIGGER)))


def _start(writer, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start a stateful query, optionally with its own number of state partitions.

    The count is read from ``spark.sql.shuffle.partitions`` when a query first
    starts and is then fixed by its checkpoint.  The live reports' keys are the
    game's vocabulary (a few thousand at most), so a handful of partitions
    avoids a state-store commit per near-empty partition on every trigger.
    """
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def start_store(pr: DataFrame, store_path: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    """Append canonical rows to the date-partitioned history store."""
    return (_writer(pr.select(*PLAYER_ROUNDS_COLUMNS), "store", checkpoint, trigger, "append")
            .format("parquet").partitionBy("date").option("path", store_path).start())


def start_quarantine(bad: DataFrame, path: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    return (_writer(bad, "quarantine", checkpoint, trigger, "append")
            .format("parquet").option("path", path).start())


def _drop_versions_before(spark: SparkSession, table: str, keep_from: int) -> None:
    """Delete ``batch_id=N`` folders of ``table`` with N < keep_from."""
    sc = spark_context(spark)
    if sc is None:  # Connect client: no filesystem access, keep all versions
        return
    root = sc._jvm.org.apache.hadoop.fs.Path(table)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=", 1)[1]) < keep_from:
            fs.delete(st.getPath(), True)


def publish_snapshot(df: DataFrame, path: str, batch_id: int) -> None:
    """Publish a new version of a snapshot table without touching the live one.

    The version is a ``batch_id=N`` folder that appears only when its write
    commits (dynamic partition overwrite, so a retried batch rewrites just its
    own folder); readers take the newest version (``read_snapshot``).  The
    two newest versions are kept so a reader of the previous one is not cut off.
    """
    write_result(df.withColumn("batch_id", F.lit(batch_id).cast("long")), path,
                 partition_by="batch_id")
    _drop_versions_before(df.sparkSession, path, batch_id - 1)


def _snapshot(transform, path: str):
    """foreachBatch body: publish ``transform(batch)`` as the new snapshot."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # nothing received yet: keep the last snapshot
            return
        publish_snapshot(transform(batch), path, batch_id)
    return run


def start_operator_ratios(pr: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                          state_partitions: int | None = None) -> StreamingQuery:
    """T1: running totals per operator name; ratios published each batch."""
    totals = live.operator_name_totals(pr)
    body = _snapshot(lambda b: live.with_ratios(b).select(
        "operator_name", "kills", "deaths", "wins", "rounds", "kill_ratio", "round_ratio"),
        f"{out}/operator_ratios")
    return _start(_writer(totals, "operator_ratios", checkpoint, trigger, "complete")
                  .foreachBatch(body), pr.sparkSession, state_partitions)


def start_mode_role_wins(pr: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                         state_partitions: int | None = None) -> StreamingQuery:
    """T2: running wins per (mode, role, map); best map per (mode, role)."""
    wins = live.mode_role_map_wins(pr)

    def body(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            publish_snapshot(batch, f"{out}/mode_role_map_wins", batch_id)
            publish_snapshot(live.best_map(batch), f"{out}/mode_role_wins", batch_id)
        finally:
            batch.unpersist()
    return _start(_writer(wins, "mode_role_wins", checkpoint, trigger, "complete")
                  .foreachBatch(body), pr.sparkSession, state_partitions)


def start_map_best(pr: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                   require_both_roles: bool = False, console: bool = False,
                   state_partitions: int | None = None) -> StreamingQuery:
    """T3: running totals per (map, operator); best attacker / defender per map.

    Each batch replaces the ``map_best`` snapshot.  The ``map_best_log`` gets,
    keyed by batch id, the winners of the maps whose totals changed in this
    batch only (found by comparing with the previous batch's totals, kept as
    the two newest ``map_operator_totals`` versions so a retried batch
    compares against the same version).  The latest log row per (map, role)
    equals the snapshot.  ``console`` also prints each batch's changed totals.
    """
    totals = live.map_operator_totals(pr)
    versions = f"{out}/map_operator_totals"

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            best = live.best_per_map(live.with_ratios(batch), require_both_roles=require_both_roles)
            publish_snapshot(best, f"{out}/map_best", batch_id)
            prev_path = f"{versions}/batch_id={batch_id - 1}"
            changed = batch
            if batch_id > 0 and path_exists(spark, prev_path):
                changed = batch.exceptAll(spark.read.parquet(prev_path).select(*batch.columns))
            touched = changed.select("map").distinct()
            if console:
                changed.show(truncate=False)
            (best.join(touched, "map", "left_semi")
             .withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
             .parquet(f"{out}/map_best_log"))
            (batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(versions))
            _drop_versions_before(spark, versions, batch_id - 1)
        finally:
            batch.unpersist()
    return _start(_writer(totals, "map_best", checkpoint, trigger, "complete")
                  .foreachBatch(body), pr.sparkSession, state_partitions)


def start_live(messages: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
               decode: str = "json", console: bool = False, **options) -> list[StreamingQuery]:
    """All live outputs over one message stream, as one query that reads the stream once:
    history store, quarantine, T1, T2, T3, daily reports of closed days (see ``single``;
    ``options`` are those of ``LiveOptions``; ``console`` prints T3's changed totals of each batch)."""
    from .single import LiveOptions, start_single
    return [start_single(messages, out, checkpoint, trigger,
                         LiveOptions(decode=decode, console=console, **options))]


def latest_map_best(spark: SparkSession, out: str) -> DataFrame:
    """Current best operator per (map, role) from the append log."""
    return latest_per_key(spark.read.parquet(f"{out}/map_best_log"), ["map", "role"], "batch_id") \
        .drop("batch_id")


# --- day closing ------------------------------------------------------------------------

def day_close_counts(events: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Rows per (day, event type), emitted once the watermark passes the day."""
    return (events.withWatermark("ts", delay)
            .groupBy(F.window("ts", "1 day").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.to_date(F.to_utc_timestamp(
                F.col("w.start"), F.current_timezone())).alias("day"), "event_type", "n"))


def start_day_close(events: DataFrame, out: str, checkpoint: str, delay: str = "0 seconds",
                    trigger: dict | None = None,
                    state_partitions: int | None = None) -> StreamingQuery:
    return _start(_writer(day_close_counts(events, delay), "day_close", checkpoint, trigger,
                          "append").format("parquet").option("path", out),
                  events.sparkSession, state_partitions)


def closed_days(pr: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """One row per day of the fact stream, emitted when the day closes."""
    # A one-day window closes when its *end* passes the watermark, i.e. once a
    # later day has arrived; the newest day stays open.
    return (pr.withColumn("_day_ts", F.try_to_timestamp("date", F.lit("yyyyMMdd")))
            .withWatermark("_day_ts", delay)
            .groupBy(F.window("_day_ts", "1 day"), "date").agg(F.count(F.lit(1)).alias("rows"))
            .select("date", "rows"))


def start_daily_closer(spark: SparkSession, store_path: str, out: str, checkpoint: str,
                       trigger: dict | None = None, delay: str = "0 seconds",
                       state_partitions: int | None = None) -> StreamingQuery:
    """Run the daily reports for each day as it closes, from the history store."""
    source = spark.readStream.schema(PLAYER_ROUNDS_SCHEMA).parquet(store_path)

    def body(batch: DataFrame, batch_id: int) -> None:
        # The closed days of one micro-batch: a handful of short strings, used
        # as literal partition filters so the store scan reads only them.
        days = [r["date"] for r in batch.select("date").distinct().collect()]
        if not days:
            return
        rows = read_store(spark, store_path).where(F.col("date").isin(days))
        # A day closes exactly once (append mode), so keying the output by the
        # micro-batch makes a re-run of this batch replace only its own folder.
        reports, shared = daily.daily_report_set(rows)
        publish_reports(reports, out, partition_by="batch_id", shared=shared,
                        extra={"batch_id": F.lit(batch_id).cast("long")})
    return _start(_writer(closed_days(source, delay), "daily_closer", checkpoint, trigger,
                          "append").foreachBatch(body), spark, state_partitions)
