"""Drive streaming queries over a stepwise replay of a table (tests, bench, demos).

The replayed rows are first written to a staging folder, so that each step
filters its days out of stored rows.  Each step is written into the source
folder as its own job; then every query is started with ``availableNow``
on its checkpoint, drains the new files and stops.  Restarting from the
checkpoint at every step also exercises recovery after a stop.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import delete_path, drop_shuffles, scratch_path
from ..sources.replay import match_sequence, replay_steps, write_match_steps
from ..sources.wire import encode_wire
from . import live, single

AVAILABLE_NOW = {"availableNow": True}
FILE_MATCHES = 50_000  # matches that one file of a step holds


def _drain(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()
        err = q.exception()
        if err is not None:
            raise RuntimeError(f"streaming query failed: {err}")


def replay_fact(spark: SparkSession, fact: DataFrame, steps: int,
                starters: Sequence[Callable[[DataFrame, str, str, dict], StreamingQuery]],
                decode: str = "json", with_closer: bool = False) -> str:
    """Replay ``fact`` as wire messages in ``steps`` day ranges through the given
    live query starters (``starter(good_rows, out, checkpoint, trigger)``).

    With ``with_closer`` the store sink and the daily closer also run, in that
    order, after the starters of each step.  Returns the output folder.
    """
    root = scratch_path(spark, "replay")
    staging, src, out, ckpt = (f"{root}/staging", f"{root}/messages", f"{root}/out",
                               f"{root}/ckpt")
    # As the joins leave them: sorting the rows by day would compute the fact twice
    # (its range bounds are sampled) and cost more than reading a few columns again.
    fact.write.mode("overwrite").parquet(staging)
    staged = spark.read.parquet(staging)

    def write_step(df: DataFrame, i: int) -> None:
        encode_wire(df).write.mode("append").text(src)

    def after_step(i: int) -> None:
        good, _bad = live.decoded(live.file_messages(spark, src), decode)
        _drain([s(good, out, ckpt, AVAILABLE_NOW) for s in starters])
        if with_closer:
            _drain([live.start_store(good, f"{out}/store", ckpt, AVAILABLE_NOW)])
            _drain([live.start_daily_closer(spark, f"{out}/store", out, ckpt, AVAILABLE_NOW)])

    replay_steps(staged, F.col("date").try_cast("int"), steps, write_step, after_step,
                 filter_col=F.col("date"), to_value=lambda v: f"{int(v):08d}")
    return out


def replay_events_day_close(spark: SparkSession, events: DataFrame, steps: int,
                            delay: str = "0 seconds") -> str:
    """Replay the events table by time range through the day-closing query."""
    root = scratch_path(spark, "events")
    src, out, ckpt = f"{root}/events", f"{root}/out", f"{root}/ckpt"
    schema = events.schema

    def write_step(df: DataFrame, i: int) -> None:
        df.write.mode("append").parquet(src)

    def after_step(i: int) -> None:
        stream = spark.readStream.schema(schema).parquet(src)
        _drain([live.start_day_close(stream, out, ckpt, delay, AVAILABLE_NOW)])

    replay_steps(events, F.col("ts"), steps, write_step, after_step)
    return out


def replay_single(spark: SparkSession, parts: Sequence[DataFrame], options: single.LiveOptions | None = None,
                  after_part: Callable[[int, str], None] | None = None) -> str:
    """Send ``parts`` one after the other through the one live query, restarted from its
    checkpoint for each; ``after_part(number, out)`` runs between.  Returns the output folder."""
    root = scratch_path(spark, "single")
    src, out = f"{root}/messages", f"{root}/out"
    for i, part in enumerate(parts):
        encode_wire(part).write.mode("append").text(src)
        _drain([single.start_single(live.file_messages(spark, src), out, f"{root}/ckpt", AVAILABLE_NOW, options)])
        if after_part is not None:
            after_part(i, out)
    return out


def replay_by_match(spark: SparkSession, fact: DataFrame, steps: int,
                    start: Callable[[DataFrame, str, str], StreamingQuery]) -> str:
    """Replay ``fact`` in ``steps`` steps of equally many whole matches, one step a micro-batch,
    through ``start(messages, out, checkpoint)``, which drains what is there (``availableNow``)
    and is called for every step.  Returns the output folder."""
    root = scratch_path(spark, "by-match")
    src, out = f"{root}/messages", f"{root}/out"
    # Numbering and steps read the rows several times; stored, the shuffles that make them are needed once and go.
    fact.write.parquet(f"{root}/staging")
    fact = spark.read.schema(fact.schema).parquet(f"{root}/staging")
    matches = match_sequence(fact).count()
    drop_shuffles(spark)
    per_step = max(1, -(-matches // steps))

    def drain(step: int = 0) -> None:
        _drain([start(live.file_messages(spark, src), out, f"{root}/ckpt")])

    # A step has as many files as it needs; drained before the next is handed over, it is one micro-batch.
    if not write_match_steps(fact, src, per_step, files_per_step=-(-per_step // FILE_MATCHES), after_step=drain,
                             compression="gzip"):
        drain()
    delete_path(spark, f"{root}/staging")
    return out
