"""Named queries over the driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query starts from the driver tables (through the fact adapter) so its
work grows with them; the plan objects are lazy, nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..operators import daily, live
from ..operators.ranking import latest_per_key
from ..schema import PLAYER_ROUNDS_COLUMNS
from ..session import scratch_path
from ..sources import csv as csv_source
from ..sources.history import HistoryStore
from ..sources import replay as replay_source
from ..sources import store as store_source
from ..sources import wire
from ..sources.tables import events_table, player_rounds_from_tables
from ..streaming import live as live_stream
from ..streaming import single
from ..streaming.replay_run import replay_by_match, replay_events_day_close, replay_fact, replay_single
from . import reports

# The day used by the single-day store scan, and the number of
# replay steps (micro-batches) the streaming queries are drained in.
SCAN_DAY = "19980301"
REPLAY_STEPS = 3
ORDER_STEPS = 6

QueryFn = Callable[[SparkSession, str], DataFrame]


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_rounds_from_tables(spark, sf_dir)


def _on_fact(transform) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return transform(_fact(spark, sf_dir))
    run.__name__ = getattr(transform, "__name__", "query")
    run.__doc__ = transform.__doc__
    return run


BATCH_QUERIES: dict[str, QueryFn] = {
    "fact_player_rounds": _on_fact(lambda pr: pr),
    "division_scoreboard": _on_fact(daily.division_scoreboard),
    "division_topk": _on_fact(daily.division_topk),
    "operator_ratios": _on_fact(daily.operator_ratios),
    "operator_topk": _on_fact(daily.operator_topk),
    "round_dedupe": _on_fact(daily.round_dedupe),
    "platform_map_time": _on_fact(daily.platform_map_time),
    "platform_summary": _on_fact(daily.platform_summary),
    "daily_platform_series": _on_fact(lambda pr: daily.daily_platform_series(pr, ("F", "O"))),
    "operator_name_ratios": _on_fact(live.operator_name_ratios),
    "mode_role_map_wins": _on_fact(live.mode_role_map_wins),
    "mode_role_best_map": _on_fact(live.mode_role_best_map),
    "mode_role_peak_match": _on_fact(live.mode_role_peak_match),
    "map_operator_stats": _on_fact(live.map_operator_stats),
    "map_best_operators": _on_fact(live.map_best_operators),
    "map_best_by_day": _on_fact(live.map_best_by_day),
    # As-written variants, kept as options.
    "operator_topk_single_row_zero": _on_fact(
        lambda pr: daily.operator_topk(pr, single_row="zero")),
    "map_best_operators_both_roles": _on_fact(
        lambda pr: live.map_best_operators(pr, require_both_roles=True)),
    "map_best_operators_as_written": _on_fact(
        lambda pr: live.map_best_operators(pr, merge_roles=True)),
}


# --- codecs, sources, store, report files ---------------------------------------------------

def _wire_encode(spark, sf_dir):
    return wire.encode_wire(_fact(spark, sf_dir), keep=("date", "match_id"))


def _wire_decode(spark, sf_dir):
    msgs = wire.encode_wire(_fact(spark, sf_dir))
    good, _ = csv_source.split_valid(wire.decode_wire(msgs, "json"))
    return good


def _wire_decode_legacy(spark, sf_dir):
    msgs = wire.encode_wire(_fact(spark, sf_dir))
    good, _ = csv_source.split_valid(wire.decode_wire(msgs, "legacy"))
    return good


def _wire_decode_rejects(spark, sf_dir):
    msgs = wire.encode_wire(_fact(spark, sf_dir))
    _, bad = csv_source.split_valid(wire.decode_wire(msgs, "legacy"))
    return bad.groupBy(F.col("_error").alias("error")).agg(F.count(F.lit(1)).alias("rows"))


def _csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    csv_source.write_raw_csv(_fact(spark, sf_dir), path)
    good, _ = csv_source.split_valid(
        csv_source.raw_to_player_rounds(csv_source.read_raw_csv(spark, path)))
    return good


def _scan_day(spark, sf_dir):
    path = scratch_path(spark, "store")
    store_source.write_store(_fact(spark, sf_dir), path)
    return store_source.scan_day(spark, path, SCAN_DAY)


def _latest_closed_date(spark, sf_dir):
    return reports.latest_closed_date(_fact(spark, sf_dir), newest_open=True)


def _latest_per_key(spark, sf_dir):
    log = live.map_best_by_day(_fact(spark, sf_dir))
    return latest_per_key(log, ["map", "role"], "date")


# --- streaming (drained replays; result tables read back) -------------------------------

def _stream_operator_ratios(spark, sf_dir):
    out = replay_fact(spark, _fact(spark, sf_dir), REPLAY_STEPS,
                      [live_stream.start_operator_ratios])
    return reports.read_snapshot(spark, f"{out}/operator_ratios")


def _stream_mode_role_wins(spark, sf_dir):
    out = replay_fact(spark, _fact(spark, sf_dir), REPLAY_STEPS,
                      [live_stream.start_mode_role_wins])
    return reports.read_snapshot(spark, f"{out}/mode_role_wins")


def _stream_map_best(spark, sf_dir):
    out = replay_fact(spark, _fact(spark, sf_dir), REPLAY_STEPS,
                      [live_stream.start_map_best])
    return reports.read_snapshot(spark, f"{out}/map_best")


def _stream_store_roundtrip(spark, sf_dir):
    out = replay_fact(spark, _fact(spark, sf_dir), REPLAY_STEPS,
                      [lambda good, o, c, t: live_stream.start_store(good, f"{o}/store", c, t)])
    return store_source.read_store(spark, f"{out}/store").select(*PLAYER_ROUNDS_COLUMNS)


def _stream_day_close(spark, sf_dir):
    out = replay_events_day_close(spark, events_table(spark, sf_dir), REPLAY_STEPS)
    return spark.read.parquet(out)


def _daily_report_all(spark, sf_dir):
    out = replay_fact(spark, _fact(spark, sf_dir), REPLAY_STEPS, [],
                      with_closer=True)
    return reports.read_result(spark, f"{out}/report_lines").select(
        "date", "section", "item", "value")


# --- the one live query, its store and late days -----------------------------------------

def _sent(n: int):
    """Part n of three: a few days are spread over all parts by match, the others come whole with the first."""
    spread = F.pmod(F.crc32("date"), F.lit(25)) == 0
    return F.when(spread, F.pmod(F.crc32("match_id"), F.lit(3))).otherwise(0) == n


def _stream_single_reports(spark, sf_dir):
    """T1, T2, T2's peak and T3 of the one live query, fed whole matches as the producer sends them."""
    out = replay_by_match(spark, _fact(spark, sf_dir), REPLAY_STEPS, lambda msgs, out, ckpt: single.start_single(
        msgs, out, ckpt, {"availableNow": True}, single.LiveOptions(store=False)))

    def lines(table, *cols):
        names = ("report", "key1", "key2", "name", "value1", "value2")
        return reports.read_snapshot(spark, f"{out}/{table}").select(*[
            (F.expr(c).cast("double") if n.startswith("value") else F.expr(c)).alias(n) for n, c in zip(names, cols)])
    return (lines("operator_ratios", "'T1'", "operator_name", "''", "''", "kill_ratio", "round_ratio")
            .unionByName(lines("mode_role_wins", "'T2'", "game_mode", "role", "best_map", "total_wins", "wins_on_map"))
            .unionByName(lines("mode_role_peak", "'T2 peak'", "game_mode", "role", "peak_map", "peak_wins", "0"))
            .unionByName(lines("map_best", "'T3'", "map", "role", "operator", "kill_ratio", "round_ratio")))


def _stream_store_compact(spark, sf_dir):
    """Stream, append in batch, fold, stream again, fold again: one store throughout."""
    fact = _fact(spark, sf_dir)
    root = scratch_path(spark, "shared-store")
    store = HistoryStore(spark, f"{root}/store")

    def stream(n):
        wire.encode_wire(fact.where(_sent(n))).write.mode("append").text(f"{root}/messages")
        q = single.start_history(live_stream.file_messages(spark, f"{root}/messages"), store.path, f"{root}/ckpt",
                                 {"availableNow": True})
        q.awaitTermination()

    stream(0)
    store.append(fact.where(_sent(1)))
    store.fold()
    stream(2)
    store.fold()
    store.vacuum(keep_seconds=0)
    return store.read()


def _daily_report_late(spark, sf_dir):
    """Part of some days' matches comes after those days are closed and reported."""
    fact = _fact(spark, sf_dir)
    out = replay_single(spark, [fact.where(~_sent(1)), fact.where(_sent(1))])
    return single.read_daily(spark, out, "report_lines").select("date", "section", "item", "value")


def _replay_order(spark, sf_dir):
    """Micro-batch number in which each match of a match-by-match replay reaches the stream."""
    def start(msgs, out, ckpt):
        def body(batch, batch_id):
            (wire.decode_wire(batch).select("date", "match_id").distinct()
             .withColumn("step", F.lit(batch_id).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("step").parquet(out))
        return (msgs.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
                .foreachBatch(body).start())
    out = replay_by_match(spark, _fact(spark, sf_dir), ORDER_STEPS, start)
    return spark.read.schema("date string, match_id string, step long").parquet(out)


MORE_QUERIES: dict[str, QueryFn] = {
    "wire_encode": _wire_encode,
    "wire_decode": _wire_decode,
    "wire_decode_legacy": _wire_decode_legacy,
    "wire_decode_rejects": _wire_decode_rejects,
    "csv_roundtrip": _csv_roundtrip,
    "scan_day": _scan_day,
    "match_sequence": _on_fact(replay_source.match_sequence),
    "report_lines": _on_fact(reports.report_lines),
    "latest_closed_date": _latest_closed_date,
    "latest_per_key": _latest_per_key,
    "stream_operator_ratios": _stream_operator_ratios,
    "stream_mode_role_wins": _stream_mode_role_wins,
    "stream_map_best": _stream_map_best,
    "stream_store_roundtrip": _stream_store_roundtrip,
    "stream_day_close": _stream_day_close,
    "daily_report_all": _daily_report_all,
    "stream_single_reports": _stream_single_reports,
    "stream_store_compact": _stream_store_compact,
    "daily_report_late": _daily_report_late,
    "replay_order": _replay_order,
}


def all_queries() -> dict[str, QueryFn]:
    return {**BATCH_QUERIES, **MORE_QUERIES}
