"""One live query for all outputs: the source is read and each message decoded once per micro-batch.

Every micro-batch is decoded, kept, and from it are written

* ``history``: its rows, in the history store that batch jobs append to and fold (``HistoryStore``);
* ``quarantine``: undecodable messages and messages of days that lie in the future;
* ``totals``: running sums per (mode, role, map, operator), the previous version plus this
  batch's sums.  T1, T2 and T3 are small aggregates of it; ``peaks`` keeps T2's largest
  single-match wins likewise.  The keys are the game's vocabulary;
* ``map_best_log``: the winners of the maps this batch touched, and no others; folded into
  ``map_best_base`` (latest row per map and role) every ``fold_every`` batches;
* the daily reports of days that are closed (a later day has arrived, ``open_days`` ago) and have
  rows that no report covers yet.  A day that receives rows after it was closed is reported
  again, and readers take each day's newest report (``read_daily``), so every closed day's
  report is complete after each batch;
* ``late_rows`` and ``batch_stats``: the rows that came after their day's report, and per
  batch the rows on time, late and refused.

Every table is keyed by batch number (or by day), and each batch reads versions below its own
number only, so a batch that is repeated after a failure replaces what it wrote and adds nothing.

A message cannot close days by naming one far ahead: days after the arrival day (``ahead_days``
more), and with ``max_step_days`` days that far past the newest day known, are refused.  The very
first batch has no newest day; its median day stands in.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import daily, live
from ..operators.ranking import arg_best, latest_per_key
from ..plans.reports import publish_reports, write_result
from ..schema import PLAYER_ROUNDS_COLUMNS
from ..session import delete_path, drop_versions, versions
from ..sources.history import HistoryStore
from ..sources.wire import decode_wire
from .live import DEFAULT_TRIGGER

KEYS = ["game_mode", "role", "map", "operator"]
SUMS = ["kills", "deaths", "wins", "rounds"]
DAYS = "date string, dirty boolean"
DAILY = ["divisions", "operators", "platforms", "series", "report_lines"]
STATS = "rows long, on_time long, late long, refused long"


@dataclass
class LiveOptions:
    decode: str = "json"
    require_both_roles: bool = False
    open_days: int = 0              # days a day stays open after a later one arrived
    ahead_days: int | None = 1      # refuse days later than today plus so many (None: any)
    max_step_days: int | None = None
    fold_every: int = 50            # batches between folds of the log and of the store's closed days
    keep_seconds: float = 600.0     # replaced versions and folders stay readable so long
    console: bool = False
    store: bool = True              # keep the history and report closed days; without it only T1 to T3


def operator_totals_of(totals: DataFrame) -> DataFrame:
    """T1 from the running totals."""
    per = totals.groupBy(live.operator_name("operator").alias("operator_name")).agg(
        *[F.sum(c).cast("long").alias(c) for c in SUMS])
    return live.with_ratios(per).select("operator_name", *SUMS, "kill_ratio", "round_ratio")


def map_wins_of(totals: DataFrame) -> DataFrame:
    return totals.groupBy("game_mode", "role", "map").agg(F.sum("wins").cast("long").alias("wins"))


def best_operators_of(totals: DataFrame, require_both_roles: bool = False) -> DataFrame:
    """T3 from the running totals."""
    per = totals.groupBy("map", "operator", "role").agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
    return live.best_per_map(live.with_ratios(per), require_both_roles=require_both_roles)


def peak_of(peaks: DataFrame) -> DataFrame:
    best = arg_best(peaks, ["game_mode", "role"], [-F.col("wins"), F.col("map")], ["map", "wins"])
    return best.select("game_mode", "role", F.col("map").alias("peak_map"), F.col("wins").alias("peak_wins"))


def together(spark: SparkSession, steps: list[Callable[[], None]]) -> None:
    """Run independent writes at the same time; the first error is raised when all have ended."""
    if len(steps) == 1:
        return steps[0]()
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()


class LiveJob:
    """The body of the live query; ``process`` handles one micro-batch of messages."""

    def __init__(self, out: str, options: LiveOptions | None = None):
        self.out, self.options = out.rstrip("/"), options or LiveOptions()

    def table(self, name: str) -> str:
        return f"{self.out}/{name}"

    # --- versioned tables

    def _before(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame | None:
        """The newest version of a table that an earlier batch wrote."""
        older = [p for n, p, _ in versions(spark, self.table(name)) if n < batch_id]
        return spark.read.parquet(older[-1]) if older else None

    def _put(self, df: DataFrame, name: str, batch_id: int, keep: bool = False) -> None:
        """Write version ``batch_id`` of a table; old versions go unless it is a log (``keep``)."""
        write_result(df.withColumn("batch_id", F.lit(batch_id).cast("long")), self.table(name), partition_by="batch_id")
        if not keep:
            drop_versions(df.sparkSession, self.table(name), keep_seconds=self.options.keep_seconds)

    def _merge(self, spark: SparkSession, fresh: DataFrame, name: str, batch_id: int, keys: list[str],
               merge: Callable[[str], Column], values: list[str]) -> None:
        """Write a table's next version: the previous one and this batch's rows, put together per key."""
        old = self._before(spark, name, batch_id)
        both = fresh if old is None else old.select(*fresh.columns).unionByName(fresh)
        self._put(both.groupBy(*keys).agg(*[merge(c).cast("long").alias(c) for c in values]), name, batch_id)

    # --- one micro-batch

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark, opt = batch.sparkSession, self.options
        known = self._before(spark, "days", batch_id)
        before = {} if known is None else {r["date"]: r["dirty"] for r in known.collect()}
        good = F.col("_error").isNull()
        decoded = self._bounded(decode_wire(batch, mode=opt.decode, keep=("value",)), max(before, default=None))
        decoded = decoded.withColumn("value", F.when(~good, F.col("value"))).persist()  # only a refused message's text is read
        rows = decoded.where(good).select(*PLAYER_ROUNDS_COLUMNS)
        try:
            # One row per calendar day of the batch, and one for what is refused.
            seen = {r["day"]: r["n"] for r in decoded.groupBy(F.when(good, F.col("date")).alias("day"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()}
            refused = seen.pop(None, 0)
            late = {d: n for d, n in seen.items() if before.get(d) is False}
            store = HistoryStore(spark, self.table("history"))
            steps = []
            if refused:
                steps.append(lambda: self._put(decoded.where(~good), "quarantine", batch_id, keep=True))
            if late:
                steps.append(lambda: self._put(rows.where(F.col("date").isin(list(late))), "late_rows", batch_id, keep=True))
            if seen:
                steps += [lambda: self._sum_up(spark, rows, batch_id), lambda: self._peaks(spark, rows, batch_id)]
            if seen and opt.store:
                steps.append(lambda: store.write_batch(rows, batch_id))
            together(spark, steps)
            if seen:
                together(spark, [*self._live_reports(spark, rows, batch_id),
                                 lambda: self._close_days(spark, before, seen, batch_id)])
            if seen or refused:
                n = sum(seen.values())
                counts = (n, n - sum(late.values()), sum(late.values()), refused)
                self._put(spark.createDataFrame([counts], STATS), "batch_stats", batch_id, keep=True)
        finally:
            decoded.unpersist()
        if opt.fold_every and batch_id % opt.fold_every == opt.fold_every - 1:
            self.fold(spark, batch_id)

    def _bounded(self, decoded: DataFrame, newest: str | None) -> DataFrame:
        """Decoded messages, those of days beyond the bound marked as errors."""
        opt, day, good = self.options, F.to_date("date", "yyyyMMdd"), F.col("_error").isNull()
        bound = F.lit(None).cast("date")
        if opt.max_step_days is not None:
            if newest is None:
                middle = decoded.where(good).agg(F.percentile_approx(F.unix_date(day), 0.5).alias("m")).first()["m"]
                start = F.date_from_unix_date(F.lit(middle).cast("int"))
            else:
                start = F.to_date(F.lit(newest), "yyyyMMdd")
            bound = F.date_add(start, opt.max_step_days)
        if opt.ahead_days is not None:
            bound = F.least(bound, F.date_add(F.current_date(), opt.ahead_days))
        ahead = F.coalesce(F.when(good, day) > bound, F.lit(False))
        return decoded.withColumn("_error", F.when(ahead, F.lit("future_date")).otherwise(F.col("_error")))

    def _sum_up(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        fresh = rows.groupBy(*KEYS).agg(*live.operator_totals())
        self._merge(spark, fresh, "totals", batch_id, KEYS, F.sum, SUMS)

    def _peaks(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        match = ["game_mode", "role", "map", "match_id"]
        per_match = rows.groupBy(*match).agg(F.sum("has_won").cast("long").alias("wins")).drop("match_id")
        self._merge(spark, per_match, "peaks", batch_id, match[:3], F.max, ["wins"])

    def _live_reports(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        totals, peaks = (spark.read.parquet(f"{self.table(t)}/batch_id={batch_id}") for t in ("totals", "peaks"))
        best = best_operators_of(totals, self.options.require_both_roles)
        touched = rows.select("map").distinct()
        tables = {"operator_ratios": operator_totals_of(totals), "mode_role_map_wins": map_wins_of(totals),
                  "mode_role_wins": live.best_map(map_wins_of(totals)), "mode_role_peak": peak_of(peaks),
                  "map_best": best}
        if self.options.console:
            totals.join(rows.select(*KEYS).distinct(), KEYS, "left_semi").show(truncate=False)
        return [*[lambda n=n, t=t: self._put(t, n, batch_id) for n, t in tables.items()],
                lambda: self._put(best.join(touched, "map", "left_semi"), "map_best_log", batch_id, keep=True)]

    def _close_days(self, spark: SparkSession, before: dict, seen: dict, batch_id: int) -> None:
        """Report the closed days that have unreported rows; what is left open or dirty is the next version."""
        dirty = {**before, **{d: True for d in seen}}
        order = sorted(dirty)
        closed = order[:max(0, len(order) - 1 - self.options.open_days)]
        due = [d for d in closed if dirty[d]]
        if due and self.options.store:
            rows = HistoryStore(spark, self.table("history")).read(due)
            reports, shared = daily.daily_report_set(rows)
            publish_reports(reports, self.out, partition_by="batch_id", shared=shared,
                            extra={"batch_id": F.lit(batch_id).cast("long")})
        left = [(d, dirty[d] and d not in due) for d in order]
        self._put(spark.createDataFrame(left, DAYS).coalesce(1), "days", batch_id)

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        """Fold the logs up to ``batch_id`` into their bases and closed, reported days of the store into one folder each."""
        self._fold_log(spark, "map_best_log", batch_id, lambda log: latest_per_key(log, ["map", "role"], "seq"))
        self._fold_log(spark, "batch_stats", batch_id, lambda log: log)
        if not self.options.store:
            return
        for name in DAILY:
            self._fold_log(spark, name, batch_id, newest_reports)
        days = self._before(spark, "days", batch_id + 1)
        settled = [] if days is None else [r["date"] for r in days.where("not dirty").collect()]
        store = HistoryStore(spark, self.table("history"))
        store.fold(settled)
        store.vacuum(self.options.keep_seconds)

    def _fold_log(self, spark: SparkSession, name: str, batch_id: int, shrink: Callable[[DataFrame], DataFrame]) -> None:
        log = self.table(name)
        entries = read_log(spark, log, batch_id)
        if entries is None:
            return
        self._put(shrink(entries), f"{name}_base", batch_id)
        covered = versions(spark, f"{log}_base")[0][0]  # also readers of the oldest base find its tail
        for number, path, modified in versions(spark, log):
            if number <= covered and time.time() - modified >= self.options.keep_seconds:
                delete_path(spark, path)


def read_log(spark: SparkSession, log: str, upto: int | None = None) -> DataFrame | None:
    """A log's entries with the batch they come from (``seq``): its newest base and the folders after it."""
    bases = [(n, p) for n, p, _ in versions(spark, f"{log}_base") if upto is None or n <= upto]
    start, base = bases[-1] if bases else (-1, None)
    tail = [p for n, p, _ in versions(spark, log) if n > start and (upto is None or n <= upto)]
    parts = [spark.read.parquet(base)] if base else []
    if tail:
        parts.append(spark.read.option("basePath", log).parquet(*tail)
                     .withColumn("seq", F.col("batch_id").cast("long")).drop("batch_id"))
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def newest_reports(log: DataFrame) -> DataFrame:
    """Each day's rows of its newest report (a report is written whole by one batch)."""
    newest = log.groupBy("date").agg(F.max("seq").alias("seq"))
    return log.join(newest, ["date", "seq"], "left_semi")


def read_daily(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A daily report table of the live query: for every closed day its newest report."""
    log = read_log(spark, f"{out.rstrip('/')}/{name}")
    if log is None:
        raise FileNotFoundError(f"no {name} reports under {out}")
    return newest_reports(log).drop("seq")


def latest_map_best(spark: SparkSession, out: str) -> DataFrame:
    """Current best operator per (map, role), from the folded base and the log's tail."""
    log = read_log(spark, f"{out.rstrip('/')}/map_best_log")
    if log is None:
        raise FileNotFoundError(f"no map winners under {out}")
    return latest_per_key(log, ["map", "role"], "seq").drop("seq")


def read_history(spark: SparkSession, out: str) -> DataFrame:
    return HistoryStore(spark, f"{out.rstrip('/')}/history").read()


def read_batch_stats(spark: SparkSession, out: str) -> DataFrame:
    """One row per batch (``seq``): rows = on_time + late, and refused messages."""
    log = read_log(spark, f"{out.rstrip('/')}/batch_stats")
    return spark.createDataFrame([], f"{STATS}, seq long") if log is None else log


def start_single(messages: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                 options: LiveOptions | None = None) -> StreamingQuery:
    """Start the one live query over a message stream (column ``value``)."""
    return (messages.select("value").writeStream
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/live")
            .trigger(**(trigger or DEFAULT_TRIGGER)).foreachBatch(LiveJob(out, options).process).start())


def start_history(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  decode: str = "json") -> StreamingQuery:
    """The store alone: decodable messages go to the history store at ``path``."""
    def body(batch: DataFrame, batch_id: int) -> None:
        good = decode_wire(batch, mode=decode).where("_error is null")
        HistoryStore(batch.sparkSession, path).write_batch(good, batch_id)
    return (messages.select("value").writeStream.option("checkpointLocation", f"{checkpoint.rstrip('/')}/history")
            .trigger(**(trigger or DEFAULT_TRIGGER)).foreachBatch(body).start())
