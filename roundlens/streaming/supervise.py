"""Keeping streaming queries alive, and recording what they do.

``supervise`` restarts a query that fails from its checkpoint, waiting longer
after each failure in a row, while the others go on.  ``ProgressLog`` is a
listener that keeps one row per micro-batch: input rows, rates and the rows
that a watermark dropped.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..session import scratch_path

PROGRESS = ("query string, name string, batch_id long, at string, input_rows long, input_rate double, "
            "processed_rate double, dropped_late long")


def supervise(starters: dict[str, Callable[[], StreamingQuery]], first_wait: float = 1.0, longest_wait: float = 60.0,
              healthy_after: float = 300.0, stop: threading.Event | None = None, poll: float = 0.5,
              on_failure: Callable[[str, Exception], None] | None = None) -> dict[str, int]:
    """Run queries until each has ended by itself or ``stop`` is set; returns the restarts of each.

    A query that ends with an exception is started again after ``first_wait`` seconds,
    twice as long after each further failure (``longest_wait`` at most); one that ran
    ``healthy_after`` seconds begins anew.  A starter that fails counts as a failed query.
    """
    stop = stop or threading.Event()
    running: dict[str, StreamingQuery] = {}
    since: dict[str, float] = {}
    waits = dict.fromkeys(starters, first_wait)
    due = dict.fromkeys(starters, 0.0)      # when to start next; absent once a query has ended
    restarts = dict.fromkeys(starters, 0)

    def failed(name: str, error: Exception, ran: float) -> None:
        if ran >= healthy_after:
            waits[name] = first_wait
        due[name] = time.monotonic() + waits[name]
        waits[name] = min(longest_wait, 2 * waits[name])
        restarts[name] += 1
        if on_failure is not None:
            on_failure(name, error)

    while (running or due) and not stop.is_set():
        for name in [n for n, at in due.items() if at <= time.monotonic()]:
            del due[name]
            try:
                running[name] = starters[name]()
                since[name] = time.monotonic()
            except Exception as error:
                failed(name, error, 0.0)
        for name, query in list(running.items()):
            if not query.isActive:
                del running[name]
                error = query.exception()
                if error is not None:
                    failed(name, error, time.monotonic() - since[name])
        stop.wait(poll)
    for query in running.values():
        query.stop()
    return restarts


class ProgressLog(StreamingQueryListener):
    """Rows per micro-batch, written as Parquet every ``rows`` batches and on ``flush``.

    Register with ``spark.streams.addListener``.  The log is the listener's own
    (a new folder per log under ``path``, or the scratch folder).
    """

    def __init__(self, spark: SparkSession, path: str | None = None, rows: int = 1000):
        self.spark, self.path, self.rows = spark, path or scratch_path(spark, "progress"), rows
        self.held: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        with self.lock:
            self.held.append((str(p.id), p.name, p.batchId, p.timestamp, p.numInputRows, float(p.inputRowsPerSecond),
                              float(p.processedRowsPerSecond), dropped))
            full = len(self.held) >= self.rows
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            held, self.held = self.held, []
        if held:
            self.spark.createDataFrame(held, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path)
