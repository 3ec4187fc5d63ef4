"""History store that a stream, batch appends and folding use together.

Three folders of Parquet, all led by ``date=D``, whose names alone say what counts:

* ``live/date=D/batch_id=N``: the rows of day D that micro-batch N brought.  A
  repeated micro-batch replaces its own folders, so there is no sink log.
* ``appended/date=D/append_id=T``: the rows that one batch append brought.
* ``archive/date=D/fold=SEQ_N_T``: all rows of D from micro-batches up to N and
  appends up to T, rewritten as few files.

A day reads as its newest fold plus the live and appended folders after it.  A
folder appears when its write commits, so a reader sees a day before a fold or
after it, never both copies and never neither; a micro-batch that repeats after
its day was folded changes nothing.  Folded folders stay until ``vacuum`` finds
them older than readers may need.  One stream writes a store (its batch numbers
order the live folders) and one job at a time appends or folds; the stream may go on meanwhile.
"""

from __future__ import annotations

import time
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PLAYER_ROUNDS_COLUMNS, PLAYER_ROUNDS_SCHEMA
from ..session import list_folders, delete_path

LIVE, APPENDED, ARCHIVE = "live/date=*/batch_id=*", "appended/date=*/append_id=*", "archive/date=*/fold=*"
KEEP_SECONDS = 3600
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # folder of rows without a day: read with the rest, never folded


@dataclass
class Day:
    """The folders of one day: (number, path, modified at) lists and the newest fold."""
    live: list = field(default_factory=list)
    appended: list = field(default_factory=list)
    folds: list = field(default_factory=list)  # ((seq, batch, append), path, modified at)

    @property
    def folded(self) -> tuple[int, int, int]:
        return max((f[0] for f in self.folds), default=(0, -1, -1))

    def counting(self) -> dict[str, list[str]]:
        """The folders that make up the day, by kind."""
        _, batch, append = self.folded
        return {"archive": [p for k, p, _ in self.folds if k == self.folded],
                "live": [p for n, p, _ in self.live if n > batch],
                "appended": [p for n, p, _ in self.appended if n > append]}

    def superseded(self) -> list[tuple[str, float]]:
        _, batch, append = self.folded
        return ([(p, at) for k, p, at in self.folds if k < self.folded]
                + [(p, at) for n, p, at in self.live if n <= batch]
                + [(p, at) for n, p, at in self.appended if n <= append])


class HistoryStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- writing

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of one micro-batch; writing the same batch again replaces it."""
        self._write(rows, "live", "batch_id", batch_id)

    def append(self, rows: DataFrame) -> int:
        """Rows of a batch job, as one append per day; returns its number."""
        used = [n for d in self.days().values() for n in (*[a[0] for a in d.appended], d.folded[2])]
        number = max(time.time_ns() // 1000, *(n + 1 for n in used)) if used else time.time_ns() // 1000
        self._write(rows, "appended", "append_id", number)
        return number

    def _write(self, rows: DataFrame, folder: str, key: str, number: int) -> None:
        (rows.select(*PLAYER_ROUNDS_COLUMNS, F.lit(number).cast("long").alias(key)).hint("rebalance", "date", key)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", key)
         .parquet(f"{self.path}/{folder}"))

    # --- reading

    def days(self) -> dict[str, Day]:
        """Folders by day, from folder names only (one entry per calendar day and open batch)."""
        found: dict[str, Day] = defaultdict(Day)
        for kind, pattern in (("folds", ARCHIVE), ("live", LIVE), ("appended", APPENDED)):
            for path, modified in list_folders(self.spark, f"{self.path}/{pattern}"):
                date, name = (part.split("=", 1)[1] for part in path.rstrip("/").split("/")[-2:])
                number = tuple(int(x) for x in name.split("_")) if kind == "folds" else int(name)
                getattr(found[date], kind).append((number, path, modified))
        return dict(found)

    def read(self, days: list[str] | None = None) -> DataFrame:
        """The rows of the store, or of some days: only their folders are opened."""
        return self._read(self.days(), days)

    def _read(self, folders: dict[str, Day], days: list[str] | None) -> DataFrame:
        paths: dict[str, list[str]] = {"archive": [], "live": [], "appended": []}
        for date in folders if days is None else [d for d in days if d in folders]:
            for kind, some in folders[date].counting().items():
                paths[kind] += some
        out = self.spark.createDataFrame([], PLAYER_ROUNDS_SCHEMA)
        for kind, some in paths.items():
            if some:
                part = (self.spark.read.schema(PLAYER_ROUNDS_SCHEMA).option("basePath", f"{self.path}/{kind}")
                        .parquet(*some).select(*PLAYER_ROUNDS_COLUMNS))
                out = out.unionByName(part)
        return out

    # --- folding

    def fold(self, days: list[str] | None = None, least: int = 2) -> list[str]:
        """Rewrite days that consist of ``least`` folders or more as one fold each; returns those days.

        The new fold is another folder than all it reads, so a failed fold leaves
        the day as it was and can be tried again.
        """
        folders = self.days()
        chosen = [d for d in sorted(folders if days is None else set(days) & set(folders))
                  if d != NO_DAY and sum(map(len, folders[d].counting().values())) >= least]
        if not chosen:
            return []
        names = []
        for d in chosen:
            seq, batch, append = folders[d].folded
            batch = max([batch, *(n for n, _, _ in folders[d].live)])
            append = max([append, *(n for n, _, _ in folders[d].appended)])
            names.append((d, f"{seq + 1:06d}_{batch}_{append}"))
        # One row per folded day: a bounded list of names, as many as the folders just listed.
        named = self.spark.createDataFrame(names, "date string, fold string")
        (self._read(folders, chosen).join(F.broadcast(named), "date").hint("rebalance", "date", "fold")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "fold")
         .parquet(f"{self.path}/archive"))
        return chosen

    def vacuum(self, keep_seconds: float = KEEP_SECONDS) -> int:
        """Delete folders that a fold replaced and that are older than ``keep_seconds``."""
        now, gone = time.time(), 0
        for day in self.days().values():
            for path, modified in day.superseded():
                if now - modified >= keep_seconds:
                    delete_path(self.spark, path)
                    gone += 1
        return gone
