"""Report outputs: formatted text lines, result tables and their readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import daily

# The line templates of the daily text report, in file order
# (date line, divisions, blank line, operators, blank line, platforms).
DIVISION_LINE = ("Divisione: {division},  Punti: {points},  Livello medio giocatori: {avg_level},"
                 "  Tempo totale giocato: {time_hms}")
OPERATOR_LINE = ("Operatore: {operator},  Ruolo: {role},  killRatio: {kill_ratio},"
                 "  roundRatio: {round_ratio},  Round totali giocati: {rounds}")
PLATFORM_LINE = ("Piattaforma: {platform},  Mappa più giocata: {top_map},"
                 "  Totale round giocati: {rounds},  Tempo di gioco totale: {time_hms}")

SECTION_DATE, SECTION_DIVISIONS, SECTION_GAP1, SECTION_OPERATORS, SECTION_GAP2, \
    SECTION_PLATFORMS = range(6)


def _fill(template: str) -> F.Column:
    """Template with ``{col}`` fields → concat of literals and columns as text."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(F.col(name).cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def report_lines(pr: DataFrame, **kw) -> DataFrame:
    """Every day's text report as rows (date, section, item, value)."""
    return report_lines_from(daily.daily_reports(pr, **kw))


def report_lines_from(reports: dict[str, DataFrame]) -> DataFrame:
    """Text report rows from already computed daily reports."""

    def line(section, item, value):
        return F.struct(F.lit(section).alias("section"), item.alias("item"), value.alias("value"))

    one = F.lit(1)
    div_line = line(SECTION_DIVISIONS, F.col("rank"), _fill(DIVISION_LINE))
    # The day's fixed lines (date, two blank separators) ride on its rank-1
    # division row: every day with rows has one, and no extra pass is needed.
    divisions = reports["divisions"].select("date", F.explode(
        F.when(F.col("rank") == 1, F.array(
            line(SECTION_DATE, one, F.col("date")), div_line,
            line(SECTION_GAP1, one, F.lit("")), line(SECTION_GAP2, one, F.lit(""))))
        .otherwise(F.array(div_line))).alias("l"))
    operators = reports["operators"].select(
        "date", line(SECTION_OPERATORS, F.col("rank"), _fill(OPERATOR_LINE)).alias("l"))
    platforms = reports["platforms"].select(
        "date", line(SECTION_PLATFORMS, F.col("rank"), _fill(PLATFORM_LINE)).alias("l"))
    return (divisions.unionByName(operators).unionByName(platforms)
            .select("date", "l.section", "l.item", "l.value"))


def publish_reports(reports: dict[str, DataFrame], out: str, partition_by: str = "date",
                    extra: dict | None = None, shared: list | tuple = ()) -> None:
    """Write the daily reports and their text lines.

    The reports and the ``shared`` inputs of several reports are small
    aggregated tables; each is persisted once so later outputs reuse it
    instead of recomputing it from the fact rows.
    """
    for df in shared:
        df.persist()
    kept = {name: df.persist() for name, df in reports.items()}
    try:
        tables = {**kept, "report_lines": report_lines_from(kept)}
        for name, df in tables.items():
            for col, value in (extra or {}).items():
                df = df.withColumn(col, value)
            write_result(df, f"{out}/{name}", partition_by=partition_by)
    finally:
        for df in [*kept.values(), *shared]:
            df.unpersist()


def write_report_files(lines: DataFrame, path: str) -> None:
    """One text file per day folder, lines in report order.  A day has a few
    lines only, so grouping a day in one task is bounded."""
    (lines.repartition("date").sortWithinPartitions("date", "section", "item")
     .select("value", "date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date").text(path))


def write_result(df: DataFrame, path: str, partition_by: str | None = "date") -> None:
    """Publish a report.  With ``partition_by`` only the partitions present in
    ``df`` are replaced (dynamic overwrite, so re-running a write is
    idempotent); with ``None`` the whole snapshot is replaced."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    w.parquet(path)


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """A published report (without the micro-batch key of streamed results)."""
    df = spark.read.parquet(path)
    if "batch_id" in df.columns:
        df = df.drop("batch_id")
    if "date" in df.columns and dict(df.dtypes)["date"] != "string":
        # Partition discovery types yyyyMMdd folders as integers: restore the text.
        df = df.withColumn("date", F.lpad(F.col("date").cast("string"), 8, "0"))
    if "date" in df.columns:
        df = df.select("date", *[c for c in df.columns if c != "date"])
    return df


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a snapshot table (``batch_id=N`` folders)."""
    df = spark.read.parquet(path)
    latest = df.agg(F.max("batch_id")).first()[0]
    return df.where(F.col("batch_id") == F.lit(latest)).drop("batch_id")


def latest_closed_date(*results: DataFrame, newest_open: bool = False) -> DataFrame:
    """The most recent closed day (one row, NULL if there is none).

    Published tables hold closed days only.  Of the fact itself (``newest_open``)
    the newest day is still open, so the one before it is named.
    """
    dates = None
    for r in results:
        d = r.select("date")
        dates = d if dates is None else dates.unionByName(d)
    if newest_open:
        two = dates.where("date is not null").distinct().orderBy(F.desc("date")).limit(2)
        return two.agg(F.when(F.count("date") == 2, F.min("date")).alias("latest_date"))
    return dates.agg(F.max("date").alias("latest_date"))
