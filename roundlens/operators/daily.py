"""Daily reports (one result per day, every day at once).

Each report is a ``groupBy`` whose keys start with ``date``; Spark plans a
partial aggregate before the shuffle and a final one after it, so a hot key
(a day, a platform) is combined map-side and never lands whole in one task.
Per-day rankings come after the aggregation, over at most one row per
(day, division / operator / platform).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    KILL_POINTS, WIN_POINTS, day_label, division, half_even_2, hms, platform_bucket, points,
    ratio2, score,
)
from ..functions.columns import DEFAULT_PLATFORM_BUCKETS, PLATFORM_SERIES
from .ranking import arg_best, top_k


def operator_day_totals(pr: DataFrame, kill_points: int = KILL_POINTS,
                        win_points: int = WIN_POINTS) -> DataFrame:
    """Per (date, operator): every sum that the division and operator reports need.

    The division is a function of the operator, so both reports come from this one
    aggregate.  ``role`` is the smallest role seen: the daily operator report has one
    line per operator, whatever roles it played.
    """
    return pr.groupBy("date", "operator").agg(
        F.min("role").alias("role"),
        F.sum("kills").cast("long").alias("kills"),
        F.sum("is_dead").cast("long").alias("deaths"),
        F.sum("has_won").cast("long").alias("wins"),
        F.count(F.lit(1)).alias("rounds"),
        F.sum(points("kills", "has_won", kill_points, win_points)).cast("long").alias("points"),
        F.sum("clearance_level").cast("long").alias("sum_level"),
        F.sum("round_duration").cast("long").alias("total_time"))


# --- B1: division scoreboard ------------------------------------------------------------

def division_scoreboard(pr: DataFrame, kill_points: int = KILL_POINTS,
                        win_points: int = WIN_POINTS) -> DataFrame:
    """Per (date, division): points, average level and time played.

    Time is summed per player row (not per round), as the report defines it.
    """
    return division_scoreboard_of(operator_day_totals(pr, kill_points, win_points))


def division_scoreboard_of(per_operator: DataFrame) -> DataFrame:
    """``division_scoreboard`` from ``operator_day_totals`` rows."""
    agg = per_operator.groupBy("date", division("operator").alias("division")).agg(
        F.sum("points").alias("points"), F.sum("sum_level").alias("_sum_level"),
        F.sum("rounds").alias("_n"), F.sum("total_time").alias("total_time"))
    return agg.select(
        "date", "division", "points",
        half_even_2("_sum_level", "_n").alias("avg_level"),
        "total_time", hms("total_time").alias("time_hms"))


def division_topk(pr: DataFrame, k: int = 5, **kw) -> DataFrame:
    """Top-k divisions of each day by points (ties: division name)."""
    return division_topk_of(division_scoreboard(pr, **kw), k)


def division_topk_of(board: DataFrame, k: int = 5) -> DataFrame:
    """``division_topk`` from ``division_scoreboard`` rows."""
    ranked = top_k(board, ["date"], [F.col("points").desc(), F.col("division").asc()], k)
    return ranked.select("date", "division", "points", "avg_level", "time_hms", "rank")


# --- B2: operators ----------------------------------------------------------------------

def operator_ratios(pr: DataFrame, single_row: str = "compute") -> DataFrame:
    """Per (date, operator): kills, deaths, wins, rounds and the two ratios.

    ``role`` is the smallest role seen for the operator (deterministic).
    ``single_row="zero"`` reproduces the original job, where an operator with a
    single row kept both ratios at 0 because its reducer never ran.
    """
    return operator_ratios_of(operator_day_totals(pr), single_row)


def operator_ratios_of(per_operator: DataFrame, single_row: str = "compute") -> DataFrame:
    """``operator_ratios`` from ``operator_day_totals`` rows."""
    if single_row not in ("compute", "zero"):
        raise ValueError("single_row must be 'compute' or 'zero'")
    kr, rr = ratio2("kills", "deaths"), ratio2("wins", "rounds")
    if single_row == "zero":
        kr = F.when(F.col("rounds") == 1, F.lit(0.0)).otherwise(kr)
        rr = F.when(F.col("rounds") == 1, F.lit(0.0)).otherwise(rr)
    return per_operator.select("date", "operator", "role", "kills", "deaths", "wins", "rounds",
                               kr.alias("kill_ratio"), rr.alias("round_ratio"))


def operator_topk(pr: DataFrame, k: int = 3, kill_divisor: int = 3,
                  single_row: str = "compute") -> DataFrame:
    """Top-k operators of each day by ``kill_ratio/3 + round_ratio`` (ties: name)."""
    return operator_topk_of(operator_ratios(pr, single_row=single_row), k, kill_divisor)


def operator_topk_of(ratios: DataFrame, k: int = 3, kill_divisor: int = 3) -> DataFrame:
    """``operator_topk`` from ``operator_ratios`` rows."""
    ratios = ratios.withColumn(
        "_score", score("kill_ratio", "round_ratio", kill_divisor))
    ranked = top_k(ratios, ["date"], [F.col("_score").desc(), F.col("operator").asc()], k)
    return ranked.select("date", "operator", "role", "kill_ratio", "round_ratio", "rounds", "rank")


# --- B3: platforms ----------------------------------------------------------------------

def round_dedupe(pr: DataFrame) -> DataFrame:
    """One row per (date, platform, map, match, round): every player of a round
    reports the same duration; keep the smallest so the result is deterministic."""
    return pr.groupBy("date", "platform", "map", "match_id", "round_nb").agg(
        F.min("round_duration").alias("round_duration"))


def platform_map_time(pr: DataFrame) -> DataFrame:
    """Rounds and play time per (date, platform, map), each round counted once."""
    return round_dedupe(pr).groupBy("date", "platform", "map").agg(
        F.count(F.lit(1)).alias("rounds"),
        F.sum("round_duration").cast("long").alias("total_time"))


def platform_summary(pr: DataFrame) -> DataFrame:
    """Per (date, platform): rounds, total time, the map with the most time
    (ties: map name) and its time, ``HH:MM:SS``, and the platform's rank in
    the day by total time."""
    return platform_summary_of(platform_map_time(pr))


def platform_summary_of(per_map: DataFrame) -> DataFrame:
    """``platform_summary`` from ``platform_map_time`` rows."""
    best = arg_best(
        per_map, ["date", "platform"], [-F.col("total_time"), F.col("map")], ["map", "total_time"],
        aggs=[F.sum("rounds").cast("long").alias("_rounds"),
              F.sum("total_time").cast("long").alias("_total")])
    out = best.select(
        "date", "platform", F.col("map").alias("top_map"), F.col("_rounds").alias("rounds"),
        F.col("_total").alias("total_time"), F.col("total_time").alias("time_on_map"),
        hms("_total").alias("time_hms"))
    # A day has one row per platform here, so the window partitions are small.
    w = Window.partitionBy("date").orderBy(F.col("total_time").desc(), F.col("platform").asc())
    return out.withColumn("rank", F.row_number().over(w))


def daily_platform_series(pr: DataFrame, buckets=DEFAULT_PLATFORM_BUCKETS,
                          names=PLATFORM_SERIES) -> DataFrame:
    """One point per day: rounds per platform series (NULL when not played),
    labelled ``dd-MM-yyyy``.  Built on the deduplicated rounds."""
    return platform_series_of(platform_map_time(pr), buckets, names)


def platform_series_of(per_map: DataFrame, buckets=DEFAULT_PLATFORM_BUCKETS,
                       names=PLATFORM_SERIES) -> DataFrame:
    """``daily_platform_series`` from ``platform_map_time`` rows."""
    series = (per_map
              .withColumn("_series", platform_bucket("platform", buckets, names))
              .groupBy("date").pivot("_series", list(names)).agg(F.sum("rounds").cast("long")))
    return series.select("date", day_label("date").alias("day"), *names)


def daily_reports(pr: DataFrame, date: str | None = None, **kw) -> dict[str, DataFrame]:
    """The three daily reports (plus the series), for one day or for every day."""
    return daily_report_set(pr, date, **kw)[0]


def daily_report_set(pr: DataFrame, date: str | None = None,
                     **kw) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """(reports, shared inputs).  Divisions and operators share the per-(day,
    operator) totals, the platform summary and the series the per-(day, platform,
    map) table; with the shared inputs persisted the fact is read twice."""
    if date is not None:
        pr = pr.where(F.col("date") == F.lit(date))
    per_operator, per_map = operator_day_totals(pr), platform_map_time(pr)
    ratios = operator_ratios_of(per_operator, kw.get("single_row", "compute"))
    reports = {
        "divisions": division_topk_of(division_scoreboard_of(per_operator)),
        "operators": operator_topk_of(ratios),
        "platforms": platform_summary_of(per_map),
        "series": platform_series_of(per_map),
    }
    return reports, [per_operator, per_map]
