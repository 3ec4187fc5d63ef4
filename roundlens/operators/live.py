"""Live reports as batch transforms over running totals.

The same functions serve batch (over the whole store) and streaming (inside
``foreachBatch`` over the state a streaming aggregation emits), so a report
drained from a stream equals its batch twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import operator_name, ratio2, score
from .ranking import arg_best, top_k

# --- T1: running kill / round ratio per operator name -----------------------------------

def operator_totals() -> list:
    """Kills, deaths, wins and rounds of a group of player rows."""
    return [
        F.sum("kills").cast("long").alias("kills"),
        F.sum("is_dead").cast("long").alias("deaths"),
        F.sum("has_won").cast("long").alias("wins"),
        F.count(F.lit(1)).alias("rounds"),
    ]


def operator_name_totals(pr: DataFrame) -> DataFrame:
    """Totals per operator *name* (division stripped): same-named operators of
    different divisions are merged, as the live chart does."""
    return pr.groupBy(operator_name("operator").alias("operator_name")).agg(*operator_totals())


def with_ratios(totals: DataFrame) -> DataFrame:
    return totals.withColumns({"kill_ratio": ratio2("kills", "deaths"),
                               "round_ratio": ratio2("wins", "rounds")})


def operator_name_ratios(pr: DataFrame) -> DataFrame:
    return with_ratios(operator_name_totals(pr)).select(
        "operator_name", "kills", "deaths", "wins", "rounds", "kill_ratio", "round_ratio")


# --- T2: wins per game mode and role, best map ------------------------------------------

def mode_role_map_wins(pr: DataFrame) -> DataFrame:
    """Round wins (per player row) per (game mode, role, map)."""
    return pr.groupBy("game_mode", "role", "map").agg(F.sum("has_won").cast("long").alias("wins"))


def best_map(map_wins: DataFrame) -> DataFrame:
    """(game_mode, role): total wins and the map with most wins (ties: name)."""
    best = arg_best(map_wins, ["game_mode", "role"], [-F.col("wins"), F.col("map")],
                    ["map", "wins"], aggs=[F.sum("wins").cast("long").alias("total_wins")])
    return best.select("game_mode", "role", "total_wins",
                       F.col("map").alias("best_map"), F.col("wins").alias("wins_on_map"))


def mode_role_best_map(pr: DataFrame) -> DataFrame:
    return best_map(mode_role_map_wins(pr))


def mode_role_peak_match(pr: DataFrame) -> DataFrame:
    """The dashboard's as-written "wins on map": the largest win count any single
    match (one replay step) produced for the (mode, role), and its map."""
    per_match = pr.groupBy("game_mode", "role", "map", "match_id").agg(
        F.sum("has_won").cast("long").alias("wins"))
    best = arg_best(per_match, ["game_mode", "role"], [-F.col("wins"), F.col("map")],
                    ["map", "wins"])
    return best.select("game_mode", "role", F.col("map").alias("peak_map"),
                       F.col("wins").alias("peak_wins"))


# --- T3: best attacker and defender per map ---------------------------------------------

def map_operator_totals(pr: DataFrame, merge_roles: bool = False) -> DataFrame:
    """Totals per (map, operator, role).

    ``merge_roles`` keeps the as-written key (map, operator): an operator seen in
    both roles comes out once, under the smaller role, with the rounds of both.
    """
    if merge_roles:
        return pr.groupBy("map", "operator").agg(F.min("role").alias("role"), *operator_totals())
    return pr.groupBy("map", "operator", "role").agg(*operator_totals())


def map_operator_stats(pr: DataFrame, merge_roles: bool = False) -> DataFrame:
    return with_ratios(map_operator_totals(pr, merge_roles)).select(
        "map", "operator", "role", "kills", "deaths", "wins", "rounds", "kill_ratio",
        "round_ratio")


def best_per_map(stats: DataFrame, kill_divisor: int = 2,
                 require_both_roles: bool = False) -> DataFrame:
    """Per (map, role): the operator with the best ``kill_ratio/2 + round_ratio``
    (ties: operator name).  ``require_both_roles`` drops maps that lack an
    attacker or a defender, like the live job's guard."""
    scored = stats.withColumn("_score", score("kill_ratio", "round_ratio", kill_divisor))
    best = top_k(scored, ["map", "role"], [F.col("_score").desc(), F.col("operator").asc()], 1)
    out = best.select("map", "role", "operator", "kill_ratio", "round_ratio")
    if require_both_roles:
        # At most one row per (map, role) here, so each window holds <= 2 rows.
        roles = F.count(F.lit(1)).over(Window.partitionBy("map"))
        out = out.withColumn("_roles", roles).where(F.col("_roles") == 2).drop("_roles")
    return out


def map_best_operators(pr: DataFrame, require_both_roles: bool = False,
                       merge_roles: bool = False) -> DataFrame:
    return best_per_map(with_ratios(map_operator_totals(pr, merge_roles)),
                        require_both_roles=require_both_roles)


def map_best_by_day(pr: DataFrame) -> DataFrame:
    """Best attacker / defender per map for each day's rounds: the log the live
    map table is fed from, one entry per (day, map, role)."""
    totals = pr.groupBy("date", "map", "operator", "role").agg(*operator_totals())
    scored = with_ratios(totals).withColumn("_score", score("kill_ratio", "round_ratio", 2))
    best = top_k(scored, ["date", "map", "role"],
                 [F.col("_score").desc(), F.col("operator").asc()], 1)
    return best.select("date", "map", "role", "operator", "kill_ratio", "round_ratio")
