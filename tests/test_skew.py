"""Hot keys: one day with ~40 % of the rows and one match with a third of them.

Results are checked against a pandas brute force on the same rows.
"""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roundlens.operators import daily
from roundlens.sources.replay import match_sequence

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    hot_day = i < int(N * 0.4)
    hot_match = i < N // 3
    df = spark.range(N).select(
        F.when(hot_day, F.lit("20170210"))
         .otherwise(F.format_string("2017%02d%02d", (i % 12) + 1, (i % 28) + 1)).alias("date"),
        F.when(hot_match, F.lit("HOT")).otherwise((i % 997).cast("string")).alias("match_id"),
        F.lit("BOMB").alias("game_mode"),
        F.concat(F.lit("MAP"), (i % 5).cast("string")).alias("map"),
        ((i % 9) + 1).cast("int").alias("round_nb"),
        F.lit("Attacker").alias("win_role"),
        (F.lit(60) + (i % 13) * 10).cast("int").alias("round_duration"),
        ((i % 300) + 1).cast("int").alias("clearance_level"),
        F.when(i % 2 == 0, "Attacker").otherwise("Defender").alias("role"),
        (i % 2).cast("int").alias("has_won"),
        F.concat(F.lit("D"), (i % 7).cast("string"), F.lit("-OP"), (i % 11).cast("string"))
         .alias("operator"),
        (i % 6).cast("int").alias("kills"),
        ((i % 3) == 0).cast("int").alias("is_dead"),
        F.lit("Rifle").alias("primary_weapon_type"),
        F.when(i % 10 < 7, "PC").otherwise("PS4").alias("platform"),
    )
    return df, df.toPandas()


def test_division_topk_under_skew(skewed):
    df, pdf = skewed
    p = pdf.assign(division=pdf.operator.str.split("-").str[0],
                   pts=pdf.kills * 5 + pdf.has_won * 15)
    g = p.groupby(["date", "division"]).agg(points=("pts", "sum")).reset_index()
    g = g.sort_values(["date", "points", "division"], ascending=[True, False, True])
    g["rank"] = g.groupby("date").cumcount() + 1
    want = sorted(map(tuple, g[g["rank"] <= 5][["date", "division", "points", "rank"]].values.tolist()))
    got = sorted(tuple(r) for r in daily.division_topk(df).select(
        "date", "division", "points", "rank").collect())
    assert got == want


def test_platform_summary_under_skew(skewed):
    df, pdf = skewed
    r = pdf.groupby(["date", "platform", "map", "match_id", "round_nb"]).round_duration.min() \
        .reset_index()
    pm = r.groupby(["date", "platform", "map"]).agg(rounds=("round_duration", "size"),
                                                    t=("round_duration", "sum")).reset_index()
    want = {}
    for (d, pl), grp in pm.groupby(["date", "platform"]):
        top = grp.sort_values(["t", "map"], ascending=[False, True]).iloc[0]
        want[(d, pl)] = (top["map"], int(grp.rounds.sum()), int(grp.t.sum()))
    got = {(r["date"], r["platform"]): (r["top_map"], r["rounds"], r["total_time"])
           for r in daily.platform_summary(df).collect()}
    assert got == want


def test_match_sequence_under_skew(spark, skewed):
    df, pdf = skewed
    keys = pdf[["date", "match_id"]].drop_duplicates().sort_values(["date", "match_id"])
    keys["seq"] = range(1, len(keys) + 1)
    keys["match_in_day"] = keys.groupby("date").cumcount() + 1
    want = sorted(map(tuple, keys[["date", "match_id", "seq", "match_in_day"]].values.tolist()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # the hot day spans many ranges
    try:
        got = sorted(tuple(r) for r in match_sequence(df).select(
            "date", "match_id", "seq", "match_in_day").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == [tuple(x) for x in want]
