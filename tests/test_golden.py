"""Hand-checked results of every report on the golden micro-fixture."""

import pytest
from conftest import rows

from roundlens.functions import operator_name
from roundlens.operators import daily, live
from roundlens.plans import reports


def test_division_topk(golden):
    got = rows(daily.division_topk(golden),
               ["date", "division", "points", "avg_level", "time_hms", "rank"])
    assert got == sorted([
        ("20170210", "SWAT", 70, 25.33, "100:04:40", 1),
        ("20170210", "SAS", 35, 13.67, "00:08:20", 2),
        ("20170210", "GIGN", 20, 30.0, "00:05:30", 3),
        ("20170211", "SAS", 40, 8.5, "00:02:02", 1),
    ])


def test_operator_topk(golden):
    got = rows(daily.operator_topk(golden),
               ["date", "operator", "role", "kill_ratio", "round_ratio", "rounds", "rank"])
    assert got == sorted([
        ("20170210", "SWAT-CASTLE", "Defender", 4.0, 1.0, 2, 1),
        ("20170210", "SAS-SLEDGE", "Attacker", 3.0, 0.5, 2, 2),
        ("20170210", "SWAT-RESERVE", "Attacker", 1.0, 1.0, 1, 3),
        ("20170211", "SAS-SMOKE", "Defender", 4.0, 1.0, 1, 1),
        ("20170211", "SAS-SLEDGE", "Attacker", 1.0, 0.0, 1, 2),
    ])


def test_operator_topk_single_row_zero(golden):
    got = rows(daily.operator_topk(golden, single_row="zero"),
               ["date", "operator", "kill_ratio", "round_ratio", "rank"])
    assert got == sorted([
        ("20170210", "SWAT-CASTLE", 4.0, 1.0, 1),
        ("20170210", "SAS-SLEDGE", 3.0, 0.5, 2),
        ("20170210", "GIGN-RESERVE", 1.0, 0.5, 3),
        ("20170211", "SAS-SLEDGE", 0.0, 0.0, 1),
        ("20170211", "SAS-SMOKE", 0.0, 0.0, 2),
    ])


def test_platform_summary(golden):
    got = rows(daily.platform_summary(golden),
               ["date", "platform", "top_map", "rounds", "total_time", "time_on_map",
                "time_hms", "rank"])
    assert got == sorted([
        ("20170210", "PS4", "HOUSE", 1, 360000, 360000, "100:00:00", 1),
        ("20170210", "PC", "CLUB", 4, 630, 330, "00:10:30", 2),
        ("20170211", "XONE", "BANK", 1, 61, 61, "00:01:01", 1),
    ])


def test_round_dedupe_counts_each_round_once(golden):
    assert daily.round_dedupe(golden).count() == 6


def test_daily_platform_series(golden):
    got = rows(daily.daily_platform_series(golden), ["day", "pc", "ps4", "xbox"])
    assert got == sorted([("10-02-2017", 4, 1, None), ("11-02-2017", None, None, 1)],
                         key=lambda t: tuple(str(x) for x in t))


def test_operator_name_ratios(golden):
    got = rows(live.operator_name_ratios(golden),
               ["operator_name", "kills", "deaths", "wins", "rounds", "kill_ratio",
                "round_ratio"])
    assert got == sorted([
        ("CASTLE", 4, 1, 2, 2, 4.0, 1.0),
        ("RESERVE", 2, 1, 2, 3, 2.0, 0.67),
        ("SLEDGE", 4, 2, 1, 3, 2.0, 0.33),
        ("SMOKE", 5, 1, 1, 2, 5.0, 0.5),
    ])


def test_mode_role_best_map(golden):
    got = rows(live.mode_role_best_map(golden),
               ["game_mode", "role", "total_wins", "best_map", "wins_on_map"])
    assert got == sorted([
        ("BOMB", "Attacker", 2, "BANK", 1), ("BOMB", "Defender", 2, "BANK", 2),
        ("HOSTAGE", "Attacker", 1, "CLUB", 1), ("HOSTAGE", "Defender", 1, "CLUB", 1),
    ])


def test_mode_role_peak_match(golden):
    got = rows(live.mode_role_peak_match(golden), ["game_mode", "role", "peak_map", "peak_wins"])
    assert got == sorted([
        ("BOMB", "Attacker", "BANK", 1), ("BOMB", "Defender", "BANK", 1),
        ("HOSTAGE", "Attacker", "CLUB", 1), ("HOSTAGE", "Defender", "CLUB", 1),
    ])


def test_map_best_operators(golden):
    cols = ["map", "role", "operator", "kill_ratio", "round_ratio"]
    expected = sorted([
        ("BANK", "Attacker", "SAS-SLEDGE", 2.0, 0.33),
        ("BANK", "Defender", "SAS-SMOKE", 5.0, 0.5),
        ("CLUB", "Attacker", "GIGN-RESERVE", 1.0, 0.5),
        ("CLUB", "Defender", "SWAT-CASTLE", 2.0, 1.0),
        ("HOUSE", "Attacker", "SWAT-RESERVE", 1.0, 1.0),
    ])
    assert rows(live.map_best_operators(golden), cols) == expected
    assert rows(live.map_best_operators(golden, require_both_roles=True), cols) == \
        [r for r in expected if r[0] != "HOUSE"]


def test_two_role_operator_is_ranked_per_role(spark, golden):
    # SAS-SLEDGE also defends on BANK: two lines per map by default, one as written.
    extra = golden.where("operator = 'SAS-SLEDGE' and date = '20170211'").selectExpr(
        *[f"'Defender' as {c}" if c == "role" else "9 as kills" if c == "kills" else c for c in golden.columns])
    both = golden.unionByName(extra)
    cols = ["map", "operator", "role", "kills", "rounds"]
    sledge = "operator = 'SAS-SLEDGE'"
    assert rows(live.map_operator_stats(both).where(sledge), cols) == [
        ("BANK", "SAS-SLEDGE", "Attacker", 4, 3), ("BANK", "SAS-SLEDGE", "Defender", 9, 1)]
    assert rows(live.map_operator_stats(both, merge_roles=True).where(sledge), cols) == [
        ("BANK", "SAS-SLEDGE", "Attacker", 13, 4)]
    best = live.map_best_operators(both).where("map = 'BANK' and role = 'Defender'")
    assert rows(best, ["operator"]) == [("SAS-SLEDGE",)]


def test_latest_closed_date_leaves_the_open_day_out(golden):
    assert rows(reports.latest_closed_date(golden, newest_open=True)) == [("20170210",)]
    assert rows(reports.latest_closed_date(golden.where("date = '20170210'"), newest_open=True)) == [(None,)]


def test_strict_operator_name(spark):
    df = spark.createDataFrame([("SAS-SLEDGE",), (None,)], "operator string")
    assert [r[0] for r in df.select(operator_name(strict=True)).collect()] == ["SLEDGE", None]
    with pytest.raises(Exception, match="without a dash"):
        df.selectExpr("'SLEDGE' as operator").select(operator_name(strict=True)).collect()
