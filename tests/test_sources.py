"""Wire codec, raw CSV, history store and replay order."""

import json

from conftest import golden_rows, rows

from roundlens import api
from roundlens.schema import PLAYER_ROUNDS_COLUMNS, PLAYER_ROUNDS_SCHEMA, RAW_COLUMNS
from roundlens.session import scratch_path
from roundlens.sources import csv as csv_source
from roundlens.sources import store, wire
from roundlens.sources.replay import match_sequence, sequence_numbers


def test_python_style_matches_json_dumps(golden):
    got = [r["value"] for r in wire.encode_wire(golden).collect()]
    want = []
    for r in golden_rows():
        d = dict(zip(PLAYER_ROUNDS_COLUMNS, r))
        key = [d["date"], d["match_id"]]
        val = [d["game_mode"], d["map"], d["round_nb"], d["win_role"], str(d["round_duration"]),
               str(d["clearance_level"]), d["role"], d["has_won"], d["operator"], d["kills"],
               d["is_dead"], d["primary_weapon_type"], d["platform"]]
        want.append(json.dumps([key, val]))
    assert sorted(got) == sorted(want)


def test_round_trip_with_awkward_values(spark):
    awkward = [("20170210", "m 1", "PvP HOSTAGE", 'CLUB, "old"', 1, "Attacker", 5, 7, "Defender",
                0, "A-B", 2, 1, "it's", "P\\C")]
    df = spark.createDataFrame(awkward, PLAYER_ROUNDS_SCHEMA)
    for style in ("python", "compact"):
        back = wire.decode_wire(wire.encode_wire(df, style=style))
        assert rows(back.drop("_error")) == rows(df)
        assert back.where("_error IS NOT NULL").count() == 0


def test_legacy_decoder_breaks_on_spaces(spark, golden):
    spaced = spark.createDataFrame(
        [("20170210", "1", "PvP HOSTAGE", "CLUB", 1, "Attacker", 5, 7, "Defender", 0, "A-B", 2, 1,
          "SMG", "PC")], PLAYER_ROUNDS_SCHEMA)
    bad = wire.decode_wire(wire.encode_wire(spaced), "legacy")
    assert [r["_error"] for r in bad.collect()] == ["arity"]
    good = wire.decode_wire(wire.encode_wire(golden), "legacy")
    assert rows(good.drop("_error")) == rows(golden)


def test_quarantine_of_bad_messages(spark):
    msgs = spark.createDataFrame(
        [("not json",), ('[["d","m"],["too","few"]]',),
         ('[["d","m"],["g","m",1,"A","x","5","R",1,"O",2,1,"W","P"]]',),
         ('[["d","m"],["g","m","1","A","5","5","R","1","O","2","1","W","P"]]',),
         ('[["20170230","m"],["g","m","1","A","5","5","R","1","O","2","1","W","P"]]',),
         ('[[null,"m"],["g","m","1","A","5","5","R","1","O","2","1","W","P"]]',),
         ('[["20170210","m"],["g","m","1","A","5","5","R",null,"O","2","1","W","P"]]',),
         ('[["20170210",null],["g","m","1","A","5","5","R","1","O","2","1","W","P"]]',),
         ('[["20170210","m"],["g","m","1","A","5","5","R","1","O","2","1","W","P"]]',)], "value string")
    got = [r["_error"] for r in wire.decode_wire(msgs).collect()]
    assert got == ["not_json", "arity", "bad_int", "bad_date", "bad_date", "bad_date",
                   "null_field", "null_field", None]
    good, bad = csv_source.split_valid(wire.decode_wire(msgs))
    assert good.count() + bad.count() == msgs.count()


def test_each_message_is_parsed_once(golden):
    for mode, parser in (("json", "from_json"), ("legacy", "translate(")):
        for df in csv_source.split_valid(wire.decode_wire(wire.encode_wire(golden), mode)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.lower().count(parser) == 1, (mode, plan)


def test_replay_keeps_rows_without_a_day(spark, golden):
    none = spark.createDataFrame([(None, *golden_rows()[0][1:])] * 3, PLAYER_ROUNDS_SCHEMA)
    for steps in (1, 2, 3, 8):
        path = scratch_path(spark, "replay-test")
        api.write_replay(golden.union(none), path, steps)
        back = spark.read.text(path)
        assert back.count() == 13
        good, bad = csv_source.split_valid(wire.decode_wire(back))
        assert rows(good) == rows(golden)
        assert [r["_error"] for r in bad.collect()] == ["bad_date"] * 3


def test_raw_csv_header_repeat_and_bad_int(spark, golden):
    path = scratch_path(spark, "csv-test")
    csv_source.write_raw_csv(golden, path)
    extra = scratch_path(spark, "csv-extra")
    header = ",".join(RAW_COLUMNS)
    bad_row = ["x"] * 31
    bad_row[4] = "99"
    bad_row[16] = "many"  # kills
    spark.sparkContext.parallelize([header, ",".join(bad_row)], 1).saveAsTextFile(extra)
    raw = csv_source.read_raw_csv(spark, path).unionByName(
        csv_source.read_raw_csv(spark, extra, header=False))
    good, bad = csv_source.split_valid(csv_source.raw_to_player_rounds(raw))
    assert rows(good) == rows(golden)
    assert [r["_error"] for r in bad.collect()] == ["bad_int"]


def test_store_day_scan_prunes_partitions(spark, golden):
    path = scratch_path(spark, "store-test")
    store.write_store(golden, path)
    day = store.scan_day(spark, path, "20170211")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "20170211" in plan
    assert day.count() == 2
    assert rows(store.read_store(spark, path)) == rows(golden)


def test_match_sequence_brute_force(golden):
    got = rows(match_sequence(golden), ["date", "match_id", "seq", "match_in_day", "pause_before"])
    assert got == [("20170210", "1", 1, 1, 0), ("20170210", "2", 2, 2, 1),
                   ("20170210", "3", 3, 3, 1), ("20170211", "4", 4, 1, 0)]


def test_sequence_numbers_across_many_partitions(spark):
    keys = spark.range(0, 5000).selectExpr("cast(id * 7919 % 5000 as long) as k")
    out = sequence_numbers(keys, ["k"], partitions=13)
    got = [(r["k"], r["seq"]) for r in out.collect()]
    assert sorted(got) == [(k, k + 1) for k in range(5000)]


def test_declared_table_schemas_equal_inferred(spark):
    from pyspark.sql.types import _parse_datatype_string

    from roundlens.sources.tables import TABLE_SCHEMAS
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        for name, ddl in TABLE_SCHEMAS.items():
            inferred = spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet").schema
            declared = _parse_datatype_string(ddl)
            assert [(f.name, f.dataType) for f in inferred] == \
                [(f.name, f.dataType) for f in declared], (sf, name)


def test_strict_decode_fails_on_bad_message(spark):
    import pytest
    msgs = spark.createDataFrame([("not json",)], "value string")
    with pytest.raises(Exception, match="undecodable message: not_json"):
        wire.decode_wire(msgs, strict=True).drop("_error").collect()
    good = wire.encode_wire(spark.createDataFrame(
        [("20170210", "1", "B", "M", 1, "A", 5, 7, "D", 0, "A-B", 2, 1, "S", "P")],
        PLAYER_ROUNDS_SCHEMA))
    assert wire.decode_wire(good, strict=True).drop("_error").count() == 1


def test_compact_days_keeps_rows_and_merges_files(spark, golden):
    import os
    path = scratch_path(spark, "compact")
    for _ in range(3):  # three appends: several files per day
        store.write_store(golden.repartition(3), path)
    local = path.replace("file:", "", 1)

    def files(day):
        return [f for f in os.listdir(f"{local}/date={day}") if f.endswith(".parquet")]
    before = len(files("20170210"))
    store.compact_days(spark, path, ["20170210"])
    assert len(files("20170210")) < before
    assert rows(store.read_store(spark, path)) == sorted(rows(golden) * 3)
