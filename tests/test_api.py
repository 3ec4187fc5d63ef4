"""Public API: daily publish, replay writer, CLI daily job."""

import json
import os

from conftest import rows

from roundlens import api
from roundlens.__main__ import main as cli
from roundlens.operators import daily
from roundlens.session import scratch_path


def test_publish_daily_and_read_results(spark, golden):
    out = scratch_path(spark, "publish")
    api.publish_daily(golden, out)
    res = api.read_results(spark, out)
    assert rows(res["divisions"]) == rows(daily.division_topk(golden))
    local = out.replace("file:", "", 1)
    day_dirs = sorted(d for d in os.listdir(f"{local}/text") if d.startswith("date="))
    assert day_dirs == ["date=20170210", "date=20170211"]
    day = f"{local}/text/date=20170211"
    text = open([os.path.join(day, f) for f in os.listdir(day) if f.endswith(".txt")][0]).read()
    assert text.splitlines()[:2] == [
        "20170211",
        "Divisione: SAS,  Punti: 40,  Livello medio giocatori: 8.5,  Tempo totale giocato: 00:02:02"]


def test_write_replay_then_decode(spark, golden):
    path = scratch_path(spark, "replay-api")
    assert api.write_replay(golden, path, steps=2) >= 1
    back = api.from_wire(spark.read.text(path))
    assert rows(back.drop("_error")) == rows(golden)


def test_write_replay_orders_shuffled_rows(spark, golden):
    path = scratch_path(spark, "replay-order")
    api.write_replay(golden.orderBy("operator", "kills"), path, steps=1)
    local = path.replace("file:", "", 1)
    lines = [line for f in sorted(os.listdir(local)) if f.startswith("part-")
             for line in open(os.path.join(local, f)).read().splitlines()]
    keys = [tuple(json.loads(line)[0]) for line in lines]
    assert len(keys) == golden.count() and keys == sorted(keys)


def test_cli_daily_for_one_day(spark, golden):
    store = scratch_path(spark, "cli-store")
    out = scratch_path(spark, "cli-out")
    api.write_store(golden, store)
    assert cli(["daily", "--store", store, "--out", out, "--date", "20170211"]) == 0
    got = rows(api.read_results(spark, out)["divisions"], ["date", "division", "points"])
    assert got == [("20170211", "SAS", 40)]


def test_cli_replay_csv_to_messages(spark, golden):
    from roundlens.sources import csv as csv_source
    raw = scratch_path(spark, "cli-csv")
    msgs = scratch_path(spark, "cli-msgs")
    csv_source.write_raw_csv(golden, raw)
    assert cli(["replay", "--csv", raw, "--messages", msgs, "--steps", "2"]) == 0
    back = api.from_wire(spark.read.text(msgs))
    assert back.where("_error IS NOT NULL").count() == 0
    assert rows(back.drop("_error")) == rows(golden)
