"""Replay steps that need several files, and the decoder's plan."""

import pytest
from pyspark.sql import functions as F

from conftest import rows

from roundlens import api
from roundlens.schema import PLAYER_ROUNDS_SCHEMA
from roundlens.session import scratch_path
from roundlens.sources.replay import write_match_steps
from roundlens.sources.wire import decode_wire, encode_wire
from roundlens.streaming import replay_run
from roundlens.streaming.replay_run import replay_by_match


@pytest.fixture(scope="module")
def many(spark):
    base = "1 round_nb, 'A' win_role, 5 round_duration, 5 clearance_level, 'A' role, 1 has_won, 'X-O' operator, 2 kills, 1 is_dead"
    return spark.range(1200).selectExpr(
        "IF(id < 12, NULL, '20170210') date", "IF(id < 6, NULL, lpad(id div 2, 4, '0')) match_id", "'g' game_mode", "'m' map",
        *base.split(", "), "'W' primary_weapon_type", "'P' platform").select(*PLAYER_ROUNDS_SCHEMA.fieldNames())


def test_a_step_of_many_matches_is_several_files(spark, many):
    root, ended = scratch_path(spark, "step-files"), []

    def after(step):
        names = [f.rsplit("/", 1)[1] for f in spark.read.text(f"{root}/src").inputFiles()]
        ended.append((step, sorted({int(n[5:17]) for n in names})))
    n = write_match_steps(many, f"{root}/src", 300, files_per_step=5, after_step=after)
    assert n > 4 and ended == [(0, [0]), (1, [0, 1])]
    got = api.from_wire(spark.read.text(f"{root}/src").withColumn("file", F.input_file_name()), keep=("file",))
    per = got.where("date is not null").groupBy("match_id").agg(F.countDistinct("file").alias("files"), F.count("*").alias("n"))
    assert {(r["files"], r["n"]) for r in per.collect()} == {(1, 2)} and per.count() == 594
    assert got.count() == 1200


def test_a_step_is_one_batch(spark, many, monkeypatch):
    monkeypatch.setattr(replay_run, "FILE_MATCHES", 40)

    def start(msgs, out, ckpt):
        def body(batch, batch_id):
            batch.withColumn("step", F.lit(batch_id)).write.mode("append").parquet(out)
        return msgs.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).foreachBatch(body).start()
    out = spark.read.parquet(replay_by_match(spark, many, 3, start))
    got = decode_wire(out, keep=("step",)).where("date is not null").groupBy("step").agg(
        F.min("match_id"), F.max("match_id"), F.countDistinct("match_id"), F.count("*"))
    assert rows(got) == [(0, "0006", "0203", 198, 396), (1, "0204", "0401", 198, 396), (2, "0402", "0599", 198, 396)]
    assert out.count() == 1200


def test_large_steps_are_on_disk_one_at_a_time_and_compressed(spark, many, tmp_path):
    staged, root = [], f"{tmp_path}/m"

    def after(step):
        staged.append([p.name for p in tmp_path.glob("m-stage-*/step=*/part-*")])
    write_match_steps(many, root, 100, files_per_step=3, after_step=after, compression="gzip")
    assert staged == [[]] * 6  # the messages of later steps are not there yet
    assert all(p.name.endswith(".gz") for p in (tmp_path / "m").glob("step-*"))
    assert api.from_wire(spark.read.text(root)).count() == 1200 and not list(tmp_path.glob("m-stage-*"))


def test_large_steps_cut_where_the_numbers_do(spark, many):
    """Null and empty match ids, prefixes of each other, and several days: the same steps as by number."""
    ids = [None, "", "1", "12", "123", "1234", "12345", "12346", "2", "é"]
    pr = (many.where("date is not null").limit(1).drop("date", "match_id")
          .join(spark.createDataFrame([(d, m) for d in ("20170210", "20170211", None) for m in ids], "date string, match_id string"))
          .select(*PLAYER_ROUNDS_SCHEMA.fieldNames()))
    steps = {}
    for files in (1, 2):
        root = scratch_path(spark, "step-cuts")
        write_match_steps(pr, root, 3, files_per_step=files)
        value = spark.read.text(root).select("value", F.substring_index(F.input_file_name(), "/step-", -1).substr(1, 12).alias("step"))
        steps[files] = sorted((r["step"], r["value"]) for r in value.collect())
    assert steps[1] == steps[2] and len(steps[1]) == 30


def test_decoder_is_compiled_in_small_methods(spark, many, tmp_path):
    encode_wire(many).write.text(f"{tmp_path}/m")
    plan = decode_wire(spark.read.text(f"{tmp_path}/m"))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    line = next(x for x in plan.splitlines() if "try_cast" in x)
    assert "Project [struct(" in line and "*(" not in line
