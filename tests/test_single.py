"""The one live query, the store it shares with batch jobs, match-by-match replay and supervision."""

import threading

import pytest
from pyspark.sql import functions as F

from conftest import rows

from roundlens import api
from roundlens.operators import daily, live
from roundlens.schema import PLAYER_ROUNDS_SCHEMA
from roundlens.session import scratch_path, versions
from roundlens.sources.history import HistoryStore
from roundlens.sources.replay import match_sequence, write_match_steps
from roundlens.sources.wire import encode_wire
from roundlens.streaming import single
from roundlens.streaming.live import file_messages, start_live
from roundlens.streaming.replay_run import AVAILABLE_NOW, replay_by_match, replay_single
from roundlens.streaming.supervise import ProgressLog, supervise

AHEAD = '[["20991231","m"],["g","m",1,"A","5","5","R",1,"X-O",2,1,"W","P"]]'
BAD = ["oops", AHEAD]


def drain(spark, root, out, options):
    q = single.start_single(file_messages(spark, f"{root}/src"), out, f"{root}/ck", AVAILABLE_NOW, options)
    q.awaitTermination()
    assert q.exception() is None
    return sum(p["numInputRows"] for p in q.recentProgress)


@pytest.fixture(scope="module")
def live_run(spark, golden):
    """Day 1 (part), day 2, then the rest of day 1, with bad messages in each batch; folded every batch."""
    root = scratch_path(spark, "single-test")
    parts = [golden.where("match_id in ('1', '2')"), golden.where("match_id = '4'"), golden.where("match_id = '3'")]
    read = []
    for part in parts:
        bad = spark.createDataFrame([(b,) for b in BAD], "value string")
        encode_wire(part).union(bad).write.mode("append").text(f"{root}/src")
        read.append(drain(spark, root, f"{root}/out", single.LiveOptions(fold_every=1, keep_seconds=0)))
    return f"{root}/out", parts, read


def test_source_is_read_once_a_batch(live_run):
    _, parts, read = live_run
    assert read == [p.count() + len(BAD) for p in parts]


def test_reports_equal_batch(spark, golden, live_run):
    res = api.read_results(spark, live_run[0])
    assert rows(res["operator_ratios"]) == rows(live.operator_name_ratios(golden))
    assert rows(res["mode_role_wins"]) == rows(live.mode_role_best_map(golden))
    assert rows(res["mode_role_peak"]) == rows(live.mode_role_peak_match(golden))
    assert rows(res["map_best"]) == rows(live.map_best_operators(golden))
    assert rows(single.latest_map_best(spark, live_run[0])) == rows(live.map_best_operators(golden))
    assert rows(single.read_history(spark, live_run[0])) == rows(golden)


def test_late_rows_reopen_their_day(spark, golden, live_run):
    # Day 1 was closed and reported before match 3 came; day 2 is still open.
    first = golden.where("date = '20170210'")
    for name, want in {"divisions": daily.division_topk(first), "operators": daily.operator_topk(first),
                       "platforms": daily.platform_summary(first)}.items():
        got = single.read_daily(spark, live_run[0], name)
        assert rows(got, want.columns) == rows(want)
    late = spark.read.parquet(f"{live_run[0]}/late_rows").drop("batch_id")
    assert rows(late, golden.columns) == rows(golden.where("match_id = '3'"))
    stats = rows(single.read_batch_stats(spark, live_run[0]), ["seq", "rows", "on_time", "late", "refused"])
    assert stats == [(0, 7, 7, 0, 2), (1, 2, 2, 0, 2), (2, 1, 0, 1, 2)]


def test_future_day_closes_nothing(spark, live_run):
    refused = spark.read.parquet(f"{live_run[0]}/quarantine")
    assert sorted({r["_error"] for r in refused.collect()}) == ["future_date", "not_json"]
    days = spark.read.parquet(versions(spark, f"{live_run[0]}/days")[-1][1])
    assert rows(days) == [("20170210", False), ("20170211", True)]


def test_steps_bound_days(spark, golden):
    # Seen from the batch's median day, or the newest day known, 20250101 is years ahead.
    far = golden.limit(1).withColumn("date", F.lit("20250101"))
    out = replay_single(spark, [golden.union(far), far], single.LiveOptions(max_step_days=30, store=False))
    assert rows(spark.read.parquet(f"{out}/quarantine"), ["_error", "batch_id"]) == [("future_date", 0), ("future_date", 1)]


def test_repeated_batch_adds_nothing(spark, golden):
    out = scratch_path(spark, "repeat")
    job = single.LiveJob(out, single.LiveOptions(fold_every=0))
    first, second = (encode_wire(golden.where(c)) for c in ("match_id <> '3'", "match_id = '3'"))
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        job.process(batch, number)
    assert rows(single.read_history(spark, out)) == rows(golden)
    assert rows(spark.read.parquet(f"{out}/map_best/batch_id=1")) == rows(live.map_best_operators(golden))
    # Only the map of match 3 was touched by batch 1.
    log = spark.read.parquet(f"{out}/map_best_log").where("batch_id = 1")
    assert {r["map"] for r in log.collect()} == {"HOUSE"}


def test_folders_stay_bounded(spark, golden):
    out = scratch_path(spark, "many")
    job = single.LiveJob(out, single.LiveOptions(fold_every=4, keep_seconds=0, store=False))
    message = encode_wire(golden.where("match_id = '3'"))
    for number in range(9):
        job.process(message, number)
    for table in ("map_best_log", "batch_stats", "totals", "map_best"):
        assert len(versions(spark, f"{out}/{table}")) <= 8
    assert len(versions(spark, f"{out}/map_best_log_base")) <= 2
    assert rows(single.latest_map_best(spark, out), ["map", "operator"]) == [("HOUSE", "SWAT-RESERVE")]
    assert single.read_batch_stats(spark, out).agg(F.sum("rows")).first()[0] == 9


def test_start_live_is_one_query(spark, golden):
    root = scratch_path(spark, "start-live")
    encode_wire(golden).write.text(f"{root}/src")
    queries = start_live(file_messages(spark, f"{root}/src"), f"{root}/out", f"{root}/ck", AVAILABLE_NOW)
    assert len(queries) == 1
    queries[0].awaitTermination()
    assert rows(single.read_history(spark, f"{root}/out")) == rows(golden)


def test_store_survives_folds_and_appends(spark, golden):
    store = HistoryStore(spark, scratch_path(spark, "history"))
    assert rows(store.read()) == []
    a, b, c = (golden.where(f"match_id {x}") for x in ("in ('1', '2')", "= '3'", "= '4'"))
    store.write_batch(a, 0)
    store.write_batch(b, 1)
    assert store.fold() == ["20170210"]
    store.write_batch(b, 1)  # a repeated batch after its day was folded
    assert rows(store.read()) == rows(a.union(b))
    store.append(c)
    store.append(a.where("kills = 3"))
    store.write_batch(c, 2)
    want = a.union(b).union(c).union(c).union(a.where("kills = 3"))
    assert rows(store.read()) == rows(want)
    assert store.fold() == ["20170210", "20170211"]
    assert rows(store.read()) == rows(want)
    assert store.vacuum(3600) == 0
    assert store.vacuum(0) > 0 and rows(store.read()) == rows(want)
    assert rows(store.read(["20170211"])) == rows(c.union(c))
    assert store.fold() == []
    daily_again = daily.division_topk(store.read(["20170211"]))
    assert rows(daily_again) == rows(daily.division_topk(c.union(c)))


def test_rows_without_a_day_stay(spark, golden):
    store = HistoryStore(spark, scratch_path(spark, "history-null"))
    none = golden.where("match_id = '3'").withColumn("date", F.lit(None).cast("string"))
    store.append(none)
    store.append(none)
    assert store.fold() == [] and store.read().count() == 2


def test_replay_match_by_match(spark, golden):
    root = scratch_path(spark, "by-match")
    assert write_match_steps(golden.repartition(3), f"{root}/src") == 4

    def body(batch, batch_id):
        batch.withColumn("step", F.lit(batch_id)).write.mode("append").parquet(f"{root}/out")
    q = (file_messages(spark, f"{root}/src", 1).writeStream.option("checkpointLocation", f"{root}/ck")
         .trigger(availableNow=True).foreachBatch(body).start())
    q.awaitTermination()
    got = api.from_wire(spark.read.parquet(f"{root}/out"), keep=("step",)).select("step", "match_id").distinct()
    assert rows(got) == [(0, "1"), (1, "2"), (2, "3"), (3, "4")]


def test_peak_from_matches(spark, golden):
    out = replay_by_match(spark, golden, 4, lambda m, o, c: single.start_single(
        m, o, c, AVAILABLE_NOW, single.LiveOptions(store=False)))
    assert rows(api.read_results(spark, out)["mode_role_peak"]) == rows(live.mode_role_peak_match(golden))


def test_match_numbers_need_no_job(spark, golden):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("numbering", "plan only")
    try:
        seq = match_sequence(golden)
        assert list(tracker.getJobIdsForGroup("numbering")) == []
        assert "BROADCAST" not in seq._jdf.queryExecution().optimizedPlan().toString().upper().split("STRATEGY")[0]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(seq, ["seq", "match_id"]) == [(1, "1"), (2, "2"), (3, "3"), (4, "4")]


def test_match_numbers_with_a_hot_day(spark):
    ids = [("20170210", str(n)) for n in range(0, 4000, 3)] + [("20170211", f"000000{n}") for n in range(500)]
    ids += [("20161231", ""), ("20161231", None), ("20170210", "5")]
    pr = spark.createDataFrame([(d, m) for d, m in ids], "date string, match_id string")
    want = sorted(set(ids), key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    got = {(r["date"], r["match_id"]): r["seq"] for r in match_sequence(pr).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda x: x[1])] == want
    assert sorted(got.values()) == list(range(1, len(want) + 1))


def test_failed_query_is_restarted(spark, golden):
    root = scratch_path(spark, "supervised")
    encode_wire(golden).write.text(f"{root}/src")
    broken = [True]

    def flaky():
        def body(batch, batch_id):
            if broken.pop() if broken else False:
                raise RuntimeError("killed")
            batch.write.mode("append").parquet(f"{root}/flaky")
        return (file_messages(spark, f"{root}/src").writeStream.option("checkpointLocation", f"{root}/ck1")
                .trigger(availableNow=True).foreachBatch(body).start())

    def steady():
        return (file_messages(spark, f"{root}/src").writeStream.option("checkpointLocation", f"{root}/ck2")
                .trigger(availableNow=True).format("parquet").option("path", f"{root}/steady").start())

    progress, errors = ProgressLog(spark), []
    spark.streams.addListener(progress)
    try:
        restarts = supervise({"flaky": flaky, "steady": steady}, first_wait=0.1, poll=0.1,
                             on_failure=lambda name, error: errors.append(name))
    finally:
        spark.streams.removeListener(progress)
    assert restarts == {"flaky": 1, "steady": 0} and errors == ["flaky"]
    assert spark.read.parquet(f"{root}/flaky").count() == spark.read.parquet(f"{root}/steady").count() == golden.count()
    assert progress.read().agg(F.sum("input_rows")).first()[0] >= 2 * golden.count()


def test_supervision_stops_when_told(spark, golden):
    root = scratch_path(spark, "stopped")
    spark.createDataFrame([], PLAYER_ROUNDS_SCHEMA).selectExpr("'' AS value").write.text(f"{root}/src")
    stop = threading.Event()
    threading.Timer(2.0, stop.set).start()
    started = []

    def start():
        q = (file_messages(spark, f"{root}/src").writeStream.option("checkpointLocation", f"{root}/ck")
             .format("noop").start())
        started.append(q)
        return q
    supervise({"idle": start}, stop=stop, poll=0.1)
    assert not started[0].isActive


def test_a_batch_is_kept_without_the_text_of_good_messages(spark, golden, tmp_path, monkeypatch):
    texts = []
    batch = encode_wire(golden).union(spark.createDataFrame([(b,) for b in BAD], "value string"))

    def persist(self, *level):
        texts.extend(r["value"] for r in self.where("value is not null").collect())
        return self
    monkeypatch.setattr(type(batch), "persist", persist)
    single.LiveJob(f"{tmp_path}/out", single.LiveOptions(store=False)).process(batch, 0)
    assert sorted(texts) == sorted(BAD)
    bad = spark.read.parquet(f"{tmp_path}/out/quarantine")
    assert sorted((r["value"], r["_error"]) for r in bad.collect()) == sorted([("oops", "not_json"), (AHEAD, "future_date")])
