"""Command line: ``python -m roundlens {daily,live,replay} ...``.

* ``daily --store S --out O [--date yyyyMMdd]``: daily reports of one day (or
  all days) of the history store, published under ``O``.
* ``live --source DIR | --kafka HOSTS --topic T, --out O --checkpoint C``:
  the live reports, the history store and the daily reports of closed days in
  one query, until stopped; a failed query starts again from its checkpoint.
* ``replay --csv PATH --messages DIR [--steps N | --matches-per-step N]``: raw
  CSV → wire messages written in day order, or match by match.
"""

from __future__ import annotations

import argparse

from . import api
from .session import build_session


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="roundlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--store", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--date")
    lv = sub.add_parser("live")
    lv.add_argument("--source")
    lv.add_argument("--kafka")
    lv.add_argument("--topic")
    lv.add_argument("--out", required=True)
    lv.add_argument("--checkpoint", required=True)
    lv.add_argument("--trigger", default="1 second")
    lv.add_argument("--open-days", type=int, default=0, help="days a day stays open after a later one arrived")
    lv.add_argument("--max-step-days", type=int, help="refuse messages of days that far past the newest day")
    lv.add_argument("--fold-every", type=int, default=50, help="micro-batches between folds of the store and the log")
    lv.add_argument("--first-wait", type=float, default=1.0, help="seconds before a failed query is started again")
    lv.add_argument("--until-done", action="store_true", help="handle what is there and end (a failure still restarts)")
    r = sub.add_parser("replay")
    r.add_argument("--csv", required=True)
    r.add_argument("--messages", required=True)
    r.add_argument("--steps", type=int, default=8)
    r.add_argument("--matches-per-step", type=int, help="write whole matches, so many a file, instead of day ranges")
    r.add_argument("--pause", type=float, default=0.0, help="seconds between the files of --matches-per-step")
    r.add_argument("--rejects", help="folder of refused rows (default: MESSAGES-rejects)")
    for sp in (d, lv, r):
        sp.add_argument("--master", default=None)
    args = p.parse_args(argv)

    # Without --master the master and partition count come from spark-submit.
    spark = build_session(master=args.master, shuffle_partitions=8 if args.master else None)
    if args.cmd == "daily":
        api.publish_daily(api.read_store(spark, args.store), args.out, args.date)
    elif args.cmd == "replay":
        good, bad = api.split_valid(api.raw_to_player_rounds(api.read_raw_csv(spark, args.csv)))
        bad.write.mode("append").parquet(args.rejects or f"{args.messages.rstrip('/')}-rejects")
        if args.matches_per_step:
            api.write_match_steps(good, args.messages, args.matches_per_step, pause_seconds=args.pause)
        else:
            api.write_replay(good, args.messages, args.steps)
    else:
        if args.kafka and not args.topic:
            p.error("--kafka needs --topic")
        if not (args.kafka or args.source):
            p.error("live needs --source or --kafka")
        msgs = (api.kafka_messages(spark, args.kafka, args.topic) if args.kafka
                else api.file_messages(spark, args.source))
        trigger = {"availableNow": True} if args.until_done else {"processingTime": args.trigger}
        options = {"open_days": args.open_days, "max_step_days": args.max_step_days, "fold_every": args.fold_every}
        progress = api.ProgressLog(spark, f"{args.out.rstrip('/')}/progress")
        spark.streams.addListener(progress)
        try:
            api.supervise({"live": lambda: api.start_live(msgs, args.out, args.checkpoint, trigger, **options)[0]},
                          first_wait=args.first_wait)
        finally:
            spark.streams.removeListener(progress)
            progress.flush()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
