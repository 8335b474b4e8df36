"""Command line: python -m tidemark <command>, or the same through spark-submit."""

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.functions import timing
from tidemark.plans import health, load, maintain, replay, reports, retention
from tidemark.session import build_session
from tidemark.sources import landing, records, rejects
from tidemark.sources.fact import FactTable
from tidemark.streaming import loader, transform_job

REPORTS = {
    "events-per-minute": reports.events_per_minute,
    "top-event-types": reports.top_event_types,
    "funnel": reports.funnel,
    "revenue-by-hour": reports.revenue_by_hour,
    "duplicates": reports.duplicate_events,
    "load-latency": reports.load_latency,
    "active-users": reports.active_users,
    "active-users-sliding": reports.active_users_sliding,
    "error-rate-by-page": reports.error_rate_by_page,
    "duplicate-check": lambda events, as_of=None: reports.duplicate_check(events),
    "skew": lambda events, as_of=None: maintain.skew_report(events),
}
# How far back the event-time reports look.
REACH_HOURS = {
    "events-per-minute": 1,
    "top-event-types": 24,
    "funnel": 24,
    "revenue-by-hour": 24 * 7,
    "load-latency": 24,
    "active-users": 1,
    "active-users-sliding": 1,
    "error-rate-by-page": 1,
}


def parser():
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    top.add_argument("--master", default=None, help="Spark master; left to spark-submit by default")
    commands = top.add_subparsers(dest="command", required=True)

    job = commands.add_parser("transform", help="stream records into the landing zone")
    job.add_argument("--source", help="folder of records, for file formats")
    job.add_argument("--format", default="parquet", help="Spark source format")
    job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="source option")
    job.add_argument("--root", required=True, help="root of landing zone and rejects")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--since", help="skip records that arrived earlier")
    job.add_argument("--trigger", default="60 seconds")
    job.add_argument("--once", action="store_true", help="work off what is there and end")
    job.add_argument("--strictness", choices=("required", "full"), default="required")
    job.add_argument("--batch-log")

    job = commands.add_parser("load", help="load one landing prefix into the fact table")
    job.add_argument("--prefix", required=True, help="folder such as .../events/year=2024/month=05/day=27/hour=14/")
    job.add_argument("--table", required=True)
    job.add_argument("--audit")
    job.add_argument("--rejects")
    job.add_argument("--dry-run", action="store_true")

    job = commands.add_parser("load-stream", help="load landed files as they arrive")
    job.add_argument("--root", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--trigger", default="60 seconds")
    job.add_argument("--once", action="store_true")
    job.add_argument("--below", default="", help="part of the zone to watch, as year=2024/month=05/*")

    job = commands.add_parser("report", help="print a report over the fact table")
    job.add_argument("name", choices=sorted(REPORTS))
    job.add_argument("--table", required=True)
    job.add_argument("--as-of")

    job = commands.add_parser("replay", help="send rejects to a target again")
    job.add_argument("--rejects", required=True, help="root that holds errors/")
    job.add_argument("--target", help="folder, or left out when the sink's options name it")
    job.add_argument("--format", default="json", help="Spark sink format")
    job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    job.add_argument("--max-messages", type=int)
    job.add_argument("--dry-run", action="store_true")

    job = commands.add_parser("shards", help="print rate and utilisation per shard")
    job.add_argument("--records", required=True, help="folder of records")
    job.add_argument("--interval", type=int, default=10, help="seconds per datapoint")
    job.add_argument("--as-of")

    job = commands.add_parser("maintain", help="compact, apply retention, remove unused folders")
    job.add_argument("--table", help="fact table, for the next three")
    job.add_argument("--compact", action="store_true")
    job.add_argument("--retention-days", type=int)
    job.add_argument("--purge", action="store_true")
    job.add_argument("--expire", metavar="ROOT", help="root of landing zone, rejects and replayed ids to expire")
    job.add_argument("--keys", help="root of seen keys to expire with them")
    job.add_argument("--grace", type=int, default=retention.GRACE_SECONDS, help="seconds from retiring days to deleting them")
    return top


def _options(pairs):
    return dict(p.split("=", 1) for p in pairs)


def _replayed_root(root):
    return f"{root}/replayed"


def run(spark, args):
    now = dt.datetime.now(dt.timezone.utc)
    if args.command == "transform":
        source = records.stream_records(spark, args.source, args.format, _options(args.option), since=args.since)
        transform_job.start(
            source, args.root, args.checkpoint, None if args.once else args.trigger,
            batch_log=args.batch_log, strictness=args.strictness,
        ).awaitTermination()
    elif args.command == "load":
        lines = landing.read_prefix(spark, args.prefix)
        if args.dry_run:
            load.dry_run(lines).show(1000, False)
        else:
            print(json.dumps(load.load(FactTable(spark, args.table), lines, args.prefix, args.audit, args.rejects)))
    elif args.command == "load-stream":
        trigger = None if args.once else args.trigger
        loader.start(
            FactTable(spark, args.table), args.root, args.checkpoint, trigger, below=args.below
        ).awaitTermination()
    elif args.command == "report":
        table = FactTable(spark, args.table)
        as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else now
        if args.name in REACH_HOURS:
            events = table.recent(as_of, REACH_HOURS[args.name])
        elif args.name == "duplicates":
            # Cut by load time, which the table's list of folders knows.
            events = table.read(loaded_since=timing.as_of_column(as_of) - timing.hours(1))
        else:
            events = table.read()
        REPORTS[args.name](events, as_of=as_of).show(1000, False)
    elif args.command == "replay":
        drained = rejects.drain(replay.sendable(replay.open_rejects(spark, args.rejects)), args.max_messages)
        if args.dry_run:
            plan = replay.dry_run(replay.unwrap(drained))
            plan.pop("samples").show(truncate=False)
            print(json.dumps(plan))
        else:
            sent = replay.replay(
                drained, _replayed_root(args.rejects), now, args.target, args.format, _options(args.option)
            )
            print(json.dumps(sent))
    elif args.command == "shards":
        stored = records.read_records(spark, args.records)
        shards = stored.select("shard_id").distinct().withColumn("ending_sequence_number", F.lit(None).cast("string"))
        latest = health.latest_points(health.shard_points(stored, args.interval), args.as_of, args.interval)
        health.shard_utilisation(shards, latest, args.interval).show(1000, False)
    elif args.command == "maintain":
        if args.table is None and (args.compact or args.purge or args.retention_days is not None):
            raise SystemExit("name the --table")
        table = FactTable(spark, args.table) if args.table else None
        if args.compact:
            print(json.dumps({"compacted": maintain.compact(table)}))
        if args.retention_days is not None:
            maintain.apply_retention(table, now.date(), args.retention_days)
        if args.expire:
            print(json.dumps({"expired": retention.expire(spark, args.expire, now, args.keys, grace_seconds=args.grace)}))
        if args.purge:
            print(json.dumps({"removed_folders": table.purge()}))


def main(argv=None):
    args = parser().parse_args(argv)
    spark = build_session(args.master, f"tidemark-{args.command}")
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
