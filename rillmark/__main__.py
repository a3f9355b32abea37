"""Command line: tables, batch runs, streams and the upkeep of what they store.

Submit it with spark-submit. The package itself goes to the executors with
``--py-files``; formats such as Avro come from ``--packages``.
"""

from __future__ import annotations

import argparse
import sys
import time
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from rillmark.plans.batch_run import FAILED, RunConfig, run_all
from rillmark.session import use_utc
from rillmark.sinks.bronze import compact_day, create_database, create_tables, expire, stored_days
from rillmark.sources.catalog import databases
from rillmark.sources.feed import envelope_schema, widened
from rillmark.spec import TableSpec, replicated_tables
from rillmark.streaming.ingest import StreamWatch, keep_all_bronze, replay_quarantine


def parse(argv: list[str]) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="rillmark")
    commands = top.add_subparsers(dest="command", required=True)
    init = commands.add_parser("init", help="create the database and its tables")
    init.add_argument("--database", required=True)
    init.add_argument("--bronze", required=True)
    run = commands.add_parser("run", help="process new change events of every table")
    for name in ("raw", "bronze", "state"):
        run.add_argument(f"--{name}", required=True)
    run.add_argument("--database")
    run.add_argument("--format", default="parquet")
    run.add_argument("--seq", help="envelope field that orders events of one millisecond, e.g. source.lsn")
    run.add_argument("--freshness-limit", type=int, default=900)
    run.add_argument("--freshness-blocks", action="store_true")
    run.add_argument("--keep-deletes", action="store_true", help="store deletes as rows with only their key")
    run.add_argument("--lookback-ms", type=int, default=0, help="take events up to so much older than the mark again")
    run.add_argument("--backfill", action="store_true", help="read the whole history where the mark cannot be read")
    run.add_argument("--dashboard-url", default="")

    stream = commands.add_parser("stream", help="keep bronze up to date, one query per table")
    for name in ("raw", "bronze", "state"):
        stream.add_argument(f"--{name}", required=True)
    stream.add_argument("--database")
    stream.add_argument("--format", default="parquet")
    stream.add_argument("--once", action="store_true", help="end when all there is has been stored")
    stream.add_argument("--interval", default="60 seconds")
    stream.add_argument("--freshness-limit", type=int, default=900)
    stream.add_argument("--dashboard-url", default="")

    replay = commands.add_parser("replay", help="store events that were set aside and can be stored now")
    for name in ("bronze", "state"):
        replay.add_argument(f"--{name}", required=True)

    tidy = commands.add_parser("compact", help="rewrite a past day's many files as few")
    tidy.add_argument("--bronze", required=True)
    tidy.add_argument("--state", required=True)
    tidy.add_argument("--day", required=True, type=date.fromisoformat)

    old = commands.add_parser("expire", help="drop old days from the catalog and from storage")
    old.add_argument("--bronze", required=True)
    old.add_argument("--database")
    old.add_argument("--keep-days", required=True, type=int)
    for each in (run, stream, replay, tidy, old):
        each.add_argument("--tables", nargs="*", help="some tables only")
    return top.parse_args(argv)


def follow(spark: SparkSession, specs: list[TableSpec], args: argparse.Namespace) -> int:
    """Runs the streams until they end or one fails; crashes are reported."""
    watch, clock = StreamWatch(), lambda: int(time.time() * 1000)
    spark.streams.addListener(watch)
    config = RunConfig(
        args.raw, args.bronze, args.state, freshness_limit_s=args.freshness_limit, dashboard_url=args.dashboard_url
    )
    failed = 0
    try:
        running = keep_all_bronze(
            spark, specs, args.raw, args.bronze, args.state, clock, args.format, args.once, args.interval,
            database=args.database, freshness_limit_s=args.freshness_limit, dashboard_url=args.dashboard_url,
        )
        while any(q.isActive for q in running.values()):
            for query in running.values():
                if query.isActive:
                    try:
                        query.awaitTermination(1)
                    except Exception:  # noqa: BLE001 - the watch reports it; the others go on
                        break
            watch.flush(spark, config, clock())
        for name, query in running.items():
            error = query.exception()
            failed += error is not None
            print(name, "ok" if error is None else f"crashed {str(error).splitlines()[0]}")
        # Listeners are told a moment after a query has ended.
        for _ in range(50):
            if watch.flush(spark, config, clock()) or not failed:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(watch)
    return int(failed > 0)


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    args = parse(argv)
    spark = spark or SparkSession.builder.appName(f"rillmark-{args.command}").getOrCreate()
    use_utc(spark)
    specs = replicated_tables()
    if args.command == "init":
        databases(spark).limit(5).show()
        create_database(spark, args.database, args.bronze)
        outcome = create_tables(spark, args.database, args.bronze, specs.values())
        print(outcome)
        return int(any(v.startswith("failed") for v in outcome.values()))
    chosen = [s for n, s in specs.items() if not args.tables or n in args.tables]
    if args.command == "stream":
        return follow(spark, chosen, args)
    if args.command == "replay":
        for spec in chosen:
            schema = envelope_schema(widened(spec.schema()))
            left = replay_quarantine(spark, spec, f"{args.bronze}/{spec.name}", args.state, schema)
            print(spec.name, left, "still aside")
        return 0
    if args.command == "compact":
        if args.day >= datetime.now(timezone.utc).date():
            raise SystemExit("only a day that is over is compacted")
        for spec in chosen:
            path = f"{args.bronze}/{spec.name}"
            if args.day in stored_days(spark, path):
                day = (args.day.year, args.day.month, args.day.day)
                print(spec.name, compact_day(spark, path, f"{args.state}/staging/compact-{spec.name}", *day), "rows")
        return 0
    if args.command == "expire":
        before = datetime.now(timezone.utc).date() - timedelta(days=args.keep_days)
        for spec in chosen:
            gone = expire(spark, f"{args.bronze}/{spec.name}", before, args.database, spec.name)
            print(spec.name, len(gone), "days dropped")
        return 0
    config = RunConfig(
        args.raw, args.bronze, args.state, args.database, args.format, lookback_ms=args.lookback_ms,
        seq_path=args.seq, freshness_limit_s=args.freshness_limit, freshness_blocks=args.freshness_blocks,
        dashboard_url=args.dashboard_url, backfill_unreadable_mark=args.backfill, keep_deletes=args.keep_deletes,
    )
    outcomes = run_all(spark, chosen, config, int(time.time() * 1000))
    for o in outcomes:
        print(o["table"], o["status"], o.get("rows_written"), o.get("message") or "")
    return int(any(o["status"] in FAILED for o in outcomes))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
