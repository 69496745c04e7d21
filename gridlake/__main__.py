"""Command line: ``python -m gridlake <command> ...``, or on a cluster
``spark-submit --py-files gridlake.zip gridlake/__main__.py <command> ...``.

  run-day     --root URI --day YYYY-MM-DD [--no-land] [--require-complete]
  run-pending --root URI [--no-land]
  run-range   --root URI --start YYYY-MM-DD --end YYYY-MM-DD [--no-land] [--require-complete]
  compact     --root URI --kind weather|energy --start YYYY-MM-DD --end YYYY-MM-DD
  land-stream --root URI --kind weather|energy (--topic T --servers H | --path URI)
              [--continuous] [--max-per-trigger N]

The session comes from the launcher (master, resources, storage settings);
only the pipeline's SQL settings are applied on top.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if not __package__:  # run as a file by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def landed_totals(spark, report_root: str) -> dict:
    """Batches and rows of a landing, from its report table (all batches)."""
    from pyspark.errors import AnalysisException
    from pyspark.sql import functions as F
    try:
        report = spark.read.parquet(report_root)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return {"batches": 0, "rows": 0}
    total = report.agg(F.count(F.lit(1)).alias("batches"), F.sum(F.col("written") + F.col("rejected")).alias("rows")).first()
    return {"batches": total["batches"], "rows": total["rows"] or 0}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gridlake")
    sub = parser.add_subparsers(dest="command", required=True)
    day = sub.add_parser("run-day")
    day.add_argument("--root", required=True)
    day.add_argument("--day", required=True)
    day.add_argument("--no-land", action="store_true")
    day.add_argument("--require-complete", action="store_true")
    new = sub.add_parser("run-pending")
    new.add_argument("--root", required=True)
    new.add_argument("--no-land", action="store_true")
    fold = sub.add_parser("compact")
    fold.add_argument("--root", required=True)
    fold.add_argument("--kind", choices=["weather", "energy"], required=True)
    fold.add_argument("--start", required=True)
    fold.add_argument("--end", required=True)
    rng = sub.add_parser("run-range")
    rng.add_argument("--root", required=True)
    rng.add_argument("--start", required=True)
    rng.add_argument("--end", required=True)
    rng.add_argument("--no-land", action="store_true")
    rng.add_argument("--require-complete", action="store_true")
    stream = sub.add_parser("land-stream")
    stream.add_argument("--root", required=True)
    stream.add_argument("--kind", choices=["weather", "energy"], required=True)
    stream.add_argument("--topic")
    stream.add_argument("--servers")
    stream.add_argument("--path")
    stream.add_argument("--continuous", action="store_true")
    stream.add_argument("--max-per-trigger", type=int, help="files or offsets per micro-batch (all: 0)")
    args = parser.parse_args(argv)

    from gridlake.session import build_session
    spark = build_session(app_name=f"gridlake-{args.command}")
    if args.command == "run-day":
        from gridlake.plans.daily import run_day
        report = run_day(spark, args.root, args.day, land=not args.no_land,
                         require_complete=args.require_complete)
    elif args.command == "run-pending":
        from gridlake.plans.incremental import run_pending
        report = run_pending(spark, args.root, land=not args.no_land)
    elif args.command == "compact":
        from gridlake.plans.daily import Paths
        from gridlake.sources.compaction import compact
        paths = Paths(args.root.rstrip("/"))
        report = compact(spark, paths.at("bronze", args.kind), paths.at("folded", args.kind), args.start, args.end)
    elif args.command == "run-range":
        from gridlake.plans.daily import run_range
        report = run_range(spark, args.root, args.start, args.end, land=not args.no_land,
                           require_complete=args.require_complete)
    else:
        from gridlake.sources.messages import ENERGY_TOPIC, WEATHER_TOPIC, read_topic
        from gridlake.streaming.ingest import land_stream
        root = args.root.rstrip("/")
        if args.path:
            source = read_topic(spark, fmt="text", path=args.path, max_per_trigger=100 if args.max_per_trigger is None else args.max_per_trigger)
        else:
            topic = args.topic or (WEATHER_TOPIC if args.kind == "weather" else ENERGY_TOPIC)
            source = read_topic(spark, topic=topic, fmt="kafka",
                                max_per_trigger=100_000 if args.max_per_trigger is None else args.max_per_trigger,
                                options={"kafka.bootstrap.servers": args.servers or "localhost:9092"})
        query = land_stream(source, args.kind, f"{root}/bronze/{args.kind}", f"{root}/quarantine/{args.kind}",
                            f"{root}/_checkpoints/land-{args.kind}", available_now=not args.continuous,
                            report_root=f"{root}/reports/land-{args.kind}", lake_root=root)
        query.awaitTermination()
        report = landed_totals(spark, f"{root}/reports/land-{args.kind}")
    print(json.dumps(report, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
