"""spark-submit entry: ``python -m skytally run-etl --lake … --raw … --endpoint flights``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from skytally.plans import jobs, quarantine, runlog
from skytally.schemas import RUN_EVENTS, RUN_LOG
from skytally.session import build_session
from skytally.sources.payloads import find_snapshot_files
from skytally.streaming.snapshots import ingest, read_incoming


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skytally")
    top.add_argument("--lake", required=True, help="root folder of the tables")
    commands = top.add_subparsers(dest="command", required=True)

    etl = commands.add_parser("run-etl", help="load landed files into a document table")
    etl.add_argument("--raw", required=True)
    etl.add_argument("--run-id")
    stream = commands.add_parser("stream", help="load what has landed as a stream")
    stream.add_argument("--incoming", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--archive")
    stream.add_argument("--remember", help="time, as '2 days', for which equal payloads are loaded once")
    for name in ("snapshot", "routes"):
        insight = commands.add_parser(name, help=f"{name} of one run")
        insight.add_argument("--incoming", required=True)
        insight.add_argument("--processed", required=True)
        insight.add_argument("--run-id", required=True)
        insight.add_argument("--loaded-seq", type=int, default=0)
    for command in commands.choices.values():
        command.add_argument("--source", default="aviationstack")
        command.add_argument("--endpoint", default="flights")

    history = commands.add_parser("load-history", help="feature-engineer the flight CSVs")
    history.add_argument("--folder", required=True)
    training = commands.add_parser("train", help="train and save the delay classifier")
    training.add_argument("--model", required=True)
    training.add_argument("--preset", default="forest_job")
    scoring = commands.add_parser("run-predictions", help="score documents")
    scoring.add_argument("--model", required=True)
    scoring.add_argument("--airports", required=True)
    scoring.add_argument("--limit", type=int)
    searching = commands.add_parser("search", help="find predictions by part of an identifier")
    searching.add_argument("--text", required=True)
    searching.add_argument("--limit", type=int, default=10)
    commands.add_parser("latest-routes", help="panels over the run loaded last")
    commands.add_parser("quarantine", help="what loads have set aside, by reason")
    tidy = commands.add_parser("compact", help="fewer files in the run log and the search index")
    tidy.add_argument("--before", required=True, help="first day that is not closed, yyyy-MM-dd")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark, lake = build_session(), jobs.Lake(args.lake)
    if args.command == "run-etl":
        print(jobs.run_etl(spark, lake, args.raw, args.source, args.endpoint, args.run_id))
    elif args.command == "stream":
        landed = read_incoming(
            spark, args.incoming, args.source, args.endpoint, archive=args.archive
        )
        ingest(
            lake, landed, args.source, args.endpoint, args.checkpoint, args.remember
        ).awaitTermination()
    elif args.command in ("snapshot", "routes"):
        files = find_snapshot_files(
            spark, args.incoming, args.processed, args.source, args.endpoint, args.run_id
        ).select("file_name", "payload", F.lit(args.run_id).alias("run_id"))
        if args.command == "snapshot":
            jobs.snapshot_job(spark, lake, files, args.source, args.endpoint)
        else:
            jobs.routes_job(spark, lake, files, args.source, args.endpoint, args.loaded_seq)
    elif args.command == "load-history":
        print(jobs.history_job(spark, lake, args.folder))
    elif args.command == "train":
        jobs.training_job(spark, lake, args.model, args.preset).show(truncate=False)
    elif args.command == "search":
        jobs.search_job(spark, lake, args.text, args.limit).show(args.limit, truncate=False)
    elif args.command == "latest-routes":
        for name, panel in jobs.route_dashboard(spark, lake).items():
            print(name)
            panel.show(100, truncate=False)
    elif args.command == "quarantine":
        quarantine.reasons(quarantine.quarantined(spark, lake.path("quarantine"))).show(truncate=False)
    elif args.command == "compact":
        runlog.compact(spark, lake.path("pipeline_runs"), RUN_LOG, args.before)
        runlog.compact(spark, lake.path("run_events"), RUN_EVENTS, args.before)
        jobs.prediction_index(lake).compact(spark)
    else:
        print(jobs.prediction_job(spark, lake, args.model, args.airports, args.limit))


if __name__ == "__main__":
    main()
