"""Command line for spark-submit or `python -m lettermill`.

    run --mode backfill|incremental --bucket URI --state URI
    stream --bucket URI --state URI --checkpoint URI [--every "15 minutes"]
    compact --state URI
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from lettermill.plans.ingest import MODES, RunOptions, SourcesFailed, ingest
from lettermill.plans.state import StateStore
from lettermill.sources.files import root_kind

LOG = logging.getLogger("lettermill")


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lettermill")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="one pass over a bucket")
    run.add_argument("--mode", choices=MODES, default="incremental")
    run.add_argument("--fail-fast", action="store_true", help="fail if a source failed")
    stream = commands.add_parser("stream", help="a pass per trigger")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--every", default="15 minutes")
    for command in (run, stream):
        command.add_argument("--bucket", required=True)
    compact = commands.add_parser("compact", help="rewrite the state tables in one piece")
    for command in (run, stream, compact):
        command.add_argument("--state", required=True)
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    args = _arguments().parse_args(argv)
    if args.command != "compact" and root_kind(args.bucket) == "missing":
        LOG.error("bucket does not exist: %s", args.bucket)
        return 2
    spark = SparkSession.builder.appName("lettermill").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.command == "compact":
        StateStore(spark, args.state).compact()
        return 0
    if args.command == "stream":
        from lettermill.streaming.runs import ingest_stream

        query = ingest_stream(
            spark, args.bucket, args.state, args.checkpoint, args.every,
            on_run=lambda stats: print(stats.summary("incremental"), flush=True),
        )
        query.awaitTermination()
        return 0
    options = RunOptions(mode=args.mode, fail_fast=args.fail_fast)
    try:
        print(ingest(spark, args.bucket, args.state, options).summary(args.mode))
    except SourcesFailed as failure:
        LOG.error("%s", failure)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
