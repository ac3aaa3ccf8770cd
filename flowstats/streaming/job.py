"""Command-line streaming job.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version> \\
        --py-files flowstats.zip flowstats/streaming/job.py tcp \\
        --brokers host:9092 --topic flows \\
        --sink s3://bucket/reports --checkpoint s3://bucket/ckpt/tcp

(or `python -m flowstats.streaming.job ...` where pyspark is configured)

runs every TCP report (or `--reports tcp_10s,...`) on each 10-second
micro-batch. `--files DIR` reads JSON-lines files instead of Kafka and
`--available-now` processes what is there and stops.
"""

from __future__ import annotations

import argparse
import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowstats.plans.http_reports import HTTP_REPORTS
from flowstats.plans.http_shared import http_report_set
from flowstats.plans.tcp_shared import tcp_report_set
from flowstats.plans.tcp_reports import TCP_REPORTS
from flowstats.schemas import BATCH_INTERVAL, HTTP_SCHEMA, TCP_SCHEMA
from flowstats.sources.json_records import SOURCE_TIME, kafka_stream, stream_json_files
from flowstats.streaming.runner import run_reports

KINDS = {"http": (HTTP_SCHEMA, HTTP_REPORTS), "tcp": (TCP_SCHEMA, TCP_REPORTS)}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="flowstats.streaming.job", description=__doc__.split("\n\n")[0])
    p.add_argument("kind", choices=sorted(KINDS))
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--brokers", help="Kafka bootstrap servers (with --topic)")
    src.add_argument("--files", help="folder of JSON-lines files")
    p.add_argument("--topic")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--reports", help="comma-separated report names (default: all of the kind)")
    p.add_argument("--sink", required=True, help="output folder of the report table")
    p.add_argument("--checkpoint", help="stream checkpoint folder (default: one for this source and sink under spark.checkpoint.dir)")
    p.add_argument("--max-offsets-per-trigger", type=int, help="most Kafka records in one batch, so a catch-up batch stays bounded")
    p.add_argument("--max-files-per-trigger", type=int, help="most files in one batch")
    p.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE", help="passed to the Kafka source")
    p.add_argument("--interval", default=BATCH_INTERVAL)
    p.add_argument("--available-now", action="store_true")
    args = p.parse_args(argv)
    if args.brokers and not args.topic:
        p.error("--brokers needs --topic")
    if any("=" not in o for o in args.kafka_option):
        p.error("--kafka-option needs NAME=VALUE")
    return args


def checkpoint_location(spark: SparkSession, args: argparse.Namespace) -> str:
    """`--checkpoint`, or the folder of this kind, source and sink under `spark.checkpoint.dir`; an error without either.

    A folder made anew at each start would forget the offsets, and the records between two runs would be skipped.
    """
    if args.checkpoint:
        return args.checkpoint
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("pass --checkpoint or set spark.checkpoint.dir: offsets must outlive the job")
    source = f"{args.brokers}/{args.topic}" if args.brokers else args.files
    digest = hashlib.sha256("\n".join([args.kind, source, args.sink]).encode()).hexdigest()[:16]
    return f"{root.rstrip('/')}/flowstats-{args.kind}-{digest}"


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    schema, catalog = KINDS[args.kind]
    names = args.reports.split(",") if args.reports else list(catalog)
    unknown = [n for n in names if n not in catalog]
    if unknown:
        raise ValueError(f"unknown {args.kind} reports: {unknown}; known: {sorted(catalog)}")
    if args.brokers:
        options = dict(o.split("=", 1) for o in args.kafka_option)
        if args.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
        records = kafka_stream(spark, args.brokers, args.topic, schema, args.starting_offsets, options, with_source=True)
    else:
        records = stream_json_files(spark, args.files, schema, args.max_files_per_trigger, with_source=True)
    checkpoint = checkpoint_location(spark, args)
    # All reports of a kind: derive them from aggregations shared within each batch.
    shared_sets = {"http": http_report_set, "tcp": tcp_report_set}
    reports = shared_sets[args.kind]() if not args.reports else {n: catalog[n] for n in names}
    return run_reports(
        records,
        reports,
        args.sink,
        checkpoint,
        interval=args.interval,
        available_now=args.available_now,
        time_col=SOURCE_TIME,
        query_name=f"flowstats_{args.kind}",
        kind=args.kind,
    )


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName(f"flowstats-{args.kind}").getOrCreate()
    start(spark, args).awaitTermination()


if __name__ == "__main__":
    main()
