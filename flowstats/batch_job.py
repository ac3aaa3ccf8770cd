"""Command-line batch job: reports over stored flow records.

    python -m flowstats.batch_job http --input hdfs://store/http/ --sink hdfs://store/reports \\
        [--format parquet|json] [--reports http_url,...] [--documents] \\
        [--by-bucket --ts-col ts --interval "10 seconds" --start 2024-01-01T09 --end 2024-01-01T12]

Without `--by-bucket` each report runs once over all the records and is stored
as one table without times. With it, each report is replayed per time bucket of
`--ts-col` (the batch twin of the streaming job) and stored by day and hour. A
replay takes the place of exactly the hours from `--start` to `--end` (UTC, whole
hours), those without records included, and reads only their records; without a
range it covers all stored records, and takes the place of all hours.

All reports of a run appear together, by one commit (`flowstats.sinks.committed`):
a run that was killed leaves nothing that readers see, and the hourly tables and
those without times do not touch one another. Read with `read_committed`.

Reports are derived from aggregations that are computed once and kept on disk
while the job runs, so the input is read three times for the twelve HTTP
reports and twice for the four TCP ones. Bad records, and with `--by-bucket`
those whose time cannot be read, are added to the sink's quarantine
(`flowstats.sinks.quarantine`) and reach no report. `--mended FILES` takes JSON
lines of mended records (with the `quarantine_id` they stand for, if known),
stores them beside the sink, and replays the hours they belong to; they are
part of every later replay.

`--partials` also stores the hourly sums and counts that the reports are derived
from (`flowstats.plans.partials`). `--days` then reports whole days of a range
from them, without reading records, as `<name>_day`:

    python -m flowstats.batch_job http --days --sink S --start 2024-01-01T00 --end 2024-01-08T00
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.functions.columns import batch_time
from flowstats.plans.http_reports import HTTP_REPORTS
from flowstats.plans.http_shared import http_report_set
from flowstats.plans.partials import merged_report, partials_path, store_partials
from flowstats.plans.replay import BUCKET
from flowstats.plans.report_set import BATCH
from flowstats.plans.tcp_reports import TCP_REPORTS
from flowstats.plans.tcp_shared import tcp_report_set
from flowstats.schemas import BATCH_INTERVAL, CORRUPT_RECORD, HTTP_SCHEMA, TCP_SCHEMA
from flowstats.sinks.documents import UNBOUNDED, report_documents, report_parts
from flowstats.sinks.committed import WHOLE, commit, hours_between, new_run, replaced_by_all, write_rows
from flowstats.sinks.quarantine import add_bad, add_mended, read_mended
from flowstats.sinks.snapshot import aligned_range
from flowstats.sources.json_records import SOURCE, decode_timed, read_json_files, split_bad

KINDS = {"http": (HTTP_SCHEMA, HTTP_REPORTS, http_report_set), "tcp": (TCP_SCHEMA, TCP_REPORTS, tcp_report_set)}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="flowstats.batch_job", description=__doc__.split("\n\n")[0])
    p.add_argument("kind", choices=sorted(KINDS))
    p.add_argument("--input", help="stored records (not with --days)")
    p.add_argument("--format", choices=["parquet", "json"], default="parquet")
    p.add_argument("--sink", required=True)
    p.add_argument("--reports", help="comma-separated report names (default: all of the kind)")
    p.add_argument("--by-bucket", action="store_true", help="replay each report per time bucket")
    p.add_argument("--ts-col", default="ts")
    p.add_argument("--interval", default=BATCH_INTERVAL)
    p.add_argument("--start", help="first hour of the replay (ISO, UTC)")
    p.add_argument("--end", help="hour after the last of the replay")
    p.add_argument("--documents", action="store_true", help="also write nested documents, under report=<name>_document")
    p.add_argument("--mended", help="JSON lines of mended records: store them and replay their hours")
    p.add_argument("--partials", action="store_true", help="with --by-bucket: also store the hourly partials")
    p.add_argument("--days", action="store_true", help="report days from stored partials")
    args = p.parse_args(argv)
    if args.days == bool(args.input):
        p.error("either --input or --days")
    if args.days and (args.by_bucket or args.mended or not args.start):
        p.error("--days needs --start and --end, and reads neither records nor buckets")
    if args.partials and not args.by_bucket:
        p.error("--partials goes with --by-bucket")
    if args.mended and (args.start or not args.by_bucket):
        p.error("--mended goes with --by-bucket, without a range: the records say which hours")
    if bool(args.start) != bool(args.end) or (args.start and not args.by_bucket and not args.days):
        p.error("--start and --end go together, with --by-bucket or --days")
    return args


#: Hour of a bucket, `yyyyMMddHH`.
HOUR = F.substring(BUCKET, 1, 10)


def read_records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The stored records; bad ones and, for a replay, those without a time carry their text in `_corrupt_record`."""
    schema = KINDS[args.kind][0]
    time_col = args.ts_col if args.by_bucket else None
    if args.format == "json":
        return read_json_files(spark, args.input, schema, time_col, with_source=True)
    records = spark.read.parquet(args.input)
    if time_col is None:
        return records
    text = F.when(F.col(time_col).isNull(), F.to_json(F.struct(*records.columns)))
    return records.withColumns({CORRUPT_RECORD: text, SOURCE: F.col("_metadata.file_path")})


def in_range(records: DataFrame, args: argparse.Namespace) -> DataFrame:
    """Records of the replayed hours; the comparison reaches the scan."""
    if not args.start:
        return records
    start, end = aligned_range(args.start, args.end)
    zoned = isinstance(records.schema[args.ts_col].dataType, T.TimestampType)
    bounds = [F.lit(t if zoned else t.replace(tzinfo=None)) for t in (start, end)]
    return records.where((F.col(args.ts_col) >= bounds[0]) & (F.col(args.ts_col) < bounds[1]))


def bucketed(records: DataFrame, args: argparse.Namespace) -> DataFrame:
    zoned = isinstance(records.schema[args.ts_col].dataType, T.TimestampType)
    return records.withColumn(BUCKET, batch_time(args.ts_col, args.interval, zoned))


def with_mended(good: DataFrame, lines: DataFrame, args: argparse.Namespace, source: str) -> DataFrame:
    """`good` and the records of the JSON `lines`, of which bad ones go to the quarantine."""
    decoded = decode_timed(lines.withColumn(SOURCE, F.lit(source)), KINDS[args.kind][0], args.ts_col, [SOURCE])
    more, bad = split_bad(decoded)
    add_bad(bad, args.sink, args.kind)
    more = more.withColumn(args.ts_col, F.col(args.ts_col).cast(good.schema[args.ts_col].dataType))
    return good.unionByName(more.drop(SOURCE), allowMissingColumns=True)


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Run, write and commit the reports; returns their names."""
    _, catalog, make_set = KINDS[args.kind]
    names = args.reports.split(",") if args.reports else list(catalog)
    unknown = [n for n in names if n not in catalog]
    if unknown:
        raise ValueError(f"unknown {args.kind} reports: {unknown}; known: {sorted(catalog)}")
    if args.start:
        aligned_range(args.start, args.end)  # refuse a misaligned range before any work
    if args.days:
        return _run_days(spark, args, names)
    good, bad = split_bad(read_records(spark, args))
    if bad is not None:
        add_bad(bad, args.sink, args.kind)
    good = good.drop(SOURCE)
    by: list[str] = []
    mended_hours = None
    if args.by_bucket:
        by = [BUCKET]
        if args.mended:
            added = add_mended(spark.read.text(args.mended), args.sink, args.kind)
            mended_hours = bucketed(with_mended(good.limit(0), added.select("value"), args, "mended"), args)
            mended_hours = mended_hours.select(HOUR.alias("_hour")).distinct()
        stored = read_mended(spark, args.sink, args.kind).select("value")
        if not stored.isEmpty():
            good = with_mended(good, stored, args, "mended")
        good = bucketed(in_range(good, args), args)
        if mended_hours is not None:
            good = good.join(mended_hours, HOUR == F.col("_hour"), "left_semi")
        if args.partials:
            hours = aligned_range(args.start, args.end) if args.start else None
            entries = None if mended_hours is None else _hour_entries(mended_hours)
            store_partials(good, args.kind, partials_path(args.sink), args.ts_col, hours, entries, names)
    report_set = make_set(by=by)
    wanted = report_set.needed(names)
    shared = {n: report_set.shared[n](good).persist(StorageLevel.DISK_ONLY) for n in wanted}
    frames = {**shared, BATCH: good}
    run_id, written = new_run(), []
    try:
        for name in names:
            rows = report_set.reports[name](frames)
            outputs = {name: rows}
            if args.documents:
                write = report_parts if name in UNBOUNDED else report_documents
                outputs[f"{name}_document"] = write(name, rows, by)
            for label, out in outputs.items():
                write_rows(out, args.sink, label, run_id, F.col(BUCKET) if by else None)
                written.append(label)
        commit(spark, args.sink, run_id, _replaced(spark, args, written, run_id, mended_hours))
    finally:
        for df in shared.values():
            df.unpersist()
    return names


def _replaced(spark: SparkSession, args: argparse.Namespace, written: list[str], run_id: str, mended_hours: DataFrame | None) -> DataFrame:
    """(report, dt, hour) that the run's rows are the content of from now on."""
    if args.start:
        return hours_between(spark, written, *aligned_range(args.start, args.end))
    if not args.by_bucket:
        return spark.createDataFrame([(n, WHOLE, WHOLE) for n in written], "report string, dt string, hour string")
    if mended_hours is None:
        return replaced_by_all(spark, args.sink, written, run_id)
    names = spark.createDataFrame([(n,) for n in written], "report string")
    return names.join(_hour_entries(mended_hours))


def _hour_entries(hours: DataFrame) -> DataFrame:
    day = F.concat_ws("-", F.substring("_hour", 1, 4), F.substring("_hour", 5, 2), F.substring("_hour", 7, 2))
    return hours.select(day.alias("dt"), F.substring("_hour", 9, 2).alias("hour"))


def _run_days(spark: SparkSession, args: argparse.Namespace, names: list[str]) -> list[str]:
    """The days of the range from the stored partials; a day is stored under its first hour."""
    start, end = aligned_range(args.start, args.end, 86400)
    run_id, written = new_run(), []
    for name in names:
        label = f"{name}_day"
        rows = merged_report(spark, args.kind, name, partials_path(args.sink), start, end, per_day=True)
        write_rows(rows, args.sink, label, run_id, F.col(BUCKET))
        written.append(label)
    commit(spark, args.sink, run_id, hours_between(spark, written, start, end).where("hour = '00'"))
    return names


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName(f"flowstats-batch-{args.kind}").getOrCreate()
    run(spark, args)


if __name__ == "__main__":
    main()
