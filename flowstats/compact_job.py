"""Command-line upkeep of a sink: few files an hour, no unreachable rows.

    python -m flowstats.compact_job --sink hdfs://store/reports --before 2024-01-02T00 [--vacuum]

Hours before `--before` (UTC) that lie in several runs, as the batches of a stream do, are rewritten as one run each
(`flowstats.sinks.committed.compact`); hours that are still being written should not be named. `--vacuum` then folds the
commits into one and deletes the rows that no reader reaches any more. Both may run beside the jobs that write, and
again after a failure.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from flowstats.sinks.committed import compact, vacuum
from flowstats.sinks.snapshot import aligned_range


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="flowstats.compact_job", description=__doc__.split("\n\n")[0])
    p.add_argument("--sink", required=True)
    p.add_argument("--before", required=True, help="first hour to leave alone (ISO, UTC)")
    p.add_argument("--vacuum", action="store_true", help="also fold commits and delete unreachable rows")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[list[str], int]:
    """(reports rewritten, folders deleted)."""
    before = aligned_range("0001-01-01T00", args.before)[1].strftime("%Y-%m-%dT%H")
    return compact(spark, args.sink, before), vacuum(spark, args.sink) if args.vacuum else 0


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("flowstats-compact").getOrCreate()
    reports, deleted = run(spark, args)
    print(f"rewritten: {', '.join(reports) or 'nothing'}; folders deleted: {deleted}")


if __name__ == "__main__":
    main()
