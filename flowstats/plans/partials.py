"""Stored hourly partials, from which the reports of days and ranges are merged.

The shared aggregations of a report set hold sums and counts of non-NULL values only. Stored per hour, they add up to
those of any longer time, so a report over a day or a range reads 24 small tables an aggregation and day instead of
the records: exact, as all partials are whole numbers. The tables change by commits (`sinks.committed`): an hour that
is replayed takes the place of its partials, and every range that is merged later has it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.functions.columns import batch_time
from flowstats.plans.http_shared import http_report_set
from flowstats.plans.replay import BUCKET
from flowstats.plans.report_set import BATCH
from flowstats.plans.tcp_shared import tcp_report_set
from flowstats.schemas import HTTP_SCHEMA, TCP_SCHEMA
from flowstats.sinks.committed import commit, hours_between, new_run, read_committed, replaced_by_all, write_rows

SETS = {"http": (http_report_set, HTTP_SCHEMA), "tcp": (tcp_report_set, TCP_SCHEMA)}
#: Keys of the shared aggregations; every other column is a sum or a count.
KEYS = {
    "http": {"url": ["dst_group_id", "url", "status_class"], "server": ["dst_group_id", "dst_ipv4"], "status": ["dst_group_id", "status_code"]},
    "tcp": {"pair": ["dst_group_id", "dst_ipv4"], "volume": ["dst_group_id", "l7_proto", "dst_port"]},
}


def partials_path(sink_path: str) -> str:
    return f"{sink_path.rstrip('/')}-partials"


def _table(kind: str, frame: str) -> str:
    return f"{kind}_{frame}"


def partial_schemas(spark: SparkSession, kind: str) -> dict[str, T.StructType]:
    """Schema of each stored table: the time bucket, the keys and the partials."""
    make_set, records = SETS[kind]
    empty = spark.createDataFrame([], T.StructType([*records.fields, T.StructField(BUCKET, T.StringType())]))
    return {name: build(empty).schema for name, build in make_set(by=[BUCKET]).shared.items()}


def store_partials(
    records: DataFrame,
    kind: str,
    path: str,
    ts_col: str = "ts",
    hours: tuple[datetime, datetime] | None = None,
    only: DataFrame | None = None,
    reports: list[str] | None = None,
) -> None:
    """Store the hourly partials of records, which take the place of all stored ones, of the whole hours in the range
    `hours`, or of the hours `only` (dt, hour).

    One aggregation and one write per table that `reports` (all, by default) are derived from; records without a time belong to no hour and are left out.
    """
    spark, make_set = records.sparkSession, SETS[kind][0]
    zoned = isinstance(records.schema[ts_col].dataType, T.TimestampType)
    hourly = records.withColumn(BUCKET, batch_time(ts_col, "1 hour", zoned)).where(F.col(BUCKET).isNotNull())
    run, tables = new_run("partials"), []
    report_set = make_set(by=[BUCKET])
    for frame in report_set.shared if reports is None else report_set.needed(reports):
        build = report_set.shared[frame]
        write_rows(build(hourly), path, _table(kind, frame), run, F.col(BUCKET), fmt="parquet")
        tables.append(_table(kind, frame))
    if only is not None:
        entries = spark.createDataFrame([(t,) for t in tables], "report string").join(only)
    elif hours is not None:
        entries = hours_between(spark, tables, *hours)
    else:
        entries = replaced_by_all(spark, path, tables, run, "parquet")
    commit(spark, path, run, entries)


def merged_frames(
    spark: SparkSession, kind: str, path: str, start: datetime | None = None, end: datetime | None = None, per: Column | None = None
) -> dict[str, DataFrame]:
    """The shared aggregations of the hours in [start, end), added up; per value of `per` (of the bucket) where given.

    The hours are picked by folder, before any file is read.
    """
    frames = {}
    for frame, schema in partial_schemas(spark, kind).items():
        rows = read_committed(spark, path, schema, _table(kind, frame), fmt="parquet")
        hour = F.concat_ws("T", "dt", "hour")
        for bound, keep in ((start, hour.__ge__), (end, hour.__lt__)):
            if bound is not None:
                rows = rows.where(keep(bound.strftime("%Y-%m-%dT%H")))
        if start is not None:
            rows = rows.where(F.col("dt") >= start.strftime("%Y-%m-%d"))
        if end is not None:
            rows = rows.where(F.col("dt") <= end.strftime("%Y-%m-%d"))
        keys = KEYS[kind][frame]
        sums = [F.sum(c).alias(c) for c in schema.fieldNames() if c not in (BUCKET, *keys)]
        leading = [] if per is None else [per.alias(BUCKET)]
        frames[frame] = rows.groupBy(*leading, *keys).agg(*sums)
    return frames


def merged_report(
    spark: SparkSession, kind: str, report: str, path: str, start: datetime | None = None, end: datetime | None = None, per_day: bool = False
) -> DataFrame:
    """A report over the stored hours in [start, end), from their partials; `per_day` gives it for every day (`batch_time`)."""
    per = F.concat(F.substring(BUCKET, 1, 8), F.lit("000000")) if per_day else None
    make_set = SETS[kind][0]
    frames = merged_frames(spark, kind, path, start, end, per)
    return make_set(by=[BUCKET] if per_day else []).reports[report]({**frames, BATCH: None})
