"""Report snapshots as a partitioned JSON table.

The original wrote one JSON file per report and 10-second batch under
`YYYY/MM/DD/HH/`. Here every row is stamped with `report`, `dt` and `hour`
and written with `partitionBy(...)` in dynamic-overwrite mode: writing a batch
again (a replay after a failure) replaces exactly its own partitions and
leaves every other batch alone, so the sink is idempotent.

The partitions are (report, day, hour), the grain in which jobs write: a run
over some hours replaces these hours and no other. A run must cover whole
partitions, or it would replace an hour by a part of it; `aligned_range`
checks that. Dynamic overwrite moves finished files into place when the job
commits, which needs a store with an atomic rename (HDFS, a local or network
file system). On an object store give every run a `path` of its own.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAMP_COLS = ["report", "dt", "hour"]
PARTITION_COLS = ["report", "dt", "hour"]


def stamp(df: DataFrame, report: str, batch_time: Column) -> DataFrame:
    """Add `report`, `dt` and `hour` from a `yyyyMMddHHmmss` batch-time column."""
    return df.select(
        "*",
        F.lit(report).alias("report"),
        F.concat_ws("-", F.substring(batch_time, 1, 4), F.substring(batch_time, 5, 2), F.substring(batch_time, 7, 2)).alias("dt"),
        F.substring(batch_time, 9, 2).alias("hour"),
    )


def aligned_range(start: str, end: str, grain_seconds: int = 3600) -> tuple[datetime, datetime]:
    """The half-open UTC range [start, end) of ISO times; both must lie on the partition grain."""
    out = []
    for text in (start, end):
        t = datetime.fromisoformat(text)
        t = t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)
        if t.microsecond or int(t.timestamp()) % grain_seconds:
            raise ValueError(f"{text!r} is not aligned to {grain_seconds} s, the grain of the written partitions")
        out.append(t)
    if out[0] >= out[1]:
        raise ValueError(f"empty range: {start!r} to {end!r}")
    return out[0], out[1]


def write_snapshot(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Write stamped rows; rewrites only the partitions present in `df`.

    The REBALANCE hint clusters rows by their partition (few files per
    partition instead of one per input task per partition) and lets AQE split
    a partition that is too large over several tasks, so one big batch or hour
    is not written by a single task.
    """
    parts = list(partition_cols or PARTITION_COLS)
    (
        df.hint("rebalance", *[F.col(p) for p in parts])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .json(path)
    )


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, stamp_cols: list[str] | None = None) -> DataFrame:
    """Read a snapshot table back with the report's schema plus its stamp columns.

    Stamp and partition columns are read as strings, so `hour` stays `'09'`.
    """
    extra = [c for c in (stamp_cols or STAMP_COLS) if c not in schema.fieldNames()]
    full = T.StructType(list(schema.fields) + [T.StructField(c, T.StringType()) for c in extra])
    return spark.read.schema(full).json(path)
