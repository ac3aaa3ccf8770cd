"""Batch replay of the micro-batch reports over stored history.

A streaming job reports once per 10-second batch. On stored records the same
results come from adding the record's 10-second bucket as a leading key to a
report (`by=[bucket]`): aggregations group by it, top-k lists rank within it
and `all` rows are per bucket. It is one plan for all buckets, not a loop
over them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowstats.functions.columns import batch_time
from flowstats.schemas import BATCH_INTERVAL

BUCKET = "batch_time"


def replay_by_bucket(
    records: DataFrame,
    report: Callable[..., DataFrame],
    ts_col: str = "ts",
    interval: str = BATCH_INTERVAL,
    bucket_col: str = BUCKET,
    **options,
) -> DataFrame:
    """`report` per tumbling `interval` bucket of `ts_col` (bucket as `yyyyMMddHHmmss`)."""
    zoned = isinstance(records.schema[ts_col].dataType, T.TimestampType)
    bucketed = records.withColumn(bucket_col, batch_time(ts_col, interval, zoned))
    return report(bucketed, by=[bucket_col], **options)
