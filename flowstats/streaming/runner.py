"""Run reports on every micro-batch of a Structured Streaming source.

The original cut a Kafka stream into 10-second batches and ran its SQL on each
one. Here `writeStream.trigger(processingTime=...)` cuts the batches and
`foreachBatch` runs any set of reports on them. Top-k windows are not
allowed on streaming frames, but inside `foreachBatch` the batch is a plain
DataFrame, so the batch reports are reused unchanged.

Fault tolerance: offsets are checkpointed, so a failed batch is replayed with
the same `batch_id` and the same records. All reports of a batch are written
into folders of their own and appear together, by one commit (`sinks.committed`),
as the part of their hour that the query's batch is; a replay takes the place of
that part instead of adding duplicates. The day and hour are those of
the batch's earliest source time, which a replay finds again.

Bad records (`_corrupt_record`) never reach a report: they are stored in the
sink's quarantine (`sinks.quarantine`), with the batch's time.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowstats.functions.columns import interval_seconds
from flowstats.plans.report_set import BATCH, ReportSet
from flowstats.schemas import BATCH_INTERVAL, CORRUPT_RECORD
from flowstats.sinks.committed import commit, new_run, write_rows
from flowstats.sinks.quarantine import add_bad, quarantine_path
from flowstats.sources.json_records import SOURCE, split_bad

__all__ = ["STREAM_PARTITIONS", "process_batch", "quarantine_path", "run_reports"]

Report = Callable[[DataFrame], DataFrame]
#: Columns besides a report's own that `read_committed` gives for rows of a stream.
STREAM_PARTITIONS = ["report", "dt", "hour", "batch_id"]


def _batch_time(batch: DataFrame, time_col: str | None, bucket_seconds: int) -> str:
    """`yyyyMMddHHmmss` (UTC) start of the batch's time bucket, the same for all its reports."""
    seconds = None
    if time_col is not None:
        # Stable on replay: the records' earliest time, read once for the batch.
        seconds = batch.agg(F.unix_seconds(F.min(time_col).cast("timestamp"))).first()[0]
    if seconds is None:
        # Wall clock, only where the source gives no time: a replay may then stamp another hour.
        seconds = int(time.time())
    return time.strftime("%Y%m%d%H%M%S", time.gmtime(seconds - seconds % bucket_seconds))


def _part(batch: DataFrame, batch_id: int) -> str:
    """Name of the batch among all queries that write to the sink; a replay and a restart of the query have it again."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or 'query'}-{batch_id}"


def process_batch(
    batch: DataFrame,
    batch_id: int,
    reports: dict[str, Report] | ReportSet,
    sink_path: str,
    time_col: str | None = None,
    bucket_seconds: int = 10,
    parallel_reports: int = 8,
    persist: bool = True,
    kind: str = "records",
) -> None:
    """Run every report on one micro-batch and commit their rows to the sink.

    Reports are submitted from up to `parallel_reports` threads, so their
    (often small) jobs share the cluster instead of queueing one after the
    other; each writes its own folder, so the writes do not conflict. `kind`
    names the records in the quarantine.

    `persist` caches the batch once for all reports, which is what a decoded
    Kafka or JSON batch needs (decoding costs more than caching). A batch read
    from a columnar table is cheaper to re-read than to cache: pass False.

    With a `ReportSet`, its shared aggregations are built once per batch and
    cached (they are small next to the batch) while every report derived from
    them is written.
    """
    if persist:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    shared: dict[str, DataFrame] = {}
    try:
        # With persist, counting fills the cache for every report in one pass.
        empty = batch.count() == 0 if persist else batch.isEmpty()
        if empty:
            return
        when, part = _batch_time(batch, time_col, bucket_seconds), _part(batch, batch_id)
        good, bad = split_bad(batch)
        if bad is not None and not bad.isEmpty():
            add_bad(bad, sink_path, kind, F.lit(when), part)
            if good.isEmpty():
                return
        good = good.drop(SOURCE)
        workers = max(1, parallel_reports)
        # Pool threads take the query's job group along, so that stopping the query cancels their jobs.
        carried = inheritable_thread_target(batch.sparkSession)
        with ThreadPoolExecutor(max_workers=workers) as pool:
            if isinstance(reports, ReportSet):
                shared = {n: build(good).persist(StorageLevel.MEMORY_AND_DISK) for n, build in reports.shared.items()}
                for done in [pool.submit(carried(df.count)) for df in shared.values()]:
                    done.result()
                frames = {**shared, BATCH: good}
                jobs = {name: (lambda fn=fn: fn(frames)) for name, fn in reports.reports.items()}
            else:
                jobs = {name: (lambda fn=fn: fn(good)) for name, fn in reports.items()}

            run_id = new_run(f"batch-{batch_id}")

            def run(name: str, build: Callable[[], DataFrame]) -> None:
                rows = build().select("*", F.lit(batch_id).alias("batch_id"), F.lit(when).alias("batch_time"))
                write_rows(rows, sink_path, name, run_id, F.col("batch_time"))

            for done in [pool.submit(carried(run), name, build) for name, build in jobs.items()]:
                done.result()  # re-raises a report's failure, failing the batch
        hour = (f"{when[:4]}-{when[4:6]}-{when[6:8]}", when[8:10])
        entries = batch.sparkSession.createDataFrame([(n, *hour) for n in jobs], "report string, dt string, hour string")
        commit(batch.sparkSession, sink_path, run_id, entries, part)
    finally:
        for df in shared.values():
            df.unpersist()
        if persist:
            batch.unpersist()


def run_reports(
    records: DataFrame,
    reports: dict[str, Report] | ReportSet,
    sink_path: str,
    checkpoint_location: str,
    interval: str = BATCH_INTERVAL,
    available_now: bool = False,
    time_col: str | None = None,
    query_name: str | None = None,
    parallel_reports: int = 8,
    kind: str = "records",
) -> StreamingQuery:
    """Start a streaming query that runs `reports` on each micro-batch.

    `interval` is the processing-time trigger (the original's 10 s, here a
    real parameter); `available_now` processes what is there and stops.
    """
    seconds = interval_seconds(interval)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, reports, sink_path, time_col, seconds, parallel_reports, kind=kind)

    writer = records.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
