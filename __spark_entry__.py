"""

Every query reads the stored tables of `sf_dir` through the flow-record
derivations of `flowstats.sources.tables` (HTTP requests from `events` +
`pages`, TCP flows from `lineitem`) and runs over all of their rows.
`oracle_sql()` holds an independent DuckDB text per query: the same flow
derivation as CTEs, then plain SQL (UNION ALL of metrics, self-joins,
GROUPING SETS) where the Spark side uses stack, windows and roll-ups.
Averages and rates are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import timedelta
from pathlib import Path

# The package sits next to this file; make it importable however this module is loaded.
_ROOT = str(Path(__file__).resolve().parent)
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.functions.columns import (
    EXTENSION_PATTERN,
    HOST_PATTERN,
    batch_time,
    is_static,
    status_class,
    url_extension,
    url_host,
)
from flowstats.operators import http as http_ops
from flowstats.operators import tcp as tcp_ops
from flowstats.plans import http_reports as H
from flowstats.plans import tcp_reports as TR
from flowstats.plans.http_shared import http_report_set
from flowstats.plans.partials import merged_report, store_partials
from flowstats.plans.tcp_shared import tcp_report_set
from flowstats.plans.replay import replay_by_bucket
from flowstats.schemas import CORRUPT_RECORD, HTTP_SCHEMA, OVERALL_METRICS, STATIC_EXTENSIONS, STATUS_CLASSES, TCP_SCHEMA, TOP_K
from flowstats.session import checkpoint_dir
from flowstats.sinks.documents import keyed_document, report_documents, report_parts
from flowstats.sinks.quarantine import add_bad, read_quarantine
from flowstats.sinks.committed import commit, compact, hours_between, new_run, read_committed, replaced_by_all, write_rows, written_hours
from flowstats.sinks.snapshot import read_snapshot, stamp, write_snapshot
from flowstats.sources.json_records import decode_json, encode_json, split_bad, stream_json_files
from flowstats.sources.tables import http_flows, read_table, tcp_flows, tcp_flows_from
from flowstats.streaming.runner import STREAM_PARTITIONS, run_reports

SMOKE_DIR = "/root/testdata/sf0.001"


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns so both engines hash the same values."""
    if not any(isinstance(f.dataType, T.DoubleType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _on_http(report: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(report(http_flows(spark, sf_dir)))

    return run


def _on_tcp(report: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(report(tcp_flows(spark, sf_dir)))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: top 50 hosts per group for each metric (R3), sf0.001."""
    return queries()["http_top_host"](spark, SMOKE_DIR)


# ---------------------------------------------------------------------------
# Queries that are not a single report call.
# ---------------------------------------------------------------------------


def _host_extract(http: DataFrame) -> DataFrame:
    return http.select("event_id", "url", url_host().alias("host"))


def _url_class(http: DataFrame) -> DataFrame:
    return http.select("event_id", "url", url_extension().alias("url_ext"), is_static().alias("is_static"))


def _status_class(http: DataFrame) -> DataFrame:
    return http.select("event_id", "status_code", status_class().alias("status_class"))


def _json_decode(http: DataFrame) -> DataFrame:
    # Round trip through JSON text: the path every streamed message takes.
    return decode_json(encode_json(http), HTTP_SCHEMA)


def _bytes_per_bucket(http: DataFrame) -> DataFrame:
    return (
        http.where(F.col("dst_group_id").isNotNull())
        .groupBy(batch_time("ts").alias("batch_time"), "dst_group_id")
        .agg(*http_ops.sum_metrics(OVERALL_METRICS))
    )


def _by_bucket(report: Callable[..., DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda flows: replay_by_bucket(flows, report)


def _from_shared(name: str, make_set=http_report_set) -> Callable[[DataFrame], DataFrame]:
    """One report derived from the aggregations a streaming job shares per batch."""

    def run(flows: DataFrame) -> DataFrame:
        report_set = make_set()
        return report_set.reports[name](report_set.frames(flows))

    return run


def _status_document(http: DataFrame) -> DataFrame:
    return keyed_document(H.status_counts(http), ["dst_group_id"], "status_code", "requests")


def _snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the per-bucket report as a (report, day, hour)-partitioned JSON table, read it back."""
    path = f"{checkpoint_dir(spark)}/snapshot_roundtrip/{uuid.uuid4().hex}"
    report = _bytes_per_bucket(http_flows(spark, sf_dir))
    schema = report.schema
    write_snapshot(stamp(report, "http_bytes_per_bucket", F.col("batch_time")), path)
    return read_snapshot(spark, path, schema)


def _snapshot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the halves of every day, then a replay of the first half: nothing is lost or doubled."""
    path = f"{checkpoint_dir(spark)}/snapshot_incremental/{uuid.uuid4().hex}"
    report = _bytes_per_bucket(http_flows(spark, sf_dir))
    rows = stamp(report, "http_bytes_per_bucket", F.col("batch_time"))
    for half in (F.col("hour") < "12", F.col("hour") >= "12", F.col("hour") < "12"):
        write_snapshot(rows.where(half), path)
    return read_snapshot(spark, path, report.schema)


def _replay_emptied_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay of all days that finds hour 05 empty empties it; a run that was killed before its commit is not seen."""
    path = f"{checkpoint_dir(spark)}/snapshot_replay_emptied_hour/{uuid.uuid4().hex}"
    flows, name = http_flows(spark, sf_dir), "http_bytes_per_bucket"
    report = _bytes_per_bucket(flows)
    first, replay = new_run(), new_run()
    write_rows(report, path, name, first, F.col("batch_time"))
    commit(spark, path, first, replaced_by_all(spark, path, [name], first))
    left = report.where(F.substring("batch_time", 9, 2) != "05")
    write_rows(left, path, name, replay, F.col("batch_time"))
    days = flows.agg(F.to_date(F.min("ts")).cast("timestamp").alias("a"), F.to_date(F.max("ts")).cast("timestamp").alias("z")).first()
    commit(spark, path, replay, hours_between(spark, [name], days.a, days.z + timedelta(days=1)))
    write_rows(report, path, name, new_run(), F.col("batch_time"))  # killed here
    return read_committed(spark, path, report.schema, name)


def _stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches in every hour, rewritten as one run per hour; a second compaction finds nothing to do."""
    path = f"{checkpoint_dir(spark)}/snapshot_compacted/{uuid.uuid4().hex}"
    report, name = _bytes_per_bucket(http_flows(spark, sf_dir)), "http_bytes_per_bucket"
    for batch in range(3):
        run, mine = new_run(), F.pmod(F.xxhash64("batch_time", "dst_group_id"), F.lit(3)) == batch
        write_rows(report.where(mine), path, name, run, F.col("batch_time"))
        commit(spark, path, run, written_hours(spark, path, [name], run), part=f"query-{batch}")
    for _ in range(2):
        compact(spark, path, before="9999-01-01T00")
    return read_committed(spark, path, report.schema, name)


def _days_from_hours(kind: str, name: str, flows_of: Callable[[SparkSession, str], DataFrame]):
    """A report per day, merged from stored hourly partials."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{checkpoint_dir(spark)}/partials/{uuid.uuid4().hex}"
        store_partials(flows_of(spark, sf_dir), kind, path, reports=[name])
        return _rounded(merged_report(spark, kind, name, path, per_day=True))

    return run


def _quarantine_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the even records, one over all, and that one again: every bad record is kept once."""
    sink = f"{checkpoint_dir(spark)}/quarantine_two_runs/{uuid.uuid4().hex}"
    http = http_flows(spark, sf_dir)
    for records in (http.where("event_id % 2 = 0"), http, http):
        _, bad = split_bad(decode_json(_mixed_messages(records), HTTP_SCHEMA))
        add_bad(bad, sink, "http")
    return read_quarantine(spark, sink).select("kind", "bad_record", "copies")


def _json_unknown_fields(http: DataFrame) -> DataFrame:
    """Requests per client, a field that the schema does not have; text after a record makes it a bad one."""
    client = F.struct(F.concat(F.lit("client-"), (F.col("event_id") % 7).cast("string")).alias("name"))
    message = F.to_json(F.struct(*[F.col(f.name) for f in HTTP_SCHEMA.fields], client.alias("client")))
    trailing = F.when(F.col("event_id") % 11 == 0, F.lit(" x")).otherwise(F.lit(""))
    messages = http.select(F.concat(message, trailing).alias("value"))
    good, _ = split_bad(decode_json(messages, HTTP_SCHEMA, extra_col="extra"))
    name = F.try_variant_get("extra", "$.client.name", "string").alias("client")
    return good.groupBy(name).agg(F.count(F.lit(1)).alias("requests"))


def _http_document_parts(http: DataFrame) -> DataFrame:
    return report_parts("http", H.url_totals(http), size=40)


def _server_document_parts(tcp: DataFrame) -> DataFrame:
    rows = TR.server_summary(tcp).select("dst_group_id", "dst_ipv4", "bytes_total", "counter", "closed")
    return report_parts("tcp_server_10s", rows, size=7)


def _mixed_messages(http: DataFrame) -> DataFrame:
    """Flows as JSON messages with cases mixed in by id: bad text and fields, blanks, tombstones, arrays, quoted numbers."""
    eid = F.col("event_id")
    group = F.col("dst_group_id").cast("string")
    plain = F.to_json(F.struct(*[F.col(f.name) for f in HTTP_SCHEMA.fields]))
    small = F.concat(F.lit('{"in_bytes":"'), eid.cast("string"), F.lit('","out_bytes":'), eid.cast("string"), F.lit(".0}"))
    value = (
        F.when(eid % 13 == 0, F.concat(F.lit("junk "), eid.cast("string")))
        .when(eid % 13 == 1, F.concat(F.lit('{"dst_group_id":"x'), eid.cast("string"), F.lit('"}')))
        .when(eid % 13 == 2, F.lit("  "))
        .when(eid % 13 == 3, F.lit(None).cast("string"))
        .when(eid % 13 == 4, F.concat(F.lit("["), small, F.lit(","), small, F.lit("]")))
        .when(eid % 13 == 5, small)
        .when(
            (eid % 13 == 6) & group.isNotNull(),
            F.concat(F.lit('{"dst_group_id":"'), group, F.lit('","status_code":200.0}')),
        )
        .otherwise(plain)
    )
    return http.select(value.alias("value"))


def _json_decode_mixed(http: DataFrame) -> DataFrame:
    good, _ = split_bad(decode_json(_mixed_messages(http), HTTP_SCHEMA))
    return good


def _json_quarantine(http: DataFrame) -> DataFrame:
    _, bad = split_bad(decode_json(_mixed_messages(http), HTTP_SCHEMA))
    return bad.select(F.col(CORRUPT_RECORD).alias("bad_record"))


def _static_dynamic_of_good(http: DataFrame) -> DataFrame:
    """R7 over decoded messages: bad ones count nowhere."""
    good, _ = split_bad(decode_json(_mixed_messages(http), HTTP_SCHEMA))
    return H.static_dynamic(good)


def _server_document(http: DataFrame) -> DataFrame:
    return report_documents("http_server", H.top_servers(http))


def _proto_document(tcp: DataFrame) -> DataFrame:
    return report_documents("tcp_proto_10s", TR.proto_bytes(tcp))


#: Flows in one of the files that a stream reads, at most; as JSON some 400 MB.
FILE_FLOWS = 1_000_000


def _slices(spark: SparkSession, rows: DataFrame, path: str) -> list[DataFrame]:
    """`rows`, written to `path` once, as frames of whole files there: a file of `FILE_FLOWS` rows for each core, two at least."""
    rows.write.option("maxRecordsPerFile", FILE_FLOWS).option("compression", "zstd").parquet(path)
    reader = spark.read.schema(rows.schema)
    counts = reader.parquet(path).groupBy("_metadata.file_name").count().collect()
    most, taken, room = FILE_FLOWS * max(2, spark.sparkContext.defaultParallelism), [], 0
    for name, n in sorted(map(tuple, counts)):
        if n > room:
            taken.append([])
            room = most
        taken[-1].append(f"{path}/{name}")
        room -= n
    return [reader.parquet(*files) for files in taken] or [rows]


def _through_stream(
    spark: SparkSession,
    rows: DataFrame,
    schema: T.StructType,
    name: str,
    report: Callable[[DataFrame], DataFrame],
    flows_of: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Flows as JSON files -> file stream -> `report` per micro-batch -> sink; rows read back.

    `flows_of` makes the flows of any part of `rows`. JSON takes many times the room of the rows that it is made of, so
    a slice of it is there at a time: the query is started from its checkpoint for each, and what it has read gives way
    to the next.
    """
    root = f"{checkpoint_dir(spark)}/stream_{name}/{uuid.uuid4().hex}"
    for part in _slices(spark, rows, f"{root}/rows"):
        encode_json(flows_of(part)).write.mode("overwrite").option("maxRecordsPerFile", FILE_FLOWS).text(f"{root}/source")
        records = stream_json_files(spark, f"{root}/source", schema, max_files_per_trigger=2)
        query = run_reports(records, {name: report}, f"{root}/sink", f"{root}/checkpoint", available_now=True)
        query.awaitTermination()
    for folder in ("rows", "source"):
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(done, True)
    out_schema = T.StructType(report(flows_of(rows)).schema.fields + [T.StructField("batch_time", T.StringType())])
    return read_committed(spark, f"{root}/sink", out_schema, stamp_cols=STREAM_PARTITIONS)


def _stream_http_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status counts through the streaming runner, summed over micro-batches."""
    out = _through_stream(spark, http_flows(spark, sf_dir), HTTP_SCHEMA, "http_status", H.status_counts)
    return out.groupBy("dst_group_id", "status_code").agg(F.sum("requests").alias("requests"))


def _stream_tcp_proto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TCP bytes by protocol through the streaming runner, summed over micro-batches."""
    rows = read_table(spark, sf_dir, "lineitem")
    out = _through_stream(spark, rows, TCP_SCHEMA, "tcp_proto_10s", TR.proto_bytes, tcp_flows_from)
    return out.groupBy("is_all", "dst_group_id", "l7_proto").agg(
        *[F.sum(c).alias(c) for c in ("total_bytes", "bytes_in", "bytes_out")]
    )


def _training_data() -> tuple[dict, dict]:
    """(queries, oracle SQL) of the training-data operators; empty where that subpackage is not installed."""
    from importlib.util import find_spec

    if find_spec("flowstats.llm") is None or find_spec("flowstats.llm.queries") is None:
        return {}, {}
    from flowstats.llm.queries import ORACLE_SQL, QUERIES

    named, sql = dict(QUERIES), dict(ORACLE_SQL)
    if find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        named["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return named, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # HTTP reports R1-R12
        "http_url_totals": _on_http(H.url_totals),
        "http_top_url": _on_http(H.top_urls),
        "http_top_host": _on_http(H.top_hosts),
        "http_top_server": _on_http(H.top_servers),
        "http_status_counts": _on_http(H.status_counts),
        "http_top_url_status": _on_http(H.top_url_status),
        "http_static_dynamic": _on_http(H.static_dynamic),
        "http_overall_top_url": _on_http(H.overall_top_urls),
        "http_overall_top_host": _on_http(H.overall_top_hosts),
        "http_overall_top_server": _on_http(H.overall_top_servers),
        "http_overall_status_counts": _on_http(H.overall_status_counts),
        "http_overall_top_url_status": _on_http(H.overall_top_url_status),
        # HTTP aggregations and scalar operators on their own
        "http_host_totals": _on_http(http_ops.host_totals),
        "http_server_totals": _on_http(http_ops.server_totals),
        "http_overall_url": _on_http(http_ops.overall_url),
        "http_overall_host": _on_http(http_ops.overall_host),
        "http_overall_server": _on_http(http_ops.overall_server),
        "http_url_status_long": _on_http(http_ops.url_status_long),
        "http_overall_url_status_long": _on_http(http_ops.overall_url_status_long),
        "http_host_extract": _on_http(_host_extract),
        "http_url_class": _on_http(_url_class),
        "http_status_class": _on_http(_status_class),
        "http_groups": _on_http(http_ops.groups),
        "http_bytes_per_bucket": _on_http(_bytes_per_bucket),
        # Reports replayed per 10-second bucket of stored history
        "http_status_by_bucket": _on_http(_by_bucket(H.status_counts)),
        "http_top_host_by_bucket": _on_http(_by_bucket(H.top_hosts)),
        "http_top_url_status_by_bucket": _on_http(_by_bucket(H.top_url_status)),
        "http_overall_top_server_by_bucket": _on_http(_by_bucket(H.overall_top_servers)),
        # HTTP reports derived from the shared aggregations of one batch
        "http_shared_top_server": _on_http(_from_shared("http_server")),
        "http_shared_overall_top_url": _on_http(_from_shared("http_filter_url")),
        "http_shared_overall_top_url_status": _on_http(_from_shared("http_filter_url_status")),
        "tcp_shared_group_summary": _on_tcp(_from_shared("tcp_10s", tcp_report_set)),
        # TCP reports R13-R16 and their aggregations
        "tcp_proto_bytes": _on_tcp(TR.proto_bytes),
        "tcp_port_bytes": _on_tcp(TR.port_bytes),
        "tcp_group_summary": _on_tcp(TR.group_summary),
        "tcp_server_summary": _on_tcp(TR.server_summary),
        "tcp_conn_by_group": _on_tcp(tcp_ops.connections_by_group),
        "tcp_traffic_by_group": _on_tcp(tcp_ops.traffic_by_group),
        "tcp_conn_by_server": _on_tcp(tcp_ops.connections_by_server),
        "tcp_traffic_by_server": _on_tcp(tcp_ops.traffic_by_server),
        "tcp_dimensions": _on_tcp(tcp_ops.dimensions),
        "tcp_groups": _on_tcp(http_ops.groups),
        "tcp_port_bytes_by_bucket": _on_tcp(_by_bucket(TR.port_bytes)),
        "tcp_group_summary_by_bucket": _on_tcp(_by_bucket(TR.group_summary)),
        "tcp_server_summary_by_bucket": _on_tcp(_by_bucket(TR.server_summary)),
        # Sources, sinks, streaming
        "json_decode_http": _on_http(_json_decode),
        "json_decode_mixed": _on_http(_json_decode_mixed),
        "json_quarantine": _on_http(_json_quarantine),
        "json_static_dynamic": _on_http(_static_dynamic_of_good),
        "group_document": _on_http(_status_document),
        "http_server_document": _on_http(_server_document),
        "tcp_proto_document": _on_tcp(_proto_document),
        "http_document": _on_http(_http_document_parts),
        "tcp_server_document": _on_tcp(_server_document_parts),
        "json_unknown_fields": _on_http(_json_unknown_fields),
        "http_top_host_per_day_from_hours": _days_from_hours("http", "http_host", http_flows),
        "http_overall_top_server_per_day_from_hours": _days_from_hours("http", "http_filter_server", http_flows),
        "quarantine_two_runs": _quarantine_two_runs,
        "snapshot_compacted": _stream_compacted,
        "snapshot_replay_emptied_hour": _replay_emptied_hour,
        "snapshot_incremental": _snapshot_incremental,
        "snapshot_roundtrip": _snapshot_roundtrip,
        "stream_http_status": _stream_http_status,
        "stream_tcp_proto": _stream_tcp_proto,
        **_training_data()[0],
    }


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

HTTP_CTE = """http_flows AS (
  SELECT e.event_id, e.ts,
    CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE e.user_id % 5 END AS dst_group_id,
    CASE WHEN e.event_id % 71 <> 0 THEN '10.0.' || CAST(e.user_id % 4 AS VARCHAR) || '.'
         || CAST((e.event_id * 7 + e.user_id) % 200 AS VARCHAR) END AS dst_ipv4,
    CASE WHEN e.event_id % 53 = 0 THEN NULL
         WHEN e.event_id % 37 = 0 THEN 'https://user:pw@' || regexp_extract(p.url, '^https?://([^/?#]+)', 1) || ':8443?q='
              || CAST(e.event_id % 7 AS VARCHAR)
         WHEN e.event_id % 4 = 0 THEN regexp_extract(p.url, '^https?://([^/?#]+)', 1) || ':8080/static/f'
              || CAST(e.event_id % 10 AS VARCHAR)
              || CASE e.event_id % 3 WHEN 0 THEN '.js' WHEN 1 THEN '.png' ELSE '.html' END
         ELSE regexp_extract(p.url, '^https?://(.*)$', 1) END AS url,
    CASE WHEN e.event_id % 41 = 0 THEN NULL WHEN e.event_id % 43 = 0 THEN 'n/a' WHEN e.event_id % 47 = 0 THEN '999'
         WHEN e.event_id % 59 = 0 THEN '0' ELSE CAST(CASE (e.event_id * 7 + e.user_id) % 11 WHEN 0 THEN 100 WHEN 1 THEN 204 WHEN 2 THEN 301 WHEN 3 THEN 302
         WHEN 4 THEN 404 WHEN 5 THEN 403 WHEN 6 THEN 500 WHEN 7 THEN 503 ELSE 200 END AS VARCHAR) END AS status_code,
    CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE (e.event_id * 13) % 1500 + 40 END AS in_bytes,
    (e.event_id * 31) % 20000 AS out_bytes,
    e.event_id % 3 AS latency_sec,
    (e.event_id * 7919) % 1000000 AS latency_usec
  FROM events e LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))"""

TCP_CTE = """tcp_flows AS (
  SELECT CASE WHEN (l_orderkey + l_partkey) % 31 <> 0 THEN l_suppkey % 4 END AS dst_group_id,
    '10.1.' || CAST(l_suppkey % 3 AS VARCHAR) || '.' || CAST(l_suppkey % 25 AS VARCHAR) AS dst_ipv4,
    CAST(CASE WHEN (l_orderkey + l_partkey) % 37 = 0 THEN NULL ELSE CASE l_partkey % 5 WHEN 0 THEN 80 WHEN 1 THEN 443
         WHEN 2 THEN 22 WHEN 3 THEN 3306 ELSE 8080 END END AS BIGINT) AS dst_port,
    CASE WHEN (l_orderkey + l_partkey) % 41 <> 0 THEN l_partkey % 6 END AS l7_proto,
    CAST(CASE WHEN (l_orderkey + l_partkey) % 43 <> 0 THEN (l_orderkey * 7 + l_linenumber) % 9 END AS BIGINT) AS final_status,
    CAST(CASE WHEN (l_orderkey + l_partkey) % 47 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS unknown_conn,
    CASE WHEN (l_orderkey + l_partkey) % 53 <> 0 THEN (l_orderkey * 13) % 1500 END AS in_bytes, (l_partkey * 31) % 9000 AS out_bytes,
    (l_orderkey * 3) % 40 AS in_pkts, (l_partkey * 5) % 60 AS out_pkts,
    l_orderkey % 3 AS retransmitted_in_pkts, l_partkey % 2 AS retransmitted_out_pkts,
    l_orderkey % 2 AS ooorder_in_pkts, l_partkey % 3 AS ooorder_out_pkts,
    CAST(CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS BIGINT) AS tcp_window_size_zero,
    l_orderkey % 2 AS client_latency_sec, (l_orderkey * 7919) % 1000000 AS client_latency_usec,
    l_partkey % 2 AS server_latency_sec, (l_partkey * 104729) % 1000000 AS server_latency_usec,
    l_shipdate AS ts
  FROM lineitem)"""

GROUP_NAMES = ["bytes_total", "bytes_in", "bytes_out", "latency", "requests"]
OVERALL_NAMES = ["total_bytes", "in_bytes", "out_bytes", "latency", "requests"]
STATIC_SQL = ", ".join(f"'{e}'" for e in STATIC_EXTENSIONS)
CLASS_SQL = "CAST(CAST(floor(TRY_CAST(status_code AS INTEGER) / 100) AS BIGINT) AS VARCHAR) || 'xx'"
HOST_SQL = f"regexp_extract(url, '{HOST_PATTERN}', 1)"
EXT_SQL = f"regexp_extract(url, '{EXTENSION_PATTERN}', 1)"


def _http_sql(body: str) -> str:
    return f"WITH {HTTP_CTE}, {body}" if not body.lstrip().upper().startswith("SELECT") else f"WITH {HTTP_CTE} {body}"


def _tcp_sql(body: str) -> str:
    return f"WITH {TCP_CTE}, {body}" if not body.lstrip().upper().startswith("SELECT") else f"WITH {TCP_CTE} {body}"


def _sum5(names: list[str]) -> str:
    t, i, o, lat, r = names
    return (
        f"CAST(sum(in_bytes + out_bytes) AS BIGINT) AS {t}, CAST(sum(in_bytes) AS BIGINT) AS {i}, "
        f"CAST(sum(out_bytes) AS BIGINT) AS {o}, CAST(sum(latency_sec * 1000000 + latency_usec) AS BIGINT) AS {lat}, "
        f"count(*) AS {r}"
    )


AVG5 = (
    "CAST(sum(in_bytes + out_bytes) AS BIGINT) AS total_bytes, avg(in_bytes) AS in_bytes, avg(out_bytes) AS out_bytes, "
    "avg(latency_sec * 1000000 + latency_usec) AS latency, count(*) AS requests"
)


def _topk(agg_sql: str, metrics: list[str], key: str, partition: list[str], value_type: str, rounded: list[str] = ()) -> str:
    long = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS {value_type}) AS _v, * FROM agg" for m in metrics)
    part = ", ".join(["metric", *partition])
    out = ", ".join(
        ["metric", *partition, 'CAST(_rk AS INTEGER) AS "rank"', key]
        + [f"round({m}, 6) AS {m}" if m in rounded else m for m in metrics]
    )
    return (
        f"agg AS ({agg_sql}), long AS ({long}), "
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY _v DESC NULLS LAST, {key} ASC NULLS LAST) AS _rk FROM long) "
        f"SELECT {out} FROM ranked WHERE _rk <= {TOP_K}"
    )


def _url_status_top(grouped: bool, bucketed: bool = False) -> str:
    g = ("batch_time, " if bucketed else "") + ("dst_group_id, " if grouped else "")
    gw = "dst_group_id IS NOT NULL AND " if grouped else ""
    src = f"(SELECT *, {BUCKET_SQL} AS batch_time FROM http_flows)" if bucketed else "http_flows"
    pivots = ", ".join(f"max(CASE WHEN status_class = '{c}' THEN requests END) AS count_{c}" for c in STATUS_CLASSES)
    classes = ", ".join(f"'{c}'" for c in STATUS_CLASSES)
    join_on = "r.url = p.url" + (" AND r.dst_group_id = p.dst_group_id" if grouped else "")
    join_on += " AND r.batch_time = p.batch_time" if bucketed else ""
    part = ", ".join(["status_class"] + (["batch_time"] if bucketed else []) + (["dst_group_id"] if grouped else []))
    lead = ("r.batch_time, " if bucketed else "") + ("r.dst_group_id, " if grouped else "")
    counts = ", ".join(f"p.count_{c}" for c in STATUS_CLASSES)
    return (
        f"classed AS (SELECT *, {CLASS_SQL} AS status_class FROM {src} WHERE url IS NOT NULL), "
        f"long AS (SELECT {g}url, status_class, count(*) AS requests FROM classed "
        f"WHERE {gw}status_class IS NOT NULL GROUP BY ALL), "
        f"piv AS (SELECT {g}url, {pivots}, '{{' || string_agg('\"' || status_class || '\":' || CAST(requests AS VARCHAR), ',' "
        f"ORDER BY status_class) FILTER (WHERE status_class NOT IN ({classes})) || '}}' AS other_classes FROM long GROUP BY ALL), "
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {part} "
        f"ORDER BY requests DESC, url ASC) AS _rk FROM long WHERE status_class IN ({classes})) "
        f"SELECT r.status_class, {lead}CAST(r._rk AS INTEGER) AS \"rank\", r.url, "
        f"r.requests, {counts}, p.other_classes FROM ranked r JOIN piv p ON {join_on} WHERE r._rk <= {TOP_K}"
    )


TRAFFIC_SQL = (
    "CAST(sum(in_bytes + out_bytes) AS BIGINT) AS bytes_total, CAST(sum(in_bytes) AS BIGINT) AS bytes_in, "
    "CAST(sum(out_bytes) AS BIGINT) AS bytes_out, CAST(sum(in_pkts + out_pkts) AS BIGINT) AS packets_total, "
    "CAST(sum(in_pkts) AS BIGINT) AS packets_in, CAST(sum(out_pkts) AS BIGINT) AS packets_out, "
    "CAST(sum(retransmitted_in_pkts) AS BIGINT) AS retransmitted_in, CAST(sum(retransmitted_out_pkts) AS BIGINT) AS retransmitted_out, "
    "CAST(sum(ooorder_in_pkts) AS BIGINT) AS ooorder_in, CAST(sum(ooorder_out_pkts) AS BIGINT) AS ooorder_out, "
    "CAST(sum(tcp_window_size_zero) AS BIGINT) AS tcp_window_size_zero"
)


def _conn_sql(closing: str = "TRUE") -> str:
    known = f"{closing} AND unknown_conn = 0"
    lat = (
        lambda side: f"CAST(coalesce(sum({side}_latency_sec) FILTER (WHERE {known}), 0) * 1000000 "
        f"+ coalesce(sum({side}_latency_usec) FILTER (WHERE {known}), 0) AS BIGINT) AS {side}_latency_total"
    )
    return (
        f"count(*) FILTER (WHERE {known}) AS counter, {lat('server')}, {lat('client')}, "
        f"count(*) FILTER (WHERE {closing}) AS closed, count(*) FILTER (WHERE final_status = 8) AS fin, "
        f"count(*) FILTER (WHERE final_status = 7) AS reset, count(*) FILTER (WHERE final_status IN (1, 2, 3, 4)) AS timeout, "
        f"count(*) FILTER (WHERE final_status = 1) AS scan, count(*) FILTER (WHERE final_status = 2) AS syn_attack"
    )


DERIVED_SQL = (
    "round(CASE WHEN packets_total > 1 THEN (retransmitted_in + retransmitted_out) / packets_total ELSE 0.0 END, 6) AS retransfer_rate, "
    "round(CASE WHEN packets_total > 1 THEN (ooorder_in + ooorder_out) / packets_total ELSE 0.0 END, 6) AS outoforder_rate, "
    "CASE WHEN counter > 1 THEN server_latency_total // counter ELSE 0 END AS server_latency, "
    "CASE WHEN counter > 1 THEN client_latency_total // counter ELSE 0 END AS client_latency"
)

CONN_COLS_SQL = "counter, server_latency_total, client_latency_total, closed, fin, reset, timeout, scan, syn_attack"


def _bytes_by_sql(dim: str, alias: str) -> str:
    return (
        f"SELECT grouping(dst_group_id) = 1 AS is_all, dst_group_id, {dim} AS {alias}, "
        "CAST(sum(in_bytes + out_bytes) AS BIGINT) AS total_bytes, CAST(sum(in_bytes) AS BIGINT) AS bytes_in, "
        f"CAST(sum(out_bytes) AS BIGINT) AS bytes_out FROM tcp_flows WHERE {dim} IS NOT NULL "
        f"GROUP BY GROUPING SETS ((dst_group_id, {dim}), ({dim})) "
        "HAVING grouping(dst_group_id) = 1 OR dst_group_id IS NOT NULL"
    )


HTTP_FIELDS = "dst_group_id, dst_ipv4, url, status_code, in_bytes, out_bytes, latency_sec, latency_usec"
_NO_HTTP = "NULL::BIGINT AS dst_group_id, NULL::VARCHAR AS dst_ipv4, NULL::VARCHAR AS url, NULL::VARCHAR AS status_code"
# The good records among the mixed messages.
MIXED_SQL = (
    f"good AS (SELECT {HTTP_FIELDS} FROM http_flows WHERE event_id % 13 > 6 OR (event_id % 13 = 6 AND dst_group_id IS NULL) "
    f"UNION ALL SELECT {_NO_HTTP}, event_id AS in_bytes, event_id AS out_bytes, NULL::BIGINT AS latency_sec, NULL::BIGINT AS latency_usec "
    "FROM http_flows, range(2) AS copies(c) WHERE event_id % 13 = 4 OR (event_id % 13 = 5 AND c = 0) "
    "UNION ALL SELECT dst_group_id, NULL, NULL, '200', NULL, NULL, NULL, NULL FROM http_flows "
    "WHERE event_id % 13 = 6 AND dst_group_id IS NOT NULL)"
)


def _row_json(columns: list[str], texts: list[str] = ()) -> str:
    """SQL text of a row as JSON, NULL fields left out."""
    quote = lambda c: f"'\"' || \"{c}\" || '\"'" if c in texts else f"CAST(\"{c}\" AS VARCHAR)"
    parts = ", ".join(f"CASE WHEN \"{c}\" IS NOT NULL THEN '\"{c}\":' || {quote(c)} END" for c in columns)
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def _parts_sql(rows: str, key: str, columns: list[str], size: int) -> str:
    """The documents of a report in parts: entries numbered in the order of (three digits of the key's md5, key)."""
    return (
        f"WITH rep AS ({rows}), named AS (SELECT dst_group_id, {', '.join(columns)}, coalesce({key}, '(none)') AS k FROM rep), "
        "num AS (SELECT *, row_number() OVER (PARTITION BY dst_group_id ORDER BY substr(md5(k), 1, 3), k) - 1 AS idx, "
        f"CAST(ceil(count(*) OVER (PARTITION BY dst_group_id) / {size}) AS BIGINT) AS parts FROM named) "
        f"SELECT dst_group_id, CAST(idx // {size} AS BIGINT) AS part, parts, '{{' || string_agg('\"' || k || '\":' || "
        + _row_json(columns, [key])
        + f", ',' ORDER BY k) || '}}' AS document FROM num GROUP BY dst_group_id, idx // {size}, parts"
    )


BUCKET_SQL = "strftime(time_bucket(INTERVAL '10 seconds', ts), '%Y%m%d%H%M%S')"
DAY_SQL = "strftime(ts, '%Y%m%d000000')"
STATUS_COUNTS_SQL = (
    "SELECT dst_group_id, status_code, count(*) AS requests FROM http_flows "
    "WHERE dst_group_id IS NOT NULL AND status_code IS NOT NULL GROUP BY ALL"
)


def oracle_sql() -> dict[str, str]:
    grouped_url = "dst_group_id IS NOT NULL AND url IS NOT NULL"
    sql = {
        "http_url_totals": _http_sql(f"SELECT dst_group_id, url, {_sum5(OVERALL_NAMES)} FROM http_flows WHERE {grouped_url} GROUP BY ALL"),
        "http_top_url": _http_sql(
            _topk(f"SELECT dst_group_id, url, {_sum5(GROUP_NAMES)} FROM http_flows WHERE {grouped_url} GROUP BY ALL",
                  GROUP_NAMES, "url", ["dst_group_id"], "BIGINT")
        ),
        "http_top_host": _http_sql(
            _topk(f"SELECT dst_group_id, {HOST_SQL} AS host, {_sum5(GROUP_NAMES)} FROM http_flows WHERE {grouped_url} GROUP BY ALL",
                  GROUP_NAMES, "host", ["dst_group_id"], "BIGINT")
        ),
        "http_top_server": _http_sql(
            _topk(f"SELECT dst_group_id, dst_ipv4 AS ip, {_sum5(GROUP_NAMES)} FROM http_flows WHERE {grouped_url} GROUP BY ALL",
                  GROUP_NAMES, "ip", ["dst_group_id"], "BIGINT")
        ),
        "http_status_counts": _http_sql(STATUS_COUNTS_SQL),
        "http_top_url_status": _http_sql(_url_status_top(True)),
        "http_static_dynamic": _http_sql(
            f"SELECT CASE WHEN {EXT_SQL} IN ({STATIC_SQL}) THEN 'static_request' ELSE 'dynamic_request' END AS request_type, "
            f"CASE WHEN {EXT_SQL} IN ({STATIC_SQL}) THEN 1 ELSE 0 END AS url_type, "
            "round(avg(in_bytes), 6) AS in_bytes, round(avg(out_bytes), 6) AS out_bytes, "
            "round(avg(latency_sec), 6) AS latency_sec, round(avg(latency_usec), 6) AS latency_usec, count(*) AS requests "
            "FROM http_flows GROUP BY ALL"
        ),
        "http_overall_top_url": _http_sql(
            _topk(f"SELECT url, {AVG5} FROM http_flows GROUP BY ALL", OVERALL_NAMES, "url", [], "DOUBLE",
                  ["in_bytes", "out_bytes", "latency"])
        ),
        "http_overall_top_host": _http_sql(
            _topk(f"SELECT {HOST_SQL} AS host, {AVG5} FROM http_flows GROUP BY ALL", OVERALL_NAMES, "host", [], "DOUBLE",
                  ["in_bytes", "out_bytes", "latency"])
        ),
        "http_overall_top_server": _http_sql(
            _topk(f"SELECT dst_ipv4, {AVG5} FROM http_flows GROUP BY ALL", OVERALL_NAMES, "dst_ipv4", [], "DOUBLE",
                  ["in_bytes", "out_bytes", "latency"])
        ),
        "http_overall_status_counts": _http_sql(
            "SELECT status_code, count(*) AS requests FROM http_flows WHERE status_code IS NOT NULL GROUP BY ALL"
        ),
        "http_overall_top_url_status": _http_sql(_url_status_top(False)),
        "http_host_totals": _http_sql(
            f"SELECT dst_group_id, {HOST_SQL} AS host, {_sum5(GROUP_NAMES)} FROM http_flows WHERE {grouped_url} GROUP BY ALL"
        ),
        "http_server_totals": _http_sql(
            f"SELECT dst_group_id, dst_ipv4, {_sum5(GROUP_NAMES)} FROM http_flows WHERE {grouped_url} GROUP BY ALL"
        ),
        "http_overall_url": _http_sql(
            "SELECT url, CAST(sum(in_bytes + out_bytes) AS BIGINT) AS total_bytes, round(avg(in_bytes), 6) AS in_bytes, "
            "round(avg(out_bytes), 6) AS out_bytes, round(avg(latency_sec * 1000000 + latency_usec), 6) AS latency, "
            "count(*) AS requests FROM http_flows GROUP BY ALL"
        ),
        "http_overall_host": _http_sql(
            f"SELECT {HOST_SQL} AS host, CAST(sum(in_bytes + out_bytes) AS BIGINT) AS total_bytes, round(avg(in_bytes), 6) AS in_bytes, "
            "round(avg(out_bytes), 6) AS out_bytes, round(avg(latency_sec * 1000000 + latency_usec), 6) AS latency, "
            "count(*) AS requests FROM http_flows GROUP BY ALL"
        ),
        "http_overall_server": _http_sql(
            "SELECT dst_ipv4, CAST(sum(in_bytes + out_bytes) AS BIGINT) AS total_bytes, round(avg(in_bytes), 6) AS in_bytes, "
            "round(avg(out_bytes), 6) AS out_bytes, round(avg(latency_sec * 1000000 + latency_usec), 6) AS latency, "
            "count(*) AS requests FROM http_flows GROUP BY ALL"
        ),
        "http_url_status_long": _http_sql(
            f"classed AS (SELECT *, {CLASS_SQL} AS status_class FROM http_flows WHERE url IS NOT NULL) "
            "SELECT dst_group_id, url, status_class, count(*) AS requests FROM classed "
            "WHERE dst_group_id IS NOT NULL AND status_class IS NOT NULL GROUP BY ALL"
        ),
        "http_overall_url_status_long": _http_sql(
            f"classed AS (SELECT *, {CLASS_SQL} AS status_class FROM http_flows WHERE url IS NOT NULL) "
            "SELECT url, status_class, count(*) AS requests FROM classed WHERE status_class IS NOT NULL GROUP BY ALL"
        ),
        "http_host_extract": _http_sql(f"SELECT event_id, url, {HOST_SQL} AS host FROM http_flows"),
        "http_url_class": _http_sql(
            f"SELECT event_id, url, {EXT_SQL} AS url_ext, CASE WHEN {EXT_SQL} IN ({STATIC_SQL}) THEN 1 ELSE 0 END AS is_static "
            "FROM http_flows"
        ),
        "http_status_class": _http_sql(f"SELECT event_id, status_code, {CLASS_SQL} AS status_class FROM http_flows"),
        "http_groups": _http_sql("SELECT DISTINCT dst_group_id FROM http_flows WHERE dst_group_id IS NOT NULL"),
        "http_bytes_per_bucket": _http_sql(
            f"SELECT {BUCKET_SQL} AS batch_time, dst_group_id, {_sum5(OVERALL_NAMES)} FROM http_flows "
            "WHERE dst_group_id IS NOT NULL GROUP BY ALL"
        ),
        "http_status_by_bucket": _http_sql(
            f"SELECT {BUCKET_SQL} AS batch_time, dst_group_id, status_code, count(*) AS requests FROM http_flows "
            "WHERE dst_group_id IS NOT NULL AND status_code IS NOT NULL GROUP BY ALL"
        ),
        "http_top_host_by_bucket": _http_sql(
            _topk(f"SELECT {BUCKET_SQL} AS batch_time, dst_group_id, {HOST_SQL} AS host, {_sum5(GROUP_NAMES)} "
                  f"FROM http_flows WHERE {grouped_url} GROUP BY ALL",
                  GROUP_NAMES, "host", ["batch_time", "dst_group_id"], "BIGINT")
        ),
        "http_top_url_status_by_bucket": _http_sql(_url_status_top(True, bucketed=True)),
        "http_overall_top_server_by_bucket": _http_sql(
            _topk(f"SELECT {BUCKET_SQL} AS batch_time, dst_ipv4, {AVG5} FROM http_flows GROUP BY ALL",
                  OVERALL_NAMES, "dst_ipv4", ["batch_time"], "DOUBLE", ["in_bytes", "out_bytes", "latency"])
        ),
        "tcp_proto_bytes": _tcp_sql(_bytes_by_sql("l7_proto", "l7_proto")),
        "tcp_port_bytes": _tcp_sql(_bytes_by_sql("dst_port", "port")),
        "tcp_group_summary": _tcp_sql(
            f"agg AS (SELECT grouping(dst_group_id) = 1 AS is_all, dst_group_id, {TRAFFIC_SQL}, "
            f"{_conn_sql('final_status NOT IN (5, 6)')} FROM tcp_flows GROUP BY GROUPING SETS ((dst_group_id), ())) "
            f"SELECT *, 0 AS \"new\", {DERIVED_SQL} FROM agg WHERE is_all OR dst_group_id IS NOT NULL"
        ),
        "tcp_server_summary": _tcp_sql(
            f"t AS (SELECT dst_group_id, dst_ipv4, {TRAFFIC_SQL} FROM tcp_flows WHERE dst_group_id IS NOT NULL GROUP BY ALL), "
            f"c AS (SELECT dst_ipv4, {_conn_sql()} FROM tcp_flows WHERE final_status NOT IN (5, 6) GROUP BY ALL), "
            "j AS (SELECT t.*, "
            + ", ".join(f"coalesce(c.{x}, 0) AS {x}" for x in CONN_COLS_SQL.split(", "))
            + " FROM t LEFT JOIN c ON t.dst_ipv4 IS NOT DISTINCT FROM c.dst_ipv4) "
            f"SELECT *, 0 AS \"new\", {DERIVED_SQL} FROM j"
        ),
        "tcp_conn_by_group": _tcp_sql(
            f"SELECT dst_group_id, {_conn_sql()}, 0 AS \"new\" FROM tcp_flows "
            "WHERE final_status NOT IN (5, 6) AND dst_group_id IS NOT NULL GROUP BY ALL"
        ),
        "tcp_traffic_by_group": _tcp_sql(
            f"SELECT dst_group_id, {TRAFFIC_SQL} FROM tcp_flows WHERE dst_group_id IS NOT NULL GROUP BY ALL"
        ),
        "tcp_conn_by_server": _tcp_sql(
            f"SELECT dst_ipv4, {_conn_sql()}, 0 AS \"new\" FROM tcp_flows WHERE final_status NOT IN (5, 6) GROUP BY ALL"
        ),
        "tcp_traffic_by_server": _tcp_sql(
            f"SELECT dst_group_id, dst_ipv4, {TRAFFIC_SQL} FROM tcp_flows WHERE dst_group_id IS NOT NULL GROUP BY ALL"
        ),
        "tcp_dimensions": _tcp_sql(
            "SELECT 'l7_proto' AS dimension, l7_proto AS value FROM tcp_flows WHERE l7_proto IS NOT NULL "
            "UNION SELECT 'dst_port' AS dimension, dst_port AS value FROM tcp_flows WHERE dst_port IS NOT NULL"
        ),
        "tcp_groups": _tcp_sql("SELECT DISTINCT dst_group_id FROM tcp_flows WHERE dst_group_id IS NOT NULL"),
        "tcp_port_bytes_by_bucket": _tcp_sql(
            f"f AS (SELECT *, {BUCKET_SQL} AS batch_time FROM tcp_flows) "
            "SELECT grouping(dst_group_id) = 1 AS is_all, dst_group_id, batch_time, dst_port AS port, "
            "CAST(sum(in_bytes + out_bytes) AS BIGINT) AS total_bytes, CAST(sum(in_bytes) AS BIGINT) AS bytes_in, "
            "CAST(sum(out_bytes) AS BIGINT) AS bytes_out FROM f WHERE dst_port IS NOT NULL "
            "GROUP BY GROUPING SETS ((batch_time, dst_group_id, dst_port), (batch_time, dst_port)) "
            "HAVING grouping(dst_group_id) = 1 OR dst_group_id IS NOT NULL"
        ),
        "tcp_group_summary_by_bucket": _tcp_sql(
            f"f AS (SELECT *, {BUCKET_SQL} AS batch_time FROM tcp_flows), "
            f"agg AS (SELECT grouping(dst_group_id) = 1 AS is_all, batch_time, dst_group_id, {TRAFFIC_SQL}, "
            f"{_conn_sql('final_status NOT IN (5, 6)')} FROM f "
            "GROUP BY GROUPING SETS ((batch_time, dst_group_id), (batch_time))) "
            f"SELECT *, 0 AS \"new\", {DERIVED_SQL} FROM agg WHERE is_all OR dst_group_id IS NOT NULL"
        ),
        "tcp_server_summary_by_bucket": _tcp_sql(
            f"f AS (SELECT *, {BUCKET_SQL} AS batch_time FROM tcp_flows), "
            f"t AS (SELECT batch_time, dst_group_id, dst_ipv4, {TRAFFIC_SQL} FROM f WHERE dst_group_id IS NOT NULL GROUP BY ALL), "
            f"c AS (SELECT batch_time, dst_ipv4, {_conn_sql()} FROM f WHERE final_status NOT IN (5, 6) GROUP BY ALL), "
            "j AS (SELECT t.*, "
            + ", ".join(f"coalesce(c.{x}, 0) AS {x}" for x in CONN_COLS_SQL.split(", "))
            + " FROM t LEFT JOIN c ON t.batch_time = c.batch_time AND t.dst_ipv4 IS NOT DISTINCT FROM c.dst_ipv4) "
            f"SELECT *, 0 AS \"new\", {DERIVED_SQL} FROM j"
        ),
        "json_decode_http": _http_sql(
            "SELECT dst_group_id, dst_ipv4, url, status_code, in_bytes, out_bytes, latency_sec, latency_usec, "
            "CAST(NULL AS VARCHAR) AS _corrupt_record FROM http_flows"
        ),
        "json_decode_mixed": _http_sql(f"{MIXED_SQL} SELECT * FROM good"),
        "json_quarantine": _http_sql(
            "SELECT CASE event_id % 13 WHEN 0 THEN 'junk ' || event_id ELSE '{\"dst_group_id\":\"x' || event_id || '\"}' END AS bad_record "
            "FROM http_flows WHERE event_id % 13 IN (0, 1)"
        ),
        "json_static_dynamic": _http_sql(
            f"{MIXED_SQL}, cls AS (SELECT *, CASE WHEN {EXT_SQL} IN ({STATIC_SQL}) THEN 1 ELSE 0 END AS url_type FROM good) "
            "SELECT CASE WHEN url_type = 1 THEN 'static_request' ELSE 'dynamic_request' END AS request_type, url_type, "
            "round(avg(in_bytes), 6) AS in_bytes, round(avg(out_bytes), 6) AS out_bytes, round(avg(latency_sec), 6) AS latency_sec, "
            "round(avg(latency_usec), 6) AS latency_usec, count(*) AS requests FROM cls GROUP BY ALL"
        ),
        "http_server_document": _http_sql(
            _topk(f"SELECT dst_group_id, dst_ipv4 AS ip, {_sum5(GROUP_NAMES)} FROM http_flows WHERE {grouped_url} GROUP BY ALL",
                  GROUP_NAMES, "ip", ["dst_group_id"], "BIGINT").replace(" SELECT metric,", ", top AS (SELECT metric,")
            + ") SELECT metric, dst_group_id, '[' || string_agg(" + _row_json(["rank", "ip", *GROUP_NAMES], ["ip"])
            + ", ',' ORDER BY \"rank\") || ']' AS document FROM top GROUP BY ALL"
        ),
        "tcp_proto_document": _tcp_sql(
            f"rep AS ({_bytes_by_sql('l7_proto', 'l7_proto')}) SELECT is_all, dst_group_id, '{{' || string_agg('\"' || l7_proto || '\":' || "
            + _row_json(["l7_proto", "total_bytes", "bytes_in", "bytes_out"])
            + ", ',' ORDER BY CAST(l7_proto AS VARCHAR)) || '}' AS document FROM rep GROUP BY ALL"
        ),
        "group_document": _http_sql(
            f"sc AS ({STATUS_COUNTS_SQL}) SELECT dst_group_id, "
            "'{' || string_agg('\"' || status_code || '\":' || CAST(requests AS VARCHAR), ',' ORDER BY status_code) || '}' "
            "AS document FROM sc GROUP BY dst_group_id"
        ),
        "snapshot_roundtrip": _http_sql(
            f"b AS (SELECT {BUCKET_SQL} AS batch_time, dst_group_id, {_sum5(OVERALL_NAMES)} FROM http_flows "
            "WHERE dst_group_id IS NOT NULL GROUP BY ALL) "
            "SELECT *, 'http_bytes_per_bucket' AS report, substr(batch_time, 1, 4) || '-' || substr(batch_time, 5, 2) || '-' "
            "|| substr(batch_time, 7, 2) AS dt, substr(batch_time, 9, 2) AS hour FROM b"
        ),
        "stream_http_status": _http_sql(STATUS_COUNTS_SQL),
        "stream_tcp_proto": _tcp_sql(_bytes_by_sql("l7_proto", "l7_proto")),
    }
    for name in ("http_top_host", "http_overall_top_server"):
        sql[f"{name}_per_day_from_hours"] = sql[f"{name}_by_bucket"].replace(BUCKET_SQL, DAY_SQL)
    sql["snapshot_compacted"] = sql["snapshot_roundtrip"]
    sql["snapshot_replay_emptied_hour"] = sql["snapshot_roundtrip"] + " WHERE substr(batch_time, 9, 2) <> '05'"
    sql["quarantine_two_runs"] = _http_sql(
        "bad AS (SELECT CASE event_id % 13 WHEN 0 THEN 'junk ' || event_id ELSE '{\"dst_group_id\":\"x' || event_id || '\"}' END AS bad_record "
        "FROM http_flows WHERE event_id % 13 IN (0, 1)) SELECT 'http' AS kind, bad_record, count(*) AS copies FROM bad GROUP BY ALL"
    )
    sql["json_unknown_fields"] = _http_sql(
        "SELECT 'client-' || (event_id % 7) AS client, count(*) AS requests FROM http_flows WHERE event_id % 11 <> 0 GROUP BY ALL"
    )
    sql["http_document"] = _parts_sql(sql["http_url_totals"], "url", ["url", *OVERALL_NAMES], 40)
    sql["tcp_server_document"] = _parts_sql(sql["tcp_server_summary"], "dst_ipv4", ["dst_ipv4", "bytes_total", "counter", "closed"], 7)
    # Reports from the shared aggregations must equal the standalone reports.
    sql["snapshot_incremental"] = sql["snapshot_roundtrip"]
    sql["http_shared_top_server"] = sql["http_top_server"]
    sql["http_shared_overall_top_url"] = sql["http_overall_top_url"]
    sql["http_shared_overall_top_url_status"] = sql["http_overall_top_url_status"]
    sql["tcp_shared_group_summary"] = sql["tcp_group_summary"]
    return {**sql, **_training_data()[1]}
