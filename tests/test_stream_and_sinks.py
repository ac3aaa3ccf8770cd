"""Streaming runner, snapshot sink and JSON documents."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.plans import http_reports as H
from flowstats.plans import tcp_reports as TR
from flowstats.schemas import HTTP_SCHEMA, TCP_SCHEMA
from flowstats.sinks.documents import keyed_document, row_document
from flowstats.sinks.committed import read_committed
from flowstats.sinks.quarantine import read_quarantine
from flowstats.sinks.snapshot import read_snapshot, stamp, write_snapshot
from flowstats.sources.json_records import encode_json, stream_json_files
from flowstats.sources.tables import http_flows, read_table, tcp_flows
from flowstats.streaming.runner import STREAM_PARTITIONS, process_batch, run_reports
from tests.conftest import SF001


def _sink_schema(df, extra=("batch_time",)):
    return T.StructType(list(df.schema.fields) + [T.StructField(c, T.StringType()) for c in extra])


def test_stream_equals_batch(spark, tmp_path):
    """Counts summed over micro-batches equal the batch report; one batch = one file pair."""
    flows = http_flows(spark, SF001)
    encode_json(flows.repartition(4)).write.text(str(tmp_path / "src"))
    records = stream_json_files(spark, str(tmp_path / "src"), HTTP_SCHEMA, max_files_per_trigger=1)
    reports = {"http_status": H.status_counts, "http_filter_status": H.overall_status_counts}
    q = run_reports(records, reports, str(tmp_path / "sink"), str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None

    expected = H.status_counts(flows)
    out = read_committed(spark, str(tmp_path / "sink"), _sink_schema(expected), stamp_cols=STREAM_PARTITIONS)
    mine = out.where("report = 'http_status'")
    assert mine.select("batch_id").distinct().count() >= 2  # really several micro-batches
    summed = mine.groupBy("dst_group_id", "status_code").agg(F.sum("requests").alias("requests"))
    assert summed.exceptAll(expected).count() == 0 and expected.exceptAll(summed).count() == 0
    assert out.where("report = 'http_filter_status'").count() > 0


def test_streamed_json_is_there_a_slice_at_a_time(spark, tmp_path, monkeypatch):
    """The JSON of all flows is never on disk together; nothing is lost, doubled or left behind."""
    import __spark_entry__ as E

    rows = spark.range(300).selectExpr(
        "if(id % 50 = 3, null, id) l_orderkey", "id * 7 % 40 l_partkey", "if(id % 9 = 0, null, id % 11) l_suppkey",
        "cast(id % 4 as int) l_linenumber", "timestamp_ntz'2024-01-01 00:00:00' l_shipdate",
    )
    rows.union(rows).coalesce(1).write.parquet(str(tmp_path / "sf" / "lineitem.parquet"))
    expected = E.TR.proto_bytes(tcp_flows(spark, str(tmp_path / "sf")))
    there, proto_bytes = [], E.TR.proto_bytes

    def watched(tcp):
        there.append(sum(len(p.read_text().splitlines()) for p in tmp_path.glob("stream_*/*/source/part-*")))
        return proto_bytes(tcp)

    monkeypatch.setattr(E, "FILE_FLOWS", 100, raising=False)
    monkeypatch.setattr(E, "checkpoint_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(E.TR, "proto_bytes", watched)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 2)
    got = E.queries()["stream_tcp_proto"](spark, str(tmp_path / "sf"))
    assert 0 < max(there) <= 200
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert not list(tmp_path.glob("stream_*/*/source")) and not list(tmp_path.glob("stream_*/*/rows"))


def test_stream_of_an_empty_table(spark, tmp_path, monkeypatch):
    import __spark_entry__ as E

    empty = spark.createDataFrame([], read_table(spark, SF001, "lineitem").schema)
    empty.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(E, "checkpoint_dir", lambda _: str(tmp_path))
    assert E.queries()["stream_tcp_proto"](spark, str(tmp_path)).count() == 0


def test_single_batch_reports_equal_batch_reports(spark, tmp_path):
    """With one micro-batch, each report's stream output equals its batch output."""
    tcp = tcp_flows(spark, SF001)
    process_batch(tcp, 0, {"tcp_10s": TR.group_summary}, str(tmp_path / "sink"))
    expected = TR.group_summary(tcp)
    out = read_committed(spark, str(tmp_path / "sink"), _sink_schema(expected), stamp_cols=STREAM_PARTITIONS)
    got = out.select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_empty_batch_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], TCP_SCHEMA)
    process_batch(empty, 0, {"tcp_10s": TR.group_summary}, str(tmp_path / "sink"))
    assert not (tmp_path / "sink").exists()


def test_replayed_batch_overwrites_itself(spark, tmp_path, http_micro):
    sink = str(tmp_path / "sink")
    reports = {"http_status": H.status_counts}
    process_batch(http_micro, 0, reports, sink)
    process_batch(http_micro, 1, reports, sink)
    process_batch(http_micro, 1, reports, sink)  # replay of batch 1
    out = read_committed(spark, sink, _sink_schema(H.status_counts(http_micro)), stamp_cols=STREAM_PARTITIONS)
    per_batch = {r.batch_id: r["count"] for r in out.groupBy("batch_id").count().collect()}
    assert per_batch == {"0": 5, "1": 5}


def test_snapshot_keeps_earlier_hours_of_the_day(spark, tmp_path):
    path = str(tmp_path / "snap")

    def write(*rows):
        df = spark.createDataFrame(list(rows), "batch_time string, n long")
        write_snapshot(stamp(df, "r", F.col("batch_time")), path)

    def stored():
        return sorted((r.dt, r.hour, r.n) for r in read_snapshot(spark, path, T.StructType.fromDDL("batch_time string, n long")).collect())

    write(("20240101090510", 1), ("20240102100000", 2))
    write(("20240101100000", 3))  # a later run of the same day
    assert stored() == [("2024-01-01", "09", 1), ("2024-01-01", "10", 3), ("2024-01-02", "10", 2)]
    write(("20240101095000", 5))  # a replay of hour 09 replaces that hour only
    assert stored() == [("2024-01-01", "09", 5), ("2024-01-01", "10", 3), ("2024-01-02", "10", 2)]


def test_ranges_are_whole_hours():
    import pytest

    from flowstats.sinks.snapshot import aligned_range

    start, end = aligned_range("2024-01-01T09", "2024-01-01T11:00:00+01:00")
    assert (start.hour, end.hour) == (9, 10)
    for bad in (("2024-01-01T09:30", "2024-01-01T10"), ("2024-01-01T09", "2024-01-01T09"), ("2024-01-01T10", "2024-01-01T09")):
        with pytest.raises(ValueError):
            aligned_range(*bad)


def test_snapshot_hour_partitions_keep_strings(spark, tmp_path):
    df = spark.createDataFrame([("20240101090510", 1), ("20240101100000", 2)], "batch_time string, n long")
    path, parts = str(tmp_path / "snap"), ["report", "dt", "hour"]
    write_snapshot(stamp(df, "r", F.col("batch_time")), path, parts)
    rows = sorted((r.dt, r.hour, r.n) for r in read_snapshot(spark, path, df.schema).collect())
    assert rows == [("2024-01-01", "09", 1), ("2024-01-01", "10", 2)]  # '09', not 9
    # rewriting hour 09 leaves hour 10 alone and adds no duplicate
    write_snapshot(stamp(df.where("n = 1").withColumn("n", F.lit(5).cast("long")), "r", F.col("batch_time")), path, parts)
    rows = sorted((r.hour, r.n) for r in read_snapshot(spark, path, df.schema).collect())
    assert rows == [("09", 5), ("10", 2)]


def test_documents(spark, http_micro):
    docs = {r.dst_group_id: json.loads(r.document) for r in keyed_document(
        H.status_counts(http_micro), ["dst_group_id"], "status_code", "requests").collect()}
    assert docs == {1: {"200": 2, "404": 1, "503": 1}, 2: {"301": 1, "500": 1}}

    top = H.top_urls(http_micro, k=2).where("metric = 'requests'").drop("metric")
    lists = {r.dst_group_id: json.loads(r.document) for r in row_document(top, ["dst_group_id"], "rank").collect()}
    assert [e["url"] for e in lists[1]] == ["a.com/x.js", "b.com/z.png?v=2"]
    assert lists[1][1].get("bytes_in") is None  # NULL fields are omitted, like toJSON


def test_command_line_job_runs_all_reports(spark, tmp_path):
    from flowstats.streaming.job import parse_args, start

    flows = tcp_flows(spark, SF001)
    encode_json(flows).write.text(str(tmp_path / "src"))
    args = parse_args(["tcp", "--files", str(tmp_path / "src"), "--sink", str(tmp_path / "sink"),
                       "--checkpoint", str(tmp_path / "ckpt"), "--available-now"])
    q = start(spark, args)
    q.awaitTermination()
    assert q.exception() is None
    written = {p.name for p in (tmp_path / "sink").iterdir() if p.name.startswith("report=")}
    assert written == {f"report={n}" for n in TR.TCP_REPORTS}
    expected = TR.group_summary(flows)
    out = read_committed(spark, str(tmp_path / "sink"), _sink_schema(expected), stamp_cols=STREAM_PARTITIONS)
    got = out.where("report = 'tcp_10s'").select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_interval_seconds():
    from flowstats.functions.columns import interval_seconds

    assert [interval_seconds(i) for i in ("10 seconds", "1 second", "1 minute", "2 hours")] == [10, 1, 60, 7200]
    assert interval_seconds("1 minute 30 seconds") == 90
    import pytest

    for bad in ("500 milliseconds", "", "10", "ten seconds", "0 seconds"):
        with pytest.raises(ValueError, match="interval"):
            interval_seconds(bad)


def _write_json_part(df, folder, name):
    # each call adds new files to the source folder (a new wave of records)
    encode_json(df).write.mode("overwrite").text(str(folder / name))


def _summed_status(spark, sink, template):
    out = read_committed(spark, sink, _sink_schema(template), stamp_cols=STREAM_PARTITIONS)
    return out.groupBy("dst_group_id", "status_code").agg(F.sum("requests").alias("requests")), out


def test_processing_time_trigger_and_restart(spark, tmp_path, http_micro):
    src, sink, ckpt = tmp_path / "src", str(tmp_path / "sink"), str(tmp_path / "ckpt")
    src.mkdir()
    template = H.status_counts(http_micro)
    reports = {"http_status": H.status_counts}

    _write_json_part(http_micro, src, "wave1")
    records = stream_json_files(spark, f"{src}/*", HTTP_SCHEMA)
    q = run_reports(records, reports, sink, ckpt, interval="1 second")
    try:
        q.processAllAvailable()
        _write_json_part(http_micro, src, "wave2")
        q.processAllAvailable()
    finally:
        q.stop()
    summed, out = _summed_status(spark, sink, template)
    doubled = template.select("dst_group_id", "status_code", (F.col("requests") * 2).alias("requests"))
    assert summed.exceptAll(doubled).count() == 0 and doubled.exceptAll(summed).count() == 0
    first_batches = out.select("batch_id").distinct().count()
    assert first_batches >= 2

    # Restart from the same checkpoint: only the new wave is processed, nothing twice.
    _write_json_part(http_micro, src, "wave3")
    q = run_reports(stream_json_files(spark, f"{src}/*", HTTP_SCHEMA), reports, sink, ckpt, available_now=True)
    q.awaitTermination()
    summed, out = _summed_status(spark, sink, template)
    tripled = template.select("dst_group_id", "status_code", (F.col("requests") * 3).alias("requests"))
    assert summed.exceptAll(tripled).count() == 0 and tripled.exceptAll(summed).count() == 0
    assert out.select("batch_id").distinct().count() == first_batches + 1


def test_batch_stamp_from_record_time(spark, tmp_path, http_micro):
    import datetime as dt

    stamped = http_micro.withColumn("timestamp", F.lit(dt.datetime(2024, 5, 6, 7, 8, 19, tzinfo=dt.timezone.utc)))
    process_batch(stamped, 3, {"http_status": H.status_counts}, str(tmp_path / "sink"), time_col="timestamp")
    out = read_committed(spark, str(tmp_path / "sink"), _sink_schema(H.status_counts(http_micro)), stamp_cols=STREAM_PARTITIONS)
    assert {r.batch_time for r in out.collect()} == {"20240506070810"}


def test_command_line_job_report_subset(spark, tmp_path, http_micro):
    import pytest

    from flowstats.streaming.job import parse_args, start

    encode_json(http_micro).write.text(str(tmp_path / "src"))
    common = ["--files", str(tmp_path / "src"), "--sink", str(tmp_path / "sink"), "--checkpoint", str(tmp_path / "ckpt"),
              "--available-now"]
    q = start(spark, parse_args(["http", *common, "--reports", "http_status,http_filter_status"]))
    q.awaitTermination()
    written = {p.name for p in (tmp_path / "sink").iterdir() if p.name.startswith("report=")}
    assert written == {"report=http_status", "report=http_filter_status"}
    with pytest.raises(ValueError):
        start(spark, parse_args(["http", *common, "--reports", "no_such_report"]))
    with pytest.raises(SystemExit):
        parse_args(["tcp", "--brokers", "b:9092", "--sink", "s"])  # --brokers needs --topic


BAD = ["junk", '{"dst_group_id":"x","status_code":200}', "", "   ", '{"status_code":']


def test_bad_records_are_quarantined_and_reach_no_report(spark, tmp_path, http_micro):
    from flowstats.streaming.job import parse_args, start

    good = [r.value for r in encode_json(http_micro).collect()]
    spark.createDataFrame([(v,) for v in good + BAD], "value string").coalesce(1).write.text(str(tmp_path / "src"))
    sink = str(tmp_path / "sink")
    args = parse_args(["http", "--files", str(tmp_path / "src"), "--sink", sink, "--checkpoint", str(tmp_path / "ckpt"),
                       "--available-now", "--max-files-per-trigger", "1"])
    start(spark, args).awaitTermination()
    for name in ("http_filter", "http_filter_url", "http_filter_status"):
        expected = H.HTTP_REPORTS[name](http_micro)
        got = read_committed(spark, sink, _sink_schema(expected), stamp_cols=STREAM_PARTITIONS).where(F.col("report") == name).select(*expected.columns)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0, name
    rows = read_quarantine(spark, sink).collect()
    assert sorted(r.bad_record for r in rows) == sorted(v for v in BAD if v.strip())
    # The day and hour are those of the source file, so a replay writes the same partitions.
    written = min(p.stat().st_mtime for p in (tmp_path / "src").glob("part-*"))
    import time

    assert {(r.kind, r.found_at[:10]) for r in rows} == {("http", time.strftime("%Y%m%d%H", time.gmtime(written)))}
    assert {r.source.rsplit("/", 2)[1] for r in rows} == {"src"}


def test_a_batch_of_bad_records_only(spark, tmp_path):
    raw = spark.createDataFrame([("junk",)], "value string")
    from flowstats.sources.json_records import decode_json
    from flowstats.streaming.runner import quarantine_path

    process_batch(decode_json(raw, HTTP_SCHEMA), 0, {"http_status": H.status_counts}, str(tmp_path / "sink"))
    assert not (tmp_path / "sink").exists()
    assert [r.bad_record for r in spark.read.json(quarantine_path(str(tmp_path / "sink"))).collect()] == ["junk"]


def test_a_start_without_a_checkpoint_folder_fails(spark, tmp_path, monkeypatch):
    import pytest

    from flowstats.session import checkpoint_dir
    from flowstats.streaming.job import checkpoint_location, parse_args

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    base = ["http", "--files", "in", "--sink"]
    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_location(Session, parse_args([*base, "a"]))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert checkpoint_dir(Session) == "hdfs://shared"
    one, other = (checkpoint_location(Session, parse_args([*base, s])) for s in ("a", "b"))
    topic = checkpoint_location(Session, parse_args(["http", "--brokers", "h:1", "--topic", "t", "--sink", "a"]))
    assert len({one, other, topic}) == 3 and one == checkpoint_location(Session, parse_args([*base, "a"]))
    assert checkpoint_location(Session, parse_args([*base, "a", "--checkpoint", "c"])) == "c"


def test_report_threads_inherit_the_job_group(spark, tmp_path, http_micro):
    seen = []

    def report(batch):
        seen.append(batch.sparkSession.sparkContext.getLocalProperty("spark.jobGroup.id"))
        return H.status_counts(batch)

    spark.sparkContext.setJobGroup("the-stream", "x")
    try:
        process_batch(http_micro, 0, {"http_status": report}, str(tmp_path / "sink"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert seen == ["the-stream"]


def test_documents_of_every_report(spark, http_micro, tcp_micro):
    import pytest

    from flowstats.sinks.documents import DOCUMENTS, UNBOUNDED, report_documents

    catalog = {**H.HTTP_REPORTS, **TR.TCP_REPORTS}
    assert set(DOCUMENTS) | set(UNBOUNDED) == set(catalog)
    for name in DOCUMENTS:
        records = tcp_micro if name.startswith("tcp") else http_micro
        rows = catalog[name](records)
        docs = report_documents(name, rows).collect()
        assert sum(len(json.loads(d.document)) for d in docs) == rows.count(), name
    summary = {d.is_all: json.loads(d.document) for d in report_documents("tcp_10s", TR.group_summary(tcp_micro)).collect()}
    assert set(summary[False]) == {"1", "2"} and summary[True]["all"]["bytes_total"] == 1172
    for name in UNBOUNDED:
        with pytest.raises(ValueError, match="no bound"):
            report_documents(name, http_micro)
