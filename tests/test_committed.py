"""Tables that change by commits: replays, killed runs, parts, compaction; the quarantine and the batch job on them."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.plans import http_reports as H
from flowstats.plans import tcp_reports as TR
from flowstats.plans.replay import replay_by_bucket
from flowstats.schemas import HTTP_SCHEMA
from flowstats.sinks import committed as C
from flowstats.sinks import quarantine as Q
from flowstats.sources.json_records import decode_json, encode_json, extra_fields, split_bad
from flowstats.streaming.runner import STREAM_PARTITIONS, process_batch

ROW = T.StructType([T.StructField("batch_time", T.StringType()), T.StructField("n", T.LongType())])


def store(spark, path, rows, hours=None, part=None, upto=None, report="r", do_commit=True):
    run = C.new_run()
    C.write_rows(spark.createDataFrame(rows, ROW), path, report, run, F.col("batch_time"))
    if do_commit:
        if hours is None:
            entries = C.written_hours(spark, path, [report], run)
        else:
            entries = spark.createDataFrame([(report, *h.split("T")) for h in hours], "report string, dt string, hour string")
        C.commit(spark, path, run, entries, part, upto)
    return run


def stored(spark, path, report=None):
    return sorted((r.report, r.dt, r.hour, r.n) for r in C.read_committed(spark, path, ROW, report).collect())


NINE, TEN = ("2024-01-01T09", "20240101090510"), ("2024-01-01T10", "20240101100000")


def test_a_replay_takes_the_place_of_its_hours(spark, tmp_path):
    path = str(tmp_path / "sink")
    assert stored(spark, path) == [] and C.latest_version(spark, path) == 0
    store(spark, path, [(NINE[1], 1), (TEN[1], 2)])
    store(spark, path, [(NINE[1], 9)], report="other")
    store(spark, path, [(TEN[1], 3)], [NINE[0], TEN[0]])  # finds hour 09 empty
    store(spark, path, [(TEN[1], 4)], do_commit=False)  # killed before its commit
    assert stored(spark, path) == [("other", "2024-01-01", "09", 9), ("r", "2024-01-01", "10", 3)]
    assert stored(spark, path, "r") == [("r", "2024-01-01", "10", 3)]
    assert stored(spark, path, "none") == []
    store(spark, path, [], [TEN[0]])
    assert stored(spark, path, "r") == [] and C.latest_version(spark, path) == 4


def test_parts_stand_beside_each_other(spark, tmp_path):
    path = str(tmp_path / "sink")
    for part, n in (("q-0", 1), ("q-1", 2), ("q-1", 3)):  # batch 1 is replayed
        store(spark, path, [(NINE[1], n)], part=part)
    assert [r[3] for r in stored(spark, path)] == [1, 3]
    store(spark, path, [(NINE[1], 10)])  # a replay of the whole hour
    assert [r[3] for r in stored(spark, path)] == [10]
    store(spark, path, [(NINE[1], 5)], part="q-2")  # a late batch
    assert [r[3] for r in stored(spark, path)] == [5, 10]


def files(path):
    return [p for p in path.rglob("part-*") if C.COMMITS not in p.parts]


def test_compaction_keeps_rows_and_is_idempotent(spark, tmp_path):
    path = tmp_path / "sink"
    for part in range(5):
        store(spark, str(path), [(NINE[1], part), (TEN[1], 10 + part)], part=f"q-{part}")
    store(spark, str(path), [(NINE[1], 99)], report="alone")
    before = stored(spark, str(path))
    assert C.compact(spark, str(path), "2024-01-01T10") == ["r"]
    assert stored(spark, str(path)) == before
    live = C.live_partitions(C.commits(spark, str(path)))
    assert Counter((r.report, r.hour) for r in live.collect()) == {("r", "09"): 1, ("r", "10"): 5, ("alone", "09"): 1}
    version = C.latest_version(spark, str(path))
    assert C.compact(spark, str(path), "2024-01-01T10") == [] and C.latest_version(spark, str(path)) == version
    assert C.vacuum(spark, str(path)) == 0  # each of the five runs still has hour 10
    assert C.compact(spark, str(path), "2024-01-02T00") == ["r"]
    killed = store(spark, str(path), [(NINE[1], 7)], do_commit=False)
    assert C.vacuum(spark, str(path)) == 5
    assert stored(spark, str(path)) == before
    # One file an hour is left, the run alone and the one without a commit, which may be at work, beside them.
    assert len(files(path)) == 4 and any(killed in p.parts[-4] for p in files(path))
    assert len(list((path / C.COMMITS).iterdir())) == 1
    store(spark, str(path), [(NINE[1], 50)])
    assert [r[3] for r in stored(spark, str(path), "r") if r[2] == "09"] == [50]


def test_commits_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sink")
    for part in range(2):
        store(spark, path, [(NINE[1], part)], part=f"q-{part}")
        store(spark, path, [(TEN[1], part)], part=f"q-{part}")
    real = C.commit

    def late(spark_, path_, run, entries, part=None, upto=None):
        monkeypatch.setattr(C, "commit", real)
        store(spark, path, [(NINE[1], 100)], part="q-9")
        store(spark, path, [(TEN[1], 200)], [TEN[0]])
        return real(spark_, path_, run, entries, part, upto)

    monkeypatch.setattr(C, "commit", late)
    C.compact(spark, path, "2024-01-02T00")
    assert [(r[2], r[3]) for r in stored(spark, path)] == [("09", 0), ("09", 1), ("09", 100), ("10", 200)]


def job(spark, tmp_path, *args):
    from flowstats.batch_job import parse_args, run

    return run(spark, parse_args(["http", "--sink", str(tmp_path / "out"), *args]))


STATUS = T.StructType([T.StructField("batch_time", T.StringType()), T.StructField("status_code", T.StringType()), T.StructField("requests", T.LongType())])


def statuses(spark, tmp_path, whole=False):
    rows = C.read_committed(spark, str(tmp_path / "out"), STATUS, "http_filter_status").collect()
    return sorted((r.batch_time, r.status_code, r.requests) for r in rows if (r.dt == C.WHOLE) == whole)


def write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(str(path))


def test_batch_job_loses_nothing(spark, tmp_path):
    """Plain runs, replays, emptied hours, bad records of several runs, unreadable times and mended records."""
    only = ("--reports", "http_filter_status")
    hourly = (*only, "--by-bucket", "--interval", "1 hour", "--format", "json", "--input")
    write_lines(spark, tmp_path / "a", ['{"status_code":200,"ts":"2024-01-01T09:10:00"}', '{"status_code":200,"ts":"2024-01-01T10:10:00"}', "junk one",
                                        '{"status_code":404,"ts":"soon"}', '{"status_code":500}'])
    nine, ten = "20240101090000", "20240101100000"
    job(spark, tmp_path, *hourly, str(tmp_path / "a"))
    assert statuses(spark, tmp_path) == [(nine, "200", 1), (ten, "200", 1)]
    first = ["junk one", '{"status_code":"404","ts":"soon"}', '{"status_code":"500"}']
    assert sorted(r.bad_record for r in Q.read_quarantine(spark, str(tmp_path / "out")).collect()) == first
    # A run over everything leaves the hourly rows alone.
    job(spark, tmp_path, *only, "--format", "json", "--input", str(tmp_path / "a"))
    assert statuses(spark, tmp_path) == [(nine, "200", 1), (ten, "200", 1)]
    assert [r[1:] for r in statuses(spark, tmp_path, whole=True)] == [("200", 2), ("404", 1), ("500", 1)]
    # A replay that finds hour 09 empty, with a bad record of its own.
    write_lines(spark, tmp_path / "b", ['{"status_code":201,"ts":"2024-01-01T10:20:00"}', "junk two"])
    job(spark, tmp_path, *hourly, str(tmp_path / "b"), "--start", "2024-01-01T09", "--end", "2024-01-01T11")
    assert statuses(spark, tmp_path) == [(ten, "201", 1)]
    for _ in range(2):  # a rerun adds no bad record
        kept = sorted(r.bad_record for r in Q.read_quarantine(spark, str(tmp_path / "out")).collect())
        assert kept == sorted([*first, "junk two"])
        job(spark, tmp_path, *hourly, str(tmp_path / "b"), "--start", "2024-01-01T09", "--end", "2024-01-01T11")
    # A mended record goes to its own hour; the other hours keep what they have.
    bad = {r.bad_record: r.id for r in Q.read_quarantine(spark, str(tmp_path / "out")).collect()}
    write_lines(spark, tmp_path / "mended", [json.dumps({"status_code": 404, "ts": "2024-01-01T09:30:00", Q.MENDED_ID: bad['{"status_code":"404","ts":"soon"}']}), "still junk"])
    for _ in range(2):  # and is counted once, however often it is sent
        job(spark, tmp_path, *hourly, str(tmp_path / "b"), "--mended", str(tmp_path / "mended"))
        assert statuses(spark, tmp_path) == [(nine, "404", 1), (ten, "201", 1)]
    left = sorted(r.bad_record for r in Q.still_bad(spark, str(tmp_path / "out")).collect())
    assert left == sorted(['{"status_code":"500"}', "junk one", "junk two", "still junk"])
    job(spark, tmp_path, *hourly, str(tmp_path / "a"))  # a later replay of all records has the mended one too
    assert statuses(spark, tmp_path) == [(nine, "200", 1), (nine, "404", 1), (ten, "200", 1)]


def test_parquet_rows_without_a_time_are_kept_as_bad(spark, tmp_path, http_micro):
    good = http_micro.withColumn("ts", F.lit("2024-01-01 09:00:00").cast("timestamp_ntz"))
    good.union(http_micro.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz"))).write.parquet(str(tmp_path / "in"))
    job(spark, tmp_path, "--reports", "http_filter_status", "--by-bucket", "--interval", "1 hour", "--input", str(tmp_path / "in"))
    assert sum(r[2] for r in statuses(spark, tmp_path)) == 7
    bad = Q.read_quarantine(spark, str(tmp_path / "out")).collect()
    assert len(bad) == 1 and json.loads(bad[0].bad_record)["url"] == "a.com/x.js" and bad[0].source.startswith("file:")


def test_a_replay_into_the_sink_of_a_stream(spark, tmp_path, http_micro):
    """The replay takes the place of the hour's batches; a later batch stands beside it."""
    import datetime as dt

    at = dt.datetime(2024, 1, 1, 9, 5, tzinfo=dt.timezone.utc)
    batch = http_micro.withColumn("timestamp", F.lit(at))
    sink = str(tmp_path / "out")
    for i in range(2):
        process_batch(batch, i, {"http_filter_status": H.overall_status_counts}, sink, time_col="timestamp")
    schema = T.StructType([*STATUS.fields])
    got = C.read_committed(spark, sink, schema, stamp_cols=STREAM_PARTITIONS).collect()
    assert Counter(r.batch_id for r in got) == {"0": 5, "1": 5}
    http_micro.withColumn("ts", F.lit(at)).write.parquet(str(tmp_path / "in"))
    job(spark, tmp_path, "--reports", "http_filter_status", "--by-bucket", "--interval", "1 hour", "--input", str(tmp_path / "in"))
    once = sum(r[2] for r in statuses(spark, tmp_path))
    process_batch(batch, 2, {"http_filter_status": H.overall_status_counts}, sink, time_col="timestamp")
    assert once == 7 and sum(r[2] for r in statuses(spark, tmp_path)) == 14


def test_text_after_a_record_is_bad(spark):
    lines = ['{"dst_group_id":1} trailing', '{"dst_group_id":2}{"dst_group_id":3}', '{"dst_group_id":4},{"dst_group_id":5}',
             ' {"dst_group_id":6} ', '[{"dst_group_id":7}] x', '{"dst_group_id":8},1],[', '{"dst_group_id":9}\t']
    good, bad = split_bad(decode_json(spark.createDataFrame([(v,) for v in lines], "value string"), HTTP_SCHEMA))
    assert [r.dst_group_id for r in good.collect()] == [6, 9]
    assert [r._corrupt_record for r in bad.collect()] == [lines[i] for i in (0, 1, 2, 4, 5)]


def test_fields_outside_the_schema_are_kept(spark):
    lines = ['{"dst_group_id":1,"agent":{"name":"x"}}', "[2]", '[{"n":1,"n":2}]', '[{"dst_group_id":2,"agent":{"name":"y"}},{"dst_group_id":3,"n":7}]', "junk", '{"dst_group_id":"q","n":1}', "[1]"]
    rows = decode_json(spark.createDataFrame([(v,) for v in lines], "value string"), HTTP_SCHEMA, extra_col="extra")
    got = rows.select(
        "dst_group_id", F.try_variant_get("extra", "$.agent.name", "string").alias("agent"), F.try_variant_get("extra", "$.n", "int").alias("n"), F.col("extra").isNull()
    )
    # A record that repeats a field has no VARIANT, but is a record.
    assert [tuple(r) for r in got.collect()] == [(1, "x", None, False), *[(None, None, None, True)] * 2, (2, "y", None, False), (3, None, 7, False), *[(None, None, None, True)] * 3]
    assert extra_fields(rows) == "OBJECT<agent: OBJECT<name: STRING>, dst_group_id: BIGINT, n: BIGINT>"


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_documents_in_parts(spark, tcp_micro, size):
    from flowstats.sinks.documents import NO_KEY, report_parts

    http = spark.createDataFrame([(g, "s", f"h/{i * 31 % 50}", "200", 1, i, 0, 0) for g in (1, 2) for i in range(23 * g)], HTTP_SCHEMA)
    rows = H.url_totals(http)
    docs = report_parts("http", rows, size=size).collect()
    for group in (1, 2):
        mine = sorted((d for d in docs if d.dst_group_id == group), key=lambda d: d.part)
        want = {r.url: r.out_bytes for r in rows.collect() if r.dst_group_id == group}
        assert [d.part for d in mine] == list(range(-(-len(want) // size))) and {d.parts for d in mine} == {len(mine)}
        entries = [(k, v["out_bytes"]) for d in mine for k, v in json.loads(d.document).items()]
        assert len(entries) == len(want) and dict(entries) == want
        assert all(len(json.loads(d.document)) <= size for d in mine) and all(list(json.loads(d.document)) == sorted(json.loads(d.document)) for d in mine)
    servers = TR.server_summary(tcp_micro.union(tcp_micro.limit(1).withColumn("dst_ipv4", F.lit(None).cast("string"))))
    found = [k for d in report_parts("tcp_server_10s", servers, size=size).collect() for k in json.loads(d.document)]
    assert len(found) == servers.count() and NO_KEY in found
    bucketed = replay_by_bucket(http.withColumn("ts", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,out_bytes)")), H.url_totals)
    assert sum(len(json.loads(d.document)) for d in report_parts("http", bucketed, ["batch_time"], size).collect()) == bucketed.count()


def test_encoded_rows_are_read_back(spark, tmp_path, http_micro):
    """Whole tables: one partition, all columns, replaced as one."""
    path = str(tmp_path / "t")
    for _ in range(2):
        run = C.new_run()
        C.write_rows(http_micro, path, "x", run)
        C.commit(spark, path, run, C.written_hours(spark, path, ["x"], run))
    back = C.read_committed(spark, path, HTTP_SCHEMA, "x", stamp_cols=())
    assert back.exceptAll(http_micro).count() == 0 and back.count() == http_micro.count()
    assert encode_json(back).count() == 7


def test_compaction_job_over_a_stream(spark, tmp_path, http_micro):
    """The batches of an hour become one file a report; the rows stay, the job may run again."""
    import datetime as dt

    from flowstats.compact_job import parse_args, run

    sink = tmp_path / "out"
    reports = {"http_status": H.status_counts, "http_filter_status": H.overall_status_counts}
    batch = http_micro.withColumn("timestamp", F.lit(dt.datetime(2024, 1, 1, 9, 5, tzinfo=dt.timezone.utc)))
    for i in range(3):
        process_batch(batch, i, reports, str(sink), time_col="timestamp")
    read = lambda: sorted(tuple(r) for r in C.read_committed(spark, str(sink), STATUS, stamp_cols=STREAM_PARTITIONS).collect())
    before = read()
    assert run(spark, parse_args(["--sink", str(sink), "--before", "2024-01-01T09", "--vacuum"])) == ([], 0)
    args = parse_args(["--sink", str(sink), "--before", "2024-01-01T10", "--vacuum"])
    assert run(spark, args) == (sorted(reports), 6)
    assert read() == before and len(before) == 3 * (5 + 5) and len(files(sink)) == 2
    assert run(spark, args) == ([], 0) and read() == before
    with pytest.raises(ValueError, match="aligned"):
        run(spark, parse_args(["--sink", str(sink), "--before", "2024-01-01T09:30"]))
