"""Per-bucket replay equals the report run on each bucket's records."""

from pyspark.sql import functions as F

from flowstats.functions.columns import batch_time
from flowstats.plans import http_reports as H
from flowstats.plans import tcp_reports as TR
from flowstats.plans.replay import replay_by_bucket
from flowstats.sources.tables import http_flows
from tests.conftest import SF001, rows_by


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_replay_matches_report_per_bucket(spark):
    flows = http_flows(spark, SF001).cache()
    for report in (H.top_hosts, H.top_url_status, H.overall_top_urls, H.static_dynamic):
        replay = replay_by_bucket(flows, report, interval="1 day").cache()
        days = sorted(r.batch_time for r in replay.select("batch_time").distinct().collect())
        assert len(days) > 5
        for day in (days[0], days[len(days) // 2], days[-1]):
            expect = report(flows.where(batch_time("ts", "1 day") == day))
            got = replay.where(F.col("batch_time") == day).drop("batch_time").select(*expect.columns)
            assert _same(got, expect), (report.__name__, day)


def test_tcp_reports_by_leading_key(tcp_micro):
    df = tcp_micro.withColumn("bucket", F.when(F.col("dst_port") == 80, "A").otherwise("B"))
    summary = rows_by(TR.group_summary(df, by=["bucket"]), "bucket", "is_all", "dst_group_id")
    assert set(summary) == {("A", False, 1), ("A", True, None), ("B", False, 1), ("B", False, 2), ("B", True, None)}
    assert summary[("A", True, None)]["bytes_total"] == 1100  # t1 + t2
    assert summary[("B", True, None)]["bytes_total"] == 72  # t3 + t4 + t5 + t6 (NULL group)
    servers = rows_by(TR.server_summary(df, by=["bucket"]), "bucket", "dst_group_id", "dst_ipv4")
    assert servers[("A", 1, "a")]["counter"] == 2  # only bucket A's flows of server a
    assert servers[("B", 2, "a")]["counter"] == 1
    proto = rows_by(TR.proto_bytes(df, by=["bucket"]), "bucket", "is_all", "dst_group_id", "l7_proto")
    assert proto[("B", True, None, 9)]["total_bytes"] == 62


def test_batch_job_writes_replayed_reports(spark, tmp_path):
    from flowstats.batch_job import parse_args, run
    from flowstats.sinks.committed import read_committed

    flows = http_flows(spark, SF001)
    flows.write.parquet(str(tmp_path / "in"))
    args = parse_args(["http", "--input", str(tmp_path / "in"), "--sink", str(tmp_path / "out"),
                       "--reports", "http_host,http_status", "--by-bucket", "--interval", "1 day"])
    assert run(spark, args) == ["http_host", "http_status"]
    expected = replay_by_bucket(flows, H.status_counts, interval="1 day")
    got = read_committed(spark, str(tmp_path / "out"), expected.schema).where("report = 'http_status'")
    got = got.select(*expected.columns)
    assert _same(got, expected)

    # Stored JSON with its time field gives the same rows.
    from flowstats.sources.json_records import encode_json

    encode_json(flows).write.text(str(tmp_path / "json"))
    args = parse_args(["http", "--input", str(tmp_path / "json"), "--format", "json", "--sink", str(tmp_path / "out3"),
                       "--reports", "http_status", "--by-bucket", "--interval", "1 day"])
    run(spark, args)
    got = read_committed(spark, str(tmp_path / "out3"), expected.schema).select(*expected.columns)
    assert _same(got, expected)

    args = parse_args(["tcp", "--input", str(tmp_path / "in"), "--sink", str(tmp_path / "out2"), "--reports", "nope"])
    import pytest

    with pytest.raises(ValueError):
        run(spark, args)


def test_batch_job_runs_hour_by_hour(spark, tmp_path):
    """Two runs of one day and a replay of the first equal one run over both hours."""
    import pytest

    from flowstats.batch_job import parse_args, run
    from flowstats.sinks.committed import read_committed

    flows = http_flows(spark, SF001)
    flows.write.parquet(str(tmp_path / "in"))
    day = flows.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d")).count().orderBy(F.desc("count"), "d").first().d

    def job(sink, start, end, *more):
        return run(spark, parse_args(["http", "--input", str(tmp_path / "in"), "--sink", str(tmp_path / sink), "--by-bucket",
                                      "--interval", "1 hour", "--start", f"{day}T{start}", "--end", f"{day}T{end}", *more]))

    some = ("--reports", "http_url,http_status,http_filter,http_filter_url_status")
    names = job("parts", "00", "12", "--documents", *some)
    job("parts", "12", "23", *some)
    job("parts", "00", "12", "--documents", *some)
    job("whole", "00", "23", *some)
    part = flows.where(F.date_format("ts", "yyyy-MM-dd") == day).where(F.hour("ts") < 23)
    for name in names:
        expected = replay_by_bucket(part, H.HTTP_REPORTS[name], interval="1 hour")
        for sink in ("parts", "whole"):
            got = read_committed(spark, str(tmp_path / sink), expected.schema).where(F.col("report") == name).select(*expected.columns)
            assert _same(got, expected), (name, sink)
    with pytest.raises(ValueError, match="aligned"):
        job("parts", "00:30", "12")
    with pytest.raises(SystemExit):
        parse_args(["http", "--input", "a", "--sink", "b", "--by-bucket", "--start", "2024-01-01T00"])


def test_buckets_of_instants_over_a_clock_change(spark):
    """Two instants an hour apart that the session's clock shows as the same time stay apart."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1730610000,), (1730613600,), (-5,), (None,)], "e long").withColumn("ts", F.timestamp_seconds("e"))
        got = [r.b for r in df.select(batch_time("ts", "1 hour", zoned=True).alias("b")).collect()]
        assert got == ["20241103050000", "20241103060000", "19691231230000", None]
        counted = replay_by_bucket(df.withColumn("status_code", F.lit("200")), H.overall_status_counts, interval="1 hour")
        assert sorted((r.batch_time or "", r.requests) for r in counted.collect()) == [("", 1), ("19691231230000", 1), ("20241103050000", 1), ("20241103060000", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
