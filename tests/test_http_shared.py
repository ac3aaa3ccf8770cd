"""Reports from shared aggregations equal the reports computed on their own."""

import pytest

from flowstats.plans.http_reports import HTTP_REPORTS
from flowstats.plans.http_shared import http_report_set
from flowstats.plans.report_set import BATCH
from flowstats.sources.tables import http_flows
from tests.conftest import SF01


def _frames(report_set, batch):
    frames = {name: build(batch) for name, build in report_set.shared.items()}
    frames[BATCH] = batch
    return frames


@pytest.mark.parametrize("source", ["micro", "sf0.01"])
def test_shared_reports_equal_direct_reports(spark, http_micro, source):
    batch = http_micro if source == "micro" else http_flows(spark, SF01).cache()
    report_set = http_report_set()
    assert set(report_set.reports) == set(HTTP_REPORTS)
    frames = _frames(report_set, batch)
    for name, direct in HTTP_REPORTS.items():
        expected = direct(batch)
        got = report_set.reports[name](frames)
        assert sorted(got.columns) == sorted(expected.columns), name
        got = got.select(*expected.columns)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0, name


def test_runner_writes_the_report_set(spark, tmp_path):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from flowstats.sinks.committed import read_committed
    from flowstats.sources.tables import http_flows
    from flowstats.streaming.runner import STREAM_PARTITIONS, process_batch
    from tests.conftest import SF001

    batch = http_flows(spark, SF001)
    process_batch(batch, 7, http_report_set(), str(tmp_path / "sink"))
    written = {p.name for p in (tmp_path / "sink").iterdir() if p.name.startswith("report=")}
    assert written == {f"report={n}" for n in HTTP_REPORTS}
    for name in ("http_filter_host", "http_url_status", "http_server"):
        expected = HTTP_REPORTS[name](batch)
        schema = T.StructType(expected.schema.fields + [T.StructField("batch_time", T.StringType())])
        got = read_committed(spark, str(tmp_path / "sink"), schema, stamp_cols=STREAM_PARTITIONS).where(F.col("report") == name)
        got = got.select(*expected.columns)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0, name


def test_command_line_http_job_uses_the_shared_set(spark, tmp_path):
    from flowstats.sources.json_records import encode_json
    from flowstats.sources.tables import http_flows
    from flowstats.streaming.job import parse_args, start
    from tests.conftest import SF001

    encode_json(http_flows(spark, SF001)).write.text(str(tmp_path / "src"))
    args = parse_args(["http", "--files", str(tmp_path / "src"), "--sink", str(tmp_path / "sink"),
                       "--checkpoint", str(tmp_path / "ckpt"), "--available-now"])
    q = start(spark, args)
    q.awaitTermination()
    assert q.exception() is None
    written = {p.name for p in (tmp_path / "sink").iterdir() if p.name.startswith("report=")}
    assert written == {f"report={n}" for n in HTTP_REPORTS}
