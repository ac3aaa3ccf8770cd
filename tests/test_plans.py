"""Plan checks: no Python workers, pruned scans, partial top-k, single scans."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TOPK = ["http_top_url", "http_top_host", "http_top_server", "http_top_url_status", "http_overall_top_url_status"]
OVERALL_TOPK = ["http_overall_top_url", "http_overall_top_host", "http_overall_top_server"]
# They run jobs while being built.
SIDE_EFFECTS = {
    "snapshot_roundtrip", "snapshot_incremental", "snapshot_compacted", "snapshot_replay_emptied_hour", "quarantine_two_runs",
    "stream_http_status", "stream_tcp_proto",
    "http_top_host_per_day_from_hours", "http_overall_top_server_per_day_from_hours",
}
# The queries of this part of the library; those of the training-data operators have tests of their own.
REPORTS = {name: fn for name, fn in E.queries().items() if not re.match(r"op\d+_|pipeline$", name)}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df) -> str:
    """`explain("formatted")` text: every scan's PushedFilters and ReadSchema untruncated."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(fn(spark, SF001)) for name, fn in REPORTS.items() if name not in SIDE_EFFECTS}


def test_no_python_udfs(plans):
    for name, plan in plans.items():
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_top_k_is_partial_before_the_shuffle(plans):
    for name in TOPK:
        plan = plans[name]
        assert "WindowGroupLimit" in plan, name
        # Final limit, exchange, partial limit, top to bottom
        final = plan.index("WindowGroupLimit")
        exchange = plan.index("Exchange", final)
        assert "WindowGroupLimit" in plan[exchange:], name


def test_class_lists_add_up_sums_only(plans):
    """No list is gathered for a URL that is not in the result."""
    for name in ("http_top_url_status", "http_overall_top_url_status", "http_shared_overall_top_url_status"):
        assert "ObjectHashAggregate" not in plans[name] and "collect_list" not in plans[name].split("WindowGroupLimit", 1)[1], name


def test_overall_top_k_keeps_a_heap_instead_of_sorting(plans):
    for name in OVERALL_TOPK:
        plan = plans[name]
        assert plan.count("TakeOrderedAndProject(limit=50") == 5, name
        assert "WindowGroupLimit" not in plan, name


def test_batch_job_reads_its_input_three_times(spark, tmp_path, http_micro, tcp_micro):
    """Twelve HTTP reports from three scans, four TCP reports from two."""
    from pyspark import StorageLevel

    from flowstats.plans.http_shared import http_report_set
    from flowstats.plans.report_set import BATCH
    from flowstats.plans.tcp_shared import tcp_report_set

    for records, make_set, scans in ((http_micro, http_report_set, 3), (tcp_micro, tcp_report_set, 2)):
        path = str(tmp_path / f"in{scans}")
        records.write.parquet(path)
        stored = spark.read.parquet(path)
        report_set = make_set()
        assert len(report_set.needed(list(report_set.reports))) == scans
        shared = {n: build(stored).persist(StorageLevel.DISK_ONLY) for n, build in report_set.shared.items()}
        assert sum(plan_of(df).count("FileScan parquet") for df in report_set.frames(stored).values() if df is not stored) == scans
        for name, report in report_set.reports.items():
            plan = plan_of(report({**shared, BATCH: stored}))
            assert "InMemoryTableScan" in plan, name
            # What is read is one of the kept aggregations; the files are only scanned to build it.
            assert plan.split("InMemoryRelation")[0].count("FileScan parquet") == 0, name
        for df in shared.values():
            df.unpersist()


def test_scans_read_only_needed_columns(spark):
    for name, fn in REPORTS.items():
        if name in SIDE_EFFECTS:
            continue
        schemas = re.findall(r"ReadSchema: (struct<.*>)", full_plan(fn(spark, SF001)))
        assert schemas, name
        for schema in schemas:
            assert "html" not in schema and "props" not in schema and "l_quantity" not in schema, (name, schema)
    tcp = full_plan(E.queries()["tcp_group_summary"](spark, SF001))
    assert "l_shipdate" not in tcp and "l_extendedprice" not in tcp


def test_tcp_reports_scan_lineitem_once(plans):
    for name in ["tcp_group_summary", "tcp_server_summary", "tcp_proto_bytes", "tcp_port_bytes"]:
        assert plans[name].count("lineitem.parquet") == 1, name


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["metric", "dst_group_id", "rank", "host"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(REPORTS) <= set(E.oracle_sql()) <= set(E.queries())


def test_filters_reach_a_parquet_scan(spark, tmp_path, http_micro, tcp_micro):
    """On stored flow records, the reports' filters and projections reach the scan."""
    from flowstats.operators import tcp as tcp_ops
    from flowstats.plans import http_reports as H

    http_micro.write.parquet(str(tmp_path / "http"))
    tcp_micro.write.parquet(str(tmp_path / "tcp"))
    http = spark.read.parquet(str(tmp_path / "http"))
    tcp = spark.read.parquet(str(tmp_path / "tcp"))

    plan = full_plan(H.url_totals(http))
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "IsNotNull(dst_group_id)" in pushed and "IsNotNull(url)" in pushed
    schema = re.search(r"ReadSchema: (struct<.*>)", plan).group(1)
    assert "status_code" not in schema and "dst_ipv4" not in schema

    plan = full_plan(tcp_ops.connections_by_group(tcp))
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "Not(In(final_status,[5,6]))" in pushed.replace(" ", "")
    assert "in_bytes" not in re.search(r"ReadSchema: (struct<.*>)", plan).group(1)
