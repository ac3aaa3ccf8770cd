"""TCP reports from the shared per-(group, server) counters equal the direct reports."""

import pytest

from flowstats.plans.tcp_reports import TCP_REPORTS
from flowstats.plans.tcp_shared import tcp_report_set
from flowstats.sources.tables import tcp_flows
from tests.conftest import SF01


@pytest.mark.parametrize("source", ["micro", "sf0.01"])
def test_shared_tcp_reports_equal_direct_reports(spark, tcp_micro, source):
    batch = tcp_micro if source == "micro" else tcp_flows(spark, SF01).cache()
    report_set = tcp_report_set()
    assert set(report_set.reports) == set(TCP_REPORTS)
    frames = report_set.frames(batch)
    for name, direct in TCP_REPORTS.items():
        expected = direct(batch)
        got = report_set.reports[name](frames).select(*expected.columns)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0, name
