"""The four TCP reports of one batch from two aggregations.

The group summary (R15) is a roll-up of the per-(group, server) counters that
the server summary (R16) aggregates anyway: every counter is a sum or a count,
so summing the pairs of a group gives the group's counters exactly. The byte
reports by protocol and by port (R13, R14) share one aggregation by (group,
protocol, port). A batch is then read twice instead of four times.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowstats.operators import tcp as agg
from flowstats.operators.rollup import with_all_rows
from flowstats.operators.tcp import Keys
from flowstats.plans import tcp_reports as T
from flowstats.plans.report_set import ReportSet

GROUP = "dst_group_id"


def tcp_report_set(by: Keys = ()) -> ReportSet:
    """The four TCP reports as a `ReportSet`; the same rows as `TCP_REPORTS`, per `by`."""

    def groups(f):
        per_group = f["pair"].groupBy(*by, GROUP).agg(*[F.sum(c).alias(c) for c in agg.TRAFFIC_COLS + agg.CONN_COLS])
        return T.group_summary_from(per_group, by)

    def volumes(tcp):
        return tcp.groupBy(*by, GROUP, "l7_proto", "dst_port").agg(*agg.byte_sums())

    def bytes_by(f, dimension, name):
        known = f["volume"].where(F.col(dimension).isNotNull())
        per_group = known.groupBy(*by, GROUP, F.col(dimension).alias(name)).agg(*[F.sum(c).alias(c) for c in agg.BYTE_COLS])
        return with_all_rows(per_group, GROUP, [*by, name], agg.BYTE_COLS)

    return ReportSet(
        shared={"pair": lambda tcp: T.pair_counters(tcp, by), "volume": volumes},
        reports={
            "tcp_proto_10s": lambda f: bytes_by(f, "l7_proto", "l7_proto"),
            "tcp_dstport_10s": lambda f: bytes_by(f, "dst_port", "port"),
            "tcp_10s": groups,
            "tcp_server_10s": lambda f: T.server_summary_from(f["pair"], by),
        },
        uses={"tcp_proto_10s": ("volume",), "tcp_dstport_10s": ("volume",), "tcp_10s": ("pair",), "tcp_server_10s": ("pair",)},
    )
