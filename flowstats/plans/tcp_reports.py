"""TCP reports R13-R16: each a `DataFrame -> DataFrame` function."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowstats.functions.columns import floor_mean, safe_rate
from flowstats.operators import tcp as agg
from flowstats.operators.tcp import Keys
from flowstats.operators.rollup import IS_ALL, with_all_rows

GROUP = "dst_group_id"


def _derived(df: DataFrame) -> DataFrame:
    """Rates and mean latencies, computed from the summed counters."""
    packets = F.col("packets_total")
    return df.select(
        "*",
        safe_rate(F.col("retransmitted_in") + F.col("retransmitted_out"), packets).alias("retransfer_rate"),
        safe_rate(F.col("ooorder_in") + F.col("ooorder_out"), packets).alias("outoforder_rate"),
        floor_mean(F.col("server_latency_total"), F.col("counter")).alias("server_latency"),
        floor_mean(F.col("client_latency_total"), F.col("counter")).alias("client_latency"),
    )


def proto_bytes(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Bytes per (group, L7 protocol), plus `all` rows per protocol."""
    return agg.bytes_by(tcp, "l7_proto", by=by)


def port_bytes(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Bytes per (group, destination port), plus `all` rows per port."""
    return agg.bytes_by(tcp, "dst_port", "port", by)


def group_summary(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Traffic + connection counters, rates and mean latencies per group.

    One aggregation per group (a NULL group too) carries both counter families,
    which replaces the original's join of two aggregates. The `all` row is
    recomputed from the summed counters of every record, then rates and means
    are derived from those sums, the same way as for a group.
    """
    per_group = tcp.groupBy(*by, GROUP).agg(*agg.traffic_counters(), *agg.connection_counters())
    return group_summary_from(per_group, by)


def group_summary_from(per_group: DataFrame, by: Keys = ()) -> DataFrame:
    """R15 from counters already summed per (*by, group), NULL group included."""
    rows = with_all_rows(per_group, GROUP, list(by), agg.TRAFFIC_COLS + agg.CONN_COLS)
    return _derived(rows.withColumn("new", F.lit(0)))


def pair_counters(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Traffic and connection counters per (*by, group, server), NULL group included."""
    return tcp.groupBy(*by, GROUP, "dst_ipv4").agg(*agg.traffic_counters(), *agg.connection_counters())


def server_summary(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Traffic per (group, server) with the server's connection counters.

    Connection counters are per server over all groups (a server in two
    groups shows the same counters in both). Computed from one aggregation per
    (group, server): the per-server sums are a window over those partial rows,
    so no join and a second scan are needed. A server's window holds one row
    per group, whatever its traffic.
    """
    return server_summary_from(pair_counters(tcp, by), by)


def server_summary_from(per_pair: DataFrame, by: Keys = ()) -> DataFrame:
    """R16 from `pair_counters`."""
    by_server = Window.partitionBy(*by, "dst_ipv4")
    spread = per_pair.select(
        *by,
        GROUP,
        "dst_ipv4",
        *agg.TRAFFIC_COLS,
        *[F.sum(c).over(by_server).alias(c) for c in agg.CONN_COLS],
    ).where(F.col(GROUP).isNotNull())
    return _derived(spread.withColumn("new", F.lit(0)))


TCP_REPORTS = {
    "tcp_proto_10s": proto_bytes,
    "tcp_dstport_10s": port_bytes,
    "tcp_10s": group_summary,
    "tcp_server_10s": server_summary,
}

__all__ = ["IS_ALL", "TCP_REPORTS", "group_summary", "port_bytes", "proto_bytes", "server_summary"]
