"""TCP aggregations: byte totals by dimension, traffic and connection counters.

The original grouped by (key, unknown_conn, final_status), collected the rows
and bucketed them on the driver. Here every counter is a conditional
aggregate in one pass, so each report is a single aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowstats.functions.columns import latency_us
from flowstats.operators.rollup import with_all_rows
from flowstats.schemas import (
    EXCLUDED_STATUSES,
    STATUS_FIN,
    STATUS_RESET,
    STATUS_SCAN,
    STATUS_SYN_ATTACK,
    TIMEOUT_STATUSES,
)

GROUP = "dst_group_id"

# Extra leading key columns, e.g. a time bucket (see flowstats.plans.replay).
Keys = list[str] | tuple[str, ...]

BYTE_COLS = ["total_bytes", "bytes_in", "bytes_out"]
TRAFFIC_COLS = [
    "bytes_total", "bytes_in", "bytes_out", "packets_total", "packets_in", "packets_out",
    "retransmitted_in", "retransmitted_out", "ooorder_in", "ooorder_out", "tcp_window_size_zero",
]
CONN_COLS = [
    "counter", "server_latency_total", "client_latency_total",
    "closed", "fin", "reset", "timeout", "scan", "syn_attack",
]


def byte_sums() -> list[Column]:
    return [
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("total_bytes"),
        F.sum("in_bytes").alias("bytes_in"),
        F.sum("out_bytes").alias("bytes_out"),
    ]


def traffic_counters() -> list[Column]:
    """Bytes, packets, retransmitted, out-of-order and zero-window sums."""
    return [
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("bytes_total"),
        F.sum("in_bytes").alias("bytes_in"),
        F.sum("out_bytes").alias("bytes_out"),
        F.sum(F.col("in_pkts") + F.col("out_pkts")).alias("packets_total"),
        F.sum("in_pkts").alias("packets_in"),
        F.sum("out_pkts").alias("packets_out"),
        F.sum("retransmitted_in_pkts").alias("retransmitted_in"),
        F.sum("retransmitted_out_pkts").alias("retransmitted_out"),
        F.sum("ooorder_in_pkts").alias("ooorder_in"),
        F.sum("ooorder_out_pkts").alias("ooorder_out"),
        F.sum("tcp_window_size_zero").alias("tcp_window_size_zero"),
    ]


def _latency_total(known: Column, side: str) -> Column:
    sec = F.coalesce(F.sum(F.when(known, F.col(f"{side}_latency_sec"))), F.lit(0).cast("long"))
    usec = F.coalesce(F.sum(F.when(known, F.col(f"{side}_latency_usec"))), F.lit(0).cast("long"))
    return latency_us(sec, usec)


def connection_counters() -> list[Column]:
    """Connection outcome counters over flows whose status is not 5 or 6.

    `counter` and the latency totals cover known connections only
    (`unknown_conn = 0`); a NULL status or flag counts nowhere.
    """
    status = F.col("final_status")
    closing = F.coalesce(~status.isin(*EXCLUDED_STATUSES), F.lit(False))
    known = closing & F.coalesce(F.col("unknown_conn") == 0, F.lit(False))
    return [
        F.count_if(known).alias("counter"),
        _latency_total(known, "server").alias("server_latency_total"),
        _latency_total(known, "client").alias("client_latency_total"),
        F.count_if(closing).alias("closed"),
        F.count_if(status == STATUS_FIN).alias("fin"),
        F.count_if(status == STATUS_RESET).alias("reset"),
        F.count_if(status.isin(*TIMEOUT_STATUSES)).alias("timeout"),
        F.count_if(status == STATUS_SCAN).alias("scan"),
        F.count_if(status == STATUS_SYN_ATTACK).alias("syn_attack"),
    ]


def bytes_by(tcp: DataFrame, dimension: str, alias: str | None = None, by: Keys = ()) -> DataFrame:
    """Byte totals per (group, dimension) plus `all` rows per dimension.

    A NULL dimension value is dropped; a NULL group counts in `all` only.
    """
    name = alias or dimension
    per_group = (
        tcp.where(F.col(dimension).isNotNull())
        .groupBy(*by, GROUP, F.col(dimension).alias(name))
        .agg(*byte_sums())
    )
    return with_all_rows(per_group, GROUP, [*by, name], BYTE_COLS)


def closing_flows(tcp: DataFrame) -> DataFrame:
    """Flows that count as connections (status not 5 or 6, not NULL)."""
    return tcp.where(~F.col("final_status").isin(*EXCLUDED_STATUSES))


def connections_by_group(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Connection counters per group (groups with closing flows only)."""
    return (
        closing_flows(tcp)
        .where(F.col(GROUP).isNotNull())
        .groupBy(*by, GROUP)
        .agg(*connection_counters(), F.lit(0).alias("new"))
    )


def traffic_by_group(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Traffic counters per group."""
    return tcp.where(F.col(GROUP).isNotNull()).groupBy(*by, GROUP).agg(*traffic_counters())


def connections_by_server(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Connection counters per server address over all groups."""
    return closing_flows(tcp).groupBy(*by, "dst_ipv4").agg(*connection_counters(), F.lit(0).alias("new"))


def traffic_by_server(tcp: DataFrame, by: Keys = ()) -> DataFrame:
    """Traffic counters per (group, server address)."""
    return tcp.where(F.col(GROUP).isNotNull()).groupBy(*by, GROUP, "dst_ipv4").agg(*traffic_counters())


def dimensions(tcp: DataFrame) -> DataFrame:
    """Distinct non-NULL protocol and port values, one scan."""
    pairs = F.stack(F.lit(2), F.lit("l7_proto"), F.col("l7_proto"), F.lit("dst_port"), F.col("dst_port"))
    return tcp.select(pairs.alias("dimension", "value")).where(F.col("value").isNotNull()).distinct()
