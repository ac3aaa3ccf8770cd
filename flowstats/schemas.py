"""Record schemas and the fixed values the reports depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# HTTP request record, one JSON object per message. `status_code` is a string
# so that both `404` and `"404"` decode; reports cast it where they need a number.
HTTP_SCHEMA = T.StructType(
    [
        T.StructField("dst_group_id", T.LongType()),
        T.StructField("dst_ipv4", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("in_bytes", T.LongType()),
        T.StructField("out_bytes", T.LongType()),
        T.StructField("latency_sec", T.LongType()),
        T.StructField("latency_usec", T.LongType()),
    ]
)

# TCP flow record.
TCP_SCHEMA = T.StructType(
    [T.StructField("dst_group_id", T.LongType()), T.StructField("dst_ipv4", T.StringType())]
    + [
        T.StructField(name, T.LongType())
        for name in (
            "dst_port",
            "l7_proto",
            "final_status",
            "unknown_conn",
            "in_bytes",
            "out_bytes",
            "in_pkts",
            "out_pkts",
            "retransmitted_in_pkts",
            "retransmitted_out_pkts",
            "ooorder_in_pkts",
            "ooorder_out_pkts",
            "tcp_window_size_zero",
            "client_latency_sec",
            "client_latency_usec",
            "server_latency_sec",
            "server_latency_usec",
        )
    ]
)

CORRUPT_RECORD = "_corrupt_record"

# ---------------------------------------------------------------------------
# These must equal the original jobs' values for equal results.
# ---------------------------------------------------------------------------

# URL extensions that make a request "static" (case-sensitive match).
STATIC_EXTENSIONS = ["jpg", "png", "gif", "ico", "js", "css", "txt", "pdf", "pptx", "docx", "rar", "zip", "tar", "jar"]

# Size of every top-k list.
TOP_K = 50

# Status classes that get a top-k list and a pivot column.
STATUS_CLASSES = ["1xx", "2xx", "3xx", "4xx", "5xx"]

# TCP `final_status` codes.
STATUS_SCAN = 1
STATUS_SYN_ATTACK = 2
STATUS_RESET = 7
STATUS_FIN = 8
TIMEOUT_STATUSES = [1, 2, 3, 4]
EXCLUDED_STATUSES = [5, 6]

# Length of one micro-batch / time bucket.
BATCH_INTERVAL = "10 seconds"

# Metric names of the per-group top-k reports (URL, host, server) ...
GROUP_METRICS = ["bytes_total", "bytes_in", "bytes_out", "latency", "requests"]
# ... and of the overall top-k reports and the per-group URL totals.
OVERALL_METRICS = ["total_bytes", "in_bytes", "out_bytes", "latency", "requests"]
