"""Network-flow reports (HTTP requests, TCP flows) as Spark DataFrame plans."""

from flowstats.plans.http_reports import HTTP_REPORTS
from flowstats.plans.http_shared import http_report_set
from flowstats.plans.tcp_reports import TCP_REPORTS
from flowstats.plans.tcp_shared import tcp_report_set
from flowstats.schemas import HTTP_SCHEMA, TCP_SCHEMA

__all__ = ["HTTP_REPORTS", "HTTP_SCHEMA", "TCP_REPORTS", "TCP_SCHEMA", "http_report_set", "tcp_report_set"]
