"""All twelve HTTP reports of one batch from three shared aggregations.

The reports come in pairs that differ only in grain: per group (R2-R6) and
over all groups (R8-R12), and R1 is R2 without the cut. Host, extension and
status class depend on the URL and status only, so one aggregation by (group,
url, status class) with sums and non-NULL counts yields all reports by URL,
host, class and static/dynamic; server addresses and status codes have one
each. Averages are the summed sum over the summed count: the sums are exact
bigints (and raise on overflow, as the reports' total bytes do), where `avg`
on its own adds doubles.
`flowstats.streaming.runner.process_batch` and `flowstats.batch_job` persist
the shared aggregations while the reports derived from them are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowstats.functions.columns import is_static, latency_us, status_class, url_host
from flowstats.operators.http import Keys
from flowstats.operators.topk import top_k_by_metrics
from flowstats.plans.http_reports import top_classes
from flowstats.plans.report_set import ReportSet
from flowstats.schemas import GROUP_METRICS, OVERALL_METRICS, TOP_K

GROUP = "dst_group_id"

SUMS = ["total", "in_sum", "out_sum", "lat_sum", "requests"]
URL_ONLY_SUMS = ["u_total", "u_in", "u_out", "u_lat", "u_requests"]
MEANS = {"in": "in_bytes", "out": "out_bytes", "sec": "latency_sec", "usec": "latency_usec"}
PARTIALS = ["total", "lat_sum", "lat_cnt", "requests", *[f"{m}_{x}" for m in MEANS for x in ("sum", "cnt")]]


def _partials(url_only: bool = False) -> list[Column]:
    """Sums, non-NULL counts and request counts; `url_only` adds sums over rows with a URL."""
    lat = latency_us()
    cols = [
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("total"),
        F.sum(lat).alias("lat_sum"),
        F.count(lat).alias("lat_cnt"),
        F.count(F.lit(1)).alias("requests"),
    ]
    for name, column in MEANS.items():
        cols += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_cnt")]
    if url_only:
        has_url = F.col("url").isNotNull()
        cols += [
            F.sum(F.when(has_url, F.col("in_bytes") + F.col("out_bytes"))).alias("u_total"),
            F.sum(F.when(has_url, F.col("in_bytes"))).alias("u_in"),
            F.sum(F.when(has_url, F.col("out_bytes"))).alias("u_out"),
            F.sum(F.when(has_url, lat)).alias("u_lat"),
            F.count_if(has_url).alias("u_requests"),
        ]
    return cols


def _summed(base: DataFrame, *keys: str | Column) -> DataFrame:
    """The partials summed to a coarser grain."""
    return base.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in PARTIALS])


def _mean(s: str, n: str) -> Column:
    return F.when(F.sum(n) > 0, F.sum(s) / F.sum(n))


def http_report_set(k: int = TOP_K, by: Keys = ()) -> ReportSet:
    """The twelve HTTP reports as a `ReportSet`; the same rows as `HTTP_REPORTS`, per `by` (e.g. a time bucket)."""
    by = list(by)
    shared = {
        "url": lambda http: http.groupBy(*by, GROUP, "url", status_class().alias("status_class")).agg(*_partials()),
        "server": lambda http: http.groupBy(*by, GROUP, "dst_ipv4").agg(*_partials(url_only=True)),
        "status": lambda http: http.groupBy(*by, GROUP, "status_code").agg(F.count(F.lit(1)).alias("requests")),
    }

    def per_group(base: DataFrame, key: str, out_key: str, names: list[str], sums: list[str] = SUMS) -> DataFrame:
        """Summed metrics per (group, key), the NULL group dropped."""
        return base.where(F.col(GROUP).isNotNull()).select(
            *by, GROUP, F.col(key).alias(out_key), *[F.col(s).alias(n) for s, n in zip(sums, names)]
        )

    def overall(base: DataFrame, key: str) -> DataFrame:
        """Averaged metrics per key over all groups (a NULL key is kept), from the partials."""
        total, bytes_in, bytes_out, latency, requests = OVERALL_METRICS
        return base.groupBy(*by, key).agg(
            F.sum("total").alias(total),
            _mean("in_sum", "in_cnt").alias(bytes_in),
            _mean("out_sum", "out_cnt").alias(bytes_out),
            _mean("lat_sum", "lat_cnt").alias(latency),
            F.sum("requests").alias(requests),
        )

    def urls(f):
        return _summed(f["url"].where(F.col("url").isNotNull()), *by, GROUP, "url")

    def hosts(f):
        return _summed(f["url"], *by, GROUP, url_host().alias("host"))

    def known_hosts(f):
        return hosts(f).where(F.col("host").isNotNull())

    def servers(f):
        with_url = f["server"].where(F.col("u_requests") > 0)  # the per-group report counts rows with a URL
        return per_group(with_url, "dst_ipv4", "ip", GROUP_METRICS, URL_ONLY_SUMS)

    def static_dynamic(f):
        flag = is_static()
        label = F.when(flag == 1, F.lit("static_request")).otherwise(F.lit("dynamic_request"))
        return f["url"].groupBy(*by, label.alias("request_type"), flag.alias("url_type")).agg(
            *[_mean(f"{m}_sum", f"{m}_cnt").alias(c) for m, c in MEANS.items()], F.sum("requests").alias("requests")
        )

    def classes(f, *keys: str):
        known = f["url"].where(F.col("url").isNotNull() & F.col("status_class").isNotNull())
        if GROUP in keys:
            known = known.where(F.col(GROUP).isNotNull())
        return top_classes(known, list(keys), k)

    def status_overall(f):
        known = f["status"].where(F.col("status_code").isNotNull())
        return known.groupBy(*by, "status_code").agg(F.sum("requests").alias("requests"))

    def grouped(rows, key):
        return top_k_by_metrics(rows, GROUP_METRICS, [key], [*by, GROUP], k)

    def over_all(f, frame, key):
        return top_k_by_metrics(overall(f[frame], key), OVERALL_METRICS, [key], by, k)

    reports = {
        "http": lambda f: per_group(urls(f), "url", "url", OVERALL_METRICS),
        "http_url": lambda f: grouped(per_group(urls(f), "url", "url", GROUP_METRICS), "url"),
        "http_host": lambda f: grouped(per_group(known_hosts(f), "host", "host", GROUP_METRICS), "host"),
        "http_server": lambda f: grouped(servers(f), "ip"),
        "http_status": lambda f: f["status"].where(F.col(GROUP).isNotNull() & F.col("status_code").isNotNull()),
        "http_url_status": lambda f: classes(f, *by, GROUP),
        "http_filter": static_dynamic,
        "http_filter_url": lambda f: over_all(f, "url", "url"),
        "http_filter_host": lambda f: top_k_by_metrics(overall(hosts(f), "host"), OVERALL_METRICS, ["host"], by, k),
        "http_filter_server": lambda f: over_all(f, "server", "dst_ipv4"),
        "http_filter_status": status_overall,
        "http_filter_url_status": lambda f: classes(f, *by),
    }
    uses = {name: ("url",) for name in reports}
    uses |= {"http_server": ("server",), "http_filter_server": ("server",)}
    uses |= {"http_status": ("status",), "http_filter_status": ("status",)}
    return ReportSet(shared, reports, uses)
