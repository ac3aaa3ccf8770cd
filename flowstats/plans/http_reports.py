"""HTTP reports R1-R12: each a `DataFrame -> DataFrame` function.

Each report is one Spark plan with no driver loop and no collect, so it runs
the same on a stored table and on a streaming micro-batch (`foreachBatch`).
Rows are flat; `flowstats.sinks.documents` can fold them into nested JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowstats.operators import http as agg
from flowstats.operators.http import Keys
from flowstats.operators.topk import top_k_by_metrics, top_k_per_class
from flowstats.schemas import GROUP_METRICS, OVERALL_METRICS, STATUS_CLASSES, TOP_K

GROUP = "dst_group_id"


def url_totals(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Every URL of every group with its summed metrics (no order, no limit)."""
    return agg.url_totals(http, OVERALL_METRICS, by)


def top_urls(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """R2: top k URLs per group for each of the five metrics."""
    return top_k_by_metrics(agg.url_totals(http, by=by), GROUP_METRICS, ["url"], [*by, GROUP], k)


def top_hosts(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """Top k hosts per group for each of the five metrics."""
    return top_k_by_metrics(agg.host_totals(http, by=by), GROUP_METRICS, ["host"], [*by, GROUP], k)


def top_servers(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """Top k server addresses (`ip`) per group for each of the five metrics."""
    return top_k_by_metrics(agg.server_totals(http, key="ip", by=by), GROUP_METRICS, ["ip"], [*by, GROUP], k)


def status_counts(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Requests per status code per group."""
    return agg.status_counts(http, by)


def top_classes(counts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Per status class (and `keys`), the k URLs with most requests of that class, from (*keys, url, status_class, requests).

    One long row per class the URL has; each keeps all class counts, which is
    what the original attached with a self-join. Ranking works on the five
    summed columns alone; the k rows of a list are joined with the counts of
    further classes afterwards.
    """
    sums = agg.class_sums(counts, keys)
    columns = {c: agg.class_count_column(c) for c in STATUS_CLASSES}
    pairs = [x for c in STATUS_CLASSES for x in (F.lit(c), F.col(agg.class_count_column(c)))]
    long = sums.select("*", F.stack(F.lit(len(STATUS_CLASSES)), *pairs).alias("status_class", "requests")).where(
        F.col("requests").isNotNull()
    )
    winners = top_k_per_class(long, "requests", ["url"], ["status_class", *keys], k)
    return agg.attach_other_classes(winners, counts, keys, ["status_class", *keys, "rank"])


def _top_url_status(http: DataFrame, keys: list[str], k: int) -> DataFrame:
    return top_classes(agg.classed_requests(http, keys), keys, k)


def top_url_status(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """Per status class and group, the k URLs with most requests of that class.

    Each row carries the URL's counts for all its classes (NULL = none).
    """
    return _top_url_status(http, [*by, GROUP], k)


def static_dynamic(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Average sizes/latency and request count, static vs dynamic URLs."""
    return agg.static_dynamic(http, by)


def overall_top_urls(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """Top k URLs over all groups for each metric (averages; NULL URL kept)."""
    return top_k_by_metrics(agg.overall_url(http, by), OVERALL_METRICS, ["url"], list(by), k)


def overall_top_hosts(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """Top k hosts over all groups for each metric."""
    return top_k_by_metrics(agg.overall_host(http, by), OVERALL_METRICS, ["host"], list(by), k)


def overall_top_servers(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """Top k server addresses over all groups for each metric."""
    return top_k_by_metrics(agg.overall_server(http, by), OVERALL_METRICS, ["dst_ipv4"], list(by), k)


def overall_status_counts(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Requests per status code over all groups."""
    return agg.overall_status_counts(http, by)


def overall_top_url_status(http: DataFrame, k: int = TOP_K, by: Keys = ()) -> DataFrame:
    """Per status class, the k URLs with most requests of that class."""
    return _top_url_status(http, list(by), k)


HTTP_REPORTS = {
    "http": url_totals,
    "http_url": top_urls,
    "http_host": top_hosts,
    "http_server": top_servers,
    "http_status": status_counts,
    "http_url_status": top_url_status,
    "http_filter": static_dynamic,
    "http_filter_url": overall_top_urls,
    "http_filter_host": overall_top_hosts,
    "http_filter_server": overall_top_servers,
    "http_filter_status": overall_status_counts,
    "http_filter_url_status": overall_top_url_status,
}
