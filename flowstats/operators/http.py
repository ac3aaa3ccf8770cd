"""HTTP aggregations (one `groupBy().agg()` each; partial + final hash aggregate).

Input: a frame with the `HTTP_SCHEMA` columns. NULL handling:
* per-group outputs drop the NULL group (it has no entry to report under);
* per-key outputs drop a NULL URL where the original filtered `url IS NOT NULL`,
  and keep it as a key where the original grouped it (overall URL/server);
* status outputs drop a NULL status code / status class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowstats.functions.columns import is_static, latency_us, status_class, url_host
from flowstats.schemas import GROUP_METRICS, OVERALL_METRICS, STATUS_CLASSES

GROUP = "dst_group_id"

# Extra leading key columns, e.g. a time bucket (see flowstats.plans.replay).
Keys = list[str] | tuple[str, ...]


def sum_metrics(names: list[str] = GROUP_METRICS) -> list[Column]:
    """Total/in/out bytes, latency (µs) and requests, all summed."""
    total, bytes_in, bytes_out, latency, requests = names
    return [
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias(total),
        F.sum("in_bytes").alias(bytes_in),
        F.sum("out_bytes").alias(bytes_out),
        F.sum(latency_us()).alias(latency),
        F.count(F.lit(1)).alias(requests),
    ]


def avg_metrics(names: list[str] = OVERALL_METRICS) -> list[Column]:
    """Summed total bytes, averaged in/out bytes and latency (µs), requests."""
    total, bytes_in, bytes_out, latency, requests = names
    return [
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias(total),
        F.avg("in_bytes").alias(bytes_in),
        F.avg("out_bytes").alias(bytes_out),
        F.avg(latency_us()).alias(latency),
        F.count(F.lit(1)).alias(requests),
    ]


def groups(flows: DataFrame) -> DataFrame:
    """The distinct groups of HTTP or TCP records, NULL left out."""
    return flows.select(GROUP).where(F.col(GROUP).isNotNull()).distinct()


def _grouped_with_url(http: DataFrame) -> DataFrame:
    return http.where(F.col(GROUP).isNotNull() & F.col("url").isNotNull())


def url_totals(http: DataFrame, names: list[str] = GROUP_METRICS, by: Keys = ()) -> DataFrame:
    """A1: five summed metrics per (group, url)."""
    return _grouped_with_url(http).groupBy(*by, GROUP, "url").agg(*sum_metrics(names))


def host_totals(http: DataFrame, names: list[str] = GROUP_METRICS, by: Keys = ()) -> DataFrame:
    """A2: five summed metrics per (group, host)."""
    return _grouped_with_url(http).groupBy(*by, GROUP, url_host().alias("host")).agg(*sum_metrics(names))


def server_totals(http: DataFrame, names: list[str] = GROUP_METRICS, key: str = "dst_ipv4", by: Keys = ()) -> DataFrame:
    """A3: five summed metrics per (group, server address)."""
    return _grouped_with_url(http).groupBy(*by, GROUP, F.col("dst_ipv4").alias(key)).agg(*sum_metrics(names))


def static_dynamic(http: DataFrame, by: Keys = ()) -> DataFrame:
    """A4: averages and request count for static (`url_type` 1) vs dynamic (0) requests."""
    flag = is_static()
    label = F.when(flag == 1, F.lit("static_request")).otherwise(F.lit("dynamic_request"))
    return http.groupBy(*by, label.alias("request_type"), flag.alias("url_type")).agg(
        F.avg("in_bytes").alias("in_bytes"),
        F.avg("out_bytes").alias("out_bytes"),
        F.avg("latency_sec").alias("latency_sec"),
        F.avg("latency_usec").alias("latency_usec"),
        F.count(F.lit(1)).alias("requests"),
    )


def overall_url(http: DataFrame, by: Keys = ()) -> DataFrame:
    """A5: averaged metrics per URL over all groups; a NULL URL is a key."""
    return http.groupBy(*by, "url").agg(*avg_metrics())


def overall_host(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Averaged metrics per host over all groups; NULL URL -> NULL host key."""
    return http.groupBy(*by, url_host().alias("host")).agg(*avg_metrics())


def overall_server(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Averaged metrics per server address; a NULL address is a key."""
    return http.groupBy(*by, "dst_ipv4").agg(*avg_metrics())


def status_counts(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Requests per (group, status code)."""
    return (
        http.where(F.col(GROUP).isNotNull() & F.col("status_code").isNotNull())
        .groupBy(*by, GROUP, "status_code")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def overall_status_counts(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Requests per status code."""
    return (
        http.where(F.col("status_code").isNotNull())
        .groupBy(*by, "status_code")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def _with_class(http: DataFrame) -> DataFrame:
    return http.where(F.col("url").isNotNull()).withColumn("status_class", status_class()).where(
        F.col("status_class").isNotNull()
    )


def url_status_long(http: DataFrame, by: Keys = ()) -> DataFrame:
    """A10: requests per (group, url, status class)."""
    return (
        _with_class(http.where(F.col(GROUP).isNotNull()))
        .groupBy(*by, GROUP, "url", "status_class")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def overall_url_status_long(http: DataFrame, by: Keys = ()) -> DataFrame:
    """Requests per (url, status class)."""
    return _with_class(http).groupBy(*by, "url", "status_class").agg(F.count(F.lit(1)).alias("requests"))


def class_count_column(cls: str) -> str:
    return f"count_{cls}"


# Counts of a URL's classes that have no column of their own, as JSON text `{"9xx": 3}`; NULL without any.
OTHER_CLASSES = "other_classes"


def class_sums(counts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (*keys, url) from (*keys, url, status_class, requests) rows: a column per class of STATUS_CLASSES.

    NULL where the URL never had the class. Plain sums only, so they are added up before the shuffle whatever the
    number of URLs; other classes are attached to the rows that need them (`attach_other_classes`).
    """
    cls, n = F.col("status_class"), F.col("requests")
    return counts.groupBy(*keys, "url").agg(*[F.sum(F.when(cls == c, n)).alias(class_count_column(c)) for c in STATUS_CLASSES])


def attach_other_classes(rows: DataFrame, counts: DataFrame, keys: list[str], row_key: list[str]) -> DataFrame:
    """`rows` (each known by `row_key`, with *keys and url) with the counts of every class beyond STATUS_CLASSES.

    Only the counts of such classes are joined; a row's are gathered in a window over itself.
    """
    others = counts.where(~F.col("status_class").isin(*STATUS_CLASSES)).groupBy(*keys, "url", "status_class")
    others = others.agg(F.sum("requests").alias("_n")).select(
        *[F.col(c).alias(f"_of_{c}") for c in [*keys, "url"]], F.col("status_class").alias("_class"), "_n"
    )
    same = F.col("url") == F.col("_of_url")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    one = Window.partitionBy(*row_key).orderBy("_class")
    found = F.collect_list(F.when(F.col("_class").isNotNull(), F.struct("_class", "_n"))).over(one)
    gathered = rows.join(others, same, "left").select(
        *rows.columns, found.alias("_found"), F.lead(F.lit(True)).over(one).isNull().alias("_last")
    )
    text = F.when(F.size("_found") > 0, F.to_json(F.map_from_entries("_found")))
    return gathered.where("_last").select(*rows.columns, text.alias(OTHER_CLASSES))


def classed_requests(http: DataFrame, keys: list[str]) -> DataFrame:
    """J3/J4 input: (*keys, url, status_class, requests) of every record with a URL and a class, not added up yet."""
    classed = _with_class(http)
    if GROUP in keys:
        classed = classed.where(F.col(GROUP).isNotNull())
    return classed.select(*keys, "url", "status_class", F.lit(1).cast("long").alias("requests"))


def url_class_pivot(http: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (*keys, url) with a request count per status class, further classes in `other_classes`."""
    counts = classed_requests(http, keys)
    return attach_other_classes(class_sums(counts, keys), counts, keys, [*keys, "url"])
