"""Invariants on the table-derived flows and brute-force checks of top-k."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowstats.operators import http as agg
from flowstats.plans import http_reports as H
from flowstats.plans import tcp_reports as TR
from flowstats.schemas import HTTP_SCHEMA
from flowstats.sources.tables import http_flows, tcp_flows
from tests.conftest import SF01

METRICS = ["bytes_total", "bytes_in", "bytes_out", "latency", "requests"]


@pytest.fixture(scope="module")
def http01(spark):
    return http_flows(spark, SF01).cache()


@pytest.fixture(scope="module")
def tcp01(spark):
    return tcp_flows(spark, SF01).cache()


def _add(a, b):
    return b if a is None else a if b is None else a + b


def brute_top(rows, key_of, k):
    """Plain-Python top k per (metric, group): value desc NULLs last, key asc."""
    totals = defaultdict(lambda: [None, None, None, None, 0])
    for r in rows:
        group, url, in_b, out_b, sec, usec = r
        if group is None or url is None:
            continue
        t = totals[(group, key_of(url))]
        total = None if in_b is None or out_b is None else in_b + out_b
        lat = None if sec is None or usec is None else sec * 1_000_000 + usec
        t[0], t[1], t[2], t[3] = _add(t[0], total), _add(t[1], in_b), _add(t[2], out_b), _add(t[3], lat)
        t[4] += 1
    out = set()
    for mi, metric in enumerate(METRICS):
        per_group = defaultdict(list)
        for (group, key), vals in totals.items():
            per_group[group].append((vals[mi] is None, -(vals[mi] or 0), key))
        for group, entries in per_group.items():
            for rank, (_, _, key) in enumerate(sorted(entries)[:k], start=1):
                out.add((metric, group, rank, key))
    return out


http_row = st.tuples(
    st.sampled_from([0, 1, 2, None]),
    st.sampled_from(["a.com/x", "a.com:81/y", "b.org/z.js", "c.net", "http://d.io/q?x=1", None]),
    st.one_of(st.none(), st.integers(0, 50)),
    st.integers(0, 50),
    st.integers(0, 2),
    st.integers(0, 999_999),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(http_row, min_size=0, max_size=40), k=st.integers(1, 4))
def test_top_urls_and_hosts_match_brute_force(spark, rows, k):
    full = [(g, "10.0.0.1", u, "200", i, o, s, us) for g, u, i, o, s, us in rows]
    df = spark.createDataFrame(full, HTTP_SCHEMA)
    got = {(r.metric, r.dst_group_id, r.rank, r.url) for r in H.top_urls(df, k).collect()}
    assert got == brute_top(rows, lambda u: u, k)
    hosts = {"a.com/x": "a.com", "a.com:81/y": "a.com", "b.org/z.js": "b.org", "c.net": "c.net", "http://d.io/q?x=1": "d.io"}
    got = {(r.metric, r.dst_group_id, r.rank, r.host) for r in H.top_hosts(df, k).collect()}
    assert got == brute_top(rows, lambda u: hosts[u], k)


def test_top_servers_small_k_matches_brute_force(http01):
    """k = 5 bites inside every group (hundreds of servers each)."""
    http01 = http01.where("dst_ipv4 IS NOT NULL")
    rows = [
        (r.dst_group_id, r.dst_ipv4, r.in_bytes, r.out_bytes, r.latency_sec, r.latency_usec)
        for r in http01.where("url IS NOT NULL").select(
            "dst_group_id", "dst_ipv4", "in_bytes", "out_bytes", "latency_sec", "latency_usec"
        ).collect()
    ]
    got = {(r.metric, r.dst_group_id, r.rank, r.ip) for r in H.top_servers(http01, k=5).collect()}
    assert got == brute_top(rows, lambda ip: ip, 5)


def test_top_k_ranks_are_dense_and_bounded(http01):
    for report, parts in [(H.top_urls, ["metric", "dst_group_id"]), (H.overall_top_hosts, ["metric"]),
                          (H.top_url_status, ["status_class", "dst_group_id"])]:
        df = report(http01)
        stats = df.groupBy(*parts).agg(F.count("*").alias("n"), F.max("rank").alias("mx"), F.min("rank").alias("mn"))
        for r in stats.collect():
            assert r.mn == 1 and r.mx == r.n <= 50


def test_pivot_sums_equal_request_counts(http01):
    piv = agg.url_class_pivot(http01, ["dst_group_id"])
    others = F.map_values(F.from_json("other_classes", "map<string,bigint>"))
    others = F.coalesce(F.aggregate(others, F.lit(0).cast("long"), lambda a, n: a + n), F.lit(0))
    total = others + sum(F.coalesce(F.col(f"count_{c}xx"), F.lit(0)) for c in "12345")
    assert piv.where("other_classes IS NOT NULL").count() > 0
    long = agg.url_status_long(http01).groupBy("dst_group_id", "url").agg(F.sum("requests").alias("n"))
    joined = piv.join(long, ["dst_group_id", "url"], "full")
    assert joined.where(total != F.col("n")).count() == 0
    assert joined.where(F.col("n").isNull() | (total == 0)).count() == 0  # no URL without a class


def test_group_rows_sum_to_all(tcp01):
    assert tcp01.where("dst_group_id IS NULL").count() > 0  # these count in `all` only
    tcp01 = tcp01.where("dst_group_id IS NOT NULL")
    for report, key in [(TR.proto_bytes, "l7_proto"), (TR.port_bytes, "port")]:
        df = report(tcp01)
        groups = df.where("NOT is_all").groupBy(key).agg(F.sum("total_bytes").alias("s"))
        alls = df.where("is_all").select(key, F.col("total_bytes").alias("s"))
        assert groups.exceptAll(alls).count() == 0 and alls.exceptAll(groups).count() == 0
    summary = TR.group_summary(tcp01)
    cols = ["bytes_total", "packets_total", "counter", "closed", "fin", "reset", "timeout", "scan", "syn_attack",
            "server_latency_total", "client_latency_total"]
    sums = summary.where("NOT is_all").agg(*[F.sum(c).alias(c) for c in cols]).first().asDict()
    assert summary.where("is_all").select(*cols).first().asDict() == sums


def test_connection_invariants(tcp01):
    for df in (TR.group_summary(tcp01), TR.server_summary(tcp01)):
        bad = df.where(
            (F.col("timeout") < F.col("scan") + F.col("syn_attack"))
            | (F.col("closed") < F.col("counter"))
            | (F.col("retransfer_rate") < 0)
            | (F.col("server_latency") * F.col("counter") > F.col("server_latency_total"))
        )
        assert bad.count() == 0


def test_reports_on_empty_input(spark):
    from flowstats.plans.http_reports import HTTP_REPORTS
    from flowstats.plans.tcp_reports import TCP_REPORTS
    from flowstats.schemas import TCP_SCHEMA

    http = spark.createDataFrame([], HTTP_SCHEMA)
    tcp = spark.createDataFrame([], TCP_SCHEMA)
    for name, report in HTTP_REPORTS.items():
        assert report(http).count() == 0, name
    for name, report in TCP_REPORTS.items():
        assert report(tcp).count() == 0, name


CODES = ["200", "404", "301", "100", "503", "600", "99", "-5", "abc", " 302 ", "404.5", None]


def _class_of(code):
    try:
        return f"{int(code) // 100}xx"  # Python floor division, as the original
    except (TypeError, ValueError):
        return None


def brute_top_url_status(rows, grouped, k):
    counts = defaultdict(int)
    for g, url, code in rows:
        cls = _class_of(code)
        if url is None or cls is None or (grouped and g is None):
            continue
        counts[(g if grouped else None, url, cls)] += 1
    pivot = defaultdict(dict)
    for (g, url, cls), n in counts.items():
        pivot[(g, url)][cls] = n
    out = set()
    for cls in ["1xx", "2xx", "3xx", "4xx", "5xx"]:
        per = defaultdict(list)
        for (g, url, c), n in counts.items():
            if c == cls:
                per[g].append((-n, url))
        for g, entries in per.items():
            for rank, (neg, url) in enumerate(sorted(entries)[:k], start=1):
                p = pivot[(g, url)]
                out.add((cls, g, rank, url, -neg, *(p.get(c) for c in ["1xx", "2xx", "3xx", "4xx", "5xx"])))
    return out


status_row = st.tuples(st.sampled_from([0, 1, None]), st.sampled_from(["a/x", "b/y", "c", None]), st.sampled_from(CODES))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(status_row, min_size=0, max_size=40), k=st.integers(1, 3))
def test_top_url_status_matches_brute_force(spark, rows, k):
    df = spark.createDataFrame([(g, "10.0.0.1", u, c, 1, 1, 0, 0) for g, u, c in rows], HTTP_SCHEMA)
    cols = ["status_class", "dst_group_id", "rank", "url", "requests", "count_1xx", "count_2xx", "count_3xx", "count_4xx", "count_5xx"]
    got = {tuple(r[c] for c in cols) for r in H.top_url_status(df, k).collect()}
    assert got == brute_top_url_status(rows, True, k)
    overall = {tuple(r[c] if c != "dst_group_id" else None for c in cols) for r in H.overall_top_url_status(df, k).collect()}
    assert overall == brute_top_url_status(rows, False, k)
