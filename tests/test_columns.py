import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.functions.columns import (
    batch_time,
    floor_mean,
    is_static,
    latency_us,
    safe_rate,
    status_class,
    url_extension,
    url_host,
)

HOST_CASES = [
    ("a.com/x", "a.com"),
    ("a.com:81/x", "a.com"),
    ("http://a.com/x", "a.com"),
    ("https://a.com:8443/x?y=1", "a.com"),
    ("a.com?q=1", "a.com"),
    ("a.com", "a.com"),
    ("a.com:/x", "a.com"),
    ("a.com#frag", "a.com"),
    ("a.com/r?u=http://z.com/q", "a.com"),
    ("a_b.com/x", "a_b.com"),
    ("u:p@a.com/x", "u:p@a.com"),
    ("", ""),
    (None, None),
]


def _one_col(spark, values, typ=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", typ)]))


def test_url_host(spark):
    df = _one_col(spark, [u for u, _ in HOST_CASES])
    got = [r.h for r in df.select(url_host("v").alias("h")).collect()]
    assert got == [h for _, h in HOST_CASES]


@pytest.mark.parametrize(
    "url, ext, static",
    [
        ("a.com/x.js", "js", 1),
        ("b.com:8080/y?f=1.js", "js", 1),  # whole last segment, query included
        ("b.com/z.png?v=2", "png?v=2", 0),
        ("c.com/p.JPG", "JPG", 0),  # case-sensitive
        ("a.com", "com", 0),
        ("a.com/dir/", "", 0),
        ("a.com/archive.tar", "tar", 1),
        (None, None, 0),  # NULL url counts as dynamic
    ],
)
def test_extension_and_static(spark, url, ext, static):
    row = _one_col(spark, [url]).select(url_extension("v").alias("e"), is_static("v").alias("s")).first()
    assert (row.e, row.s) == (ext, static)


def test_status_class(spark):
    codes = ["200", "404", "100", "599", "7", None, "abc", "404.5", " 302 "]
    got = [r.c for r in _one_col(spark, codes).select(status_class("v").alias("c")).collect()]
    assert got == ["2xx", "4xx", "1xx", "5xx", "0xx", None, None, None, "3xx"]


def test_latency_rate_mean(spark):
    df = spark.createDataFrame(
        [(1, 500, 3, 13, 1001001, 2), (0, 7, 1, 1, 700, 1), (2, 0, 0, 0, 5, 0), (None, 1, 1, None, 9, 3)],
        "sec long, usec long, num long, pkts long, total long, counter long",
    )
    rows = df.select(
        latency_us("sec", "usec").alias("lat"),
        safe_rate(F.col("num"), F.col("pkts")).alias("rate"),
        floor_mean(F.col("total"), F.col("counter")).alias("mean"),
    ).collect()
    assert [r.lat for r in rows] == [1000500, 7, 2000000, None]
    assert rows[0].rate == pytest.approx(3 / 13)
    assert [r.rate for r in rows[1:]] == [0.0, 0.0, 0.0]  # packets not > 1, NULL packets
    assert [r.mean for r in rows] == [500500, 0, 0, 3]


def test_floor_mean_is_exact_for_large_totals(spark):
    big = 2**62 + 3
    df = spark.createDataFrame([(big, 3)], "total long, counter long")
    assert df.select(floor_mean(F.col("total"), F.col("counter")).alias("m")).first().m == big // 3


def test_batch_time_floors_to_ten_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 10, 20, 37),)], "ts timestamp_ntz")
    assert df.select(batch_time("ts").alias("b")).first().b == "20240305102030"


def test_batch_time_keeps_null_times_and_other_lengths(spark):
    rows = [(dt.datetime(2024, 3, 5, 23, 59, 59), 1), (None, 2), (dt.datetime(2024, 3, 5, 0, 0, 0), 3)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, n long")
    got = df.select(
        "n", batch_time("ts").alias("s10"), batch_time("ts", "1 minute").alias("m1"),
        batch_time("ts", "15 minutes").alias("m15"), batch_time("ts", "1 day").alias("d1"),
    ).orderBy("n").collect()
    assert [tuple(r)[1:] for r in got] == [
        ("20240305235950", "20240305235900", "20240305234500", "20240305000000"),
        (None, None, None, None),  # the row is kept, with no bucket
        ("20240305000000", "20240305000000", "20240305000000", "20240305000000"),
    ]
    with pytest.raises(ValueError):
        batch_time("ts", "7 seconds")


def test_url_host_equals_the_single_pattern(spark):
    from flowstats.functions.columns import HOST_PATTERN

    odd = ["a.com:81:82/x", "a.com:8x/y", "a.com:", "::", "1http://a.com", "a.com/x:80", "HTTP://A.com:1",
           "ftp+ssh://h:22?x", "://x", "u:p@h:9#f", "a.com/r?u=http://z.com/q", "#x", "?", "/", ":80"]
    df = _one_col(spark, [u for u, _ in HOST_CASES] + odd)
    diff = df.where(~url_host("v").eqNullSafe(F.regexp_extract("v", HOST_PATTERN, 1)))
    assert diff.count() == 0, diff.collect()


def test_url_extension_equals_the_pattern(spark):
    from flowstats.functions.columns import EXTENSION_PATTERN

    urls = ["a.com/x.js", "b.com/y?f=1.js", "a.com", "a.com/dir/", "x.tar.gz", "/", ".", "a/.b", "a.b/c", "", None,
            "a.com/p.JPG", "no-dot", "a.com/x.js#frag.png"]
    df = _one_col(spark, urls)
    diff = df.where(~url_extension("v").eqNullSafe(F.regexp_extract("v", EXTENSION_PATTERN, 1)))
    assert diff.count() == 0, diff.collect()
