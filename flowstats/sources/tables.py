"""Flow records derived from the stored tables.

The stored tables hold no network flows, so HTTP and TCP records are derived
from `events` + `pages` and from `lineitem` with integer arithmetic (one rule
per field, see FIXTURES.md). Every input row becomes exactly one flow record;
nothing is sampled or filtered. The output columns follow `HTTP_SCHEMA` and
`TCP_SCHEMA`, so the reports run on these frames exactly as on decoded JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


# Columns read from the stored tables. Declaring them skips schema inference
# (a footer-reading job per table) and reads nothing else.
SOURCE_SCHEMAS = {
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
        ]
    ),
    "pages": T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())]),
    "lineitem": T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_suppkey", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
        ]
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table; with a declared schema for the tables the flows use."""
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cases(key: Column, mapping: list[tuple[int, object]], default: object) -> Column:
    expr = None
    for value, result in mapping:
        expr = F.when(key == value, F.lit(result)) if expr is None else expr.when(key == value, F.lit(result))
    return expr.otherwise(F.lit(default))


def http_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTTP request per `events` row; the URL comes from a page of `pages`."""
    return http_flows_from(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "pages"))


def http_flows_from(events: DataFrame, pages: DataFrame) -> DataFrame:
    """`http_flows` over given `events` (event_id, ts, user_id) and `pages` (page_id, url)."""
    events = events.select("event_id", "ts", "user_id")
    # The page URL is split once per page, on the smaller side of the join.
    pages = pages.select(
        "page_id",
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("page_site"),
        F.regexp_extract("url", r"^https?://(.*)$", 1).alias("page_rest"),
    )
    # Scalar subquery: stays in the plan, no driver round trip.
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    keyed = events.withColumn("page_key", F.col("event_id") % n_pages)
    joined = keyed.join(pages, keyed.page_key == pages.page_id, "left")

    eid, uid = F.col("event_id"), F.col("user_id")
    static_url = F.concat(
        F.col("page_site"),
        F.lit(":8080/static/f"),
        (eid % 10).cast("string"),
        _cases(eid % 3, [(0, ".js"), (1, ".png")], ".html"),
    )
    url = (
        F.when(eid % 53 == 0, F.lit(None).cast("string"))
        .when(eid % 37 == 0, F.concat(F.lit("https://user:pw@"), F.col("page_site"), F.lit(":8443?q="), (eid % 7).cast("string")))
        .when(eid % 4 == 0, static_url)
        .otherwise(F.col("page_rest"))
    )
    known = _cases(
        (eid * 7 + uid) % 11,
        [(0, 100), (1, 204), (2, 301), (3, 302), (4, 404), (5, 403), (6, 500), (7, 503)],
        200,
    )
    # Also codes that are missing, no number, or in a class without a list of its own.
    status = (
        F.when(eid % 41 == 0, F.lit(None).cast("string"))
        .when(eid % 43 == 0, F.lit("n/a"))
        .when(eid % 47 == 0, F.lit("999"))
        .when(eid % 59 == 0, F.lit("0"))
        .otherwise(known.cast("string"))
    )
    address = F.concat(F.lit("10.0."), (uid % 4).cast("string"), F.lit("."), ((eid * 7 + uid) % 200).cast("string"))
    return joined.select(
        "event_id",
        "ts",
        F.when(eid % 97 == 0, F.lit(None).cast("long")).otherwise(uid % 5).alias("dst_group_id"),
        F.when(eid % 71 == 0, F.lit(None).cast("string")).otherwise(address).alias("dst_ipv4"),
        url.alias("url"),
        status.alias("status_code"),
        F.when(eid % 101 == 0, F.lit(None).cast("long")).otherwise((eid * 13) % 1500 + 40).alias("in_bytes"),
        ((eid * 31) % 20000).alias("out_bytes"),
        (eid % 3).alias("latency_sec"),
        ((eid * 7919) % 1000000).alias("latency_usec"),
    )


def tcp_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One TCP flow per `lineitem` row; `final_status` spans 0..8, `ts` is the ship date."""
    return tcp_flows_from(read_table(spark, sf_dir, "lineitem"))


def tcp_flows_from(li: DataFrame) -> DataFrame:
    """`tcp_flows` over a given `lineitem` frame."""
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")

    def missing(every: int, value: Column) -> Column:
        return F.when((ok + pk) % every != 0, value)  # NULL in the rest

    return li.select(
        missing(31, sk % 4).alias("dst_group_id"),
        F.concat(F.lit("10.1."), (sk % 3).cast("string"), F.lit("."), (sk % 25).cast("string")).alias("dst_ipv4"),
        missing(37, _cases(pk % 5, [(0, 80), (1, 443), (2, 22), (3, 3306)], 8080)).cast("long").alias("dst_port"),
        missing(41, pk % 6).alias("l7_proto"),
        missing(43, (ok * 7 + F.col("l_linenumber")) % 9).cast("long").alias("final_status"),
        missing(47, F.when(pk % 3 == 0, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("unknown_conn"),
        missing(53, (ok * 13) % 1500).alias("in_bytes"),
        ((pk * 31) % 9000).alias("out_bytes"),
        ((ok * 3) % 40).alias("in_pkts"),
        ((pk * 5) % 60).alias("out_pkts"),
        (ok % 3).alias("retransmitted_in_pkts"),
        (pk % 2).alias("retransmitted_out_pkts"),
        (ok % 2).alias("ooorder_in_pkts"),
        (pk % 3).alias("ooorder_out_pkts"),
        F.when(ok % 17 == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("tcp_window_size_zero"),
        (ok % 2).alias("client_latency_sec"),
        ((ok * 7919) % 1000000).alias("client_latency_usec"),
        (pk % 2).alias("server_latency_sec"),
        ((pk * 104729) % 1000000).alias("server_latency_usec"),
        F.col("l_shipdate").alias("ts"),
    )
