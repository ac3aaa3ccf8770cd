"""A key holding a third of all rows: results stay exact, shuffles stay small."""

from pyspark.sql import functions as F

from flowstats.plans import http_reports as H
from flowstats.plans import tcp_reports as TR
from flowstats.schemas import HTTP_SCHEMA, TCP_SCHEMA

N = 300_000
PARTS = 12


def _stage_shuffles(df) -> list[int]:
    """Run `df` and return records written by each shuffle of its final plan, bottom-up."""
    df.collect()
    root = df._jdf.queryExecution().executedPlan()
    plan = root.executedPlan() if root.nodeName() == "AdaptiveSparkPlan" else root
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "ShuffleQueryStage":
            exchange = node.plan()
            walk(exchange)
            metric = exchange.metrics().get("shuffleRecordsWritten")
            out.append(int(metric.get().value()))
            return
        if name.endswith("QueryStage"):  # result / broadcast stages are leaves holding a plan
            walk(node.plan())
            return
        if name == "ReusedExchange":
            return
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return out


def _skewed_http(spark):
    # Every third request goes to one URL of group 0.
    ids = spark.range(0, N, numPartitions=PARTS)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 4).alias("dst_group_id"),
        F.concat(F.lit("10.0.0."), (F.col("id") % 7).cast("string")).alias("dst_ipv4"),
        F.when(hot, F.lit("hot.example/x")).otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string"), F.lit(".example/p"))).alias("url"),
        F.lit("200").alias("status_code"),
        (F.col("id") % 100).alias("in_bytes"),
        (F.col("id") % 1000).alias("out_bytes"),
        F.lit(0).cast("long").alias("latency_sec"),
        (F.col("id") % 997).alias("latency_usec"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in HTTP_SCHEMA.fields])


def test_hot_url_top_k(spark):
    http = _skewed_http(spark)
    top = H.top_urls(http)
    shuffles = _stage_shuffles(top)
    assert len(shuffles) == 2
    aggregated, ranked = shuffles
    # map-side combine: at most one row per key and map task, never the raw rows
    assert aggregated <= PARTS * (5000 * 4 + 1) and aggregated < N / 3
    # partial top-k: at most k rows per (metric, group) and map task
    assert ranked <= 8 * 5 * 4 * 50 + 200  # post-aggregation partitions x metrics x groups x k (+ slack)
    hot = top.where("url = 'hot.example/x' AND metric = 'requests'").first()
    assert hot.rank == 1 and hot.requests == N // 3
    assert hot.bytes_in == sum(i % 100 for i in range(0, N, 3))


def test_hot_server_summary(spark):
    ids = spark.range(0, N, numPartitions=PARTS)
    hot = F.col("id") % 3 == 0
    cols = {f.name: F.lit(1).cast("long") for f in TCP_SCHEMA.fields}
    cols.update(
        dst_group_id=(F.col("id") % 5).cast("long"),
        dst_ipv4=F.when(hot, F.lit("10.9.9.9")).otherwise(F.concat(F.lit("10.1.0."), (F.col("id") % 200).cast("string"))),
        final_status=(F.col("id") % 9).cast("long"),
        unknown_conn=(F.col("id") % 2).cast("long"),
    )
    tcp = ids.select(*[cols[f.name].alias(f.name) for f in TCP_SCHEMA.fields])
    summary = TR.server_summary(tcp)
    shuffles = _stage_shuffles(summary)
    assert shuffles[0] <= PARTS * 5 * 201  # partial aggregates per (group, server)
    rows = summary.where("dst_ipv4 = '10.9.9.9'").collect()
    assert len(rows) == 5  # the hot server in each group, with its server-wide counters
    hot_ids = range(0, N, 3)
    closing = [i for i in hot_ids if i % 9 not in (5, 6)]
    assert {r.closed for r in rows} == {len(closing)}
    assert {r.counter for r in rows} == {sum(1 for i in closing if i % 2 == 0)}
    assert sum(r.bytes_total for r in rows) == 2 * len(hot_ids)
