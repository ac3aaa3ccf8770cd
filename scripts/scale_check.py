#!/usr/bin/env python
"""Time reports as the input grows: the given tables replicated k times by Spark.

Each `events` / `lineitem` row is repeated k times (`explode(sequence(...))`,
a new id per copy) and goes through the same flow derivation as the tests. Each
`pages` row is repeated too, with an address of its own, so distinct URLs grow
with k as well as rows. The copies are written once as multi-file parquet into a fresh scratch folder, so
the timed runs scan files in parallel. Prints one Markdown row per k with the
seconds per report (noop sink, median of 3 after a warm-up).

    python scripts/scale_check.py /root/testdata/sf0.1 OUT_DIR 1 4 16
"""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from flowstats.plans import http_reports as H  # noqa: E402
from flowstats.plans import tcp_reports as T  # noqa: E402
from flowstats.session import local_session  # noqa: E402
from flowstats.sources.tables import http_flows_from, read_table, tcp_flows_from  # noqa: E402

REPORTS = {
    "http_top_url": (H.top_urls, "http"),
    "http_top_url_status": (H.top_url_status, "http"),
    "http_overall_top_url": (H.overall_top_urls, "http"),
    "http_overall_top_host": (H.overall_top_hosts, "http"),
    "tcp_proto_bytes": (T.proto_bytes, "tcp"),
    "tcp_group_summary": (T.group_summary, "tcp"),
    "tcp_server_summary": (T.server_summary, "tcp"),
}


def replicate(df, key: str, k: int, stride: int):
    copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
    return df.select("*", copy).withColumn(key, F.col(key) + F.col("_copy").cast("long") * F.lit(stride)).drop("_copy")


def main() -> None:
    sf_dir, out_dir = sys.argv[1], sys.argv[2]
    ks = [int(x) for x in sys.argv[3:]] or [1, 4, 16]
    spark = local_session(8)
    print("| k | HTTP rows | TCP rows | " + " | ".join(REPORTS) + " |")
    print("|---|---|---|" + "---|" * len(REPORTS))
    for k in ks:
        base = f"{out_dir}/k{k}"
        events = read_table(spark, sf_dir, "events").repartition(8)
        lineitem = read_table(spark, sf_dir, "lineitem").repartition(8)
        replicate(events, "event_id", k, 1_000_000_000).write.parquet(f"{base}/events")
        replicate(lineitem, "l_orderkey", k, 10_000_000_000).write.parquet(f"{base}/lineitem")
        copies = replicate(read_table(spark, sf_dir, "pages"), "page_id", k, read_table(spark, sf_dir, "pages").count())
        copies = copies.withColumn("url", F.concat("url", F.lit("/c"), F.col("page_id").cast("string")))
        copies.write.parquet(f"{base}/pages")
        pages = spark.read.parquet(f"{base}/pages")
        inputs = {
            "http": http_flows_from(spark.read.parquet(f"{base}/events"), pages),
            "tcp": tcp_flows_from(spark.read.parquet(f"{base}/lineitem")),
        }
        n_http, n_tcp = inputs["http"].count(), inputs["tcp"].count()
        cells = []
        for report, kind in REPORTS.values():
            samples = []
            for i in range(4):
                t0 = time.perf_counter()
                report(inputs[kind]).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
            cells.append(f"{statistics.median(samples):.2f}")
        print(f"| {k} | {n_http:,} | {n_tcp:,} | " + " | ".join(cells) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
