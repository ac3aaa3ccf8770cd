"""Nested JSON documents from flat report rows.

The original folded collected rows into dicts such as `{group: {status: n}}`
on the driver. Here the folding is an aggregation: one JSON document per
outer key, built on the executors. Only use it for reports whose inner
entries per outer key are bounded (status codes, protocols, ports, top-k
lists); an unbounded inner list would put a whole group into one row.
`report_documents` knows the shape of every report and refuses those whose
inner list has no bound; `report_parts` writes these in numbered parts of a
bounded number of entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Shape of each report's document: outer keys, inner key, and whether a group's entries are rows in order (`list`),
# rows by key (`rows`) or one count by key (`count`).
DOCUMENTS = {
    "http_url": (["metric", "dst_group_id"], "rank", "list"),
    "http_host": (["metric", "dst_group_id"], "rank", "list"),
    "http_server": (["metric", "dst_group_id"], "rank", "list"),
    "http_url_status": (["status_class", "dst_group_id"], "rank", "list"),
    "http_filter_url": (["metric"], "rank", "list"),
    "http_filter_host": (["metric"], "rank", "list"),
    "http_filter_server": (["metric"], "rank", "list"),
    "http_filter_url_status": (["status_class"], "rank", "list"),
    "http_status": (["dst_group_id"], "status_code", "count"),
    "http_filter_status": ([], "status_code", "count"),
    "http_filter": ([], "request_type", "rows"),
    "tcp_proto_10s": (["is_all", "dst_group_id"], "l7_proto", "rows"),
    "tcp_dstport_10s": (["is_all", "dst_group_id"], "port", "rows"),
    "tcp_10s": (["is_all"], "dst_group_id", "rows"),
}
# A group of these may hold any number of URLs or servers: outer keys and inner key, rows by key in parts.
PARTED = {"http": (["dst_group_id"], "url"), "tcp_server_10s": (["dst_group_id"], "dst_ipv4")}
UNBOUNDED = tuple(PARTED)
#: Entries of a part at most.
PART_ENTRIES = 10_000
#: Digits of the key's md5 that deal a group's entries into slices (16 ** digits of them).
SLICE_DIGITS = 3
NO_KEY = "(none)"


def report_documents(report: str, rows: DataFrame, by: list[str] | tuple[str, ...] = (), doc_col: str = "document") -> DataFrame:
    """The documents of a report's rows, one per outer key (`by` leads, e.g. a time bucket).

    Status codes and ports come from the records, so the inner lists of those reports are as long as there are
    codes (ports: 65,536 at most); the `all` entry of TCP documents is the one with `is_all`.
    """
    if report in UNBOUNDED:
        raise ValueError(f"{report}: a group's list has no bound, write it with `report_parts`")
    outer, key, shape = DOCUMENTS[report]
    outer = [*by, *outer]
    if shape == "list":
        return row_document(rows, outer, key, doc_col)
    if shape == "count":
        return keyed_document(rows, outer, key, "requests", doc_col)
    return keyed_rows(rows, outer, key, doc_col)


def report_parts(
    report: str, rows: DataFrame, by: list[str] | tuple[str, ...] = (), size: int = PART_ENTRIES, doc_col: str = "document"
) -> DataFrame:
    """The documents of a report whose groups have no bound: per group, `parts` of them, numbered from 0 (`part`).

    Every part is `{key: {row}, ...}` with `size` entries, the last one with the rest; an entry's place is its
    running number in the order of (slice, key), a slice being some digits of the key's md5. Counts per slice give
    every slice its first number, so a group of any size is numbered and gathered by many tasks, and no task holds
    more of it than a slice's sort, which spills, and one part. A row without a key is written as `(none)`.
    """
    outer, key = PARTED[report]
    outer = [*by, *outer]
    inner = [c for c in rows.columns if c not in outer]
    sliced = rows.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY)))
    sliced = sliced.withColumn("_slice", F.substring(F.md5(F.col("_key").cast("binary")), 1, SLICE_DIGITS))
    before = Window.partitionBy(*outer).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*outer, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("parts", F.ceil(F.sum("_n").over(Window.partitionBy(*outer)) / size).cast("long"))
        .select(*[F.col(c).alias(f"_of_{c}") for c in outer], F.col("_slice").alias("_of_slice"), "_start", "parts")
    )
    same = F.col("_slice") == F.col("_of_slice")
    for c in outer:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    place = F.row_number().over(Window.partitionBy(*outer, "_slice").orderBy("_key"))
    numbered = sliced.withColumn("_place", place).join(starts, same)
    part = F.floor((F.col("_start") + F.col("_place") - 1) / size).cast("long").alias("part")
    entries = F.array_sort(F.collect_list(F.struct(F.col("_key").alias("k"), F.struct(*inner).alias("v"))))
    return numbered.groupBy(*outer, part, "parts").agg(F.to_json(F.map_from_entries(entries)).alias(doc_col))


def keyed_rows(df: DataFrame, outer: list[str], key: str, doc_col: str = "document") -> DataFrame:
    """`{key: {row}, ...}` per outer key, keys sorted, as JSON text; a NULL key is written as `all`."""
    inner = [c for c in df.columns if c not in outer]
    name = F.coalesce(F.col(key).cast("string"), F.lit("all"))
    entries = F.array_sort(F.collect_list(F.struct(name.alias("k"), F.struct(*inner).alias("v"))))
    return df.groupBy(*outer).agg(F.to_json(F.map_from_entries(entries)).alias(doc_col))


def keyed_document(df: DataFrame, outer: list[str], key: str, value: str, doc_col: str = "document") -> DataFrame:
    """`{key: value, ...}` per outer key, keys sorted, as JSON text."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col(value).alias("v"))))
    return df.groupBy(*outer).agg(F.to_json(F.map_from_entries(entries)).alias(doc_col))


def row_document(df: DataFrame, outer: list[str], order_by: str, doc_col: str = "document") -> DataFrame:
    """`[{row}, ...]` per outer key, ordered by `order_by`, as JSON text.

    Each element is the row's remaining columns; NULL fields are omitted,
    as `DataFrame.toJSON` does.
    """
    inner = [c for c in df.columns if c not in outer]
    entries = F.array_sort(F.collect_list(F.struct(F.col(order_by).alias("_o"), F.struct(*inner).alias("_r"))))
    return df.groupBy(*outer).agg(F.to_json(F.transform(entries, lambda e: e["_r"])).alias(doc_col))
