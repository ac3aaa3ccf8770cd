"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, connected components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowstats.llm.common import connected_components, cut

THRESHOLD = 0.9
#: The chance that two vectors at exactly the threshold meet in at least one table.
RECALL = 0.995
#: The expected number of unrelated vectors in a bucket sets the number of signs per table.
BUCKET_ROWS = 256
#: A bucket with more rows than this is cut in blocks, and each pair of blocks is a task's group of its own.
BLOCK_ROWS = 1024
#: Blocks per bucket are bounded by what the pairs of blocks cost, not capped: every pair of blocks is compared.


def plan_tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(signs per table, tables) for n distinct vectors."""
    bits = min(30, max(1, round(math.log2(max(n, 2) / BUCKET_ROWS)) if n > BUCKET_ROWS else 1))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def hyperplanes(dim: int, bits: int, tables: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(4))
    return rng.standard_normal((dim, bits * tables))


def signatures(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A row of `tables` integers of `bits` signs for each vector."""
    signs = (unit @ hyperplanes(unit.shape[1], bits, tables) >= 0).reshape(len(unit), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(2)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length, in double precision, scaled to unit length."""
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # keeps squares of very large and very small vectors finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(batch: pa.RecordBatch, at: int):
    lengths = np.asarray(batch.column(at).value_lengths())
    for n in np.unique(lengths):
        yield int(n), batch.filter(pa.array(lengths == n))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of the links that are not smallest themselves."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == label).all():
            node = np.flatnonzero(label != np.arange(n))
            return node, label[node]
        label = new


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `vectors` (vec_id, embedding).

    Equal vectors are collapsed first and share their links. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different lengths. A null id links with nothing, has a
    null component and is kept. Rows with the same id are one node of the components; every row is returned. Other
    columns are not read; an empty table gives an empty result.
    """
    x = F.col("embedding")
    fine = F.coalesce(
        F.col("vec_id").isNotNull()
        & (F.size(x) > 0)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0),
        F.lit(False),
    )
    rows = vectors.select(
        "vec_id", "embedding", fine.alias("fine"),
        F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2"),
    )
    distinct = cut(
        rows.where("fine")
        .groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
    )
    bits, tables = plan_tables(distinct.count(), threshold, recall)
    found = cut(_linked(distinct, bits, tables, threshold))
    links = found.where("a IS NULL").groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    # An id that occurs with several vectors is one node, so the representatives of these are connected.
    several = rows.where("fine").groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id")
    several = rows.where("fine").drop("embedding").join(several, "vec_id").join(distinct.drop("embedding"), ["k1", "k2"])
    same = several.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    roots = connected_components(found.where("a IS NOT NULL").select("a", "b").union(same))
    known = distinct.drop("embedding").join(links, ["k1", "k2"], "left").join(
        roots, F.col("rep") == F.col("node"), "left"
    ).select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("root", "rep").alias("root"), F.lit(True).alias("fine"),
    )
    out = rows.drop("embedding").join(known, ["k1", "k2", "fine"], "left")
    component = F.coalesce("root", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _linked(distinct: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """Rows (k1, k2, links) with the number of linked vectors, and rows (a, b) whose links connect all that are linked.

    Both come from the tiles of the buckets; a pair that shares several tables counts in the first of them.
    """

    kind = dict(distinct.dtypes)["embedding"]

    def sign(batches):
        for batch in batches:
            for dim, part in _by_length(batch, 4):
                sig = signatures(_matrix(part.column(4)), bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([dim] * part.num_rows, pa.int32()), pa.array(list(sig), pa.list_(pa.int64()))],
                    names=["k1", "k2", "rep", "copies", "embedding", "dim", "sig"],
                )

    signed = cut(
        distinct.select("k1", "k2", "rep", "copies", "embedding").mapInArrow(
            sign, f"k1 long, k2 long, rep long, copies long, embedding {kind}, dim int, sig array<long>"
        )
    )
    spread = signed.drop("embedding").select("k1", "dim", F.posexplode("sig").alias("tab", "bucket"))
    sizes = spread.groupBy("dim", "tab", "bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    sizes = sizes.withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int"))
    entries = (
        signed.select("k1", "k2", "rep", "copies", "embedding", "dim", F.posexplode("sig").alias("tab", "bucket"))
        .join(sizes, ["dim", "tab", "bucket"])
        .withColumn("block", F.pmod(F.xxhash64("k2"), F.col("blocks")).cast("int"))
    )
    # A row goes to the tiles (block, j) for all j >= block and (i, block) for all i < block.
    tiles = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "dim", "tab", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "k1", "k2", "rep", "copies", "embedding",
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        tab, i, j = (table.column(c)[0].as_py() for c in ("tab", "i", "j"))
        unit = _matrix(table.column("embedding").chunk(0))
        sig = signatures(unit, bits, tables)[:, : tab + 1]
        block = table.column("block").to_numpy()
        copies, rep = table.column("copies").to_numpy(), table.column("rep").to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        hits_a, hits_b = [], []
        for lo in range(0, len(left), 256):
            part = left[lo : lo + 256]
            x, y = np.nonzero(unit[part] @ unit[right].T >= threshold)
            a, b = part[x], right[y]
            ok = (a < b) if i == j else np.ones(len(a), bool)
            a, b = a[ok], b[ok]
            for at in range(0, len(a), 1 << 18):
                p, q = a[at : at + (1 << 18)], b[at : at + (1 << 18)]
                first = ~(sig[p, :tab] == sig[q, :tab]).any(1)
                hits_a.append(p[first])
                hits_b.append(q[first])
        a = np.concatenate(hits_a) if hits_a else np.zeros(0, np.int64)
        b = np.concatenate(hits_b) if hits_b else np.zeros(0, np.int64)
        n = len(unit)
        links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        node, root = _forest(a, b, n)
        some = np.flatnonzero(links)
        k1, k2 = table.column("k1").to_numpy(), table.column("k2").to_numpy()
        none = lambda m: pa.nulls(m, pa.int64())
        return pa.table(
            {
                "k1": pa.concat_arrays([pa.array(k1[some]), none(len(node))]),
                "k2": pa.concat_arrays([pa.array(k2[some]), none(len(node))]),
                "links": pa.concat_arrays([pa.array(links[some].astype(np.int64)), none(len(node))]),
                "a": pa.concat_arrays([none(len(some)), pa.array(rep[node])]),
                "b": pa.concat_arrays([none(len(some)), pa.array(rep[root])]),
            }
        )

    return tiles.groupBy("dim", "tab", "bucket", "i", "j").applyInArrow(
        compare, "k1 long, k2 long, links long, a long, b long"
    )


#: All pairs, and the smallest id reachable by links; for small tables. The operator finds a link at exactly the
#: threshold with a chance of RECALL.
ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.x, b.x) >= {THRESHOLD}),
r(vec_id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.vec_id),
m AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN m ON v.vec_id = m.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
