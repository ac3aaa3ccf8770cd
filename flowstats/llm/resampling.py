"""Importance resampling towards a target distribution, with exact ranks by parallel sorting by regular sampling.

Features are hashed runs of words. Their counts over the raw rows and the target rows give every bucket a gain; a
row's weight is the sum of its features' gains, taken by arrays. With Gumbel noise on top, the highest scores are a
draw without replacement. The ranking sorts runs locally, takes every so many-th row of each run as a sample, splits
the order at regular places of the sorted samples, counts the rows of every segment, and exchanges only the segments
that the draw reaches; there they are sorted and ranked behind the rows of all segments before.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowstats.llm.common import cut, ragged, slices
from flowstats.llm.ragged_words import Words, crc32_of

# Buckets of the feature hash, least words of a row that may be drawn, share drawn, seed of the noise.
BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
#: Bytes of text that a task hashes at once; a longer text stands alone.
SLICE_BYTES = 4 << 20
#: Rows aimed at in a segment of the order, the greatest number of segments, samples taken per segment.
SEGMENT_ROWS = 50_000
MAX_SEGMENTS = 4096
OVERSAMPLE = 32


def _buckets(words: Words, max_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every feature: all runs of 1 to `max_words` words."""
    parts = []
    for k in range(1, max_words + 1):
        starts, ends, row = words.runs(k)
        parts.append((crc32_of(words.buffer, starts, ends) % np.uint32(BUCKETS), row))
    return np.concatenate([p[0] for p in parts]).astype(np.int64), np.concatenate([p[1] for p in parts])


def bucket_counts(texts: DataFrame, max_words: int = 1, text_column: str = "text") -> np.ndarray:
    """Features per bucket over all rows: every task sends one row per bucket at most, the driver gets BUCKETS rows."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = ragged(batch.column(0))
            for a, b in slices(offsets, SLICE_BYTES):
                words = Words.of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total += np.bincount(_buckets(words, max_words)[0], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = texts.select(text_column).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+BUCKETS) / ((s+1)(T+BUCKETS)))) per bucket, in doubles."""
    up, down = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    pairs = zip(raw.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log(((t + 1.0) * up) / ((s + 1.0) * down))) for s, t in pairs], np.int64)


def noise(id_column: str) -> Column:
    """floor of 1000 x Gumbel noise from the id alone, so reruns agree; a null id counts as an empty one."""
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _weights(docs: DataFrame, gains: np.ndarray, max_words: int, id_column: str, text_column: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = ragged(batch.column(1))
            for a, b in slices(offsets, SLICE_BYTES):
                words = Words.of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                bucket, row = _buckets(words, max_words)
                if max_words > 1:
                    order = np.argsort(row, kind="stable")
                    bucket, row = bucket[order], row[order]
                bounds = np.searchsorted(row, np.arange(b - a + 1))
                sums = np.r_[0, np.cumsum(gains[bucket])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(np.diff(words.rows), pa.int64()),
                        pa.array(sums[bounds[1:]] - sums[bounds[:-1]], pa.int64()),
                    ],
                    names=[id_column, "n_features", "n_words", "weight"],
                )

    schema = f"`{id_column}` {dict(docs.dtypes)[id_column]}, n_features long, n_words long, weight long"
    return docs.select(id_column, text_column).mapInArrow(run, schema)


class _Order:
    """The order of the rows: score descending, id (nulls last), then columns that tell equal ids apart."""

    columns = ("score", "__id", "n_features", "__row")

    def __init__(self, id_column: str):
        self.id_column = id_column

    def sort_columns(self) -> list[Column]:
        return [F.desc("score"), F.asc_nulls_last(self.id_column), F.asc("n_features"), F.asc("__row")]

    def arrays(self, batch: pa.RecordBatch) -> np.ndarray:
        """The keys as rows of integers, ascending in the order of the rows."""
        ids = batch.column(self.id_column).cast(pa.int64())
        rank = [
            -batch.column("score").to_numpy(zero_copy_only=False),
            ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
            ids.fill_null(0).to_numpy(zero_copy_only=False),
            batch.column("n_features").to_numpy(zero_copy_only=False),
            batch.column("__row").to_numpy(zero_copy_only=False),
        ]
        return np.stack(rank, axis=1) if batch.num_rows else np.zeros((0, len(rank)), np.int64)


def _sorted(keys: np.ndarray) -> np.ndarray:
    return np.lexsort(tuple(keys[:, c] for c in range(keys.shape[1] - 1, -1, -1)))


def _splitters(eligible: DataFrame, order: _Order, n: int, segments: int) -> np.ndarray:
    """Regular splitters of the order from regular samples of locally sorted runs.

    A sample stands for `stride` rows, so there are at most segments x OVERSAMPLE of them, plus one per run.
    """
    stride = max(1, n // (segments * OVERSAMPLE))
    names = ["a", "b", "c", "d", "e"]

    def regular(batches):
        skip = stride // 2
        for batch in batches:
            keys = order.arrays(batch)[skip::stride]
            skip = (skip - batch.num_rows) % stride if skip < batch.num_rows else skip - batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, c], pa.int64()) for c in range(len(names))], names=names)

    runs = eligible.select(order.id_column, "score", "n_features", "__row").sortWithinPartitions(*order.sort_columns())
    samples = runs.mapInArrow(regular, ", ".join(f"{x} long" for x in names)).toArrow()
    keys = np.stack([samples.column(x).to_numpy() for x in names], axis=1) if samples.num_rows else np.zeros((0, 5), np.int64)
    keys = keys[_sorted(keys)]
    return keys[[len(keys) * i // segments for i in range(1, segments)]] if len(keys) else keys


def rank_rows(scored: DataFrame, eligible: Column, drawn: int, n: int, id_column: str = "doc_id") -> DataFrame:
    """`scored` with `rank`: 1, 2, ... for the `drawn` first of its n eligible rows in the order, null for the others.

    `scored` must be a written table (score, n_features, __row and the id): all steps then see the same rows. Only
    rows of segments that the draw reaches are exchanged. A segment is sorted and numbered with spilling; equal keys
    are told apart by `__row`, so no key makes a segment large.
    """
    order = _Order(id_column)
    segments = max(1, min(math.ceil(n / SEGMENT_ROWS), MAX_SEGMENTS))
    splitters = _splitters(scored.where(eligible), order, n, segments) if segments > 1 else np.zeros((0, 5), np.int64)

    def assign(batches):
        for batch in batches:
            keys = order.arrays(batch)
            both = _sorted(np.concatenate([splitters, keys]))
            is_splitter = both < len(splitters)
            segment = np.empty(len(keys), np.int64)
            segment[both[~is_splitter] - len(splitters)] = np.cumsum(is_splitter)[~is_splitter]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], names=[*batch.schema.names, "__segment"])

    schema = ", ".join(f"`{c}` {t}" for c, t in scored.dtypes) + ", __segment long"
    placed = cut(scored.mapInArrow(assign, schema).withColumn("__eligible", F.coalesce(eligible, F.lit(False))))
    sizes = dict(placed.where("__eligible").groupBy("__segment").count().collect())
    before, starts = 0, []
    for segment in range(segments):  # at most MAX_SEGMENTS counts
        if before < drawn:
            starts.append((segment, before))
        before += sizes.get(segment, 0)
    reached = F.col("__eligible") & (F.col("__segment") < len(starts))
    place = F.row_number().over(Window.partitionBy("__segment").orderBy(*order.sort_columns()))
    offsets = scored.sparkSession.createDataFrame(starts or [(0, 0)], "__at long, __before long")
    rank = F.col("__before") + F.col("__place")
    ranked = (
        placed.where(reached)
        .withColumn("__place", place)
        .join(F.broadcast(offsets), F.col("__segment") == F.col("__at"))
        .select(*scored.columns, F.when(rank <= drawn, rank).alias("rank"))
    )
    return ranked.union(placed.where(~reached).select(*scored.columns, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    max_words: int = 1,
    min_words: int = MIN_WORDS,
    percent: int = DRAW_PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of `docs`, drawn towards the texts of `target`.

    `percent` of the rows with at least `min_words` words are drawn; the others have a null rank. The id is an integer.
    Null and empty texts have no features, weight 0, and are never drawn for a positive `min_words`; null ids share one
    noise and come after all others of their score; repeated rows are each scored and take ranks one after the other;
    an empty `docs` gives an empty result, an empty `target` flat targets. Very long texts are hashed whole, alone in
    their slice. Other columns are not read.
    """
    gains = bucket_gains(bucket_counts(docs, max_words, text_column), bucket_counts(target, max_words, text_column))
    scored = _weights(docs, gains, max_words, id_column, text_column)
    scored = scored.withColumn("score", F.col("weight") + noise(id_column)).withColumn("__row", F.monotonically_increasing_id())
    scored = cut(scored)
    eligible = F.col("n_words") >= min_words
    n = scored.where(eligible).count()
    return rank_rows(scored, eligible, percent * n // 100, n, id_column).select(id_column, "n_features", "weight", "score", "rank")


ORACLE_SQL = rf"""
WITH crc(t) AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, CAST(n AS BIGINT)))),
w AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
d AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM w UNION SELECT word FROM b)),
k AS (SELECT word, xor(4294967295, list_reduce(
    list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)),
    lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), CAST(4294967295 AS BIGINT))) % {BUCKETS} AS bucket FROM d, crc),
s AS (SELECT bucket, count(*) AS n FROM w JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN k USING (word) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(
    ((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS}.0::DOUBLE))
    / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS}.0::DOUBLE)))) AS BIGINT) AS gain
    FROM (SELECT unnest(range({BUCKETS})) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
f AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
    FROM w JOIN k USING (word) JOIN g USING (bucket) GROUP BY doc_id),
e AS (SELECT documents.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || documents.doc_id), 1, 8) AS BIGINT)
        + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM documents LEFT JOIN f ON f.doc_id = documents.doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM e WHERE n_features >= {MIN_WORDS})
SELECT e.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, CAST(score AS BIGINT) AS score, CAST(r.rank AS BIGINT) AS rank
FROM e LEFT JOIN r ON r.doc_id = e.doc_id
    AND r.rank <= (SELECT count(*) * {DRAW_PERCENT} // 100 FROM e WHERE n_features >= {MIN_WORDS})
"""
