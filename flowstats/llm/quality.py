"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Texts become sparse counts (shapes of three characters, hashed words, repetition), weighted by the idf of the labelled
sample and projected on its leading singular directions. The labelled vectors are broadcast; each block of documents
is multiplied with all of them, so the cosines are exact, and the nearest neighbours vote, weighted by similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowstats.llm.common import RangeHash, mix, ragged, slices, word_spans

#: At most this many labelled rows are fitted on (those with the smallest hashes of their ids); bounds what is
#: collected and broadcast whatever the size of the tables.
SAMPLE_ROWS = 3000
DIMENSIONS, NEIGHBOURS, SHARPNESS = 48, 25, 4
THRESHOLD = 0.3  # fixed value: score from which a document is predicted to be good
#: Texts are featurized in slices of so many bytes and rows: a row takes WIDTH floats however short its text is.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 512
WORD_BUCKETS, SHAPES, REPEAT_BINS = 2048, 16**3, 32
WIDTH = SHAPES + WORD_BUCKETS + 2 * REPEAT_BINS


def _shape_classes() -> np.ndarray:
    """16 classes of bytes: letters by case, digits, white space, common marks, and parts of longer characters."""
    c = np.full(256, 13, np.int64)  # other marks
    c[ord("a") : ord("z") + 1], c[ord("A") : ord("Z") + 1], c[ord("0") : ord("9") + 1] = 0, 1, 2
    c[ord(" ")], c[[9, 10, 11, 12, 13]] = 3, 4
    for i, marks in enumerate((".", ",", "!?", "|", "%$&*#", "-_=+~", "<>/\\", "@:;"), 5):
        c[[ord(m) for m in marks]] = i
    c[128:192], c[192:256] = 14, 15
    return c


_CLASS = _shape_classes()


def featurize(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Weighted counts, a row of WIDTH floats per text."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(n), lengths)
    cls = _CLASS[data]
    out = np.zeros((n, WIDTH), np.float32)
    if len(data) > 2:
        same = row[2:] == row[:-2]
        key = (row[2:] * SHAPES + cls[:-2] * 256 + cls[1:-1] * 16 + cls[2:])[same]
        out[:, :SHAPES] = np.bincount(key, minlength=n * SHAPES).reshape(n, SHAPES)
    starts, ends, by_row = word_spans(data, offsets)
    if len(starts):
        hashes = RangeHash(data, lower=True)(starts, ends)
        owner = np.repeat(np.arange(n), np.diff(by_row))
        bucket = (hashes >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS
        out[:, SHAPES : SHAPES + WORD_BUCKETS] = np.bincount(
            owner * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS
        ).reshape(n, WORD_BUCKETS)
        out[:, SHAPES + WORD_BUCKETS :] = _repetition(hashes, owner, n)
    out[:, :SHAPES] /= np.maximum(lengths, 1)[:, None]
    words = np.maximum(np.diff(by_row), 1)[:, None]
    out[:, SHAPES : SHAPES + WORD_BUCKETS] /= words
    return np.sqrt(out, out=out)


def _repetition(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Share of word pairs that came before in the text, and of words equal to the one before."""
    if len(hashes) < 2:
        return np.zeros((n, 2 * REPEAT_BINS), np.float32)
    pair = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    inside = owner[:-1] == owner[1:]
    twin = (hashes[:-1] == hashes[1:])[inside]
    pair, of = pair[inside], owner[:-1][inside]
    order = np.lexsort((pair, of))
    again = np.zeros(len(pair), bool)
    again[1:] = (pair[order][1:] == pair[order][:-1]) & (of[order][1:] == of[order][:-1])
    return np.c_[_binned(again, of[order], n), _binned(twin, of, n)]


def _binned(flags: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Each text's share of flags, as a position between two bins."""
    out = np.zeros((n, REPEAT_BINS), np.float32)
    total = np.bincount(of, minlength=n)
    place = np.bincount(of, flags, minlength=n) / np.maximum(total, 1) * (REPEAT_BINS - 1)
    low = place.astype(np.int64)
    rows = np.flatnonzero(total)
    out[rows, low[rows]] = (1 - (place - low))[rows] * 0.2
    out[rows, np.minimum(low + 1, REPEAT_BINS - 1)[rows]] += (place - low)[rows] * 0.2
    return out


@dataclass
class NeighbourModel:
    weights: np.ndarray  # idf of each feature
    basis: np.ndarray  # feature x direction
    vectors: np.ndarray  # labelled rows, unit length
    labels: np.ndarray
    prior: float

    def project(self, features: np.ndarray) -> np.ndarray:
        z = (features * self.weights) @ self.basis
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        return np.divide(z, norm, out=np.zeros_like(z), where=norm > 1e-12)

    def score(self, features: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(features), self.prior)
        z = self.project(features)
        cosines = z @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        # Vectors as near as the k-th share the places that are left, so no order of the sample decides.
        least = np.partition(cosines, -k, axis=1)[:, -k, None]
        above, tied = cosines > least, cosines == least
        share = (k - above.sum(1)) / np.maximum(tied.sum(1), 1)
        weight = np.clip(cosines, 0, 1) * (above | tied)
        weight = np.where(tied, share[:, None], 1.0) * weight.astype(np.float64) ** SHARPNESS
        total = weight.sum(1)
        votes = weight @ self.labels
        return np.where(total > 0, votes / np.where(total > 0, total, 1), self.prior)


def fit(features: np.ndarray, labels: np.ndarray) -> NeighbourModel:
    """The model of the labelled rows; without any, every score is 1/2."""
    if not len(labels):
        empty = np.zeros((0, DIMENSIONS), np.float32)
        return NeighbourModel(np.ones(WIDTH, np.float32), np.zeros((WIDTH, DIMENSIONS), np.float32), empty, labels, 0.5)
    seen = (features > 0).sum(0)
    weights = np.log((1 + len(labels)) / (1 + seen)).astype(np.float32) + np.float32(0.1)
    x = features * weights
    rng = np.random.Generator(np.random.PCG64(8))
    probe = rng.standard_normal((WIDTH, DIMENSIONS + 8)).astype(np.float32)
    for _ in range(4):  # power iterations towards the leading directions
        probe, _ = np.linalg.qr(x.T @ (x @ probe))
    _, _, rotate = np.linalg.svd(x @ probe, full_matrices=False)
    basis = np.ascontiguousarray((probe @ rotate.T)[:, :DIMENSIONS], np.float32)
    model = NeighbourModel(weights, basis, np.zeros((0, DIMENSIONS), np.float32), labels, float(labels.mean()))
    model.vectors = model.project(features).astype(np.float32)
    return model


def _features_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded table (text, label), as sparse rows from the tasks."""

    def run(batches):
        for batch in batches:
            data, offsets = ragged(batch.column(0))
            for lo, hi in slices(offsets, SLICE_BYTES, SLICE_ROWS):
                f = featurize(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = [np.flatnonzero(r).astype(np.uint16) for r in f]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(lo, hi - lo).cast(pa.int32()),
                        pa.array([a.tobytes() for a in at], pa.binary()),
                        pa.array([r[a].tobytes() for r, a in zip(f, at, strict=True)], pa.binary()),
                    ],
                    names=["label", "at", "value"],
                )

    got = rows.mapInArrow(run, "label int, at binary, value binary").collect()  # SAMPLE_ROWS rows at most
    features = np.zeros((len(got), WIDTH), np.float32)
    for i, r in enumerate(got):
        features[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    return features, np.array([r["label"] for r in got], np.float64)


def fold(folds: int):
    """Remainder of the id's crc32; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, rows: int, folds: int = 5) -> DataFrame:
    """(doc_id, text, label) of at most `rows` rows to learn from: outside fold 0, with the smallest hashes of the id.

    Only ids and labels are ordered; the texts are joined to that bounded choice. Null labels are left out, and a
    document with several labels counts with its smallest, an id with several texts with the smallest of these.
    """
    chosen = (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (fold(folds) != 0))
        .groupBy("doc_id")
        .agg(F.min(column).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs` (doc_id, text).

    Learns from `labels` (doc_id, quality) outside the held-out fold, on a bounded sample. The score is the voted
    share of good neighbours, 0 to 1; a text without any feature (null, empty) gets the sample's share of good rows,
    and 1/2 without labelled rows. Neighbours equally near share the last places. A null id is held out; repeated rows
    are each returned; other columns are not read; texts of any length are read whole; an empty table gives an empty
    result. One narrow pass over the documents after fitting.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "quality", sample_rows).select("doc_id", "text", "label")
    sample = sample.orderBy("doc_id").select("text", "label")
    model = spark.sparkContext.broadcast(fit(*_features_of(sample)))
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        m = model.value
        for batch in batches:
            data, offsets = ragged(batch.column(1))
            for lo, hi in slices(offsets, SLICE_BYTES, SLICE_ROWS):
                f = featurize(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                score = np.clip(m.score(f), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(score, pa.float64()),
                        pa.array((score >= THRESHOLD).astype(np.int32), pa.int32()),
                    ],
                    names=["doc_id", "score", "predicted"],
                )

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double, predicted int")
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")
