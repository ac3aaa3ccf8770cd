"""Toxicity as expected severity from a cumulative-link (proportional odds) regression on sparse text features.

Grades are ordered: 0 is not toxic, 1 to 3 are toxic texts by how many of the words they hold that mark toxic labels.
P(grade >= k) = sigmoid(w.x + b_k) with one weight per word shared by all thresholds and b_1 > b_2 > b_3; the expected
severity is the sum of the three probabilities. Features are whether a word occurs in the text, by its exact hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.llm.common import RangeHash, ragged, slices
from flowstats.llm.quality import fold, labelled_sample

#: At most this many labelled rows are fitted on; bounds what is collected, whatever the size of the tables.
SAMPLE_ROWS = 8192
#: A word is a feature if it occurs in so many rows of the sample.
MIN_ROWS = 4
#: and if its share among toxic and other rows differs by so many standard errors.
MIN_DEVIATIONS = 5.0
PREFIXES = (4, 5, 6)
GRADES = 3
SLICE_BYTES = 2 << 20
#: A text is toxic if P(grade >= 1) is at least this.
THRESHOLD = 0.4

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of the words of each text and of the longer words' beginnings of 4, 5 and 6 bytes.

    A word is a run of letters, digits and non-ASCII bytes, in lower case; a beginning never equals a whole word.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = _LETTER[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.r_[False, inside[:-1]] & ~edge[:n]
    after = np.r_[inside[1:], False] & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    ranged = RangeHash(data, lower=True)
    hashes, owners = [ranged(starts, ends)], [owner]
    for k in PREFIXES:
        long = ends - starts > k
        hashes.append(ranged.fixed(starts[long], k) ^ np.uint64(k))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class OrdinalModel:
    """Sorted word hashes with their weights, and the decreasing intercepts of the thresholds."""

    words: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def probabilities(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """P(grade >= k) for k = 1.. of n texts."""
        total = np.zeros(n)
        if len(self.words) and len(hashes):
            sieve = np.zeros(1 << 16, bool)
            sieve[self.words >> np.uint64(48)] = True
            maybe = sieve[hashes >> np.uint64(48)]
            hashes, owner = hashes[maybe], owner[maybe]
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = self.words[at] == hashes
            seen = np.unique(owner[hit] * len(self.words) + at[hit])  # a word counts once per text
            total = np.bincount(seen // len(self.words), self.weights[seen % len(self.words)], n)
        return _sigmoid(total[:, None] + self.cuts[None, :])


def select(rows: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, whether they mark toxic rows) of the words that tell the two kinds of rows apart."""
    words, counts = np.unique(np.concatenate(rows), return_counts=True)
    words, counts = words[counts >= MIN_ROWS], counts[counts >= MIN_ROWS]
    in_toxic, found = np.unique(np.concatenate([r for r, t in zip(rows, toxic, strict=True) if t]), return_counts=True)
    at = np.minimum(np.searchsorted(in_toxic, words), len(in_toxic) - 1)
    k = np.where(in_toxic[at] == words, found[at], 0) if len(in_toxic) else np.zeros(len(words))
    n, m = len(rows), toxic.sum()
    share = counts / n
    deviation = (k / m - (counts - k) / (n - m)) / np.sqrt(share * (1 - share) * (1 / m + 1 / (n - m)) + 1e-12)
    chosen = np.abs(deviation) >= MIN_DEVIATIONS
    return words[chosen], deviation[chosen] > 0


def grades(toxic: np.ndarray, columns: list[np.ndarray], marks: np.ndarray) -> np.ndarray:
    """Ordered grades of labelled texts: toxic ones split at the thirds of how many marking words they hold."""
    count = np.array([marks[c].sum() for c in columns])
    out = np.zeros(len(toxic), np.int64)
    edges = np.quantile(count[toxic], np.arange(1, GRADES) / GRADES)
    out[toxic] = 1 + np.searchsorted(edges, count[toxic], side="left")
    return out


def likelihood_gradient(weights, cuts, row, col, y, importance, penalty) -> np.ndarray:
    """Gradient, by the weights and then the cuts, of the mean weighted log likelihood of the grades less the penalty.

    Text `row[i]` holds feature `col[i]`. A grade's probability is P(>=k) - P(>=k+1), by its two bounding thresholds.
    """
    n = len(y)
    p = _sigmoid(np.bincount(row, weights[col], n)[:, None] + cuts[None, :])
    upper = np.c_[np.ones(n), p]
    lower = np.c_[p, np.zeros(n)]
    mass = np.maximum((upper - lower)[np.arange(n), y], 1e-9)
    slope = p * (1 - p)
    d = np.zeros((n, GRADES))
    has = y > 0
    d[np.flatnonzero(has), y[has] - 1] += slope[np.flatnonzero(has), y[has] - 1]
    below = y < GRADES
    d[np.flatnonzero(below), y[below]] -= slope[np.flatnonzero(below), y[below]]
    d *= (importance / mass)[:, None] / n
    return np.r_[np.bincount(col, d.sum(1)[row], len(weights)) - penalty * weights, d.sum(0)]


def fit(rows: list[np.ndarray], toxic: np.ndarray, rounds: int = 400, penalty: float = 3e-4) -> OrdinalModel:
    """Fit weights and cuts by gradient steps with momentum on the cumulative likelihood.

    `rows` holds the distinct word hashes of each text. Without rows of both kinds the model predicts the share of
    toxic rows (0 without rows).
    """
    n = len(rows)
    share = (toxic.sum() + 0.5) / (n + 1.0) if n else 1e-6
    flat = np.log(share / (1 - share)) - np.arange(GRADES)
    if not n or toxic.all() or not toxic.any():
        return OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), flat)
    words, marks = select(rows, toxic)
    if not len(words):
        return OrdinalModel(words, np.zeros(0), flat)
    columns = []
    for r in rows:
        at = np.minimum(np.searchsorted(words, r), max(len(words) - 1, 0))
        columns.append(at[words[at] == r] if len(words) else np.zeros(0, np.int64))
    y = grades(toxic, columns, marks)
    row = np.repeat(np.arange(n), [len(c) for c in columns])
    col = np.concatenate(columns)
    weights, cuts = np.zeros(len(words)), flat.copy()
    # The rarer kind of rows counts more, by the root of how much rarer it is.
    importance = 1 / np.sqrt(np.where(toxic, toxic.sum(), (~toxic).sum()) / n)
    importance /= importance.mean()
    m1, v1 = np.zeros(len(words) + GRADES), np.zeros(len(words) + GRADES)
    for step in range(1, rounds + 1):
        gradient = likelihood_gradient(weights, cuts, row, col, y, importance, penalty)
        m1 = 0.9 * m1 + 0.1 * gradient
        v1 = 0.99 * v1 + 0.01 * gradient**2
        move = 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(v1 / (1 - 0.99**step)) + 1e-8)
        weights += move[: len(words)]
        cuts += move[len(words) :]
        cuts = np.minimum.accumulate(cuts)  # thresholds stay in order
    return OrdinalModel(words, weights, cuts)


def _labelled_words(rows: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct word hashes and labels of a bounded table (text, label)."""

    def run(batches):
        for batch in batches:
            data, offsets = ragged(batch.column(0))
            hashes, owner = terms(data, offsets)
            order = np.argsort(owner, kind="stable")
            hashes, edges = hashes[order], np.searchsorted(owner[order], np.arange(batch.num_rows + 1))
            sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int32()), pa.array(sets, pa.binary())], names=["label", "words"]
            )

    got = rows.mapInArrow(run, "label int, words binary").collect()  # SAMPLE_ROWS rows at most
    return [np.frombuffer(r["words"], np.uint64) for r in got], np.array([r["label"] > 0 for r in got], bool)


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`docs` with expected_severity (0 to 3), severity (most likely grade) and toxic (boolean) for every row.

    Learns from `labels` (doc_id, toxic) outside fold 0 of the id's crc32, on a bounded sample. Columns of `docs` with
    these names are replaced. A null or empty text has no word and is graded by the cuts alone; a text of any length is
    graded whole; null ids and repeated rows are graded like any other, and of a repeated id with a label the smallest
    text is learnt from; an empty table gives an empty result. One narrow pass after fitting.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "toxic", sample_rows).orderBy("doc_id")
    model = spark.sparkContext.broadcast(fit(*_labelled_words(sample.select("text", "label"))))
    added = ["expected_severity", "severity", "toxic"]
    kept = docs.drop(*added)
    at = kept.columns.index("text")

    def run(batches):
        m = model.value
        for batch in batches:
            data, offsets = ragged(batch.column(at))
            for lo, hi in slices(offsets, SLICE_BYTES):
                hashes, owner = terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                p = m.probabilities(hashes, owner, hi - lo)
                grade = np.argmax(np.c_[np.ones(len(p)), p] - np.c_[p, np.zeros(len(p))], axis=1)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p.sum(1)), pa.array(grade.astype(np.int32)), pa.array(p[:, 0] >= THRESHOLD)],
                    names=[*part.schema.names, *added],
                )

    out = T.StructType(
        [*kept.schema.fields, T.StructField(added[0], T.DoubleType()), T.StructField(added[1], T.IntegerType()),
         T.StructField(added[2], T.BooleanType())]
    )
    return kept.mapInArrow(run, out)


def held_out(docs: DataFrame) -> DataFrame:
    """The rows of fold 0, which no model of this module learns from."""
    return docs.where(fold(5) == 0)
