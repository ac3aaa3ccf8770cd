"""Language-model scores from an interpolated modified Kneser-Ney bigram model counted in Spark.

Counting is three shuffles of pre-aggregated, sorted integer blocks: word hashes, word pairs (as pairs of ranks in the
sorted word hashes, so a pair is exact in 64 bits), and left contexts per word. Every group writes its part of the
model as sorted arrays to the shared folder; scoring tasks memory-map those files, so the model may be larger than
memory. Nothing of the model passes through the driver but one manifest row per file and the counts of counts.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowstats.llm.common import RangeHash, cut, open_store, pack, ragged, shared_dir, slices, text_volume, unpack, word_spans

#: Text bytes hashed at once in a task, and words gathered before their counts are sent; they bound a task's memory.
SLICE_BYTES, GATHER_WORDS = 2 << 20, 2_000_000
#: Text bytes of the corpus per bucket of the shuffles and file of the model.
BUCKET_BYTES = 16 << 20
#: A left context with more occurrences than this is split over several buckets by the following word.
HOT_CONTEXT = 500_000
END_HASH = np.uint64(0xE0D0F0D0C5A1B2C3)
START_ID = np.uint32(0xFFFFFFFF)
ADD = 0.1  # fixed value: the base score's added count


def _write(uri: str, name: str, *arrays: np.ndarray) -> str:
    """Arrays one after the other in a new file; the name is this attempt's own."""
    store, root = open_store(uri)
    store.create_dir(root, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{root}/{name}") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).data if len(a) else b"")
    return name


def _mapped(path: str) -> np.ndarray:
    return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)


@lru_cache(maxsize=64)
def _fetched(uri: str, name: str) -> np.ndarray:
    """A file of a store without a mount, copied once per worker for the 64 used last; the copy goes when it is unmapped.

    Names are never used twice, so what is held is never out of date.
    """
    store, root = open_store(uri)
    fd, path = tempfile.mkstemp()
    try:
        with store.open_input_stream(f"{root}/{name}") as f, os.fdopen(fd, "wb") as out:
            while part := f.read(8 << 20):
                out.write(part)
        return _mapped(path)
    finally:
        os.unlink(path)


def _map(uri: str, name: str, layout: list[tuple[str, int]]) -> list[np.ndarray]:
    """The file's arrays, memory-mapped."""
    store, root = open_store(uri)
    whole = _mapped(f"{root}/{name}") if isinstance(store, pafs.LocalFileSystem) else _fetched(uri, name)
    out, at = [], 0
    for dtype, n in layout:
        size = np.dtype(dtype).itemsize * n
        out.append(whole[at : at + size].view(dtype))
        at += size
    return out


def doc_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, token offsets by document): the document's lower-cased words, then the end."""
    starts, ends, by_doc = word_spans(data, offsets)
    hashed = RangeHash(data, lower=True)(starts, ends)
    n = len(offsets) - 1
    out = np.empty(len(hashed) + n, np.uint64)
    token_offsets = by_doc + np.arange(n + 1)
    at_end = token_offsets[1:] - 1
    words = np.ones(len(out), bool)
    words[at_end] = False
    out[words], out[at_end] = hashed, END_HASH
    return out, token_offsets


def _bucket_of_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Ranges of the hash values, so that buckets in order are sorted."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _scatter(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Vocabulary:
    """Sorted word hashes and their counts, a file per range of hashes."""

    uri: str
    names: list[str]
    sizes: list[int]
    tokens: int

    def __post_init__(self):
        self.starts = np.r_[0, np.cumsum(self.sizes)].astype(np.int64)
        self.types = int(self.starts[-1])
        if self.types >= int(START_ID):
            raise ValueError("more than 2**32 - 2 distinct words")

    def open(self):
        self._parts = {}
        return self

    def part(self, b: int) -> list[np.ndarray]:
        if b not in self._parts:
            n = self.sizes[b]
            self._parts[b] = _map(self.uri, self.names[b], [("u8", n), ("u8", n)]) if n else [np.zeros(0, "u8")] * 2
        return self._parts[b]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of the hashes; -1 and 0 for words not in the vocabulary."""
        unique, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(unique), -1, np.int64), np.zeros(len(unique), np.int64)
        bucket = _bucket_of_hash(unique, len(self.sizes))
        edges = np.searchsorted(bucket, np.arange(len(self.sizes) + 1))
        for b in np.flatnonzero(np.diff(edges)):
            lo, hi = edges[b], edges[b + 1]
            keys, n = self.part(b)
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, unique[lo:hi]), len(keys) - 1)
            hit = keys[at] == unique[lo:hi]
            ids[lo:hi] = np.where(hit, self.starts[b] + at, -1)
            counts[lo:hi] = np.where(hit, n[at], 0)
        return ids[back], counts[back]


def _gathered(batches):
    """(token hashes, token offsets, ids of the rows) of slices of the text column, each of bounded size."""
    for batch in batches:
        data, offsets = ragged(batch.column(1))
        for lo, hi in slices(offsets, SLICE_BYTES):
            part = data[offsets[lo] : offsets[hi]]
            yield (*doc_words(part, offsets[lo : hi + 1] - offsets[lo]), batch.slice(lo, hi - lo))


def _blocks(bucket: np.ndarray, columns: list[np.ndarray]):
    """A row (bucket, payloads) for each run of equal buckets."""
    heads = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    tails = np.r_[heads[1:], len(bucket)][: len(heads)]
    arrays = [pa.array(bucket[heads].astype(np.int32), pa.int32())]
    for c in columns:
        arrays.append(pa.array([pack(c[a:b]) for a, b in zip(heads, tails, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "a", "b"][: len(arrays)])


def _joined(table: pa.Table, dtypes: list[str]) -> list[np.ndarray]:
    return [
        np.concatenate([unpack(x, t) for x in table.column(i + 1).to_pylist()] or [np.zeros(0, t)])
        for i, t in enumerate(dtypes)
    ]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.uint64)
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _pair_bucket(left: np.ndarray, left_count: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """A context's bucket; a hot context has one for each residue of the following word."""
    salt = right.astype(np.uint64) % (left_count.astype(np.uint64) // np.uint64(HOT_CONTEXT) + np.uint64(1))
    return _bucket_of_hash(_scatter(_scatter(left) + salt), n)


def count_vocabulary(train: DataFrame, uri: str, n_buckets: int) -> Vocabulary:
    def words(batches):
        held, size = [], 0
        for tokens, _, _ in _gathered(batches):
            held.append(tokens)
            size += len(tokens)
            if size >= GATHER_WORDS:
                yield send(held)
                held, size = [], 0
        if held:
            yield send(held)

    def send(held):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return _blocks(_bucket_of_hash(keys, n_buckets), [keys, counts.astype(np.uint32)])

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = _summed(*_joined(table, ["u8", "u4"]))
        name = _write(uri, "words", keys, counts)
        return pa.table(
            {"bucket": [table.column(0)[0].as_py()], "name": [name], "n": [len(keys)], "total": [int(counts.sum())]},
            schema=pa.schema([("bucket", pa.int32()), ("name", pa.string()), ("n", pa.int64()), ("total", pa.int64())]),
        )

    rows = (
        cut(
            train.mapInArrow(words, "bucket int, a binary, b binary")
            .groupBy("bucket")
            .applyInArrow(merge, "bucket int, name string, n long, total long")
        )
        .orderBy("bucket")
        .collect()  # a row per file
    )
    names, sizes = [""] * n_buckets, [0] * n_buckets
    for r in rows:
        names[r.bucket], sizes[r.bucket] = r.name, r.n
    return Vocabulary(uri, names, sizes, sum(r.total for r in rows))


def _pairs(tokens: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary):
    """(left id, left count, right id, right count) of every token; the left of a document's first is the start."""
    ids, counts = vocabulary.find(tokens)
    left, left_count = np.empty_like(ids), np.empty_like(counts)
    left[1:], left_count[1:] = ids[:-1], counts[:-1]
    left[offsets[:-1]], left_count[offsets[:-1]] = int(START_ID), 0
    return left, left_count, ids, counts


def count_pairs(train: DataFrame, uri: str, vocabulary: Vocabulary, n_buckets: int, n_docs: int) -> list[dict]:
    """A manifest row per pair file: sorted pair keys and counts, then its contexts and their counts of counts."""

    def pairs(batches):
        words, held, size = vocabulary.open(), [], 0
        for tokens, offsets, _ in _gathered(batches):
            left, left_count, right, _ = _pairs(tokens, offsets, words)
            left_count[left == int(START_ID)] = n_docs
            held.append(((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64), left_count))
            size += len(tokens)
            if size >= GATHER_WORDS:
                yield send(held)
                held, size = [], 0
        if held:
            yield send(held)

    def send(held):
        keys, first, counts = np.unique(np.concatenate([k for k, _ in held]), return_index=True, return_counts=True)
        left_count = np.concatenate([c for _, c in held])[first]
        bucket = _pair_bucket(keys >> np.uint64(32), left_count, keys & np.uint64(0xFFFFFFFF), n_buckets)
        order = np.argsort(bucket, kind="stable")
        return _blocks(bucket[order], [keys[order], counts[order].astype(np.uint32)])

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = _summed(*_joined(table, ["u8", "u4"]))
        left = (keys >> np.uint64(32)).astype(np.uint32)
        heads = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
        seen = [np.add.reduceat(m, heads, dtype=np.uint32) for m in (counts == 1, counts == 2, counts >= 3)]
        name = _write(uri, "pairs", keys, counts, left[heads], *seen)
        return pa.table(
            {
                "bucket": [table.column(0)[0].as_py()], "name": [name], "n": [len(keys)], "contexts": [len(heads)],
                "of": [[int((counts == k).sum()) for k in (1, 2, 3, 4)]],
            },
            schema=_PAIR_FILES,
        )

    rows = cut(
        train.mapInArrow(pairs, "bucket int, a binary, b binary")
        .groupBy("bucket")
        .applyInArrow(merge, "bucket int, name string, n long, contexts long, of array<long>")
    ).collect()  # a row per file
    out = [{"name": "", "n": 0, "contexts": 0, "of": [0] * 4} for _ in range(n_buckets)]
    for r in rows:
        out[r.bucket] = {"name": r.name, "n": r.n, "contexts": r.contexts, "of": list(r.of)}
    return out


_PAIR_FILES = pa.schema(
    [("bucket", pa.int32()), ("name", pa.string()), ("n", pa.int64()), ("contexts", pa.int64()), ("of", pa.list_(pa.int64()))]
)


def _open_pairs(uri: str, row: dict) -> list[np.ndarray]:
    n, c = row["n"], row["contexts"]
    return _map(uri, row["name"], [("u8", n), ("u8", n), ("u4", c), ("u4", c), ("u4", c), ("u4", c)])


def count_left_contexts(spark, uri: str, vocabulary: Vocabulary, files: list[dict]) -> tuple[list[str], list[int]]:
    """(a file per vocabulary file with each word's number of distinct left contexts, counts of these counts 1-4)."""
    tasks = spark.createDataFrame([(i,) for i, f in enumerate(files) if f["n"]], "file int")
    n_words = len(vocabulary.sizes)

    def lefts(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                keys = _open_pairs(uri, files[i])[0]
                right, counts = np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_counts=True)
                bucket = np.searchsorted(vocabulary.starts, right, side="right") - 1
                yield _blocks(bucket, [right, counts.astype(np.uint32)])

    def merge(table: pa.Table) -> pa.Table:
        b = table.column(0)[0].as_py()
        right, counts = _joined(table, ["u4", "u4"])
        dense = np.bincount(right - np.uint32(vocabulary.starts[b]), counts, vocabulary.sizes[b]).astype(np.uint64)
        name = _write(uri, "lefts", dense)
        return pa.table(
            {"bucket": [b], "name": [name], "of": [[int((dense == k).sum()) for k in (1, 2, 3, 4)]]},
            schema=pa.schema([("bucket", pa.int32()), ("name", pa.string()), ("of", pa.list_(pa.int64()))]),
        )

    rows = cut(
        tasks.repartition(max(1, min(len(files), 4096)), "file")
        .mapInArrow(lefts, "bucket int, a binary, b binary")
        .groupBy("bucket")
        .applyInArrow(merge, "bucket int, name string, of array<long>")
    ).collect()  # a row per file
    names, of = [""] * n_words, np.zeros(4, np.int64)
    for r in rows:
        names[r.bucket] = r.name
        of += r.of
    return names, of.tolist()


def discounts(of: list[int]) -> tuple[float, float, float]:
    """The three modified Kneser-Ney discounts from the numbers of n-grams seen 1, 2, 3, 4 times.

    Where too few n-grams exist to estimate one, it is half its count.
    """
    n1, n2, n3, n4 = (float(x) for x in of)
    y = n1 / (n1 + 2 * n2) if n1 + n2 > 0 else 0.0
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a > 0 and b > 0 else k / 2
        out.append(d if 0 < d < k else k / 2)
    return tuple(out)


@dataclass
class Model:
    """A counted model; workers map its files."""

    uri: str
    vocabulary: Vocabulary
    pair_files: list[dict]
    left_files: list[str]
    pair_discounts: tuple
    left_discounts: tuple
    left_of: list[int]
    pairs: int
    docs: int

    def open(self):
        self.vocabulary.open()
        self._pairs, self._lefts = {}, {}
        v, d = self.vocabulary.types, self.left_discounts
        rest = v - self.left_of[0] - self.left_of[1]
        left = (d[0] * self.left_of[0] + d[1] * self.left_of[1] + d[2] * rest) / self.pairs if self.pairs else 1.0
        self.floor = left / (v + 1)
        return self

    def word_probability(self, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), self.floor)
        known = np.flatnonzero(ids >= 0)
        unique, back = np.unique(ids[known], return_inverse=True)
        lefts = np.zeros(len(unique))
        bucket = np.searchsorted(self.vocabulary.starts, unique, side="right") - 1
        edges = np.searchsorted(bucket, np.arange(len(self.vocabulary.sizes) + 1))
        for b in np.flatnonzero(np.diff(edges)):
            if b not in self._lefts:
                self._lefts[b] = _map(self.uri, self.left_files[b], [("u8", self.vocabulary.sizes[b])])[0]
            lefts[edges[b] : edges[b + 1]] = self._lefts[b][unique[edges[b] : edges[b + 1]] - self.vocabulary.starts[b]]
        out[known] += ((lefts - _discount(lefts, self.left_discounts)) / self.pairs)[back]
        return out

    def probabilities(self, left, left_count, right) -> np.ndarray:
        """p(right | left) of every token."""
        start = left == int(START_ID)
        left_count = np.where(start, self.docs, left_count).astype(np.int64)
        lower = self.word_probability(right)
        higher, share = np.zeros(len(right)), np.ones(len(right))
        seen = np.flatnonzero((left >= 0) & (left_count > 0))
        known_right = np.where(right[seen] >= 0, right[seen], int(START_ID))  # no pair ends in the start
        keys = (left[seen].astype(np.uint64) << np.uint64(32)) | known_right.astype(np.uint64)
        n = len(self.pair_files)
        bucket = _pair_bucket(keys >> np.uint64(32), left_count[seen], known_right, n).astype(np.int64)
        order = np.lexsort((keys, bucket))
        keys, where, bucket, counts = keys[order], seen[order], bucket[order], left_count[seen][order]
        edges = np.searchsorted(bucket, np.arange(n + 1))
        d1, d2, d3 = self.pair_discounts
        for b in np.flatnonzero(np.diff(edges)):
            lo, hi = edges[b], edges[b + 1]
            f = self.part(b)
            if not len(f[0]):
                continue
            at = np.minimum(np.searchsorted(f[0], keys[lo:hi]), len(f[0]) - 1)
            c = np.where(f[0][at] == keys[lo:hi], f[1][at], 0).astype(np.float64)
            higher[where[lo:hi]] = (c - _discount(c, self.pair_discounts)) / counts[lo:hi]
            cold = counts[lo:hi] < HOT_CONTEXT
            context = (keys[lo:hi] >> np.uint64(32)).astype(np.uint32)
            at = np.minimum(np.searchsorted(f[2], context), len(f[2]) - 1)
            hit = (f[2][at] == context) & cold
            mass = d1 * f[3][at] + d2 * f[4][at] + d3 * f[5][at].astype(np.float64)
            share[where[lo:hi]] = np.where(hit, mass / counts[lo:hi], 1.0)
        hot = np.flatnonzero(left_count >= HOT_CONTEXT)
        if len(hot):
            contexts, first, back = np.unique(left[hot], return_index=True, return_inverse=True)
            share[hot] = np.array(
                [self.hot_mass(int(c), int(left_count[hot[i]])) for c, i in zip(contexts, first, strict=True)]
            )[back]
        return higher + share * lower

    def part(self, b: int) -> list[np.ndarray]:
        if b not in self._pairs:
            row = self.pair_files[b]
            self._pairs[b] = _open_pairs(self.uri, row) if row["n"] else [np.zeros(0, "u8")] * 2 + [np.zeros(0, "u4")] * 4
        return self._pairs[b]

    def hot_mass(self, context: int, count: int) -> float:
        """A hot context's share left to the lower order: the sum over its buckets."""
        key = ("hot", context)
        if key not in self._pairs:
            salts = np.arange(count // HOT_CONTEXT + 1, dtype=np.uint64)
            left = np.full(len(salts), context, np.uint64)
            buckets = np.unique(_pair_bucket(left, np.full(len(salts), count), salts, len(self.pair_files)))
            mass = 0.0
            for b in buckets.tolist():
                f = self.part(int(b))
                at = int(np.searchsorted(f[2], context))
                if at < len(f[2]) and f[2][at] == context:
                    mass += sum(d * int(f[3 + i][at]) for i, d in enumerate(self.pair_discounts))
            self._pairs[key] = mass / count
        return self._pairs[key]


def _discount(counts: np.ndarray, d: tuple) -> np.ndarray:
    return np.choose(np.minimum(counts, 3).astype(np.int64), (0.0, *d))


def fit(train: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Count a model over all rows of `train` (id, text); texts may be null or empty."""
    spark = train.sparkSession
    uri = f"{shared_dir(spark)}/lm-{uuid.uuid4().hex}"
    n_docs, n_bytes = text_volume(train, train.columns[1])
    n = max(1, -(-n_bytes // bucket_bytes))
    vocabulary = count_vocabulary(train, uri, n)
    files = count_pairs(train, uri, vocabulary, n, n_docs)
    lefts, left_of = count_left_contexts(spark, uri, vocabulary, files)
    pair_of = np.sum([f["of"] for f in files], axis=0).tolist()
    return Model(
        uri, vocabulary, files, lefts, discounts(pair_of), discounts(left_of), left_of, sum(f["n"] for f in files), n_docs
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs` (id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # file names and counts of counts only
    id_name, id_type = docs.columns[0], docs.dtypes[0][1]

    def run(batches):
        m = shared.value.open()
        total, types = m.vocabulary.tokens, m.vocabulary.types
        for tokens, offsets, rows in _gathered(batches):
            left, left_count, right, count = _pairs(tokens, offsets, m.vocabulary)
            logs = np.log10(m.probabilities(left, left_count, right))
            base = np.log10((count + ADD) / (total + ADD * (types + 1)))
            heads = offsets[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(np.add.reduceat(count > 0, heads, dtype=np.int64), pa.int64()),
                    pa.array(np.full(len(heads), total), pa.int64()),
                    pa.array(np.add.reduceat(base, heads), pa.float64()),
                    pa.array(np.add.reduceat(logs, heads), pa.float64()),
                ],
                names=[id_name, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.mapInArrow(
        run, f"`{id_name}` {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def score_documents(docs: DataFrame, folds: int = 10) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs` (doc_id, text).

    The model learns from the rows whose crc32 of the id's text leaves a remainder by `folds`; the others are held
    out. A null id counts as the empty text (held out), a null or empty text is one end token, repeated rows count
    and are returned each time, other columns are not read, and an empty table gives an empty result. Without any
    training row every word has probability 1 / (0 + 1).
    """
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "text", (crc % folds == 0).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")).select("doc_id", "text"))
    scored = score(rows.select("doc_id", "text"), model)
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return scored.select(
        "doc_id", (crc % folds == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
