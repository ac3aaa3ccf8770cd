"""Removal of repeated passages by a distributed difference-cover suffix sort.

A byte is removed if it lies in a string of LENGTH bytes that also starts in a document with a smaller id. Strings are
compared as in difference-cover suffix sorting, to the depth of LENGTH bytes:

1. Sample. Positions whose place in the document modulo 21 is in a difference cover of 21: for any two positions some
   shift under 21 brings both into the sample. A sampled position is named by its first LENGTH - 20 bytes, so every
   repeated string holds a pair of equal names. Names are sorted; unique ones are settled and leave the recursion.
2. Recurse on names. Of the surviving positions the triples of names (p, p + 21, p + 42) are sorted. A triple covers
   all strings that start in its first 21 bytes, so where a smaller document holds it, these are settled: the interior
   of every long repeat.
3. The sampled positions of strings that are still open are named and sorted once more, among themselves only: the
   smallest document with a string is never settled, so nothing that could settle a string is missing.
4. Merge the remaining suffixes. Every open string, sampled start or not, that holds a surviving name is sorted by its
   whole prefix of LENGTH bytes, and neighbours with equal prefixes are compared.

Triples and prefixes are sorted by names, not by their bytes: 64 bits of one hash of the whole string and 32 bits of
another with byte values of its own, so that strings which share any part are told apart by 96 bits. The names of the
samples in steps 1 and 3 are shorter; they only choose what is looked at further.

Documents are dealt in chunks that are ranges of the id, cut where their bytes fill a chunk; an id whose rows hold more
than a chunk has several chunks to itself, which are no source for each other. A chunk sends each distinct name once, as
sorted integers for one range of names, so a passage that a third of all documents share is a single entry per chunk; and
as chunks are ordered by id, comparing documents means comparing chunk numbers, and the answer to an entry is one bit. The
text is shuffled once and read again by every step. Chunks and ranges grow with the root of the input once a row would
hold fewer than ROW_ENTRIES names (from some 200 GB on), so the number of rows grows with the input, not its square.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.llm.common import RangeHash, cut, mix, pack, ragged, unpack

LENGTH = 50
# A perfect difference set modulo 21 (every residue is a difference of two members).
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
#: Text bytes per chunk of documents, and entries per range of names; they bound a task's memory.
CHUNK_BYTES, RANGE_ENTRIES = 3 << 20, 4_000_000
#: Names per row (a chunk's names in one range) that chunks and ranges are made large enough for.
ROW_ENTRIES = 64

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_STAGE = "bucket long, chunk int, a binary, b binary"
_STAGE_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _STAGE_ARROW, strict=True)], schema=_STAGE_ARROW)


class Chunk:
    """The texts of one range of document ids, in the order of their ids, with their sampled positions."""

    def __init__(self, table: pa.Table, length: int):
        self.length = length
        self.name_bytes = length - PERIOD + 1
        ids = table.column("doc_id").to_numpy()
        data, offsets = ragged(table.column("text"))
        sizes = np.diff(offsets)
        digest = [hashlib.md5(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], digest[i]))
        order = np.array(self.order, np.int64)
        self.sizes = sizes[order]
        self.offsets = np.r_[0, np.cumsum(self.sizes)].astype(np.int64)
        self.data = np.concatenate([data[offsets[i] : offsets[i + 1]] for i in order] or [np.zeros(0, np.uint8)])
        sorted_ids = ids[order]
        # Rows with one id are one rank: neither is smaller than the other.
        self.rank = np.cumsum(np.r_[False, sorted_ids[1:] != sorted_ids[:-1]]) if len(order) else order
        n = len(self.data)
        place = np.arange(n) - np.repeat(self.offsets[:-1], self.sizes)
        left = np.repeat(self.sizes, self.sizes) - place
        self.doc = np.repeat(np.arange(len(order), dtype=np.int32), self.sizes)
        self.starts = left >= length  # where a string of full length starts
        self.sample = np.flatnonzero(_IN_COVER[place % PERIOD] & (left >= self.name_bytes))
        self.names = RangeHash(self.data).fixed(self.sample, self.name_bytes)

    def ranks(self, positions: np.ndarray) -> np.ndarray:
        return self.rank[self.doc[positions]]

    def _more(self, at: np.ndarray, length: int) -> np.ndarray:
        """32 more bits for the names of the strings that start at `at`."""
        return (RangeHash(self.data, other=True).fixed(at, length) >> np.uint64(32)).astype(np.uint32)

    def triples(self, shared: np.ndarray) -> tuple[np.ndarray, Entries]:
        """(indexes into the sample, entries) of the triples of shared names."""
        step = len(COVER)
        i = np.arange(max(0, len(self.sample) - 2 * step))
        a, b, c = self.sample[i], self.sample[i + step], self.sample[i + 2 * step]
        ok = shared[i] & shared[i + step] & shared[i + 2 * step]
        ok &= (b - a == PERIOD) & (c - b == PERIOD) & (self.doc[a] == self.doc[c])
        i = i[ok]
        first, second, third = self.names[i], self.names[i + step], self.names[i + 2 * step]
        names = mix(mix(first * np.uint64(0x9E3779B97F4A7C15) + second) * np.uint64(0xD6E8FEB86659FD93) + third)
        at = self.sample[i]
        return i, Entries(names, self.ranks(at), self._more(at, 2 * PERIOD + self.name_bytes))

    def prefixes(self, at: np.ndarray) -> Entries:
        """Entries of the whole strings that start at `at`."""
        return Entries(RangeHash(self.data).fixed(at, self.length), self.ranks(at), self._more(at, self.length))

    def open_samples(self, settled: np.ndarray) -> np.ndarray:
        """Whether an unsettled string holds the name of a sampled position."""
        still = np.r_[0, np.cumsum(self.starts & ~settled)]
        return still[self.sample + 1] - still[np.maximum(self.sample - (PERIOD - 1), 0)] > 0

    def open_strings(self, settled: np.ndarray, named: np.ndarray) -> np.ndarray:
        """Starts of the unsettled strings that hold one of the named sampled positions."""
        mark = np.zeros(len(self.data) + 1, np.int64)
        mark[self.sample[named]] += 1
        upto = np.r_[0, np.cumsum(mark)]
        at = np.flatnonzero(self.starts & ~settled)
        return at[upto[at + PERIOD] - upto[at] > 0]


class Entries:
    """Distinct names of a chunk in order, with the smallest document that has each."""

    def __init__(self, names: np.ndarray, ranks: np.ndarray, second: np.ndarray | None = None):
        order = np.argsort(names, kind="stable") if second is None else np.lexsort((second, names))
        s = names[order]
        new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.zeros(0, bool)
        if second is not None and len(s):
            new[1:] |= second[order][1:] != second[order][:-1]
        heads = np.flatnonzero(new)
        self.names = s[heads]
        self.second = None if second is None else second[order][heads]
        self.of = np.empty(len(s), np.int64)
        self.of[order] = np.cumsum(new) - 1
        r = ranks[order]
        self.least = np.minimum.reduceat(r, heads) if len(heads) else r
        self.most = np.maximum.reduceat(r, heads) if len(heads) else r

    def rows(self, bucket: np.ndarray, chunk: int, payload: np.ndarray) -> list[tuple]:
        """A row for each range of names; the entries of a range are in order."""
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
        ends = np.r_[edges[1:], len(bucket)][: len(edges)]
        return [
            (int(bucket[a]), chunk, pack(payload[a:b], in_order=True), None if self.second is None else pack(self.second[a:b]))
            for a, b in zip(edges, ends, strict=True)
        ]


def _range_of(names: np.ndarray, ranges: int) -> np.ndarray:
    return (((names >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)).astype(np.int64)


def _short(names: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    """Names cut to their range and a few more bits: equal names stay equal, and few others meet."""
    return (_range_of(names, ranges).astype(np.uint64) << np.uint64(32)) | ((names >> np.uint64(8)) & np.uint64((1 << bits) - 1))


def _answers(table: pa.Table, wanted: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The answer bits of a chunk's entries in their order, and the bit arrays that the last step sent on."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "a", "b")), strict=True), key=lambda r: r[0])
    state = [r for r in rows if r[2] is not None]
    kept = []
    if state:
        sizes = np.frombuffer(state[0][2], np.int64)
        at = 0
        for n in sizes:
            size = -(-int(n) // 8)
            kept.append(np.unpackbits(np.frombuffer(state[0][1][at : at + size], np.uint8), count=int(n)).astype(bool))
            at += size
    bits = []
    for _, a, b in rows:
        if b is None:
            n = int(np.frombuffer(a[:8], np.int64)[0])
            bits.append(np.unpackbits(np.frombuffer(a[8:], np.uint8), count=n))
    out = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
    assert len(out) == wanted or wanted < 0, "an answer does not belong to its chunk"
    return out, kept


def _state_row(ranges: int, chunk: int, arrays: list[np.ndarray]) -> tuple:
    """Bit arrays that travel on to the next step of the same chunk, through a range of their own."""
    body = b"".join(np.packbits(a).tobytes() for a in arrays)
    return (ranges + chunk, chunk, body, np.array([len(a) for a in arrays], np.int64).tobytes())


def _bits(flags: np.ndarray) -> bytes:
    return np.int64(len(flags)).tobytes() + np.packbits(flags).tobytes()


def _settle(rows: DataFrame, ranges: int, whole: bool, cuts: Broadcast) -> DataFrame:
    """One range of names at a time: sort the entries of all chunks and answer each.

    Names of samples: does another chunk have this name? Names of `whole` strings: does a chunk of smaller ids have it?
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= ranges:  # a chunk's bits on their way
            return table.select(["bucket", "chunk", "a", "b"]).cast(_STAGE_ARROW)
        chunks = table.column("chunk").to_pylist()
        dtype = "u8" if whole else "u4"
        parts = [unpack(x, dtype, in_order=True) for x in table.column("a").to_pylist()]
        sizes = [len(p) for p in parts]
        names, chunk = np.concatenate(parts), np.repeat(np.array(chunks, np.int32), sizes)
        if whole:
            second = np.concatenate([unpack(x, "u4") for x in table.column("b").to_pylist()])
            order = np.lexsort((second, names))
        else:
            second, order = None, np.argsort(names)
        s = names[order]
        new = np.r_[True, s[1:] != s[:-1]]
        if second is not None:
            new[1:] |= second[order][1:] != second[order][:-1]
        heads = np.flatnonzero(new)
        flags = np.empty(len(s), bool)
        counts = np.diff(np.r_[heads, len(s)])
        if whole:
            first = np.repeat(np.minimum.reduceat(chunk[order], heads), counts)
            flags[order] = first < cuts.value.first_of_id(chunk[order])
        else:
            flags[order] = np.repeat(counts > 1, counts)
        out, at = [], 0
        for c, n in zip(chunks, sizes, strict=True):
            out.append((bucket, c, _bits(flags[at : at + n]), None))
            at += n
        return _table(out)

    return rows.groupBy("bucket").applyInArrow(run, _STAGE)


class Cuts:
    """Which chunk a row belongs to: ranges of ids, and several chunks for an id of its own."""

    def __init__(self, pieces: list[tuple[int, int]], chunk_bytes: int):
        """`pieces`: (first id, bytes) in order; small neighbours are joined up to the size of a chunk."""
        first, size = [], []
        for start, n in pieces:
            if first and size[-1] + n <= chunk_bytes:
                size[-1] += n
            else:
                first.append(start)
                size.append(n)
        self.first = np.array(first, np.int64)
        self.parts = np.maximum(1, -(-np.array(size, np.int64) // chunk_bytes))
        self.begin = (np.cumsum(self.parts) - self.parts).astype(np.int32)

    def chunk(self, ids: np.ndarray, salt: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ids, side="right") - 1
        return (self.begin[at] + salt % self.parts[at]).astype(np.int32)

    def first_of_id(self, chunks: np.ndarray) -> np.ndarray:
        """The first chunk of the same range of ids."""
        return self.begin[np.searchsorted(self.begin, chunks, side="right") - 1]


def _pieces(rows: Iterator[tuple[int, int]], chunk_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs of (id, bytes), in order, that fill a chunk at most; an id with more bytes is a run of its own."""
    start, size = None, 0
    for i, n in rows:
        if start is not None and size + n > chunk_bytes:
            yield start, size
            start, size = None, 0
        start, size = (i if start is None else start), size + n
    if start is not None:
        yield start, size


def _cuts(known: DataFrame, chunk_bytes: int) -> tuple[Cuts, int, int]:
    """(cuts, text bytes, bytes of a chunk): ids are sorted and cut in Spark; a row per chunk or so reaches the driver."""
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    ids = cut(known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(size.alias("n")))
    n_bytes = ids.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    growth = max(1.0, math.sqrt(ROW_ENTRIES * n_bytes / (chunk_bytes * RANGE_ENTRIES)))
    limit = int(chunk_bytes * growth)

    def run(batches):
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        got = list(_pieces(rows, limit))
        yield pa.RecordBatch.from_pydict({"id": [i for i, _ in got], "n": [n for _, n in got]}, schema)

    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])
    # Some sixteen chunks to a task, so few runs end with their task instead of with a full chunk.
    tasks = max(1, n_bytes // (16 * limit))
    pieces = ids.repartitionByRange(tasks, "id").sortWithinPartitions("id").mapInArrow(run, "id long, n long")
    return Cuts(sorted(tuple(r) for r in pieces.collect()), limit), n_bytes, limit


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Every row of `docs` with the passages removed that a document with a smaller id also has.

    Adds n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and spans (array of [start, end) byte
    offsets); with `with_text`, `text` is what is left (bytes cut inside a character are dropped), else it is left
    out. Columns of `docs` with these names are replaced. A null text counts as empty. Rows with a null id keep their
    text and are no source for others; rows with the same id are no source for each other. A text longer than a chunk is
    a chunk by itself. An empty table gives an empty result.
    """
    if length <= 2 * PERIOD:
        raise ValueError(f"length must be over {2 * PERIOD}")
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "__chunk"]
    docs = docs.drop(*added)
    known = docs.where(F.col("doc_id").isNotNull())
    cuts, n_bytes, chunk_limit = _cuts(known, chunk_bytes)
    range_entries = int(RANGE_ENTRIES * chunk_limit / chunk_bytes)
    ranges = max(1, -(-int(n_bytes * len(COVER) / PERIOD) // range_entries))
    # In a full range, one of 64 unique names of samples meets another; step 3 finds most of these unique.
    bits = min(32, range_entries.bit_length() + 6)
    bounds = docs.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def chunk_of(ids, salt):
        return _pd_series(bounds.value.chunk(ids.to_numpy(), salt.to_numpy()))

    # Equal rows of one id are told apart by the task that reads them.
    salt = F.xxhash64("text", F.spark_partition_id())
    texts = known.withColumn("__chunk", chunk_of(F.col("doc_id").cast("long"), salt))
    by_chunk = texts.groupBy("__chunk")

    def chunk_number(table: pa.Table) -> int:
        return table.column("__chunk")[0].as_py()

    def name_entries(c: Chunk, mask: np.ndarray, again: bool = False) -> Entries:
        # Named again, names that met by their short form are told apart by other bits.
        names = mix(c.names[mask] + np.uint64(1)) if again else c.names[mask]
        return Entries(_short(names, ranges, bits), c.ranks(c.sample[mask]))

    def name_rows(e: Entries, number: int) -> list[tuple]:
        return e.rows((e.names >> np.uint64(32)).astype(np.int64), number, e.names.astype(np.uint32))

    # Step 1: names of all sampled positions.
    def sample_names(table: pa.Table) -> pa.Table:
        c = Chunk(table, length)
        return _table(name_rows(name_entries(c, np.ones(len(c.sample), bool)), chunk_number(table)))

    # Step 2: triples of names that other documents have.
    def triple_names(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([])
        c, number = Chunk(table, length), chunk_number(table)
        e = name_entries(c, np.ones(len(c.sample), bool))
        elsewhere, _ = _answers(answers, len(e.names))
        shared = (elsewhere | (e.least != e.most))[e.of]
        _, t = c.triples(shared)
        return _table([*t.rows(_range_of(t.names, ranges), number, t.names), _state_row(ranges, number, [shared])])

    def earlier(c: Chunk, e: Entries, flags: np.ndarray, positions: np.ndarray) -> np.ndarray:
        return flags[e.of] | (e.least[e.of] < c.ranks(positions))

    # Step 3: names of the sampled positions of strings that are still open.
    def open_names(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([])
        c, number = Chunk(table, length), chunk_number(table)
        flags, (shared,) = _answers(answers, -1)
        i, t = c.triples(shared)
        found = earlier(c, t, flags, c.sample[i])
        # A triple covers 2 x PERIOD + name_bytes bytes, so the strings that start in its first ones.
        reach = 2 * PERIOD + c.name_bytes - length + 1
        mark = np.zeros(len(c.data) + reach + 1, np.int32)
        np.add.at(mark, c.sample[i[found]], 1)
        np.add.at(mark, c.sample[i[found]] + reach, -1)
        settled = np.cumsum(mark)[: len(c.data)] > 0
        named = shared & c.open_samples(settled)
        e = name_entries(c, named, again=True)
        return _table([*name_rows(e, number), _state_row(ranges, number, [settled, named])])

    # Step 4: whole prefixes of the remaining strings.
    def open_prefixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([])
        c, number = Chunk(table, length), chunk_number(table)
        flags, (settled, named) = _answers(answers, -1)
        e = name_entries(c, named, again=True)
        still = np.zeros(len(c.sample), bool)
        still[named] = (flags | (e.least != e.most))[e.of]
        at = c.open_strings(settled, still)
        p = c.prefixes(at)
        chosen = np.zeros(len(c.data), bool)
        chosen[at] = True
        return _table([*p.rows(_range_of(p.names, ranges), number, p.names), _state_row(ranges, number, [settled, chosen])])

    fields = [f for f in docs.schema.fields if f.name != "text" or with_text]
    schema = T.StructType(
        [*fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
         T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
         T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))]
    )

    def emit(table: pa.Table, kept: list[bytes], counts: list[tuple[int, int, list]]) -> pa.Table:
        table = table.drop_columns([x for x in ("__chunk",) if x in table.column_names])
        if with_text:
            at = table.column_names.index("text")
            left = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
            if table.column("text").null_count:  # a null text stays null
                left = pc.if_else(table.column("text").combine_chunks().is_null(), pa.nulls(len(left), pa.string()), left)
            table = table.set_column(at, "text", left)
        else:
            table = table.drop_columns(["text"])
        return (
            table.append_column("n_bytes", pa.array([n for n, _, _ in counts], pa.int64()))
            .append_column("n_removed", pa.array([r for _, r, _ in counts], pa.int64()))
            .append_column("n_spans", pa.array([len(s) for _, _, s in counts], pa.int64()))
            .append_column("kept_sha256", pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
            .append_column("spans", pa.array([s for _, _, s in counts], pa.list_(pa.list_(pa.int64()))))
        )

    def removed(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return emit(table, [], [])
        c = Chunk(table, length)
        flags, (settled, chosen) = _answers(answers, -1)
        at = np.flatnonzero(chosen)
        starts = settled & c.starts
        starts[at] |= earlier(c, c.prefixes(at), flags, at)
        mark = np.zeros(len(c.data) + length + 1, np.int32)
        where = np.flatnonzero(starts)
        mark[where] += 1
        mark[where + length] -= 1
        gone = np.cumsum(mark)[: len(c.data)] > 0
        kept, counts = [], []
        for a, b in zip(c.offsets[:-1], c.offsets[1:], strict=True):
            g = gone[a:b]
            edge = np.flatnonzero(np.diff(np.r_[False, g, False].astype(np.int8)))
            kept.append(c.data[a:b][~g].tobytes())
            counts.append((int(b - a), int(g.sum()), edge.reshape(-1, 2).tolist()))
        return emit(table.take(pa.array(c.order)), kept, counts)

    state = by_chunk.applyInArrow(sample_names, _STAGE)
    for whole, step in ((False, triple_names), (True, open_names), (False, open_prefixes)):
        answers = _settle(state, ranges, whole, bounds)
        state = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(step, _STAGE)
    out = by_chunk.cogroup(_settle(state, ranges, True, bounds).groupBy("chunk")).applyInArrow(removed, schema)

    nobody = docs.where(F.col("doc_id").isNull())

    def untouched(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            data, offsets = ragged(table.column("text"))
            body = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield from emit(table, body, [(len(x), 0, []) for x in body]).combine_chunks().to_batches()

    return out.union(nobody.mapInArrow(untouched, schema))


def _pd_series(values: np.ndarray):
    import pandas as pd

    return pd.Series(values.astype(np.int32))
