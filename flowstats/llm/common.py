"""Helpers shared by the operators: tables, shared folders, ragged byte arrays, hashes, components."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the bytes between words in every word rule of this subpackage.
WORD_SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (`spark.checkpoint.dir`); a fresh local one only in one local process, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = _LOCAL.setdefault("dir", None) or tempfile.mkdtemp(prefix="llm-shared-")
        _LOCAL["dir"] = path
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_LOCAL: dict[str, str | None] = {}


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder, with its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hold(df: DataFrame) -> DataFrame:
    """`df` kept on executor disks for reuse in one query; lost blocks are recomputed from the source."""
    return df.persist(StorageLevel.DISK_ONLY)


def text_volume(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of the text column) over all rows; sizes the number of partitions and blocks."""
    row = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()
    return int(row[0]), int(row[1])


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address as Spark writes it (a bare path, `file:`, `hdfs://`, `s3a://`), and the path."""
    scheme, sep, rest = uri.partition("://")
    if not sep:
        return pafs.FileSystem.from_uri("file://" + uri.removeprefix("file:"))
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


# ---- ragged byte arrays -------------------------------------------------------------------------------------------


def ragged(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, and `rows` rows, each; a longer row stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n, start + (rows or n))
        yield start, end
        start = end


_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[list(WORD_SEPARATORS)] = False


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets by row) of the words `[^\\x20\\x09-\\x0D]+`; no word crosses a row."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = _NOT_SPACE[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# ---- hashes of byte ranges ----------------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_OTHER_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """64-bit hashes of any byte ranges of one buffer, from prefix sums of a polynomial over random byte values.

    With `other`, from byte values of their own, so that both kinds together tell ranges apart by more than 64 bits.
    """

    def __init__(self, data: np.ndarray, lower: bool = False, other: bool = False):
        up, self.down = _powers(len(data) + 1)
        table = _OTHER_BYTE if other else _BYTE
        table = table[LOWER] if lower else table
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def fixed(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[starts + length] - self.sums[starts]) * self.down[starts])


# ---- binary payloads of sorted integers -----------------------------------------------------------------------------


_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray, in_order: bool = False) -> bytes:
    """Integers as compressed byte planes; `in_order`, as differences of neighbours, whose high planes are nearly empty."""
    values = np.ascontiguousarray(values)
    if in_order and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return _PACKER.compress(planes.tobytes())


def unpack(payload: bytes, dtype, in_order: bool = False) -> np.ndarray:
    planes = np.frombuffer(_UNPACKER.decompress(payload), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if in_order else values


# ---- connected components -------------------------------------------------------------------------------------------


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps on the edge table, until it stops changing. Every step is a
    partial aggregation and a join on the node, so a node with very many edges is combined before the shuffle
    and its join partition is split by adaptive execution. Each round is written to the shared checkpoint folder.
    Null ends and self-loops are dropped; an empty table gives an empty result.
    """
    e = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    e = cut(e)
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
