"""The draw against plain Python and its DuckDB text; ranks over many segments."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from flowstats.llm import resampling
from flowstats.llm.common import read_table
from flowstats.llm.ragged_words import Words, crc32_of
from flowstats.llm.resampling import ORACLE_SQL, rank_rows, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_words):
    w = WORD.findall((text or "").translate(UPPER))
    runs = [" ".join(w[i : i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(rows, target, max_words=1, min_words=20, percent=10):
    own = [features(t, max_words) for _, t in rows]
    raw = Counter(b for _, f in own for b in f)
    want = Counter(b for t in target for b in features(t, max_words)[1])
    s, t = sum(raw.values()) + 10_000, sum(want.values()) + 10_000

    def gain(b):
        return math.floor(1000 * math.log((want[b] + 1.0) * s / ((raw[b] + 1.0) * t)))

    out = []
    for (i, _), (n, f) in zip(rows, own, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    order = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(order[: percent * len(order) // 100], 1):
        r.append(rank)
    return sorted((tuple(r[:4]) + ((r[5] if len(r) > 5 else None),) for r in out), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


ROWS = [(i, " ".join(f"W{(i * 7 + j * j) % 53}" for j in range(i % 60))) for i in range(400)]
ROWS += [(None, ROWS[59][1]), (None, None), (500, None), (501, ""), (59, ROWS[59][1]), (59, ROWS[59][1]), (502, "é日本 " * 30), (503, "x" * 300 + " y" * 4000)]
TARGET = ["w1 w2 w3 É", None, "", "w7 w7, w11"]


@pytest.mark.parametrize(("max_words", "percent"), [(1, 10), (2, 50), (1, 100)])
def test_odd_rows(spark, max_words, percent):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, score int, rank string").repartition(5)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert got(resample(docs, target, max_words, percent=percent)) == brute(ROWS, TARGET, max_words, percent=percent)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(7, "a b " * 20)]])
def test_tiny_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for target in ([], ["a"]):
        out = resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=100)
        assert got(out) == brute(rows, target, percent=100)


@pytest.mark.parametrize("hot", [0, 6000])
def test_ranks_over_many_segments(spark, monkeypatch, hot):
    """Splitters cut the order evenly although a key holds a third of the rows, and ranks are exact."""
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 500)
    rows = [(i, (i * 7919) % 1000, 30, i) for i in range(12_000)] + [(-5, 999, 30, 20_000 + i) for i in range(hot)]
    rows += [(-7 - i, 10_000, 3, 50_000 + i) for i in range(10)]  # not eligible, whatever their score
    df = spark.createDataFrame(rows, "doc_id long, score long, n_features long, __row long").repartition(7)
    eligible = resampling.F.col("n_features") >= 20
    n = 12_000 + hot
    out = rank_rows(df, eligible, 9_000, n).collect()
    order = sorted((r for r in rows if r[2] >= 20), key=lambda r: (-r[1], r[0], r[3]))
    want = {r[3]: k for k, r in enumerate(order[:9_000], 1)}
    assert {r["__row"]: r["rank"] for r in out} == {r[3]: want.get(r[3]) for r in rows}
    order_ = resampling._Order("doc_id")
    splitters = resampling._splitters(df.where(eligible), order_, n, n // 500)
    keys = np.array([(-r[1], 0, r[0], r[2], r[3]) for r in rows if r[2] >= 20])
    both = resampling._sorted(np.concatenate([splitters, keys]))
    sizes = np.diff(np.r_[-1, np.flatnonzero(both < len(splitters)), len(both)]) - 1
    assert sizes.max() <= 2 * 500


def test_checksums():
    buffer = np.frombuffer(bytes(range(256)) * 3, np.uint8)
    starts = np.arange(0, 400, 3)
    ends = starts + np.arange(len(starts)) % 131
    assert crc32_of(buffer, starts, ends).tolist() == [zlib.crc32(buffer[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    empty = Words.of(np.zeros(0, np.uint8), np.zeros(3, np.int64))
    assert crc32_of(empty.buffer, *empty.runs(1)[:2]).tolist() == []


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    out = resample(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    assert got(out) == sorted(db.sql(ORACLE_SQL).select("doc_id, n_features, weight, score, rank").fetchall(), key=str)
