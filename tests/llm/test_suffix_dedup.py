"""Removal of repeats against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowstats.llm import suffix_dedup
from flowstats.llm.common import RangeHash, read_table
from flowstats.llm.suffix_dedup import Chunk, Cuts, _cuts, _pieces, remove_repeats

from .brute import repeats


def result(df, **more):
    out = remove_repeats(df, **more)
    return sorted((tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    alphabet = ["ab", "c ", "é", "xy", "\n", "the ", "of "]
    make = lambda k: "".join(rnd.choice(alphabet) for _ in range(k))
    shared = [make(rnd.choice([12, 20, 30, 60, 300])) for _ in range(8)]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice([make(rnd.randint(0, 60)), rnd.choice(shared)]) for _ in range(rnd.randint(0, 6)))
        if rows and rnd.random() < 0.2:  # a near copy
            text = list(rows[rnd.randrange(len(rows))][1] or "")
            for _ in range(rnd.randint(0, 3)):
                if text:
                    text[rnd.randrange(len(text))] = rnd.choice("qzé")
            text = "".join(text)
        rows.append((i * 7 % 101, text))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "chunk_bytes"), [(1, 600), (2, 3 << 20), (3, 50)])
def test_random_texts(spark, seed, chunk_bytes):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, chunk_bytes=chunk_bytes) == sorted(repeats(rows), key=str)


def test_nulls_repeats_ties_and_empty(spark):
    long = "".join(random.Random(9).choices("abcdefgh", k=200))
    rows = [(1, long), (1, long), (2, None), (None, long), (None, None), (3, ""), (4, "x" + long[20:140]), (5, long[:50]), (6, long[:49]), (7, "a" * 500)]
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, n_removed string, __chunk int")
    assert result(df, chunk_bytes=100) == sorted(repeats(rows), key=str)
    assert result(df.where("doc_id < 0")) == []
    assert {r.text for r in remove_repeats(df.where("doc_id = 2"), with_text=True).collect()} == {None}
    kept = {r.doc_id: r.text for r in remove_repeats(df.where("doc_id > 3"), with_text=True).collect()}
    assert kept[4] == rows[6][1] and kept[5] == long[:50] and kept[7] == "a" * 500


def test_shared_passage_in_every_document(spark):
    passage = "this line is in every document of the table and longer than fifty bytes. "
    rows = [(i, f"{i} {passage * (1 + i % 3)} end {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, chunk_bytes=2000) == sorted(repeats(rows), key=str)


def test_whole_small_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert result(docs, chunk_bytes=50_000) == sorted(repeats(rows), key=str)


def test_one_id_with_most_of_the_bytes(spark):
    """Rows of one id spread over chunks of their own, equal rows too, and are still no source for each other."""
    rows = corpus(4, 30) + [(50, t) for _, t in corpus(5, 60)] + [(50, "one row many times, in chunks of its own, over fifty bytes")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert result(df, chunk_bytes=700) == sorted(repeats(rows), key=str)


def test_chunks_are_cut_by_bytes(spark):
    """90 % of the bytes lie under a tenth of the ids, and a third of all under one id."""
    ids = F.when(F.col("id") % 3 == 0, 150).otherwise(F.col("id") % 3000)
    docs = spark.range(0, 30_000, 1, 12).select(ids.alias("doc_id"), F.repeat(F.lit("x"), F.when(ids < 300, 900).otherwise(10)).alias("text"))
    cuts, n_bytes, limit = _cuts(docs, 100_000)
    assert limit == 100_000 and n_bytes == docs.agg(F.sum(F.length("text"))).first()[0]
    rows = docs.select("doc_id", F.length("text"), F.xxhash64("text", F.spark_partition_id()), F.col("doc_id") == 150).toPandas().to_numpy()
    own = np.random.default_rng(0).integers(-(2**60), 2**60, len(rows))  # texts of one id that differ
    chunk = cuts.chunk(rows[:, 0].astype(np.int64), own)
    size = np.bincount(chunk, rows[:, 1].astype(np.int64))
    assert size.max() < 1.5 * limit and len(size) < 3 * n_bytes / limit
    order = np.argsort(rows[:, 0].astype(np.int64), kind="stable")
    assert (np.diff(cuts.first_of_id(chunk)[order]) >= 0).all()
    alone = rows[:, 3].astype(bool)
    assert len(set(chunk[alone])) > 1 and not set(chunk[alone]) & set(chunk[~alone])
    assert len(set(cuts.first_of_id(chunk[alone]))) == 1


def test_pieces_and_cuts():
    rows = [(1, 4), (2, 5), (3, 30), (4, 1), (6, 9), (9, 2)]
    pieces = list(_pieces(iter(rows), 10))
    assert pieces == [(1, 9), (3, 30), (4, 10), (9, 2)]
    cuts = Cuts(pieces, 10)
    assert cuts.begin.tolist() == [0, 1, 4, 5]
    assert cuts.chunk(np.array([1, 2, 3, 3, 3, 4, 6, 9]), np.array([7, 7, 0, -1, 4, 7, 7, 7])).tolist() == [0, 0, 1, 3, 2, 4, 4, 5]
    assert cuts.first_of_id(np.array([0, 1, 2, 3, 4, 5])).tolist() == [0, 1, 1, 1, 4, 5]
    assert Cuts([(1, 3), (2, 3), (5, 5)], 10).first.tolist() == [1, 5]


def test_chunks_and_ranges_grow_with_the_root_of_the_input(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_ENTRIES", 100)
    rows = corpus(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n_bytes = sum(len(t.encode()) for _, t in rows)
    assert _cuts(df, 600)[2] == int(600 * (suffix_dedup.ROW_ENTRIES * n_bytes / 60_000) ** 0.5) > 600
    assert result(df, chunk_bytes=600) == sorted(repeats(rows), key=str)


def test_names_tell_apart_by_both_hashes():
    """Strings with one half in common differ in the 32 further bits as well as in the first 64."""
    texts = ["a" * 25 + "b" * 24 + "c", "a" * 25 + "b" * 24 + "d", "c" + "b" * 24 + "a" * 25]
    c = Chunk(pa.table({"doc_id": pa.array([1, 2, 3], pa.int64()), "text": texts}), 50)
    p = c.prefixes(c.offsets[:-1])
    assert len(p.names) == len(set(p.second.tolist())) == 3
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.array([0, 50, 100])
    assert not set(RangeHash(data).fixed(at, 50).tolist()) & set(RangeHash(data, other=True).fixed(at, 50).tolist())
