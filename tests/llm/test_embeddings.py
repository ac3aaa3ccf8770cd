"""Embedding links against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from flowstats.llm import embeddings
from flowstats.llm.common import read_table
from flowstats.llm.embeddings import link_vectors, plan_tables

from .brute import Union


def exact(rows, threshold=0.9):
    """({row: links}, components) of all pairs of usable vectors."""
    usable = [
        i for i, (v, e) in enumerate(rows)
        if v is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
    ]
    links, union = [0] * len(rows), Union()
    for x, i in enumerate(usable):
        a = np.array(rows[i][1], float)
        for j in usable[x + 1 :]:
            b = np.array(rows[j][1], float)
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[i] += 1
                links[j] += 1
                union.join(rows[i][0], rows[j][0])
    return [(v, n, None if v is None else union.find(v), v is None or union.find(v) == v) for (v, _), n in zip(rows, links, strict=True)]


def frame(spark, rows):
    return spark.createDataFrame([(v, e, "x", 1) for v, e in rows], "vec_id long, embedding array<float>, rep string, links int")


def clusters(seed, n=40, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        base = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 8)):
            rows.append([float(x) for x in np.float32(base + rng.choice([0, 0.02, 0.1, 0.3]) * rng.standard_normal(dim))])
    return [(i * 13 % 1009, e) for i, e in enumerate(rows)]


def result(df):
    return sorted((tuple(r) for r in link_vectors(df).collect()), key=str)


def test_clusters_and_blocks(spark, monkeypatch):
    rows = clusters(1)
    assert result(frame(spark, rows)) == sorted(exact(rows), key=str)  # one sign a table at this size: every pair meets
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 20)
    assert result(frame(spark, rows)) == sorted(exact(rows), key=str)


def test_odd_vectors_copies_ties_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]),
            (9, [1.0, 2.0]), (9, [1.0, 2.0]), (None, [1.0, 2.0]), (10, [1.0, 2.0, 0.0]), (11, [-0.0, 3.0]), (12, [0.0, 3.0]),
            (13, [1e-30, 1e-30]), (14, [1e30, 1e30]), (9, [-5.0, 1.0])]
    assert result(frame(spark, rows)) == sorted(exact(rows), key=str)
    assert result(frame(spark, rows).where("vec_id < 0")) == []
    wide = frame(spark, rows).selectExpr("vec_id", "cast(embedding as array<double>) as embedding")
    assert len(result(wide)) == len(rows)


def test_tables_reach_the_recall_at_the_threshold():
    for n in (2, 500, 50_000, 10**9):
        bits, tables = plan_tables(n)
        same = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - same) ** tables >= 0.99


@pytest.mark.parametrize("bucket_rows", [16, 256])
def test_recall_with_many_buckets(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(embeddings, "BUCKET_ROWS", bucket_rows)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 64))
    noise = rng.standard_normal((900, 64)) * rng.choice([0.1, 0.3, 0.4, 0.48], (900, 1))  # many cosines near 0.9
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(base[rng.integers(0, 150, 900)] + noise))]
    want, got = {r[0]: r for r in exact(rows)}, {r[0]: r for r in result(frame(spark, rows))}
    links = sum(r[1] for r in want.values())
    assert links > 500
    assert 0.97 * links <= sum(r[1] for r in got.values()) <= links
    assert all(got[k][1] <= want[k][1] for k in want)


def test_small_table_against_all_pairs(spark):
    table = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    assert result(table) == sorted(exact(rows), key=str)
