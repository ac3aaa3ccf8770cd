"""The mix against plain Python and its DuckDB text."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

from flowstats.llm.common import read_table
from flowstats.llm.mixing import ORACLE_SQL, mix_sources, mixed_documents


def brute(rows):
    """[(doc_id, source, size, source_size, target, taken)] by filling and queueing one document at a time."""
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    sources = sorted({s for _, s, _ in sized if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for _, s, _ in sized)
    total = {s: sum(n for _, t, n in sized if t == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    budget = sum(total.values()) * 150 / 100
    target, left = {s: 0.0 for s in sources}, {s for s in sources if total[s]}
    while left:
        rest = budget - sum(target[s] for s in sources if s not in left)
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] >= 2 * total[s]}
        target.update({s: 2.0 * total[s] for s in over} if over else share)
        left = left - over if over else set()
    entries = []
    for k, s in enumerate(sources):
        queue = sorted(
            (hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), i is not None, i or 0, n, at)
            for at, (i, t, n) in enumerate(sized) if t == s
        )
        for again in (0, 1):
            clock = total[s] * again
            for *_, n, at in queue:
                clock += n
                if n and target[s]:
                    entries.append((clock / target[s], k, at, n))
    taken, used = [0] * len(sized), 0
    for _, _, at, n in sorted(entries):
        used += n
        if used > budget:
            break
        taken[at] += n
    return [(i, s, n, total[s], target[s], x) for (i, s, n), x in zip(sized, taken, strict=True)]


def compare(got, want):
    key = lambda r: (str(r[0]), str(r[1]), r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [(*r[:4], r[5]) for r in got] == [(*r[:4], r[5]) for r in want]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in want])


def test_odd_rows(spark):
    rows = [(i, "w " * (i % 17), ["b", "a", "é", None, "Z", "c", ""][i % 7]) for i in range(120)]
    rows += [(500, None, "a"), (501, "", "only empty"), (None, "x y", "a"), (None, None, None), (3, "w " * 3, "Z"), (3, "w " * 3, "Z"), (502, "v " * 4000, "b")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, size int, taken string")
    compare([tuple(r) for r in mix_sources(df).collect()], brute(rows))
    again = sorted(map(tuple, mix_sources(df.repartition(5)).collect()), key=str)
    assert again == sorted(map(tuple, mix_sources(df).collect()), key=str)
    mixed = mixed_documents(df)
    assert mixed.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    assert sum(r.taken for r in mixed.collect()) == sum(r[5] for r in brute(rows))


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b c", "s")]])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    compare([tuple(r) for r in mix_sources(df).collect()], brute(rows))
    assert mixed_documents(df).count() <= len(rows)


def test_each_source_comes_near_its_target_and_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = mix_sources(read_table(spark, sf, "documents")).collect()
    for s in {r.source for r in got}:
        rows = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 2 * max(r.size for r in rows)
        assert all(r.taken <= 2 * r.size for r in rows)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = db.sql(ORACLE_SQL).select("doc_id, source, size, source_size, target, taken").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
