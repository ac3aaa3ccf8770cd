"""The source audit against plain Python and its DuckDB text; perfect hashes on their own."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from flowstats.llm import divergence
from flowstats.llm.common import read_table
from flowstats.llm.divergence import ORACLE_SQL, Lookup, audit_sources
from flowstats.llm.perfect_hash import PerfectHash

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """`rows` of (text, lang, source)."""
    docs = [(TERM.findall((t or "").translate(UPPER)), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {x for _, x, _ in docs}:
        here = [(t, s) for t, x, s in docs if x == lang]
        in_docs = Counter(w for t, _ in here for w in set(t))
        kept = sorted((w for w, n in in_docs.items() if n >= 3), key=str.encode)
        counts = {s: Counter(w for t, x in here if x == s for w in t if in_docs[w] >= 3) for _, s in here}
        both = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + len(kept)
            return [1 + 10**9 * (c[w] + 1) // total for w in kept]

        q = shares(both)
        for s, c in counts.items():
            p = shares(c)
            pairs = [(sum((a - b) ** 2 // b for a, b in zip(p, shares(d), strict=True)), o) for o, d in counts.items() if o != s]
            terms = [((a - b) ** 2 // b, w) for a, b, w in zip(p, q, kept, strict=True) if c[w] and a > b]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(ranked, 1) if part == "pair" or r <= 200]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, term int, n string")


ROWS = [(" ".join(f"{chr(97 + (i * j) % 26)}{chr(97 + (i + j * j) % 7)}É" for j in range(i % 40)), "abAB"[i % 4], f"s{i * i % 5}") for i in range(160)]
ROWS += [(None, "a", "only null"), ("", "a", "only empty"), ("aé bÉ1c'd", None, None), (None, None, None), ("x", "rare", "s"), ("y", "rare", "t")]
ROWS += [("same Same SAME", "one", None)] * 5 + [("long " * 300 + "日本 x", "one", "t")] * 3 + [("l\x00z", "nul\x00", "é")] * 4


@pytest.mark.parametrize("broadcast_terms", [4_000_000, 40, 0])
def test_odd_rows(spark, broadcast_terms):
    df = frame(spark, ROWS).repartition(4)
    assert sorted(map(tuple, audit_sources(df, broadcast_terms=broadcast_terms).collect())) == brute(ROWS)


def test_small_memory_bounds_change_nothing(spark, monkeypatch):
    """Counts are sent on when a bound is reached; blocks are many; long texts are read term by term."""
    for name, value in (("HELD_TERMS", 5), ("DENSE_SLOTS", 90), ("CACHED_WORDS", 20), ("SHARD_TERMS", 8), ("BLOCK_TERMS", 2), ("LONG_TEXT", 100)):
        monkeypatch.setattr(divergence, name, value)
    for terms in (4_000_000, 30):
        assert sorted(map(tuple, audit_sources(frame(spark, ROWS), broadcast_terms=terms).collect())) == brute(ROWS)


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [("a b", "x", "s"), ("a", "x", "t")]])
def test_tiny_tables(spark, rows):
    assert sorted(map(tuple, audit_sources(frame(spark, rows)).collect())) == brute(rows)


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = audit_sources(read_table(spark, sf, "documents"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = db.sql(ORACLE_SQL).select(", ".join(got.columns)).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 70_000])
def test_perfect_hash_numbers_every_key_once(n):
    hashes = np.random.Generator(np.random.PCG64(n)).integers(0, 2**64, 2 * n + 1, dtype=np.uint64)
    own, others = np.unique(hashes)[:n], np.unique(hashes)[n:]
    perfect = PerfectHash.build(own)
    assert perfect.size == n and sorted(perfect.number(own).tolist()) == list(range(n))
    assert perfect.number(others).max(initial=-1) < n
    assert sum(len(x) for x in perfect.levels) <= max(64, n)  # 8 bits a key at most


def test_equal_hashes_keep_their_terms_apart(monkeypatch, spark):
    monkeypatch.setattr(divergence.xxhash, "xxh64_intdigest", lambda t, seed: len(t))
    terms = [b"a", b"b", b"cc", b"ddd", b"ee"]
    table = divergence.pa.table({"lang": ["x"] * 5, "shard": [0] * 5, "term": [t.decode() for t in terms]})
    found = Lookup(divergence._shard(table).to_pylist(), 1)
    slots = found.slots("x", [*terms, b"q", b"zzzz"])
    assert sorted(slots[:5].tolist()) == list(range(5)) and slots[5:].tolist() == [-1, -1]
    assert [found.terms["x"][i] for i in slots[:5]] == terms
    assert found.slots("y", [b"a"]).tolist() == [-1]


def test_shares_beyond_64_bit_products():
    counts = np.array([1, 7, 10**12, 4 * 10**15], np.int64)
    total = 9 * 10**15
    assert divergence._share(counts, total).tolist() == [1 + 10**9 * int(c) // total for c in counts]
