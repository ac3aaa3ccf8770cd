"""The language model against a plain-Python interpolated modified Kneser-Ney bigram model."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowstats.llm import kneser_ney
from flowstats.llm.common import read_table
from flowstats.llm.kneser_ney import discounts, score_documents

from .brute import LOWER, WORD

END, START = object(), object()


def tokens(text):
    return [*WORD.findall((text or "").encode().translate(LOWER)), END]


def brute(rows, folds=10):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0 for i, _ in rows]
    train = [tokens(t) for (_, t), h in zip(rows, held, strict=True) if not h]
    counts = Counter(w for t in train for w in t)
    total, types = sum(counts.values()), len(counts)
    pairs = Counter(p for t in train for p in zip([START, *t], t, strict=False))
    context, followers, lefts = Counter(), defaultdict(Counter), Counter()
    for (h, w), c in pairs.items():
        context[h] += c
        followers[h][min(c, 3)] += 1
        lefts[w] += 1
    of = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    d2, d1 = (0, *discounts(of(pairs.values()))), (0, *discounts(of(lefts.values())))
    n = Counter(min(c, 3) for c in lefts.values())
    rest = sum(d1[k] * n[k] for k in (1, 2, 3)) / len(pairs) if pairs else 1.0

    def p1(w):
        c = lefts[w]
        return rest / (types + 1) + ((c - d1[min(c, 3)]) / len(pairs) if c else 0.0)

    def p2(h, w):
        if not context[h]:
            return p1(w)
        c = pairs[h, w]
        share = sum(d2[k] * followers[h][k] for k in (1, 2, 3)) / context[h]
        return (c - d2[min(c, 3)]) / context[h] + share * p1(w)

    out = []
    for (i, text), h in zip(rows, held, strict=True):
        t = tokens(text)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t)
        score = sum(math.log10(p2(a, w)) for a, w in zip([START, *t], t, strict=False))
        out.append((i, h, len(t), sum(counts[w] > 0 for w in t), total, base, score))
    some = list(context)[:5]
    for h in some:  # probabilities over the vocabulary and one unknown word add up
        assert abs(sum(p2(h, w) for w in counts) + p2(h, b"unknown!") - 1) < 1e-9
    return out


def check(df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    key = lambda r: str(r[:5])
    got = sorted((tuple(r) for r in score_documents(df).collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def corpus(n=150):
    rnd = random.Random(3)
    words = [f"w{int(rnd.paretovariate(0.8))}" for _ in range(400)]
    texts = [" ".join(rnd.choice(words).upper() for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return [*enumerate(texts), (None, "w1 w2"), (n, None), (n + 1, ""), (3, texts[3]), (3, texts[3]), (n + 2, "\n \t"), (n + 3, "É é w1")]


def test_against_plain_python(spark):
    check(spark.createDataFrame([(*r, 1, "x") for r in corpus()], "doc_id long, text string, n_tokens int, score string"))


def test_many_files_and_split_contexts(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "HOT_CONTEXT", 40)
    monkeypatch.setattr(kneser_ney, "GATHER_WORDS", 500)
    monkeypatch.setattr(kneser_ney.fit, "__defaults__", (2000,))
    check(spark.createDataFrame(corpus(), "doc_id long, text string"))


def test_small_table_empty_and_untrained(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    check(docs)
    assert score_documents(docs.where("doc_id < 0")).collect() == []
    only_held = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 10 = 0")
    check(only_held)


def test_files_of_a_store_without_mount_are_fetched_once(tmp_path, monkeypatch):
    """A store that is not local: each file is copied once per worker, and no copy's name is left behind."""
    from pyarrow.fs import FileSelector, LocalFileSystem, SubTreeFileSystem

    from flowstats.llm import kneser_ney

    opened = []

    def remote(uri):
        opened.append(uri)
        return SubTreeFileSystem(str(tmp_path), LocalFileSystem()), "root"

    monkeypatch.setattr(kneser_ney, "open_store", remote)
    kneser_ney._fetched.cache_clear()
    words, counts = np.arange(5, dtype=np.uint64), np.arange(3, dtype=np.uint32)
    name = kneser_ney._write("far://root", "part", words, counts)
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    for _ in range(3):
        a, b = kneser_ney._map("far://root", name, [("u8", 5), ("u4", 3)])
        assert (a == words).all() and (b == counts).all()
    assert kneser_ney._fetched.cache_info().misses == 1
    left = [f.path for f in LocalFileSystem().get_file_info(FileSelector(str(tmp_path), recursive=True)) if f.is_file]
    assert len(left) == 1
    empty = kneser_ney._write("far://root", "none", words[:0])
    assert len(kneser_ney._map("far://root", empty, [("u8", 0)])[0]) == 0
