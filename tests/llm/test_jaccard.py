"""The shingle join against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from flowstats.llm import jaccard
from flowstats.llm.common import read_table
from flowstats.llm.jaccard import one_of_each, similar_components

from .brute import similar


def result(df, **more):
    return sorted((tuple(r) for r in similar_components(df, **more).collect()), key=str)


def near_copies(seed, families=12, most=9, length=(1, 160)):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(*length))]
        for _ in range(rnd.randint(1, most)):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary).upper()
            if rnd.random() < 0.3:
                words = words[rnd.randint(0, 3) :]
            rows.append((n, rnd.choice([" ", "\n", "\t "]).join(words)))
            n += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "words", "percent"), [(1, 4, 85), (3, 5, 80)])
def test_families_of_near_copies(spark, seed, words, percent):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, words=words, percent=percent) == sorted(similar(rows, words, percent), key=str)


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 600)
    rows = near_copies(5, families=3, most=40, length=(60, 90))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == sorted(similar(rows), key=str)


def test_large_family_under_the_threshold(spark, monkeypatch):
    """One candidate group whose sets do not link: no task gets more than two blocks of it, and no link is lost."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rnd.sample(range(200), rnd.randint(3, 7)):
            words[k] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    for i in (3, 50, 90):  # links across blocks, some between sets of other sizes
        rows += [(200 + i, rows[i][1] + " tail"), (300 + i, rows[i][1] + " a longer tail of it" * 3)]
    rnd.shuffle(rows)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 2000)  # some ten sets
    compare = jaccard._compare

    def watched(*args, **more):
        run = compare(*args, **more)

        def bounded(table):
            if table.num_rows > 45:
                raise ValueError(f"{table.num_rows} of 126 sets in one task")
            return run(table)

        return bounded

    monkeypatch.setattr(jaccard, "_compare", watched)
    want = similar(rows)
    assert 1 < sum(c != i for i, _, c in want) < 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == sorted(want, key=str)


def test_nulls_short_texts_repeats_and_empty(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO "), (6, "two one"), (None, "one two"), (None, "one two"),
            (7, "a b c d"), (7, "a b c d"), (8, "A B C D"), (9, "x " * 30000), (10, "x x x x x"), (11, "É b"), (12, "é b"),
            (7, "one two"), (20, None)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, component_id int, rep string")
    assert result(df) == sorted(similar(rows), key=str)
    assert result(df.where("doc_id < 0")) == []
    kept = one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids == [1, 2, 3, 4, 6, 7, 9, 11, 12, 20] or ids == [1, 2, 3, 4, 6, 7, 9, 10, 11, 12, 20]
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_no_text_goes_but_for_a_kept_near_copy(spark):
    """Rows that share an id but not their text are rows of their own (ids repeat, texts repeat, families of near copies)."""
    rnd = random.Random(31)
    families = [[f"w{f}x{i}" for i in range(60)] for f in range(12)]
    rows = [(1, "a b c d e"), (1, "f g h i j"), (2, "a b c d e"), (3, "f g h i j"), (4, "k l m n o")]
    for _ in range(150):
        text = list(rnd.choice(families))
        if rnd.random() < 0.5:
            text[rnd.randrange(60)] = "changed"
        rows.append((rnd.randrange(10, 60), " ".join(text)))
    rows += [(9, None), (9, ""), (9, None)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(4)
    kept = [(r.doc_id, r.text) for r in one_of_each(df).collect()]
    distinct = sorted(set(rows), key=str)
    groups: dict[int, list] = {}
    for (node, _, root), row in zip(similar([(k, t) for k, (_, t) in enumerate(distinct)], 5, 80), distinct, strict=True):
        groups.setdefault(root if row[1] else -node - 1, []).append(row)
    assert len(kept) == len(set(kept)) == len(groups)
    for members in groups.values():
        stays = [r for r in members if r in kept]
        assert len(stays) == 1 and stays[0][0] == min(i for i, _ in members)
    again = {(r.doc_id, r.text) for r in one_of_each(df.repartition(2)).collect()}
    assert again == set(kept)


def test_whole_small_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert result(docs) == sorted(similar(rows), key=str)


def test_common_passages_bring_nothing_together(spark):
    """Documents that share a passage, three quarters of each, are no candidates; near copies among them are found."""
    rnd = random.Random(8)
    passage = " ".join(f"common{i}" for i in range(60))
    rows = [(i, f"{passage} " + " ".join(f"own{i}x{k}" for k in range(20))) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(0, 200, 10)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == sorted(similar(rows), key=str)
    assert jaccard._candidates(df, 4, 85, 3, 2).distinct().count() <= 40


def test_orders_of_the_same_words_are_different_shingles():
    words = ["x", "y", "x", "y", "y", "x", "x", "y", "y", "x", "y", "x", "x", "x", "y", "y", "y", "y", "x"]
    text = " ".join(words).encode()
    data = np.frombuffer(text, np.uint8)
    hashes, offsets = jaccard.shingle_sets(data, np.array([0, len(data)]), 4)
    assert len(hashes) == offsets[-1] == len({tuple(words[i : i + 4]) for i in range(len(words) - 3)})
