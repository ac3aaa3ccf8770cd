"""Held-out accuracy of the quality and toxicity models, and their behaviour on odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowstats.llm.common import read_table
from flowstats.llm import quality, toxicity
from flowstats.llm.quality import fold, labelled_sample, quality_scores
from flowstats.llm.toxicity import fit, toxicity_scores

SF = "/root/testdata/sf0.1"
ODD = [(None, "text without an id"), (900001, None), (900002, ""), (900003, "a" * 200_000), (900004, "same row"), (900004, "same row"), (900005, " \n")]


@pytest.fixture(scope="module")
def tables(spark):
    return read_table(spark, SF, "documents"), read_table(spark, SF, "labels")


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    got = quality_scores(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    good = got.quality == 1
    assert len(got) > 500 and (got.predicted[good] == 1).mean() > 0.98 and (got.predicted[~good] == 0).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    got = toxicity_scores(docs, labels).where(fold(5) == 0).drop("toxic").join(labels, "doc_id").toPandas()
    toxic = got.toxic == 1
    rejected = got.expected_severity[toxic].median(), got.expected_severity[~toxic].median()
    assert rejected[0] > 1 > 0.3 > rejected[1]
    assert (got.severity[~toxic] == 0).mean() > 0.97


def test_odd_rows(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(*r, 7, "x") for r in ODD], "doc_id long, text string, toxic int, label string")
    more = labels.withColumn("text", F.lit("clash")).withColumn("label", F.lit(3))
    scored = quality_scores(docs.select("doc_id", "text", F.lit(1).alias("toxic"), F.lit("y").alias("label")).union(odd), more)
    rows = [r for r in scored.collect() if r.doc_id is None or r.doc_id > 900_000]
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    graded = toxicity_scores(docs.select("doc_id", "text", F.lit(1).alias("toxic"), F.lit("y").alias("label")).union(odd), labels)
    assert graded.columns == ["doc_id", "text", "label", "expected_severity", "severity", "toxic"]
    rows = [r for r in graded.collect() if r.doc_id is None or r.doc_id > 900_000]
    assert len(rows) == len(ODD) and not any(r.toxic for r in rows)


def test_no_labels_and_no_rows(tables):
    docs, labels = tables
    none = labels.where("doc_id < 0")
    assert {r.score for r in quality_scores(docs.limit(5), none).collect()} == {0.5}
    assert not any(r.toxic for r in toxicity_scores(docs.limit(5), none).collect())
    assert quality_scores(docs.where("doc_id < 0"), labels).collect() == []
    assert toxicity_scores(docs.where("doc_id < 0"), labels).collect() == []


def test_cuts_are_ordered_and_weights_shared():
    rng = np.random.default_rng(0)
    mild, strong = rng.integers(1, 2**60, 2, dtype=np.uint64)
    rows, toxic = [], []
    for i in range(600):
        words = set(rng.integers(1, 50, 8).astype(np.uint64).tolist())
        bad = i % 4 == 0
        words |= ({int(mild)} if bad else set()) | ({int(strong)} if bad and i % 8 == 0 else set())
        rows.append(np.array(sorted(words), np.uint64))
        toxic.append(bad)
    model = fit(rows, np.array(toxic))
    assert (np.diff(model.cuts) <= 0).all()
    p = model.probabilities(np.array([mild, mild, strong]), np.array([1, 2, 2]), 3)
    assert p[0, 0] < 0.5 < p[1, 0] and p[2].sum() > p[1].sum() and (np.diff(p, axis=1) <= 0).all()


def test_the_gradient_is_that_of_the_plain_likelihood():
    rng = np.random.default_rng(1)
    held = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(40)]
    row, col = np.repeat(np.arange(40), [len(h) for h in held]), np.concatenate(held)
    y, importance, penalty = rng.integers(0, toxicity.GRADES + 1, 40), rng.random(40) + 0.5, 0.01
    x = np.r_[rng.normal(size=6), 1.0, 0.2, -0.9]

    def likelihood(x):
        total = 0.0
        for h, grade, w in zip(held, y, importance, strict=True):
            at_least = [1.0, *(1 / (1 + np.exp(-(sum(x[j] for j in h) + b))) for b in x[6:]), 0.0]
            total += w * np.log(at_least[grade] - at_least[grade + 1])
        return total / 40 - penalty / 2 * (x[:6] ** 2).sum()

    plain = [(likelihood(x + s) - likelihood(x - s)) / 2e-5 for s in np.eye(9) * 1e-5]
    assert np.allclose(toxicity.likelihood_gradient(x[:6], x[6:], row, col, y, importance, penalty), plain, atol=1e-7)


def test_toxicity_scores_are_those_of_a_plain_program(spark, tables):
    """All rows graded by sets of words and a plain sum over the fitted weights; the features are those of plain counts."""
    import re

    docs, labels = tables
    sample = labelled_sample(docs, labels, "toxic", 2000).orderBy("doc_id")
    text_rows = [(r.text, r.label) for r in sample.collect()]

    def words(text):
        found = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
        return {(w, 0) for w in found} | {(w[:k], k) for w in found for k in toxicity.PREFIXES if len(w) > k}

    def name(term):
        body = np.frombuffer(term[0], np.uint8)
        ranged = toxicity.RangeHash(body)
        if not term[1]:
            return int(ranged(np.array([0]), np.array([len(body)]))[0])
        return int(ranged.fixed(np.array([0]), term[1])[0] ^ np.uint64(term[1]))

    # Feature choice: plain counts over all words of the sample.
    n, m = len(text_rows), sum(t > 0 for _, t in text_rows)
    rows, counts = [], {}
    for text, t in text_rows:
        for w in (own := words(text)):
            c = counts.setdefault(w, [0, 0])
            c[0] += 1
            c[1] += t > 0
        rows.append((own, t > 0))
    z = lambda c, k: (k / m - (c - k) / (n - m)) / (c / n * (1 - c / n) * (1 / m + 1 / (n - m)) + 1e-12) ** 0.5
    chosen = {w for w, (c, k) in counts.items() if c >= toxicity.MIN_ROWS and abs(z(c, k)) >= toxicity.MIN_DEVIATIONS}
    names = {w: name(w) for w in chosen}
    got_rows, got_toxic = toxicity._labelled_words(sample.select("text", "label"))
    assert len(got_rows) == n and set(toxicity.select(got_rows, got_toxic)[0].tolist()) == set(names.values())
    assert sorted((sorted(map(int, r)), bool(t)) for r, t in zip(got_rows, got_toxic, strict=True)) == sorted(
        (sorted(map(name, own)), t) for own, t in rows
    )
    few = docs.where("doc_id % 37 = 0").select("doc_id", "text").collect()
    scored = {r.doc_id: r for r in toxicity_scores(docs.where("doc_id % 37 = 0"), labels).collect()}
    whole = fit(*toxicity._labelled_words(labelled_sample(docs.where("doc_id % 37 = 0"), labels, "toxic", toxicity.SAMPLE_ROWS).orderBy("doc_id").select("text", "label")))
    weight = dict(zip(whole.words.tolist(), whole.weights.tolist(), strict=True))
    for r in few:
        total = sum(weight.get(name(w), 0.0) for w in words(r.text))
        p = [1 / (1 + np.exp(-(total + b))) for b in whole.cuts]
        assert abs(scored[r.doc_id].expected_severity - sum(p)) < 1e-6 and scored[r.doc_id].toxic == (p[0] >= toxicity.THRESHOLD)


def test_quality_votes_are_those_of_a_full_sort():
    """Cosines in float64 and every neighbour ranked, for 300 texts; equal neighbours share the places that are left."""
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma;", "Delta", "12", "x|y"], rng.integers(1, 40))) for _ in range(300)]
    texts += texts[:60] + ["", " "]  # ties
    body = [t.encode() for t in texts]
    features = quality.featurize(np.frombuffer(b"".join(body), np.uint8), np.r_[0, np.cumsum([len(b) for b in body])])
    labels = rng.integers(0, 2, len(texts)).astype(float)
    model = quality.fit(features, labels)
    z = (features.astype(float) * model.weights) @ model.basis.astype(float)
    size = np.linalg.norm(z, axis=1, keepdims=True)
    z = np.divide(z, size, out=np.zeros_like(z), where=size > 1e-12)
    got = model.score(features[:300])
    for i in range(300):
        cosine = np.round(z @ z[i], 5)
        ranked = sorted(range(len(texts)), key=lambda j: -cosine[j])
        edge = cosine[ranked[quality.NEIGHBOURS - 1]]
        above = [j for j in ranked if cosine[j] > edge]
        tied = [j for j in ranked if cosine[j] == edge]
        share = (quality.NEIGHBOURS - len(above)) / len(tied)
        vote = [(min(max(cosine[j], 0), 1) ** quality.SHARPNESS * (1 if cosine[j] > edge else share), labels[j]) for j in (*above, *tied)]
        total = sum(w for w, _ in vote)
        assert abs(got[i] - (sum(w * y for w, y in vote) / total if total else model.prior)) < 0.02
    shuffled = rng.permutation(len(texts))
    again = quality.NeighbourModel(model.weights, model.basis, model.vectors[shuffled], labels[shuffled], model.prior)
    assert np.abs(again.score(features[:300]) - got).max() < 0.02


def test_a_repeated_id_teaches_its_smallest_text(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1)], "doc_id long, toxic int")
    learnt = [i for i in (1, 3) if i in {r.doc_id for r in docs.where(fold(5) != 0).collect()}]
    got = {tuple(r) for r in labelled_sample(docs, labels, "toxic", 10).collect()}
    assert learnt and got == {x for x in ((1, "a", 0), (3, None, 1)) if x[0] in learnt}


def test_many_short_texts_are_featurized_in_bounded_slices():
    from flowstats.llm.common import slices

    offsets = np.arange(10_001) * 3
    assert max(b - a for a, b in slices(offsets, quality.SLICE_BYTES, quality.SLICE_ROWS)) == quality.SLICE_ROWS
    assert sum(b - a for a, b in slices(offsets, quality.SLICE_BYTES, quality.SLICE_ROWS)) == 10_000
