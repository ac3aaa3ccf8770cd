"""The corpus pipeline, stage by stage."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from flowstats.llm.common import read_table

from .brute import repeats, similar
from .test_decontaminate import brute as leaking

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_on_their_own_input(spark):
    docs = read_table(spark, SF, "documents")
    outs = []
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        outs.append(docs)
    columns = read_table(spark, SF, "documents").columns
    assert all(o.columns == columns for o in outs[:-1])
    clean, single, cut, fair, mixed = outs
    texts = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    # Near copies: one document, that with the smallest id, of each component.
    components = similar(texts(clean), 5, 80)
    assert sorted(i for i, _, c in components if i == c) == sorted(r.doc_id for r in single.collect())
    # Repeats: as many bytes left as plain Python leaves.
    want = {i: n - gone for i, n, gone, *_ in repeats(texts(single))}
    got = {r.doc_id: r for r in cut.collect()}
    assert got.keys() == want.keys()
    assert all(len(got[i].text.encode()) <= n and got[i].n_chars == len(got[i].text) for i, n in want.items())
    assert sum(len(got[i].text.encode()) == n for i, n in want.items()) > 0.9 * len(want)
    # Decontamination: what leaks goes, what is clean stays unchanged.
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    short = [t for t in texts(cut) if len(t[1]) < 1200]
    dirty = {r[0] for r in leaking(short, items)}
    left = {r.doc_id: r for r in fair.collect()}
    assert all((i not in left) == (i in dirty) for i, _ in short)
    assert all(tuple(left[i]) == tuple(got[i]) for i in left)
    # The mix holds nothing but these, and takes 150 % of their words.
    assert {r.doc_id for r in mixed.collect()} <= set(left)
    taken, size = sum(r.taken for r in mixed.collect()), sum(len(t.split()) for _, t in texts(fair))
    assert 1.3 * size < taken <= 1.5 * size * 1.02
    toxic_gone = {r.doc_id for r in read_table(spark, SF, "documents").collect()} - {r.doc_id for r in clean.collect()}
    labels = {r.doc_id: r.toxic for r in read_table(spark, SF, "labels").collect()}
    assert all(labels.get(i, 1) == 1 for i in toxic_gone)


def test_run_writes_each_stage(spark):
    out = pipeline.run(spark, SF)
    assert out.count() > 0 and set(read_table(spark, SF, "documents").columns) < set(out.columns)


def test_odd_documents(spark):
    odd = [(None, None, None, None, None), (None, "w " * 40, "en", "s", 80), (1, "", "en", "s", 0), (2, "é" * 90, None, None, 90), (2, "é" * 90, None, None, 90)]
    docs = spark.createDataFrame(odd, read_table(spark, SF, "documents").schema)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
    assert {r.doc_id for r in docs.collect()} <= {None, 2}
    empty = docs.sparkSession.createDataFrame([], read_table(spark, SF, "documents").schema)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.collect() == []


def test_columns_with_the_operators_names_are_kept(spark):
    """Extra columns that share a name with what an operator adds keep their values in every stage but the last."""
    plain = read_table(spark, SF, "documents").where("doc_id < 40")
    names = ("toxic", "severity", "n_bytes", "spans", "kept_sha256", "component_id", "item_id", "matched_bytes")
    docs = plain.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    want = {r.doc_id: tuple(r[n] for n in names) for r in docs.collect()}
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == [*plain.columns, *names]
        assert docs.count() and all(tuple(r[n] for n in names) == want[r.doc_id] for r in docs.collect())
