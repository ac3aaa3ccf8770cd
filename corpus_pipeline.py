"""A training corpus from `documents`: each stage works on all that its predecessor kept.

Needs the training-data operators (`flowstats.llm`). Every stage takes (spark, docs, sf_dir) and returns the documents
that go on, with the columns of `documents`; the last returns the mix, with how many words of each document it takes.

All stages but the last keep every column as it is, whatever its name, but for `text` and `n_chars` where a passage is
cut. Null ids, texts, languages and sources, empty and very long texts, repeated rows and empty tables pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowstats.llm.common import read_table, shared_dir
from flowstats.llm.decontaminate import without_leaks
from flowstats.llm.jaccard import one_of_each
from flowstats.llm.mixing import mixed_documents
from flowstats.llm.suffix_dedup import remove_repeats
from flowstats.llm.toxicity import toxicity_scores


def _aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, Column]]:
    """`docs` with the columns that an operator would replace under other names, and how to select each by its own."""
    other = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(other), {c: F.col(other.get(c, c)).alias(c) for c in docs.columns}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go, by their texts alone: a null or empty text stays, equal rows go or
    stay together."""
    free, own = _aside(docs, ("expected_severity", "severity", "toxic"))
    scored = toxicity_scores(free, read_table(spark, sf_dir, "labels"))
    return scored.where(~F.col("toxic")).select(*own.values())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id: five-word shingles, a similarity of
    0.8 or more. Rows are told apart by id and text, and equal rows are copies; texts without words are copies of none."""
    return one_of_each(docs, words=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document with a smaller id has are cut from the texts; `n_chars` is what is
    left. Every row stays; one without an id keeps its text, and rows of one id cut nothing from each other."""
    free, own = _aside(docs, ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "__chunk"))
    if "n_chars" in own:
        own["n_chars"] = F.length("text").cast("long").alias("n_chars")
    return remove_repeats(free, with_text=True).select(*own.values())


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 50 bytes of a benchmark item go (see `without_leaks`); null and empty texts stay."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with size, target and the words taken of each; a null source is a source of its own."""
    return mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]

#: The ordinal model and the fuzzy search have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`; each is written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
    return docs
