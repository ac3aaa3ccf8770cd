"""The operators' registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowstats.llm import divergence, embeddings, jaccard, mixing, resampling, warc
from flowstats.llm.common import read_table
from flowstats.llm.decontaminate import leaks
from flowstats.llm.embeddings import link_vectors
from flowstats.llm.jaccard import similar_components
from flowstats.llm.kneser_ney import score_documents
from flowstats.llm.license_scan import find_licenses, license_digest
from flowstats.llm.quality import quality_scores
from flowstats.llm.suffix_dedup import remove_repeats
from flowstats.llm.token_counts import count_tokens
from flowstats.llm.toxicity import toxicity_scores


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(read_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read_table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "expected_severity", "severity", "toxic")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(find_licenses(read_table(spark, sf_dir, "documents")))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_jaccard_join, op3_token_counts, op4_embedding_dedup, op5_mixing, op6_toxicity,
        op7_decontamination, op8_quality, op9_warc, op10_language_model, op11_license_scan, op12_resampling,
        op13_divergence,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op2_jaccard_join": jaccard.ORACLE_SQL,
    "op4_embedding_dedup": embeddings.ORACLE_SQL,
    "op5_mixing": mixing.ORACLE_SQL,
    "op9_warc": warc.ORACLE_SQL,
    "op12_resampling": resampling.ORACLE_SQL,
    "op13_divergence": divergence.ORACLE_SQL,
}
