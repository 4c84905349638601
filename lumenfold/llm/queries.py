"""The subpackage's queries and their SQL, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenfold.llm import bpe, gru, license_scan, lines, oracle, packing, quality, simhash, substring
from lumenfold.llm.common import table

#: Folder of the public vocabulary files.
TOKENIZERS = "/opt/tokenizers"
Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """Ids of every document by a public vocabulary, and whether decoding them gives its text back; see :func:`lumenfold.llm.bpe.encode_documents`."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary)


def op2_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every document; trusted are those that all labels call good. See :func:`lumenfold.llm.quality.importance_scores`."""
    return quality.importance_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, its copies, near fingerprints and class; see :func:`lumenfold.llm.simhash.document_fingerprints`."""
    return simhash.document_fingerprints(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies of every ``doc_id``, and which one stays; see :func:`lumenfold.llm.simhash.near_duplicates`."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences that hold every token of every document once; see :func:`lumenfold.llm.packing.pack_documents`."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections in every document; see :func:`lumenfold.llm.license_scan.scan_licenses`."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document under a model of all of them; see :func:`lumenfold.llm.gru.score_documents`."""
    return gru.language_model_scores(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 and more tokens that occur again; see :func:`lumenfold.llm.substring.repeated_substrings`."""
    return substring.repeated_substrings(table(spark, sf_dir, "documents")).drop("tid")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a classifier fitted to the labelled ones; see :func:`lumenfold.llm.quality.classify`."""
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit_classifier(docs, table(spark, sf_dir, "labels")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of repeated three-line windows; see :func:`lumenfold.llm.lines.dedup_lines`."""
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_bpe, op2_quality_ratio, op3_document_fingerprints, op4_best_fit_packing, op5_license_scan, op6_lm_scoring, op7_substring_dedup, op8_quality_classifier, op9_line_dedup, op10_simhash_near_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_ratio": oracle.op2(quality.RATIO_THRESHOLD, quality.RATIO_SMOOTHING, quality.PAIR_SMOOTHING, quality.RATIO_BUCKETS, quality.RATIO_PAIRS, quality.PREFIXES), "op3_document_fingerprints": oracle.op3(), "op7_substring_dedup": oracle.op7(), "op9_line_dedup": oracle.op9(), "op10_simhash_near_dedup": oracle.op10()}
