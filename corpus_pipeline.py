"""A training-data pipeline: five operators of ``lumenfold.llm``, one after the other.

Each stage reads what the stage before it wrote.  SQL can't express the classifier
or the packing, so there is no SQL of the whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import lines, packing, quality, simhash, substring
from lumenfold.llm.common import checkpoint, folder, parted, positional, remove, table

ORACLE_SQL: str | None = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted to the labels of ``sf_dir``.

    Each row is judged on its own: repeated rows and rows with a NULL ``doc_id`` are like
    any other.  NULL texts and texts without tokens go; without labels of both kinds all
    others stay."""
    return quality.keep_good(docs, quality.fit_classifier(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of repeated three-line windows; a document of which only white space is left goes.

    Rows with a NULL stay as they are; of equal windows the first by ``doc_id`` and place
    stays."""
    return lines.without_repeated_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near copies, each distinct ``doc_id`` and text judged on its own, repeated rows once.

    Rows with a NULL ``doc_id`` or text stay.  Only rows that a group drops, or that are
    repeated, are shuffled (and those that a filter of bounded size can't tell from them);
    of repeated rows that differ in other columns, any one stays."""
    own, id_, text = positional(docs)
    value = F.col(text).cast("string")
    own = own.select("*", F.col(id_).cast("long").alias("id"), F.when(value.isNotNull(), F.xxhash64(value)).alias("tid"))
    told = checkpoint(simhash.near_copies(docs)).toDF("id", "tid", "keep")
    some, rest = parted(own, ["id", "tid"], told)
    left = some.join(told.where("NOT keep"), ["id", "tid"], "left_anti")
    several = told.where("keep").select("id", "tid")
    if not several.isEmpty():
        again = left.join(several, ["id", "tid"], "left_semi").dropDuplicates(["id", "tid"])  # combined before the shuffle
        left = left.join(several, ["id", "tid"], "left_anti").select(own.columns).union(again.select(own.columns))
    return left.select(own.columns).union(rest.select(own.columns)).drop("id", "tid").toDF(*docs.columns)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of passages of 50 or more tokens.

    Rows with a NULL stay as they are, empty texts too; of equal passages the first by
    ``doc_id`` and place stays."""
    return substring.remove_substrings(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, see :func:`lumenfold.llm.packing.pack_documents`.

    Texts without tokens and NULL texts take no room; repeated rows are packed each."""
    return packing.pack_documents(docs)


STAGES = [("quality classifier", classify), ("line dedup", dedup_lines), ("near dedup", dedup_near), ("substring dedup", dedup_substrings), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder.

    Each of these tables is removed when the next one is there; the last one, which the
    result reads, stays in ``pipeline-<uuid>`` and can go when the result is written."""
    docs = table(spark, sf_dir, "documents")
    root = f"{folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        if k:
            docs.write.parquet(f"{root}/{k}")
            docs = spark.read.parquet(f"{root}/{k}")
            if k > 1:
                remove(spark, f"{root}/{k - 1}")
        docs = stage(spark, docs, sf_dir)
    return docs
