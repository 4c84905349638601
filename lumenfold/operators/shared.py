"""Materialized results in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a local session (a test) gets one of its own and a cluster is an error."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lumenfold-")
    context.setCheckpointDir(path)
    return context._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Computes ``df`` now and cuts its lineage through :func:`folder`, so that the result survives lost executors.

    Spark removes the files with the result where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    folder(df.sparkSession)
    return df.checkpoint()
