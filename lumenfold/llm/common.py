"""What the operators share: table access, shared-folder checkpoints, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumenfold.operators.shared import checkpoint, folder  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def parts(spark: SparkSession, times: int = 1) -> int:
    """Number of groups for a shuffle; it follows the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * times


#: Bytes of the Arrow batches in which texts go to Python, and rows that a Parquet scan decodes at a time.
BATCH, DECODED = 8 << 20, 512


def lean(spark: SparkSession) -> None:
    """Makes batches of :data:`BATCH` bytes and :data:`DECODED` rows the session's, where it has Spark's defaults of eight times as much.

    Arrow batches are held in several copies, by the JVM outside of its heap and by Python,
    and a scan holds all texts of the rows it decodes in one array, which doubles as it
    grows.  No result depends on these sizes."""
    for key, usual, own in (("spark.sql.execution.arrow.maxBytesPerBatch", (str(64 << 20), f"{64 << 20}b"), BATCH), ("spark.sql.parquet.columnarReaderBatchSize", ("4096",), DECODED)):
        if spark.conf.get(key, None) in usual:
            spark.conf.set(key, str(own))


def documents(docs: DataFrame, *, fold: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only, so that other columns neither travel nor clash."""
    lean(docs.sparkSession)
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.lower(text) if fold else text).alias("text"))


def positional(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with columns ``c0, c1, ...`` (so that no name of theirs can clash), and which of these are ``doc_id`` and ``text``."""
    names = [c.lower() for c in docs.columns]
    return docs.toDF(*[f"c{k}" for k in range(len(names))]), f"c{names.index('doc_id')}", f"c{names.index('text')}"


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """:func:`positional` with ``id``, and ``tid``, the ``hash`` of the text or NULL; and the name of ``text``."""
    lean(docs.sparkSession)
    plain, id_, text = positional(docs)
    value = F.col(text).cast("string")
    return plain.select("*", F.col(id_).cast("long").alias("id"), F.when(value.isNotNull(), F.hash(value)).alias("tid")), text


def sized(plain: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """:func:`positional` columns under the names of ``docs`` again, ``n_chars`` set anew where there is one."""
    sizes = {f"c{k}": F.length(text).cast(f.dataType) for k, f in enumerate(docs.schema) if f.name.lower() == "n_chars"}
    return plain.withColumns(sizes).toDF(*docs.columns)


#: Slots of the filter that is broadcast, at most (8 bytes each).
SLOTS = 1 << 20


def parted(left: DataFrame, keys: list[str], right: DataFrame, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Rows of ``left`` that ``right`` may have a match for, and those for which it has none (a NULL key has none).

    Keys meet in ``slots`` slots by their hash; the slots that ``right`` (which should be
    checkpointed) fills are broadcast.  Where it fills more than half of them, all rows
    without a NULL key are in the first part; so this saves shuffling and never decides on a row."""
    slot = F.xxhash64(*keys).bitwiseAND(F.lit(slots - 1))
    filled = checkpoint(right.select(slot.alias("slot")).distinct())
    ready = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    if filled.count() > slots // 2:
        return left.where(ready), left.where(~ready)
    told = left.select("*", F.when(ready, slot).alias("slot"))
    return told.join(F.broadcast(filled), "slot", "left_semi").drop("slot"), told.join(F.broadcast(filled), "slot", "left_anti").drop("slot")


def rewritten(left: DataFrame, keys: list[str], right: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType, new: dict[str, Column], slots: int = SLOTS) -> DataFrame:
    """``fn`` over the Arrow batches of the left join with ``right`` (distinct keys), without the keys; ``schema`` is its result's.

    Rows that surely have no match stay where they are and don't go through ``fn``: they
    have ``new`` for the columns that it adds.  See :func:`parted`."""
    some, rest = parted(left, keys, right, slots)
    joined = some.join(right, keys, "left").select(*[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys])
    return joined.mapInArrow(batches(fn), schema).unionByName(rest.drop(*keys).withColumns(new) if new else rest.drop(*keys))


def batches(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow function from one that maps a batch."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                yield fn(batch)

    return run


def split(order: np.ndarray, groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Group number and rows of each group; ``order`` sorts ``groups``."""
    g = groups[order]
    cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
    for a, b in zip(cut, np.append(cut[1:], len(g))):
        yield int(g[a]), order[a:b]
