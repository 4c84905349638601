"""Line dedup: windows of three consecutive lines that occurred before, anywhere in the corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lumenfold.llm import words as W
from lumenfold.llm.common import batches, checkpoint, keyed, lean, rewritten, sized

NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[10] = True


def _windows(size: int):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, tids = batch.column("doc_id").to_numpy(), batch.column("tid").to_numpy()
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]]
        for a, _, rows, hashes, _, _ in W.words(batch.column("text"), NEWLINE):
            n = len(rows) - size + 1
            if n <= 0:
                continue
            at = np.flatnonzero(rows[:n] == rows[size - 1 :])
            h = W.combine([hashes[k : k + n][at] for k in range(size)], 3)
            doc = rows[at]
            for c, x in zip(out, (h.view(np.int64), ids[a + doc], tids[a + doc], (at - np.searchsorted(rows, doc)).astype(np.int32))):
                c.append(x)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["h", "doc_id", "tid", "pos"])

    return one


def repeated_lines(docs: DataFrame, *, window: int = 3) -> DataFrame:
    """``doc_id, tid, lines``: for each document with later occurrences, its non-empty lines (from 0) that they cover."""
    lean(docs.sparkSession)
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("tid"), text.alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    found = checkpoint(own.mapInArrow(batches(_windows(window)), "h long, doc_id long, tid int, pos int"))
    first = found.groupBy("h").agg(F.min(F.struct("doc_id", "tid", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "first")
    later = found.join(first, "h").where(F.struct("doc_id", "tid", "pos") > F.col("first"))
    lines = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("pos", F.col("pos") + (window - 1))))))
    return later.groupBy("doc_id", "tid").agg(lines.alias("lines"))


def _rewrite(column: str):
    """Function of a batch: ``column`` without the ``lines`` to remove, and their number in the place of these."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(column)
        texts, gone = batch.column(at), batch.column("lines")
        removed = np.zeros(batch.num_rows, np.int32)
        if gone.null_count < batch.num_rows:
            texts = texts.to_pylist()
            for i, lines in enumerate(gone.to_pylist()):
                if lines:
                    drop, k, out = set(lines), 0, []
                    for line in texts[i].split("\n"):
                        if not line or k not in drop:
                            out.append(line)
                        k += bool(line)
                    texts[i], removed[i] = "\n".join(out), len(drop)
            texts = pa.array(texts, pa.string())
        return batch.set_column(at, column, texts).drop_columns(["lines"]).append_column("removed", pa.array(removed))

    return one


def dedup_lines(docs: DataFrame, *, window: int = 3, count: str = "n_removed") -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without the lines of later occurrences, and their number in ``count``.

    A window is ``window`` consecutive non-empty lines of a document, compared byte by
    byte (by a 64-bit hash).  The first occurrence, by ``doc_id`` and place, stays; the
    lines that later ones cover go, with their line ends.  Empty lines are neither
    counted nor removed.  Texts with fewer than ``window`` lines, NULL texts and rows
    with a NULL ``doc_id`` stay as they are; rows that share ``doc_id`` and text count
    as one document, and a column of ``docs`` named like ``count`` is replaced.  Other
    columns may have any name.  Of very long texts all lines count."""
    docs = docs.drop(count)
    return _deduped(docs, window)[0].toDF(*docs.columns, count)


def _deduped(docs: DataFrame, window: int) -> tuple[DataFrame, str]:
    """:func:`common.positional` columns after the dedup and ``removed``, and the name of the text."""
    gone = checkpoint(repeated_lines(docs, window=window)).toDF("id", "tid", "lines")
    own, text = keyed(docs)
    schema = StructType([*own.drop("id", "tid").schema.fields, StructField("removed", IntegerType())])
    return rewritten(own, ["id", "tid"], gone, _rewrite(text), schema, {"removed": F.lit(0)}), text


def without_repeated_lines(docs: DataFrame, *, window: int = 3) -> DataFrame:
    """Like :func:`dedup_lines`, with the columns of ``docs`` only, ``n_chars`` set again, and without rows of which only white space is left."""
    left, text = _deduped(docs, window)
    emptied = (F.col("removed") > 0) & ~F.col(text).rlike(r"\S")
    return sized(left.where(~F.coalesce(emptied, F.lit(False))).drop("removed"), docs, text)
