"""Substring dedup: fixed-length token windows that occur again, merged into intervals.

Tokens are runs of non-white-space bytes.  Every window of ``window`` tokens has a
Rabin-Karp hash, read off one prefix sum of the document.  Windows travel to their
count in *runs*: neighbouring windows with one anchor, the least hash of the
``SHINGLE``-token shingles inside a window.  Equal windows have equal anchors, so
all windows of an anchor meet in one place; a run costs 6 bytes a window and about
26 bytes besides, and there are some 18 windows in a run.  Anchors of many runs, as
boilerplate has them, are counted out beforehand; their windows are counted one by one
with map-side combine instead, so that no group outgrows a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.llm import words as W
from lumenfold.llm.common import batches, checkpoint, keyed, lean, parts, rewritten, sized

SHINGLE = 16
#: Bytes of a window's hash that travel, beside the 8 of its anchor.
KEEP = 6
#: Runs of an anchor from which its windows are counted one by one, at least, and the part of all runs from which they are.
HOT, SHARE = 1 << 17, 1 << 18
#: Windows that are broadcast at most (some 40 bytes each).
BROADCAST = 1 << 20


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each ``n`` neighbours."""
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def window_runs(hashes: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the token hashes of some rows: token at which each window starts, its anchor and its hash."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    powers, inverse = W._tables(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(hashes * powers[:n], out=prefix[1:])
        rolling = lambda k: W.mix((prefix[k:] - prefix[:-k]) * inverse[: n + 1 - k])
        short = min(SHINGLE, window)
        anchor, value = _least(rolling(short), window - short + 1), rolling(window)
    at = np.flatnonzero(rows[: n - window + 1] == rows[window - 1 :])
    return at, anchor[at], value[at]


def _anchors(window: int):
    """Function of a batch: the runs of each anchor."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.zeros(0, np.uint64)]
        for _, _, rows, hashes, _, _ in W.words(batch.column("text"), W.SPACE):
            at, anchor, _ = window_runs(hashes, rows, window)
            if len(at):
                found.append(anchor[_starts(anchor, rows[at])])
        anchor, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], ["anchor", "n"])

    return one


def _starts(anchor: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where runs begin."""
    return np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))


def _hot_windows(window: int, hot: np.ndarray):
    """Function of a batch: the windows whose anchor is in ``hot``, which is sorted."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, tids = batch.column("doc_id").to_numpy(), batch.column("tid").to_numpy()
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]]
        for a, _, rows, hashes, _, _ in W.words(batch.column("text"), W.SPACE):
            at, anchor, value = window_runs(hashes, rows, window)
            some = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor)
            at, doc = at[some], rows[at[some]]
            for c, x in zip(out, (value[some].view(np.int64), ids[a + doc], tids[a + doc], (at - np.searchsorted(rows, doc)).astype(np.int32))):
                c.append(x)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["h", "doc_id", "tid", "pos"])

    return one


def _intervals(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Windows of a batch, neighbours as one interval."""
    doc, tid, pos, removed = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tid", "pos", "removed"))
    order = np.lexsort((pos, removed, tid, doc))
    doc, tid, pos, removed = doc[order], tid[order], pos[order], removed[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tid[1:] != tid[:-1]) | (removed[1:] != removed[:-1]) | (pos[1:] > pos[:-1] + 1)
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(doc)) - 1
    return pa.RecordBatch.from_arrays([pa.array(doc[lo]), pa.array(tid[lo]), pa.array(pos[lo]), pa.array(pos[hi]), pa.array(removed[lo])], ["doc_id", "tid", "lo", "hi", "removed"])


def _hot(own: DataFrame, window: int, hot: np.ndarray, broadcast: int) -> DataFrame:
    """Intervals of the windows with one of the ``hot`` anchors: counted by hash, then the first is sought for each."""
    windows = own.mapInArrow(batches(_hot_windows(window, hot)), "h long, doc_id long, tid int, pos int")
    # rows that the input repeats are one document: their places are counted once
    first = windows.groupBy("h").agg(F.min(F.struct("doc_id", "tid", "pos")).alias("first"), F.max(F.struct("doc_id", "tid", "pos")).alias("last")).where("first <> last").select("h", "first")
    first = checkpoint(first)
    small = first.limit(broadcast + 1).count() <= broadcast
    met = windows.join(F.broadcast(first) if small else first.hint("merge"), "h")
    return met.select("doc_id", "tid", "pos", (F.struct("doc_id", "tid", "pos") > F.col("first")).alias("removed")).mapInArrow(batches(_intervals), _INTERVAL)


_INTERVAL = "doc_id long, tid int, lo int, hi int, removed boolean"


def _runs(window: int, buckets: int, hot: np.ndarray):
    """Function of a batch: runs, but for those of ``hot`` anchors."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, tids = batch.column("doc_id").to_numpy(), batch.column("tid").to_numpy()
        cols: list[list[np.ndarray]] = [[], [], [], []]
        lengths, values = [], []
        for a, b, rows, hashes, _, _ in W.words(batch.column("text"), W.SPACE):
            at, anchor, value = window_runs(hashes, rows, window)
            if len(hot) and len(at):
                some = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] != anchor)
                at, anchor, value = at[some], anchor[some], value[some]
            if not len(at):
                continue
            row = rows[at]
            start = _starts(anchor, row)
            if len(hot):  # a run of others may end where a hot one was
                start = np.union1d(start, np.flatnonzero(at[1:] != at[:-1] + 1) + 1)
            doc = row[start]
            first = np.searchsorted(rows, doc)
            for c, x in zip(cols, (anchor[start].view(np.int64), ids[a + doc], tids[a + doc], (at[start] - first).astype(np.int32))):
                c.append(x)
            lengths.append(np.diff(np.append(start, len(at))))
            values.append(np.ascontiguousarray(value.view(np.uint8).reshape(-1, 8)[:, :KEEP]))
        if not lengths:
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())], NAMES)
        anchor, doc, tid, start = map(np.concatenate, cols)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths)) * KEEP]).astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(anchor), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(values))])
        bucket = (W.mix(anchor.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(anchor), pa.array(doc), pa.array(tid), pa.array(start), blobs], NAMES)

    return one


NAMES = ["bucket", "anchor", "doc_id", "tid", "start", "hashes"]


def _counted(key: tuple, t: pa.Table) -> pa.Table:
    """Intervals of window starts (``lo`` to ``hi``) that repeat, of the runs of a bucket."""
    anchor, doc, tid, start = (t.column(c).to_numpy() for c in NAMES[1:5])
    blob = t.column("hashes").combine_chunks() if t.num_rows else None
    if isinstance(blob, pa.ChunkedArray):
        blob = pa.concat_arrays(blob.chunks)
    offsets = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64)
    data = np.frombuffer(blob.buffers()[2], np.uint8)
    order = np.lexsort((start, tid, doc))
    same = np.zeros(len(order), bool)  # rows that the input repeats
    same[1:] = (doc[order][1:] == doc[order][:-1]) & (tid[order][1:] == tid[order][:-1]) & (start[order][1:] == start[order][:-1])
    order = order[~same]
    size = (np.diff(offsets) // KEEP)[order]
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    within = np.arange(size.sum()) - np.repeat(begin, size)
    source = np.repeat(offsets[order], size) + within * KEEP
    value = np.zeros((len(source), 8), np.uint8)
    for k in range(KEEP):
        value[:, k] = data[source + k]
    with np.errstate(over="ignore"):
        whole = W.mix(value.view(np.uint64)[:, 0] ^ np.repeat(anchor[order].view(np.uint64) * np.uint64(W.MIX1), size))
    by = np.argsort(whole)
    cut = np.flatnonzero(np.concatenate([[True], whole[by][1:] != whole[by][:-1]]))
    times = np.diff(np.append(cut, len(by)))
    state = np.zeros(len(by), np.int8)  # 1: the first of several, 2: a later one
    many = np.repeat(times > 1, times)
    state[by[many]] = 2
    if len(cut):
        state[np.minimum.reduceat(by, cut)[times > 1]] = 1
    run = np.repeat(np.arange(len(order)), size)
    edge = np.flatnonzero(np.concatenate([[True], (state[1:] != state[:-1]) | (run[1:] != run[:-1])])) if len(state) else np.zeros(0, int)
    last = np.append(edge[1:], len(state)) - 1
    edge, last = edge[state[edge] > 0], last[state[edge] > 0]
    r = order[run[edge]]
    return pa.table({"doc_id": doc[r], "tid": tid[r], "lo": start[r] + within[edge].astype(np.int32), "hi": start[r] + within[last].astype(np.int32), "removed": state[edge] == 2})


def _often(counts: DataFrame, hot: int) -> np.ndarray:
    """The anchors with more than ``hot`` runs and more than one run of ``SHARE``, of which there are less than ``SHARE``; sorted."""
    counts = checkpoint(counts.groupBy((F.col("n") > hot).alias("many"), F.when(F.col("n") > hot, F.col("anchor")).alias("anchor")).agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where("many").where(F.col("n") > total // SHARE).select("anchor").toArrow()
    return np.sort(rows.column("anchor").to_numpy().view(np.uint64))


def repeated_substrings(docs: DataFrame, *, window: int = 50, hot: int = HOT, broadcast: int = BROADCAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tid, start_word, end_word, removed``: maximal intervals of windows that occur more than once.

    ``removed`` intervals hold windows that occurred before, in an earlier document
    (by ``doc_id``) or earlier in the same one; the others are the first occurrences,
    which stay.  Windows that overlap or touch merge.  ``tid`` is a hash of the text:
    rows that share ``doc_id`` and text count as one document.  Rows with a NULL
    ``doc_id`` or text, and texts of fewer than ``window`` tokens, have no interval.  Very
    long texts are read as a whole.  Anchors with more than ``hot`` runs (and more than one
    run of ``SHARE``) go the other way, see above; the result is the same."""
    lean(docs.sparkSession)
    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.hash(text).alias("tid"), text.alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    buckets = parts(docs.sparkSession, 4)
    counts = own.select("text").mapInArrow(batches(_anchors(window)), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    often = _often(counts, hot)
    runs = own.mapInArrow(batches(_runs(window, buckets, often)), "bucket int, anchor long, doc_id long, tid int, start int, hashes binary")
    found = runs.groupBy("bucket").applyInArrow(_counted, _INTERVAL)
    if len(often):
        found = found.union(_hot(own, window, often, broadcast))
    w = Window.partitionBy("doc_id", "tid", "removed").orderBy("lo", "hi")
    far = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    told = found.withColumn("new", (far.isNull() | (F.col("lo") > far + window)).cast("int")).withColumn("part", F.sum("new").over(w))
    return told.groupBy("doc_id", "tid", "removed", "part").agg(F.min("lo").alias("start_word"), (F.max("hi") + window).cast("int").alias("end_word")).select("doc_id", "tid", "start_word", "end_word", "removed")


def _cut(column: str):
    """Function of a batch: ``column`` without its ``spans``."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, gone = batch.schema.get_field_index(column), batch.column("spans")
        texts = batch.column(at)
        if gone.null_count < batch.num_rows:
            texts = texts.to_pylist()
            for i, spans in enumerate(gone.to_pylist()):
                if spans:
                    raw = texts[i].encode()
                    _, _, _, _, s, e = next(W.words(pa.array([texts[i]]), W.SPACE))
                    out, end = [], 0
                    for span in sorted(spans, key=lambda x: x["a"]):
                        out.append(raw[end : int(s[span["a"]])])
                        end = int(e[span["b"] - 1])
                    out.append(raw[end:])
                    texts[i] = b" ".join(x.strip(b" ") for x in out).strip(b" ").decode()
            texts = pa.array(texts, pa.string())
        return batch.set_column(at, column, texts).drop_columns(["spans"])

    return one


def remove_substrings(docs: DataFrame, *, window: int = 50, hot: int = HOT) -> DataFrame:
    """``docs`` with all later occurrences cut out of ``text``; all rows and columns stay, whatever their names.

    What is left on either side of a cut is joined by one blank.  ``n_chars`` is set again
    where ``docs`` has it.  Rows with a NULL stay as they are; see
    :func:`repeated_substrings` for what is an occurrence."""
    gone = repeated_substrings(docs, window=window, hot=hot).where("removed").groupBy("doc_id", "tid").agg(F.collect_list(F.struct(F.col("start_word").alias("a"), F.col("end_word").alias("b"))).alias("spans"))
    own, text = keyed(docs)
    left = rewritten(own, ["id", "tid"], checkpoint(gone).toDF("id", "tid", "spans"), _cut(text), own.drop("id", "tid").schema, {})
    return sized(left, docs, text)
