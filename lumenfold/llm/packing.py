"""Best-fit packing of documents into sequences of fixed length by non-negative least squares.

Lengths are counted in white-space tokens and rounded up to ``width``, so that the
corpus is a histogram of ``seq_len / width`` bins.  All patterns of up to three bins
that fill a sequence are columns of a matrix; their repeat counts are fitted to the
histogram, rounded down to what is there, and what is left is packed best fit
decreasing, bin by bin.  All of this happens on the histogram; its cost doesn't
depend on the corpus.  Each document then finds its place from its rank in its bin.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.llm import words as W
from lumenfold.llm.common import batches, checkpoint, documents


def patterns(bins: int) -> list[tuple[int, ...]]:
    """All ways to fill ``bins`` with one, two or three lengths, in descending order."""
    found: list[tuple[int, ...]] = [(bins,)]
    for a in range(bins - 1, 0, -1):
        rest = bins - a
        if rest <= a:
            found.append((a, rest))
        found += [(a, b, rest - b) for b in range(min(a, rest - 1), 0, -1) if 0 < rest - b <= b]
    return found


#: Parts in which the documents of a bin are ranked.
PARTS = 1024


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``x >= 0`` that makes ``|a x - b|`` least, by the active-set method.

    It ends at the optimum, after some two columns a row; that rounding can't make it
    go round for ever, no more than 30 columns a row enter."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gram_tol = 1e-10 * max(1.0, np.abs(a.T @ b).max(initial=0.0))
    for _ in range(30 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        j = int(np.argmax(gradient))
        if gradient[j] <= gram_tol:
            break
        passive[j] = True
        while True:
            at = np.flatnonzero(passive)
            sub = a[:, at]
            z = np.linalg.solve(sub.T @ sub + 1e-12 * np.eye(len(at)), sub.T @ b)
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            bad = z <= 0
            old = x[at]
            step = (old[bad] / np.maximum(old[bad] - z[bad], 1e-300)).min()
            x[at] = old + step * (z - old)
            passive[at[(x[at] <= 1e-14) & bad]] = False
            x[~passive] = 0
    return x


def best_fit(left: np.ndarray, bins: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and repeats that best fit decreasing makes of ``left[b]`` items of each length ``b``."""
    room: dict[int, list[list]] = {}
    for b in range(bins, 0, -1):
        n = int(left[b])
        while n:
            space = min((s for s in room if s >= b), default=None)
            if space is None:
                each = bins // b
                for k, times in ((each, n // each), (n % each, 1)):
                    if k and times:
                        room.setdefault(bins - k * b, []).append([(b,) * k, times])
                break
            pattern, times = room[space].pop()
            each = space // b
            k = min(each, n)
            used = min(times, n // k)
            if times > used:
                room[space].append([pattern, times - used])
            if not room[space]:
                del room[space]
            room.setdefault(space - k * b, []).append([pattern + (b,) * k, used])
            n -= used * k
    return [(tuple(p), t) for s in sorted(room) for p, t in room[s]]


def plan(histogram: np.ndarray, bins: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and repeats that hold exactly ``histogram[b]`` items of each length ``b`` (1 to ``bins``)."""
    left = histogram.astype(np.int64).copy()
    found: list[tuple[tuple[int, ...], int]] = []
    if left.sum():
        columns = patterns(bins)
        matrix = np.zeros((bins + 1, len(columns)))
        for j, p in enumerate(columns):
            for b in p:
                matrix[b, j] += 1
        weight = np.where(np.arange(bins + 1) < bins / 8, 0.1, 1.0)  # short ones fit anywhere later
        x = nnls(matrix * weight[:, None], histogram / histogram.sum() * weight) * histogram.sum()
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            times = min(int(round(x[j])), *(int(left[b]) // columns[j].count(b) for b in set(columns[j])))
            if times:
                found.append((columns[j], times))
                for b in columns[j]:
                    left[b] -= times
    return found + best_fit(left, bins)


def places(steps: list[tuple[tuple[int, ...], int]], bins: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per bin: first rank, items a pack, first pack of each step that holds the bin."""
    rows: dict[int, list[tuple[int, int, int]]] = {b: [] for b in range(1, bins + 1)}
    rank, pack = np.zeros(bins + 1, np.int64), 0
    for pattern, times in steps:
        for b in sorted(set(pattern)):
            each = pattern.count(b)
            rows[b].append((int(rank[b]), each, pack))
            rank[b] += each * times
        pack += times
    return {b: tuple(np.array(c, np.int64) for c in zip(*r)) for b, r in rows.items() if r}


def _lengths(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = np.zeros(batch.num_rows, np.int64)
    data, offsets, _ = W.buffers(batch.column("text"))
    for a, b in W.groups(offsets):
        _, _, rows = W.spans(data, offsets[a : b + 1], W.SPACE)
        n[a:b] = np.bincount(rows, minlength=b - a)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n)], ["doc_id", "n"])


def pack_documents(docs: DataFrame, *, seq_len: int = 2048, width: int = 8) -> DataFrame:
    """``pack_id, doc_ids, starts, lengths, used``: a row per sequence of at most ``seq_len`` tokens.

    Entry k of the arrays is ``lengths[k]`` tokens of document ``doc_ids[k]`` from token
    ``starts[k]`` on; ``used`` is their sum.  Every token of every row of ``docs`` is in
    one sequence: a longer document is cut into whole sequences and a rest that is
    packed.  NULL texts and texts without tokens take no room; a NULL ``doc_id`` stays
    NULL, and repeated rows are packed like any other row.  Which documents share a
    sequence depends on the rows alone, not on how they are partitioned."""
    bins = seq_len // width
    lengths = checkpoint(documents(docs).mapInArrow(batches(_lengths), "doc_id long, n long").where("n > 0"))
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / seq_len).cast("long"))).alias("k")
    own = lengths.select("doc_id", "n", piece).select("doc_id", (F.col("k") * seq_len).alias("start"), F.least(F.lit(seq_len).cast("long"), F.col("n") - F.col("k") * seq_len).cast("int").alias("length"))
    own = own.withColumn("bin", F.ceil(F.col("length") / width).cast("int")).withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(PARTS)).cast("int"))
    counts = own.groupBy("part", "bin").agg(F.count("*").alias("n"))
    histogram = np.zeros(bins + 1, np.int64)
    for row in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # a row per bin
        histogram[row["bin"]] = row["n"]
    place = places(plan(histogram, bins), bins)

    before = F.coalesce(F.sum("n").over(Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("part", "bin", before.alias("before"))
    local = F.row_number().over(Window.partitionBy("part", "bin").orderBy("doc_id", "start", "length")) - 1
    ranked = own.withColumn("local", local).join(offsets, ["part", "bin"]).select("doc_id", "start", "length", "bin", (F.col("local") + F.col("before")).alias("rank"))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        bin_, rank = batch.column("bin").to_numpy(), batch.column("rank").to_numpy()
        pack = np.zeros(len(rank), np.int64)
        for b in np.unique(bin_):
            at = np.flatnonzero(bin_ == b)
            first, each, base = place[int(b)]
            step = np.searchsorted(first, rank[at], side="right") - 1
            pack[at] = base[step] + (rank[at] - first[step]) // each[step]
        return pa.RecordBatch.from_arrays([pa.array(pack), batch.column("doc_id"), batch.column("start"), batch.column("length")], ["pack_id", "doc_id", "start", "length"])

    placed = ranked.mapInArrow(batches(one), "pack_id long, doc_id long, start long, length int")
    rows = placed.groupBy("pack_id").agg(F.array_sort(F.collect_list(F.struct("doc_id", "start", "length"))).alias("e"), F.sum("length").cast("int").alias("used"))
    return rows.select("pack_id", F.col("e.doc_id").alias("doc_ids"), F.col("e.start").alias("starts"), F.col("e.length").alias("lengths"), "used")
