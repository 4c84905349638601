"""Two quality filters over hashed word n-grams.

Tokens are runs of letters and digits or runs of punctuation, case kept; n-grams
are single tokens, pairs of neighbours and the first 4 and 5 bytes of longer tokens,
hashed into a fixed number of buckets.

* :func:`importance_scores`: log-likelihood ratio between the multinomial of
  trusted documents and that of the whole corpus, per n-gram.
* :func:`fit_classifier` / :func:`classify`: naive Bayes support vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm import words as W
from lumenfold.llm.common import batches, documents, lean

#: Buckets of the two filters.
RATIO_BUCKETS, CLASSIFIER_BUCKETS = 1 << 20, 1 << 18
PREFIXES = (4, 5)
#: Buckets of the ratio's pairs, behind the others'.
RATIO_PAIRS = 1 << 18
#: Ratio from which a document is kept (0: as likely under trusted documents as in the corpus), and what is added to each bucket and to each of pairs, which are rarer: a pair counts where it is frequent in one of the two.
RATIO_THRESHOLD, RATIO_SMOOTHING, PAIR_SMOOTHING = 0.0, 3.0, 300.0
#: Labelled ids that are broadcast at most (8 bytes each); beyond that the join shuffles.
BROADCAST_IDS = 1 << 21


def ngrams(texts: pa.Array, buckets: int, own: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per group of rows: first and end row, row of each n-gram (from the first row), its bucket.

    N-grams are tokens, the first ``PREFIXES`` bytes of longer tokens, and pairs of neighbours,
    which have ``own`` buckets of their own behind the others' or, where it is 0, share these."""
    data, offsets, _ = W.buffers(texts)
    for a, b in W.groups(offsets):
        starts, ends, rows = W.tokens(data, offsets[a : b + 1])
        h = W.hashes(data, starts, ends)
        same = rows[1:] == rows[:-1]
        found, at = [h & np.uint64(buckets - 1)], [rows]
        for k in PREFIXES:
            longer = ends - starts > k
            found.append(W.combine([W.hashes(data, starts[longer], starts[longer] + k)], k) & np.uint64(buckets - 1))
            at.append(rows[longer])
        two = W.combine([h[:-1][same], h[1:][same]], 2)
        found.append((two & np.uint64(own - 1)) + np.uint64(buckets) if own else two & np.uint64(buckets - 1))
        at.append(rows[:-1][same])
        yield a, b, np.concatenate(at), np.concatenate(found).astype(np.int64)


def trusted(labels: DataFrame) -> DataFrame:
    """``doc_id, good``: good where every label of the document says quality 1 and toxic 0; labels with a NULL are passed over."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))


def _counts(buckets: int, own: int):
    """mapInArrow function: of each bucket the n-grams of all texts and of the ``good`` ones."""
    n = buckets + own

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros((2, n), np.int64), ([], []), 0

        def add() -> None:
            for t, x in zip(total, held):
                if x:
                    t += np.bincount(np.concatenate(x), minlength=n)
                x.clear()

        for batch in it:
            good = batch.column("good").to_numpy(zero_copy_only=False).astype(bool)
            for a, b, rows, bucket in ngrams(batch.column("text"), buckets, own):
                held[0].append(bucket)
                held[1].append(bucket[good[a:b][rows]])
                size += len(bucket)
                if size > 4 * n:
                    add()
                    size = 0
        add()
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[0][at]), pa.array(total[1][at])], ["bucket", "n", "good"])

    return run


def marked(docs: DataFrame, ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``text`` of all ``docs``, and whether the ``doc_id`` is in ``ids`` (distinct); broadcasts no more than ``limit`` ids."""
    small = ids.limit(limit + 1).count() <= limit
    ids = ids.select("doc_id", F.lit(True).alias("good"))
    return docs.join(F.broadcast(ids) if small else ids.hint("merge"), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))


def importance_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = RATIO_THRESHOLD, smoothing: float = RATIO_SMOOTHING, pair_smoothing: float = PAIR_SMOOTHING, buckets: int = RATIO_BUCKETS, pair_buckets: int = RATIO_PAIRS, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``doc_id, score, keep`` for every row of ``docs``.

    ``score`` is the mean over the text's n-grams (tokens, beginnings of tokens, pairs of
    tokens) of ``log p_trusted - log p_corpus``, both multinomials counted over all their
    documents, the corpus scaled to the size of the trusted part and ``smoothing`` added
    to each bucket (``pair_smoothing`` to those of pairs), rounded to 6 digits; ``keep`` is
    ``score >= threshold``.  A NULL text or one without tokens has a NULL score and isn't
    kept.  Without any trusted document all are equally likely under both: scores are 0 and
    every text with tokens is kept.  Repeated rows count and are scored each, rows with a
    NULL ``doc_id`` too; of a text of any length all n-grams count."""
    own, n = documents(docs), buckets + pair_buckets
    rows = marked(own, trusted(labels).where("good").select("doc_id"), broadcast_ids).mapInArrow(_counts(buckets, pair_buckets), "bucket int, n long, good long")
    rows = rows.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toArrow()  # a row a bucket, 26 MB at most
    corpus, target = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = rows.column("bucket").to_numpy()
    corpus[at], target[at] = rows.column("n").to_numpy(), rows.column("good").to_numpy()
    added = np.where(np.arange(n) < buckets, smoothing, pair_smoothing)
    ratio = np.log(target + added) - np.log(corpus * (target.sum() / max(1, corpus.sum())) + added)
    sent = docs.sparkSession.sparkContext.broadcast(ratio)  # 10 MB, whatever the corpus

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ratio, total, n = sent.value, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for a, b, rows, bucket in ngrams(batch.column("text"), buckets, pair_buckets):
            total[a:b], n[a:b] = np.bincount(rows, ratio[bucket], b - a), np.bincount(rows, minlength=b - a)
        score = np.round(total / np.maximum(n, 1), 6) + 0.0
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, mask=n == 0), pa.array((score >= threshold) & (n > 0))], ["doc_id", "score", "keep"])

    return own.mapInArrow(batches(one), "doc_id long, score double, keep boolean")


def _indicators(texts: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Like :func:`ngrams`, each bucket once a row and sorted by row."""
    bits = np.uint64(buckets.bit_length() - 1)
    for a, b, rows, bucket in ngrams(texts, buckets):
        key = np.sort(rows.astype(np.uint64) << bits | bucket.astype(np.uint64))
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        yield a, b, (key >> bits).astype(np.int64), (key & np.uint64(buckets - 1)).astype(np.int64)


def dual_coordinate_descent(features: list[np.ndarray], scale: np.ndarray, sign: np.ndarray, *, cost: float = 3.0, epochs: int = 12, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear L1-loss support vector machine over scaled, length-normalised indicators."""
    w, bias, rng = np.zeros(len(scale)), 0.0, np.random.default_rng(seed)
    x = [scale[f] for f in features]
    x = [(v / max(np.sqrt(v @ v), 1e-12)).astype(np.float32) for v in x]
    alpha = np.zeros(len(x))
    square = np.array([float(v @ v) for v in x]) + 1.0  # and the constant feature
    weight = cost * len(sign) / (2 * np.maximum(1, np.where(sign > 0, (sign > 0).sum(), (sign < 0).sum())))
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            gradient = sign[i] * (w[features[i]] @ x[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), weight[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[features[i]] += step * x[i]
                bias += step
                alpha[i] = new
    return w, bias


def fit_classifier(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 8000, buckets: int = CLASSIFIER_BUCKETS, smoothing: float = 5.0) -> dict:
    """A model for :func:`classify` from at most about ``max_labelled`` labelled documents, chosen by a hash of ``doc_id``.

    The bound holds what the driver gathers (some 40 MB), a row per ``doc_id``: of texts that
    share one, the one with the least set of n-grams counts.  All labelled documents are
    used below it.  NULL texts are passed over.  Without labelled documents of both kinds the model
    keeps every text that isn't empty: each has margin 1, that of a support vector."""
    known = trusted(labels)
    n = known.count()
    if n > max_labelled:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(max_labelled / n * (1 << 20)))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [b""] * batch.num_rows
        for a, b, rows, bucket in _indicators(batch.column("text"), buckets):
            cut = np.searchsorted(rows, np.arange(b - a + 1))
            for r in range(b - a):
                sets[a + r] = bucket[cut[r] : cut[r + 1]].astype(np.int32).tobytes()
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(sets, pa.binary())], ["doc_id", "good", "set"])

    found = documents(docs).where("text IS NOT NULL").join(F.broadcast(known), "doc_id").select("doc_id", "good", "text")
    rows = found.mapInArrow(batches(one), "doc_id long, good boolean, set binary").groupBy("doc_id").agg(F.first("good").alias("good"), F.min("set").alias("set")).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    good = rows.column("good").to_numpy()[order].astype(bool)
    raw = [np.frombuffer(b.as_buffer(), np.int32) for b in rows.column("set")]  # views, no copies
    sets = [raw[i] for i in order]
    if good.all() or not good.any():
        return {"weights": np.zeros(buckets, np.float32), "scale": np.ones(buckets, np.float32), "bias": 1.0, "buckets": buckets}
    count = np.zeros((2, buckets), np.int64)
    for s, g in zip(sets, good):
        count[0 if g else 1][s] += 1  # a set holds a bucket once
    scale = np.log(count[0] * (count[1].sum() / max(1, count[0].sum())) + smoothing) - np.log(count[1] + smoothing)
    w, bias = dual_coordinate_descent(sets, scale, np.where(good, 1.0, -1.0))
    return {"weights": (w * scale).astype(np.float32), "scale": np.abs(scale).astype(np.float32), "bias": float(bias), "buckets": buckets}


def scored(texts: pa.Array, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Margin of each text, rounded to 6 digits, and whether it has any token (NULL texts have none)."""
    weights, scale, out, some = model["weights"], model["scale"], np.zeros(len(texts)), np.zeros(len(texts), bool)
    for a, b, rows, bucket in _indicators(texts, model["buckets"]):
        norm = np.sqrt(np.bincount(rows, scale[bucket].astype(np.float64) ** 2, b - a))
        out[a:b] = np.bincount(rows, weights[bucket].astype(np.float64), b - a) / np.maximum(norm, 1e-12) + model["bias"]
        some[a:b] = np.bincount(rows, minlength=b - a) > 0
    return np.round(out, 6) + 0.0, some


def classify(docs: DataFrame, model: dict, *, threshold: float = 0.1) -> DataFrame:
    """``doc_id, score, keep`` for every row; ``keep`` is ``score >= threshold``.

    NULL texts and texts without tokens have a NULL score and aren't kept.  Each row is
    scored on its own and its text as a whole: repeated rows and rows with a NULL ``doc_id``
    are like any other."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the corpus

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        score, some = scored(batch.column("text"), sent.value)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, mask=~some), pa.array((score >= threshold) & some)], ["doc_id", "score", "keep"])

    return documents(docs).mapInArrow(batches(one), "doc_id long, score double, keep boolean")


def keep_good(docs: DataFrame, model: dict, *, threshold: float = 0.1) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, with all their columns."""
    lean(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            score, some = scored(batch.column("text"), sent.value)
            yield batch.filter(pa.array((score >= threshold) & some))

    return docs.mapInArrow(run, docs.schema)
