"""A gated recurrent language model in numpy, trained on the whole corpus, that scores whole documents.

Words (runs of letters and digits, or of punctuation, in lower case) have ids by
their frequency in the corpus; rarer ones share ``RARE`` hashed ids, and a rare word
has the probability of its id times its share of all words counted under that id.  The
vocabulary grows with the corpus: it has every word that is counted ``COMMON`` times the
square root of the number of tokens, and the classes grow with it.  The output
softmax is factored into classes of about equal summed square-root frequency.

Documents run side by side in *lanes*, one after the other in a lane; the state is
set to zero where a document begins and carried from window to window inside it, in
training and in scoring, however long the document is.  Training is truncated
backpropagation through one window; Adam takes a step when ``STEP`` tokens have
been seen since the last one.  It goes over all documents once, in rounds: in each, every
partition starts from the common parameters and trains on its share, and the results
are averaged by tokens.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm import words as W
from lumenfold.llm.common import checkpoint, documents, parts, split

RARE = 64
#: A word has an id of its own where its count is at least so many square roots of the number of tokens (or it is one of the ``words`` most frequent).
COMMON = 0.5
WINDOW = 32
LANES = 512
#: Tokens of an Adam step, at least: windows in which few lanes are left add their gradients up.
STEP = 2048
#: Tokens that are trained on or scored together, at least: Arrow batches are gathered up to here, so that their size doesn't matter much.
GATHER = 1 << 22
#: Floats of a parameter block, and partial averages that are averaged at a time.
BLOCK, FAN = 4096, 256
#: Largest output weight; a sum of ``hidden`` + 1 of them stays under 80.
BOUND = 80.0

OUT = ("wc", "bc", "wo", "bo")
Params = dict[str, np.ndarray]


class Vocabulary:
    """Ids of words: frequent ones by hash, ``RARE`` ids for the others; the last id begins a document."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, rare: np.ndarray, classes: int) -> None:
        self.size = len(hashes) + RARE
        self.begin = self.size
        order = np.argsort(hashes)
        self.sorted, self.order = hashes[order], order.astype(np.int32)
        # most words are told by one look into a table: by the low bits, the last word that has them or -1
        self.slots = np.full(max(1 << 16, 1 << (16 * len(hashes)).bit_length()), -1, np.int32)
        self.slots[self._slot(self.sorted)] = np.arange(len(hashes), dtype=np.int32)
        weight = np.sqrt(np.concatenate([counts, rare]) + 1.0)
        # frequent first, classes of about equal weight; a class is a range of places
        self.place_of = np.empty(self.size, np.int32)
        by = np.lexsort((np.arange(self.size), -weight))
        self.place_of[by] = np.arange(self.size)
        share = np.cumsum(weight[by]) - weight[by]
        in_class = np.minimum((share / weight.sum() * classes).astype(np.int64), classes - 1)
        in_class = np.unique(in_class, return_inverse=True)[1]
        self.class_of = in_class.astype(np.int16)  # by place
        self.cut = np.searchsorted(in_class, np.arange(in_class[-1] + 2))
        self.rare = rare  # words counted under each rare id
        self.is_rare = np.zeros(self.size, bool)
        self.is_rare[self.place_of[len(hashes) :]] = True
        self.dtype = np.int16 if self.size < 1 << 15 else np.int32
        self.classes = int(in_class[-1]) + 1

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.slots) - 1)).astype(np.intp)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Places (ids in order of frequency) of words."""
        rare = len(self.sorted) + (hashes % np.uint64(RARE)).astype(np.int32)
        if not len(self.sorted):
            return self.place_of[rare]
        at = self.slots[self._slot(hashes)]
        other = np.flatnonzero((self.sorted[at] != hashes) & (at >= 0))  # another word's slot
        at[other] = np.minimum(np.searchsorted(self.sorted, hashes[other]), len(self.sorted) - 1)
        return self.place_of[np.where((at >= 0) & (self.sorted[at] == hashes), self.order[at], rare)]


def initial(size: int, classes: int, hidden: int, seed: int = 5) -> Params:
    rng = np.random.default_rng(seed)
    shape = {"e": (size + 1, hidden), "wx": (hidden, 3 * hidden), "wh": (hidden, 3 * hidden), "b": (3 * hidden,), "wc": (hidden, classes), "bc": (classes,), "wo": (size, hidden), "bo": (size,)}
    scale = {"e": 0.3, "wx": hidden**-0.5, "wh": hidden**-0.5, "wc": 0.1, "wo": 0.1}
    return {k: (rng.standard_normal(s) * scale.get(k, 0.0)).astype(np.float32) for k, s in shape.items()}


def lanes(sizes: np.ndarray, most: int = LANES) -> tuple[list[list[int]], np.ndarray]:
    """Documents of each lane, longest lane first, and the lanes' lengths."""
    n = max(1, min(most, int((sizes > 0).sum())))
    heap = [(0, k) for k in range(n)]
    held: list[list[int]] = [[] for _ in range(n)]
    for d in np.argsort(-sizes, kind="stable"):
        if sizes[d]:
            total, k = heapq.heappop(heap)
            held[k].append(int(d))
            heapq.heappush(heap, (total + int(sizes[d]), k))
    total = np.array([int(sizes[h].sum()) if h else 0 for h in held])
    order = np.argsort(-total, kind="stable")
    return [held[k] for k in order], total[order]


def windows(tokens: np.ndarray, sizes: np.ndarray, begin: int, most: int = LANES) -> Iterator[tuple[np.ndarray, ...]]:
    """Per window: inputs, targets, document starts and documents as (steps, lanes) arrays, and the mask of real steps.

    Lanes end one after the other, so later windows have fewer columns."""
    bound = np.concatenate([[0], np.cumsum(sizes)])
    held, length = lanes(sizes, most)
    base = np.concatenate([[0], np.cumsum(length)])
    docs = np.array([d for h in held for d in h], np.int64)
    doc = np.repeat(docs, sizes[docs])
    at = np.repeat(bound[docs] - np.cumsum(sizes[docs]) + sizes[docs], sizes[docs]) + np.arange(len(doc))
    target = tokens[at]
    first = at == bound[doc]
    source = np.where(first, begin, target[np.arange(-1, len(target) - 1)]) if len(target) else target
    for lo in range(0, int(length[0]) if len(length) else 0, WINDOW):
        k = int(np.searchsorted(-length, -lo, side="left"))
        steps = lo + np.arange(WINDOW)[:, None]
        real = steps < length[:k]
        place = np.minimum(base[:k] + steps, len(target) - 1)
        yield source[place], target[place], first[place], doc[place], real


def forward(p: Params, table: np.ndarray, x: np.ndarray, first: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States after all steps of a window, as (steps, units, lanes), and their gates and the state before the window; ``table`` is ``e @ wx + b``."""
    steps, k = x.shape
    n = h.shape[0]
    out, gates = np.empty((steps, n, k), h.dtype), np.ascontiguousarray(table[x].transpose(0, 2, 1))
    wh, begin, begins = np.ascontiguousarray(p["wh"].T), h, first.any(axis=1)
    for t in range(steps):
        if begins[t]:
            h = h * ~first[t]
        g, hh = gates[t], wh @ h
        zr, c = g[: 2 * n], g[2 * n :]
        zr += hh[: 2 * n]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        hn = hh[2 * n :]
        hn *= zr[n:]
        c += hn
        np.tanh(c, out=c)
        new = np.subtract(h, c, out=out[t])
        new *= zr[:n]
        new += c
        h = new
    return out, gates, begin


def _states(out: np.ndarray, real: np.ndarray) -> np.ndarray:
    """States of the real steps of a window, a row each."""
    by_step = out.transpose(0, 2, 1)
    return by_step.reshape(-1, out.shape[1]) if real.all() else by_step[real]


def _picked(x: np.ndarray, pick: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-softmax of ``x`` at ``pick``, and the exponentials (in place of ``x``) with their sums.

    Without a shift: states are within 1 and weights within ``BOUND``, so that float32 holds the exponentials."""
    at = x[pick]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return at - np.log(total), x, total


def output(p: Params, v: Vocabulary, h: np.ndarray, target: np.ndarray, grad: Params | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-probability of each target after each state; with ``grad``, adds the loss's gradients and returns that of the states."""
    n = len(target)
    cls = v.class_of[target]
    order = np.argsort(cls, kind="stable")
    h, target, cls = h[order], target[order], cls[order]
    x = h @ p["wc"]
    x += p["bc"]
    pick = (np.arange(n), cls)
    score, d, total = _picked(x, pick)
    dh = None
    if grad is not None:
        d /= total[:, None]
        d[pick] -= 1
        dh = d @ p["wc"].T
        grad["wc"] += h.T @ d
        grad["bc"] += d.sum(axis=0)
    cut = np.searchsorted(cls, np.arange(v.classes + 1))
    for c in np.flatnonzero(np.diff(cut)):
        a, b, lo, hi = cut[c], cut[c + 1], v.cut[c], v.cut[c + 1]
        if hi - lo == 1:
            continue
        x = h[a:b] @ p["wo"][lo:hi].T
        x += p["bo"][lo:hi]
        pick = (np.arange(b - a), target[a:b] - lo)
        log, d, total = _picked(x, pick)
        score[a:b] += log
        if grad is not None:
            d /= total[:, None]
            d[pick] -= 1
            dh[a:b] += d @ p["wo"][lo:hi]
            grad["wo"][lo:hi] += d.T @ h[a:b]
            grad["bo"][lo:hi] += d.sum(axis=0)
    back = np.empty(n, np.float32)
    back[order] = score
    if dh is not None:
        dh[order] = dh.copy()
    return back, dh


def backward(p: Params, x: np.ndarray, first: np.ndarray, run: tuple[np.ndarray, np.ndarray, np.ndarray], dh_out: np.ndarray, grad: Params) -> None:
    """Adds the gradients through one window; ``run`` is what :func:`forward` gave, ``dh_out`` the gradient of its states."""
    out, gates, begin = run
    steps, n, k = out.shape
    z, r, c = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
    before = np.concatenate([begin[None], out[:-1]])
    begins = first.any(axis=1)
    for t in np.flatnonzero(begins):
        before[t] *= ~first[t]
    to_c = (1 - z) * (1 - c * c)
    to_z = (before - c) * (z * (1 - z))
    to_r = np.matmul(np.ascontiguousarray(p["wh"][:, 2 * n :].T), before)
    to_r *= r * (1 - r)
    dg, dc, dh = np.empty((steps, 3 * n, k), out.dtype), np.empty((steps, n, k), out.dtype), np.zeros((n, k), out.dtype)
    for t in range(steps - 1, -1, -1):
        dh += dh_out[t]
        g, da = dg[t], np.multiply(dh, to_c[t], out=dc[t])
        np.multiply(dh, to_z[t], out=g[:n])
        np.multiply(da, to_r[t], out=g[n : 2 * n])
        np.multiply(da, r[t], out=g[2 * n :])
        dh *= z[t]
        dh += p["wh"] @ g
        if begins[t]:
            dh *= ~first[t]
    grad["wh"] += np.matmul(before, dg.transpose(0, 2, 1)).sum(axis=0)
    dg[:, 2 * n :] = dc
    flat, ids = dg.transpose(0, 2, 1).reshape(-1, 3 * n), x.reshape(-1)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    per_id, seen = np.add.reduceat(flat[order], start, axis=0), ids[start]
    grad["wx"] += p["e"][seen].T @ per_id
    grad["b"] += per_id.sum(axis=0)
    grad["e"][seen] += per_id @ p["wx"].T


class Trainer:
    """Trains ``p`` in place on documents that come batch by batch, once each.

    What a lane has left when a batch runs out stays, with its state, and the documents
    of the next batch join the shortest lanes; so one very long document only holds its
    own lane up."""

    def __init__(self, p: Params, v: Vocabulary, *, lanes: int = LANES, step: int = STEP, rate: float = 0.01) -> None:
        self.p, self.v, self.most, self.least, self.rate = p, v, lanes, step, rate
        self.hidden = p["wh"].shape[0]
        self.left: list[list[np.ndarray]] = []  # of each lane, what is left of documents; negative ids begin one
        self.state = np.zeros((self.hidden, 0), p["wh"].dtype)
        self.before = np.zeros(0, np.int64)  # last token of each lane
        self.grad = {k: np.zeros_like(a) for k, a in p.items()}
        self.adam: Params = {f"{m}{k}": np.zeros_like(a) for k, a in p.items() for m in "ms"}
        self.waiting: list[tuple] = []  # windows whose states have no outputs yet
        self.steps = self.seen = self.tokens = 0
        self.loss = 0.0
        self.table = p["e"] @ p["wx"] + p["b"]

    def feed(self, tokens: np.ndarray, sizes: np.ndarray) -> None:
        """Trains on these documents, but for what is left when less than half of the lanes have any."""
        if not len(tokens):
            return
        start = np.cumsum(sizes) - sizes
        more = min(self.most, len(self.left) + int((sizes > 0).sum())) - len(self.left)
        self.left += [[] for _ in range(more)]
        self.state = np.concatenate([self.state, np.zeros((self.hidden, more), self.state.dtype)], axis=1)
        self.before = np.concatenate([self.before, np.zeros(more, np.int64)])
        heap = [(sum(map(len, x)), k) for k, x in enumerate(self.left)]
        heapq.heapify(heap)
        for d in np.argsort(-sizes, kind="stable"):
            if sizes[d]:
                n, k = heap[0]
                doc = tokens[start[d] : start[d] + sizes[d]].astype(self.v.dtype)
                doc[0] = ~doc[0]
                self.left[k].append(doc)
                heapq.heapreplace(heap, (n + int(sizes[d]), k))
        self._run(len(self.left) // 2)

    def finish(self) -> Params:
        """Trains on all that is left."""
        self._run(0)
        self._step()
        return self.p

    def _run(self, least: int) -> None:
        length = np.array([sum(map(len, x)) for x in self.left], np.int64)
        order = np.argsort(-length, kind="stable")
        lane, length, state, before = [self.left[k] for k in order], length[order], self.state[:, order], self.before[order]
        marked = np.concatenate([y for x in lane for y in x] or [np.zeros(0, self.v.dtype)])
        first = marked < 0
        target = np.where(first, ~marked, marked)
        base = np.cumsum(length) - length
        source = np.empty_like(target)
        source[1:] = target[:-1]
        some = length > 0
        source[base[some]] = before[some]
        source[first] = self.v.begin
        lo = 0
        while (k := int(np.searchsorted(-length, -lo, side="left"))) > least:
            steps = lo + np.arange(WINDOW)[:, None]
            place = np.minimum(base[:k] + steps, len(target) - 1)
            state[:, :k] = self._window(source[place], target[place], first[place], steps < length[:k], state[:, :k])
            lo += WINDOW
        for i in range(len(lane)):
            if length[i] > lo:
                before[i] = target[base[i] + lo - 1] if lo else before[i]
                lane[i] = [marked[base[i] + lo : base[i] + length[i]]]
            else:
                lane[i] = []
        self.left, self.state, self.before = lane, state, before

    def _window(self, x: np.ndarray, target: np.ndarray, first: np.ndarray, real: np.ndarray, state: np.ndarray) -> np.ndarray:
        run = forward(self.p, self.table, x, first, state.copy())
        self.waiting.append((x, first, real, target[real], run))
        self.seen += len(self.waiting[-1][3])
        if self.seen >= self.least:
            self._step()
        return run[0][-1]

    def _step(self) -> None:
        if not self.seen:
            return
        log, d = output(self.p, self.v, np.concatenate([_states(run[0], real) for _, _, real, _, run in self.waiting]), np.concatenate([w[3] for w in self.waiting]), self.grad)
        self.loss -= float(log.sum(dtype=np.float64))
        at = 0
        for x, first, real, target, run in self.waiting:
            if len(target) == x.size:
                dh = d[at : at + len(target)].reshape(*x.shape, self.hidden)
            else:
                dh = np.zeros((*x.shape, self.hidden), d.dtype)
                dh[real] = d[at : at + len(target)]
            backward(self.p, x, first, run, np.ascontiguousarray(dh.transpose(0, 2, 1)), self.grad)
            at += len(target)
        limit, scale = BOUND / (self.hidden + 1), 1.0 / self.seen
        self.steps += 1
        step = self.rate * min(1.0, self.seen / 1024) * np.sqrt(1 - 0.98**self.steps) / (1 - 0.9**self.steps)
        for k, g in self.grad.items():
            g *= g.dtype.type(scale)
            m, s = self.adam["m" + k], self.adam["s" + k]
            m += 0.1 * (g - m)
            s += 0.02 * (g * g - s)
            self.p[k] -= g.dtype.type(step) * m / (np.sqrt(s) + 1e-6)
            if k in OUT:
                np.clip(self.p[k], -limit, limit, out=self.p[k])
            g[...] = 0
        self.tokens += self.seen
        self.seen, self.waiting = 0, []
        self.table = self.p["e"] @ self.p["wx"] + self.p["b"]


def score(p: Params, v: Vocabulary, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log-likelihood of each document, the state carried through all of its windows."""
    total, state, table = np.zeros(len(sizes)), np.zeros((p["wh"].shape[0], LANES), p["wh"].dtype), p["e"] @ p["wx"] + p["b"]
    waiting: list[tuple[np.ndarray, ...]] = []

    def add() -> None:
        h, target, doc = (np.concatenate(x) for x in zip(*waiting))
        total[:] += np.bincount(doc, output(p, v, h, target)[0], len(sizes))
        waiting.clear()

    for x, target, first, doc, real in windows(tokens, sizes, v.begin):
        out, _, _ = forward(p, table, x, first, state[:, : x.shape[1]])
        state = out[-1]
        waiting.append((_states(out, real), target[real], doc[real]))
        if sum(len(w[1]) for w in waiting) >= STEP:
            add()
    if waiting:
        add()
    return total


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the number of each text's."""
    data, offsets, _ = W.buffers(texts)
    hashes, sizes = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for a, b in W.groups(offsets):
        starts, ends, rows = W.tokens(data, offsets[a : b + 1])
        hashes.append(W.hashes(data, starts, ends))
        sizes[a:b] = np.bincount(rows, minlength=b - a)
    return np.concatenate(hashes), sizes


def _coded(texts: pa.Array, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    data, offsets, _ = W.buffers(texts)
    ids, sizes = [np.zeros(0, v.dtype)], np.zeros(len(texts), np.int64)
    for a, b in W.groups(offsets):
        starts, ends, rows = W.tokens(data, offsets[a : b + 1])
        ids.append(v.ids(W.hashes(data, starts, ends)).astype(v.dtype))
        sizes[a:b] = np.bincount(rows, minlength=b - a)
    return np.concatenate(ids), sizes


def _gathered(items: Iterable, size: Callable[[Any], int]) -> Iterator[list]:
    """Items in lists of at least ``GATHER`` tokens."""
    held, n = [], 0
    for x in items:
        held.append(x)
        n += size(x)
        if n >= GATHER:
            yield held
            held, n = [], 0
    if held:
        yield held


def _word_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        h, n = np.unique(_hashed(batch.column("text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])


def _rare_counts(hashes: np.ndarray):
    """mapInArrow function: the counts of the words that aren't among ``hashes``, summed by rare id."""
    known = np.sort(hashes)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARE, np.int64)
        for batch in it:
            h, n = batch.column("h").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            rare = ~np.isin(h, known)
            np.add.at(total, (h[rare] % np.uint64(RARE)).astype(np.int64), n[rare])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(RARE, dtype=np.int32)), pa.array(total)], ["id", "n"])

    return run


def vocabulary(docs: DataFrame, *, words: int = 1024, classes: int = 32) -> tuple[Vocabulary, DataFrame]:
    """From the counts of all words of all documents, and these counts (``h, n``).

    ``words`` and ``classes`` are the least of each; the driver gets the words of the
    vocabulary (at most 2 square roots of the number of tokens, or ``words``) and a row per rare id."""
    counts = checkpoint(docs.select("text").mapInArrow(_word_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    tokens = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.where(F.col("n") >= max(2, COMMON * tokens**0.5))
    few = counts.orderBy(F.desc("n"), "h").limit(words)
    top = common.union(few).distinct().orderBy(F.desc("n"), "h").toArrow()
    hashes, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    rare = np.zeros(RARE, np.int64)
    for row in counts.mapInArrow(_rare_counts(hashes), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        rare[row["id"]] = row["n"]
    return Vocabulary(hashes, n, rare, max(classes, int((len(hashes) + RARE) ** 0.5)) if len(hashes) > words else classes), counts


def _average(rows: DataFrame, partitions: int) -> DataFrame:
    """Averages weighted by ``w`` of parameter blocks, ``FAN`` at a time."""

    def mean(key: tuple, t: pa.Table) -> pa.Table:
        w = t.column("w").to_numpy()
        x = sum(float(a) / max(w.sum(), 1.0) * np.frombuffer(b, np.float32) for a, b in zip(w, t.column("x").to_pylist()))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "w": [float(w.sum())], "x": pa.array([np.asarray(x, np.float32).tobytes()], pa.binary())})

    while True:
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("block", "part").applyInArrow(mean, "block int, part int, w double, x binary")
        if partitions <= FAN:
            return rows
        partitions = -(-partitions // FAN)


def fit(docs: DataFrame, *, words: int = 1024, classes: int = 32, hidden: int = 16, rounds: int = 3, lanes: int = LANES, step: int = STEP) -> tuple[Params, Vocabulary, DataFrame]:
    """Parameters, vocabulary and counts of all words from all of ``docs`` (``doc_id, text``); round r trains on the documents whose hash is r.

    The hash is of ``doc_id`` and ``size``, or the length of ``text`` where there is no such column."""
    size = F.col("size") if "size" in docs.columns else F.length("text")
    spark = docs.sparkSession
    v, counts = vocabulary(docs, words=words, classes=classes)
    p = initial(v.size, v.classes, hidden)
    names, shapes = list(p), [a.shape for a in p.values()]
    edge = np.cumsum([0] + [a.size for a in p.values()])
    for r in range(rounds):
        sent = spark.sparkContext.broadcast((p, v))  # 140 bytes a word of the vocabulary

        def run(it: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            own, v = {k: a.copy() for k, a in sent.value[0].items()}, sent.value[1]
            trainer = Trainer(own, v, lanes=lanes, step=step)
            for held in _gathered((_coded(batch.column("text"), v) for batch in it), lambda x: len(x[0])):
                trainer.feed(*map(np.concatenate, zip(*held)))
            own, n = trainer.finish(), trainer.tokens
            if n:
                flat = np.concatenate([a.reshape(-1) for a in own.values()])
                blocks = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
                part = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array([float(n)] * len(blocks)), pa.array(blocks, pa.binary())], ["block", "part", "w", "x"])

        share = docs.where(F.pmod(F.hash("doc_id", size), F.lit(rounds)) == r).select("text")
        rows = _average(share.mapInArrow(run, "block int, part int, w double, x binary"), docs.rdd.getNumPartitions()).collect()
        if rows:
            flat = np.concatenate([np.frombuffer(x["x"], np.float32) for x in sorted(rows, key=lambda x: x["block"])])
            p = {k: flat[a:b].reshape(s).copy() for k, s, a, b in zip(names, shapes, edge, edge[1:])}
    return p, v, counts


_PARTS = "kind int, source long, shard int, x binary, y binary"
_BASE, _WORDS, _COUNTS = range(3)


def _part(kind: int, source: int, shards: list[int], x: list[bytes], y: list[bytes]) -> pa.RecordBatch:
    n = len(shards)
    cols = [pa.array([kind] * n, pa.int32()), pa.array([source] * n, pa.int64()), pa.array(shards, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, ["kind", "source", "shard", "x", "y"])


def _sharded(kind: int, source: int, shards: int, hashes: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    """Hashes and what belongs to them, a row per shard."""
    to = (hashes >> np.uint64(32)) % np.uint64(shards)
    to = to.astype(np.int16 if shards < 1 << 15 else np.int32)
    found = list(split(np.argsort(to, kind="stable"), to))
    return _part(kind, source, [g for g, _ in found], [hashes[at].tobytes() for _, at in found], [other[at].tobytes() for _, at in found])


def _shares(totals: np.ndarray):
    """applyInArrow function for a shard: per source the rows and the summed log-shares of their rare words; documents pass."""
    log_total = np.log(totals + 1.0)  # and one for all unknown words

    def run(key: tuple, t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        known = t.filter(pa.array(kind == _COUNTS))
        h = np.frombuffer(b"".join(known.column("x").to_pylist()), np.uint64)
        n = np.frombuffer(b"".join(known.column("y").to_pylist()), np.int64)
        order = np.argsort(h)
        h, log_n = h[order], np.log(n[order])
        words, out = t.filter(pa.array(kind == _WORDS)), [t.filter(pa.array(kind == _BASE))]
        for source, x, y in zip(words.column("source").to_pylist(), words.column("x"), words.column("y")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.int32)
            log = -log_total[(x % np.uint64(RARE)).astype(np.int64)]
            if len(h):
                at = np.minimum(np.searchsorted(h, x), len(h) - 1)
                log += np.where(h[at] == x, log_n[at], 0.0)
            first = np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]]))
            out.append(pa.Table.from_batches([_part(_WORDS, source, [-1], [y[first].tobytes()], [np.add.reduceat(log, first).tobytes()])]).cast(t.schema))
        return pa.concat_tables(out)

    return run


def _finished(key: tuple, t: pa.Table) -> pa.Table:
    """Documents of a source, with the log-shares of their rare words added in the order of the shards' first words."""
    found = sorted(zip(t.column("kind").to_pylist(), t.column("x").to_pylist(), t.column("y").to_pylist()))
    docs = pa.ipc.open_stream(found[0][1]).read_all()
    log = docs.column("log_likelihood").to_numpy(zero_copy_only=False).copy()
    for _, x, y in found[1:]:
        log[np.frombuffer(x, np.int32)] += np.frombuffer(y, np.float64)
    sizes = docs.column("n_tokens")
    null, n = sizes.is_null().to_numpy(), sizes.fill_null(0).to_numpy()
    return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": sizes, "log_likelihood": pa.array(log, mask=null), "per_token": pa.array(log / np.maximum(n, 1), mask=n == 0)})


def score_documents(docs: DataFrame, model: tuple[Params, Vocabulary, DataFrame]) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, per_token`` for every row of ``docs``.

    Natural logarithms, each text as a whole.  A rare word has the probability of its id
    times ``n / (total + 1)``, its count and that of its id in the corpus; all unknown
    words of an id share the one that is left.  Rare words meet their counts in a shuffle
    (12 bytes a word).  A text without tokens has log-likelihood 0 and a NULL ``per_token``; a NULL text has NULLs.
    Repeated rows and rows with a NULL ``doc_id`` are scored each."""
    p, v, counts = model
    sent = docs.sparkSession.sparkContext.broadcast((p, v))
    shards = parts(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        source = TaskContext.get().partitionId() << 32
        for held in _gathered(((*_hashed(b.column("text")), b.column("text").is_null().to_numpy(zero_copy_only=False), b.column("doc_id")) for b in it), lambda x: len(x[0])):
            p, v = sent.value
            hashes, sizes, null = (np.concatenate(x) for x in list(zip(*held))[:3])
            tokens = v.ids(hashes).astype(v.dtype)
            log = score(p, v, tokens, sizes)
            base = pa.RecordBatch.from_arrays([pa.concat_arrays([x[3] for x in held]), pa.array(sizes.astype(np.int32), mask=null), pa.array(log)], ["doc_id", "n_tokens", "log_likelihood"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, base.schema) as writer:
                writer.write_batch(base)
            yield _part(_BASE, source, [source % shards], [sink.getvalue().to_pybytes()], [b""])
            rare = np.flatnonzero(v.is_rare[tokens])
            if len(rare):
                yield _sharded(_WORDS, source, shards, hashes[rare], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[rare])
            source += 1

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                yield _sharded(_COUNTS, -1, shards, batch.column("h").to_numpy().view(np.uint64), batch.column("n").to_numpy())

    met = docs.select("doc_id", "text").mapInArrow(run, _PARTS).union(counts.mapInArrow(counted, _PARTS)).groupBy("shard").applyInArrow(_shares(v.rare), _PARTS)
    return met.groupBy("source").applyInArrow(_finished, "doc_id long, n_tokens int, log_likelihood double, per_token double")


def language_model_scores(docs: DataFrame, *, words: int = 1024, classes: int = 32, hidden: int = 16, rounds: int = 3) -> DataFrame:
    """Fits the model to all of ``docs`` and scores all of them, see :func:`score_documents`."""
    own = documents(docs)
    own = own.select("doc_id", F.lower("text").alias("text"), F.length("text").alias("size"))  # a round's filter needs no folded text
    return score_documents(own, fit(own, words=words, classes=classes, hidden=hidden, rounds=rounds))
