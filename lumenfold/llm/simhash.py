"""SimHash fingerprints, and exact search for all of them within a Hamming radius.

A fingerprint has 64 bits.  Every distinct term of the lower-cased text votes on
each bit with weight ``1 + floor(log2(times))``; a bit is set where the votes are
positive.  Terms are words (:data:`words.ALNUM`) or, for the second fingerprint
that near-dedup checks, pairs of neighbouring words.

Search works by *mask tables*: two fingerprints meet in a table where they agree
on all bits of its mask.  :func:`block_masks` are the permuted blocks of the
classic scheme (any ``agree`` of ``blocks`` blocks); :func:`covering_masks` are
the structured masks of covering LSH.  Both guarantee that every pair within the
radius meets at least once, so the search is exact.

Fingerprints travel as packed binary blobs, one per table, sub-bucket and map
batch: 8 or 16 bytes an entry and no row overhead.  The number of sub-buckets
follows ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.llm import words as W
from lumenfold.llm.common import batches, checkpoint, documents, parts, split

BITS = 64
#: Bits of a word's hash that make its term.
TERM_BITS = 44
#: Nodes of a map task that are routed at a time.
FLUSH = 1 << 19


def votes(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each of ``n`` rows (< 2**20) from its terms' hashes, and whether it has any."""
    out, some = np.zeros(n, np.uint64), np.zeros(n, bool)
    if not len(hashes):
        return out, some
    key = np.sort(rows.astype(np.uint64) << np.uint64(TERM_BITS) | hashes >> np.uint64(64 - TERM_BITS))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    weight = (np.frexp(times)[1]).astype(np.uint8)  # 1 + floor(log2)
    row = (key >> np.uint64(TERM_BITS)).astype(np.int64)
    vote = W.mix(key & np.uint64((1 << TERM_BITS) - 1))
    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    at = row[start]
    for a in range(0, len(start), 256):
        lo, hi = start[a], start[a + 256] if a + 256 < len(start) else len(row)
        bits = np.unpackbits(vote[lo:hi].view(np.uint8).reshape(-1, 8), axis=1)
        bits *= weight[lo:hi, None]
        s = start[a : a + 256] - lo
        yes = np.add.reduceat(bits, s, axis=0, dtype=np.int32)
        total = np.add.reduceat(weight[lo:hi], s, dtype=np.int32)
        out[at[a : a + 256]] = np.packbits(2 * yes > total[:, None], axis=1).view(np.uint64)[:, 0]
    some[at] = True
    return out, some


def _fingerprints(texts: pa.Array, pairs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(texts)
    one, two, some = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
    for a, b, rows, hashes, _, _ in W.words(texts, W.ALNUM):
        one[a:b], some[a:b] = votes(hashes, rows, b - a)
        if pairs and len(rows):
            same = rows[1:] == rows[:-1]
            two[a:b], _ = votes(W.combine([hashes[:-1][same], hashes[1:][same]], 2), rows[:-1][same], b - a)
    return one, two, some


def sketches(docs: DataFrame, *, pairs: bool = False, tid: bool = False) -> DataFrame:
    """``doc_id, fp`` (and ``fp2`` over word pairs, ``tid``, a hash of the text); ``fp`` is NULL where a text is NULL or has no word."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp, fp2, some = _fingerprints(batch.column("text"), pairs)
        cols = [batch.column("doc_id"), pa.array(fp.view(np.int64), mask=~some)]
        cols += [pa.array(fp2.view(np.int64), mask=~some)] * pairs + ([batch.column("tid")] if tid else [])
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "fp"] + ["fp2"] * pairs + ["tid"] * tid)

    own = documents(docs)
    own = own.select("doc_id", F.lower("text").alias("text"), *[F.xxhash64("text").alias("tid")] * tid)
    return own.mapInArrow(batches(one), "doc_id long, fp long" + ", fp2 long" * pairs + ", tid long" * tid)


def block_masks(blocks: int, radius: int, bits: int = BITS) -> np.ndarray:
    """Masks of all choices of ``blocks - radius`` blocks: at most ``radius`` blocks differ within the radius."""
    edge = [i * bits // blocks for i in range(blocks + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edge, edge[1:])]
    return np.array([sum(c) for c in combinations(part, blocks - radius)], dtype=np.uint64)


def covering_masks(radius: int, bits: int = BITS, seed: int = 11) -> np.ndarray:
    """2**(radius+1) - 1 masks: bit i of mask v is the parity of code(i) & v.

    The codes of any ``radius`` bits span less than radius + 1 dimensions, so some
    non-zero v is orthogonal to all of them: its mask has none of these bits."""
    n = 1 << (radius + 1)
    rng = np.random.default_rng(seed)
    code = np.concatenate([rng.permutation(np.arange(1, n)) for _ in range(-(-bits // (n - 1)))])[:bits]
    return np.array([sum(1 << i for i in range(bits) if bin(int(code[i]) & v).count("1") & 1) for v in range(1, n)], dtype=np.uint64)


def _routed(masks: np.ndarray, sub: int, width: int):
    """mapInArrow function: fingerprints (``width`` long columns) to blobs by table and sub-bucket of the masked value."""

    def flush(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        t, s, blobs = [], [], []
        for k, mask in enumerate(masks):
            if sub == 1:
                t.append(k), s.append(0), blobs.append(x.tobytes())
            else:
                to = (W.mix(x[:, 0] & mask) % np.uint64(sub)).astype(np.int32)
                for g, at in split(np.argsort(to, kind="stable"), to):
                    t.append(k), s.append(g), blobs.append(x[at].tobytes())
            if sum(map(len, blobs[-1:])) * len(blobs) > 1 << 23 or len(blobs) > 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(s, pa.int32()), pa.array(blobs, pa.binary())], ["table", "sub", "blob"])
                t, s, blobs = [], [], []
        if t:
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(s, pa.int32()), pa.array(blobs, pa.binary())], ["table", "sub", "blob"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in it:
            held.append(np.stack([batch.column(i).to_numpy().view(np.uint64) for i in range(width)], axis=1))
            n += batch.num_rows
            if n >= FLUSH:
                yield from flush(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from flush(np.concatenate(held))

    return run


def _entries(blobs: pa.ChunkedArray, width: int, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a bucket sorted by masked value, and where a new value starts."""
    x = np.concatenate([np.frombuffer(b.as_buffer(), np.uint64) for b in blobs]).reshape(-1, width)
    key = x[:, 0] & mask
    order = np.argsort(key)
    key = key[order]
    return x[order], np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))


def lagged(cut: np.ndarray, most: int | None = None) -> Iterator[tuple[np.ndarray, int]]:
    """All pairs (i, i + lag) inside the runs that ``cut`` bounds, for the runs of at most ``most`` rows."""
    size = np.diff(cut)
    pick = size > 1 if most is None else (size > 1) & (size <= most)
    start, size = cut[:-1][pick], size[pick]
    if not len(size):
        return
    at = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    left = np.repeat(start + size, size) - at  # rows to the end of the run
    lag = 1
    while len(at := at[left > lag]):
        left = left[left > lag]
        yield at, lag
        lag += 1


def patterns(mask: np.uint64, radius: int) -> np.ndarray:
    """All differences of 1 to ``radius`` bits outside ``mask``."""
    free = [1 << b for b in range(BITS) if not int(mask) >> b & 1]
    return np.array([sum(c) for k in range(1, radius + 1) for c in combinations(free, k)], dtype=np.uint64)


def pairs_in(x: np.ndarray, cut: np.ndarray, mask: np.uint64, radius: int, long: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of distinct values within the radius inside the runs that ``cut`` bounds, in pieces.

    In runs of at most ``long`` values all pairs are compared.  In a longer one each value
    looks up all that differ from it in so many bits outside the mask, so that the cost of
    a run grows as its size, times a constant, and not as its square."""
    for at, lag in lagged(cut, long):
        near = at[np.bitwise_count(x[at] ^ x[at + lag]) <= radius]
        yield x[near], x[near + lag]
    size = np.diff(cut)
    for k in np.flatnonzero(size > long):
        run = np.sort(x[cut[k] : cut[k + 1]])
        for p in patterns(mask, radius):
            other = run ^ p
            up = np.flatnonzero(other > run)
            other = other[up]
            hit = run[np.minimum(np.searchsorted(run, other), len(run) - 1)] == other
            yield run[up[hit]], other[hit]


def links(fps: DataFrame, masks: np.ndarray, radius: int, long: int = 4096) -> DataFrame:
    """Rows ``fp, o, n`` about pairs of distinct fingerprints (column ``fp``) within the radius, each counted once.

    ``n`` sums up to the number of pairs that ``fp`` is in (``o`` is NULL there); rows with ``o``
    (and ``n`` 0) are edges that connect what the pairs connect.  No more than two rows per
    fingerprint and table, however many pairs there are."""
    spark = fps.sparkSession
    sub = -(-parts(spark, 4) // len(masks))

    def found(key: tuple, t: pa.Table) -> pa.Table:
        k = key[0].as_py()
        x, cut = _entries(t.column("blob"), 1, masks[k])
        x = x[:, 0]
        value = np.sort(x)
        count, a, b, held = np.zeros(len(x), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for p, q in pairs_in(x, cut, masks[k], radius, long):
            d = p ^ q
            new = np.ones(len(d), bool)  # the first of the tables in which they meet counts them
            for m in masks[:k]:
                new &= (d & m) != 0
            i, j = np.searchsorted(value, p[new]), np.searchsorted(value, q[new])
            np.add.at(count, i, 1)
            np.add.at(count, j, 1)
            a.append(i), b.append(j)
            held += len(i)
            if held > 1 << 20:
                i, j = _forest(np.concatenate(a), np.concatenate(b))
                a, b, held = [i], [j], 0
        i, j = _forest(np.concatenate(a), np.concatenate(b))
        some, signed = np.flatnonzero(count), value.view(np.int64)
        fp = np.concatenate([signed[some], signed[i]])
        o = pa.array(np.concatenate([signed[some], signed[j]]), mask=np.arange(len(fp)) < len(some))
        return pa.table({"fp": fp, "o": o, "n": np.concatenate([count[some], np.zeros(len(i), np.int64)])})

    routed = fps.select("fp").mapInArrow(_routed(masks, sub, 1), "table int, sub int, blob binary")
    return routed.groupBy("table", "sub").applyInArrow(found, "fp long, o long, n long")


def document_fingerprints(docs: DataFrame, *, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``doc_id, fingerprint, n_same, n_near, class_id``: a row per row of ``docs``.

    ``n_same`` counts the documents with this fingerprint, ``n_near`` the other
    fingerprints within ``radius``; ``class_id`` is the least fingerprint that it is
    connected to by such steps.  A NULL text or one without words has a NULL fingerprint
    and class, and 0 twice; rows with a NULL ``doc_id`` and repeated rows are treated like
    any other row.  Of very long texts all words vote."""
    own = checkpoint(sketches(docs))
    fps = own.where("fp IS NOT NULL").groupBy("fp").agg(F.count("*").alias("n_same"))
    found = checkpoint(links(fps, block_masks(blocks, radius), radius))
    near = found.where("o IS NULL").groupBy("fp").agg(F.sum("n").alias("n_near"))
    roots = components(found.where("o IS NOT NULL").select(F.col("fp").alias("u"), F.col("o").alias("v")))
    told = fps.join(near, "fp", "left").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    none = F.lit(0).cast("long")
    return own.join(told, "fp", "left").select("doc_id", F.col("fp").alias("fingerprint"), F.coalesce("n_same", none).alias("n_same"), F.coalesce("n_near", none).alias("n_near"), F.coalesce("root", "fp").alias("class_id"))


def _linked(x: np.ndarray, cut: np.ndarray, radius: int, radius2: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what near pairs connect: all pairs of short runs, a spanning forest of each long one."""
    a, b = [np.zeros(0, int)], [np.zeros(0, int)]
    one, two = np.ascontiguousarray(x[:, 0]), np.ascontiguousarray(x[:, 1])
    for at, lag in lagged(cut, 64):
        near = at[(np.bitwise_count(one[at] ^ one[at + lag]) <= radius)]
        near = near[np.bitwise_count(two[near] ^ two[near + lag]) <= radius2]
        a.append(near), b.append(near + lag)
    for lo, hi in zip(cut[:-1], cut[1:]):
        if hi - lo > 64:
            left = np.arange(lo, hi)
            while len(left):
                queue, left = [left[0]], left[1:]
                while queue and len(left):
                    i = queue.pop()
                    near = (np.bitwise_count(one[left] ^ one[i]) <= radius) & (np.bitwise_count(two[left] ^ two[i]) <= radius2)
                    got, left = left[near], left[~near]
                    queue += list(got)
                    a.append(np.full(len(got), i)), b.append(got)
    return np.concatenate(a), np.concatenate(b)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node but the root with the root (the least node) of its tree, for edges between ints."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    for p, q in zip(a.tolist(), b.tolist()):
        p, q = root(p), root(q)
        parent.setdefault(p, p), parent.setdefault(q, q)
        if p != q:
            parent[max(p, q)] = min(p, q)
    nodes = np.array([x for x in parent if root(x) != x], dtype=np.int64)
    return nodes, np.array([root(x) for x in nodes.tolist()], dtype=np.int64)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``u, v`` that isn't the least of its component (alternating large and small stars)."""
    edges = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        # large star: the neighbours above u go to the least of u and all its neighbours
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u").select(F.col("w").alias("u"), F.least("u", "m").alias("v")).distinct()
        # small star: u and its neighbours below go to the least of these
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        new = checkpoint(small)
        state = [e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for e in (edges, new)]
        edges = new
        if state[0] == state[1]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _groups(own: DataFrame, radius: int, radius2: int) -> DataFrame:
    """``doc_id, group_id`` for distinct ``doc_id`` (of any type with an order) with ``fp, fp2``; ``group_id`` is the least of the group."""
    masks = covering_masks(radius)
    nodes = own.groupBy("fp", "fp2").agg(F.min("doc_id").alias("rep"))
    sub = -(-parts(own.sparkSession, 16) // len(masks))  # small, even groups

    def found(key: tuple, t: pa.Table) -> pa.Table:
        x, cut = _entries(t.column("blob"), 2, masks[key[0].as_py()])
        a, b = _linked(x, cut, radius, radius2)
        u, v = _forest(a, b)
        s = x.view(np.int64)
        return pa.table({"fp": s[u, 0], "fp2": s[u, 1], "o": s[v, 0], "o2": s[v, 1]})

    routed = nodes.select("fp", "fp2").mapInArrow(_routed(masks, sub, 2), "table int, sub int, blob binary")
    links = routed.groupBy("table", "sub").applyInArrow(found, "fp long, fp2 long, o long, o2 long").distinct()
    links = links.join(nodes, ["fp", "fp2"]).select(F.col("o").alias("fp"), F.col("o2").alias("fp2"), F.col("rep").alias("u")).join(nodes, ["fp", "fp2"]).select("u", F.col("rep").alias("v"))
    roots = components(links)
    return own.join(nodes, ["fp", "fp2"]).join(roots, F.col("rep") == F.col("node"), "left").select("doc_id", F.coalesce("root", "rep").alias("group_id"))


def near_duplicates(docs: DataFrame, *, radius: int = 7, radius2: int = 14) -> DataFrame:
    """``doc_id, group_id, keep``: a row per distinct non-NULL ``doc_id``.

    Two documents are near copies where their word fingerprints differ in at most
    ``radius`` bits and their word-pair fingerprints in at most ``radius2``; groups
    are the components of this relation, ``group_id`` is the least ``doc_id`` of the
    group and the only one with ``keep``.  All texts that are empty or have no word
    form one group.  NULL texts are alone.  Repeated rows count once; of rows that
    share a ``doc_id`` but not a text, the one with the least fingerprint counts
    (:func:`near_copies` judges each)."""
    raw = documents(docs).where("doc_id IS NOT NULL")
    no_word = F.lit(0).cast("long")
    known = raw.where("text IS NOT NULL")
    own = sketches(known, pairs=True).select("doc_id", F.coalesce("fp", no_word).alias("fp"), F.coalesce("fp2", no_word).alias("fp2"))
    own = checkpoint(own.groupBy("doc_id").agg(F.min(F.struct("fp", "fp2")).alias("s")).select("doc_id", "s.fp", "s.fp2"))
    grouped = _groups(own, radius, radius2)
    alone = raw.where("text IS NULL").select("doc_id").distinct().join(own.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("group_id"))
    return grouped.union(alone).select("doc_id", "group_id", (F.col("doc_id") == F.col("group_id")).alias("keep"))


def near_copies(docs: DataFrame, *, radius: int = 7, radius2: int = 14) -> DataFrame:
    """``doc_id, tid, keep`` of each distinct ``doc_id`` and text (``tid`` is its ``xxhash64``) that isn't a single row and the one to keep of its group.

    Groups are those of :func:`near_duplicates`, each distinct pair judged on its own.
    The kept member of a group is the least ``(doc_id, tid)``, one whose ``doc_id`` has no
    other text first; it is only listed where several rows have it.  Rows with a NULL are
    passed over."""
    no_word = F.lit(0).cast("long")
    own = sketches(documents(docs).where("doc_id IS NOT NULL AND text IS NOT NULL"), pairs=True, tid=True)
    own = own.groupBy("doc_id", "tid").agg(F.min(F.struct(F.coalesce("fp", no_word).alias("fp"), F.coalesce("fp2", no_word).alias("fp2"))).alias("s"), F.count("*").alias("n"))
    shared = F.count("*").over(Window.partitionBy("doc_id")) > 1
    own = checkpoint(own.select(F.struct(shared.alias("shared"), "doc_id", "tid", (F.col("n") > 1).alias("many")).alias("doc_id"), "s.fp", "s.fp2"))
    keep = F.col("doc_id") == F.col("group_id")
    return _groups(own, radius, radius2).where(~keep | F.col("doc_id.many")).select("doc_id.doc_id", "doc_id.tid", keep.alias("keep"))
