"""Byte-level BPE with a public vocabulary of ranks.

A word keeps one contiguous array of part ids and one of the ranks of neighbouring
parts: find the least rank (the first of equals), merge there, delete the boundary
and look the two neighbouring ranks up again, until no neighbours merge.  Words of
similar length do this side by side as rows of numpy matrices; words of more than
``LONG`` bytes use the same steps on a heap, which doesn't slow down with length.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lumenfold.llm import words as W
from lumenfold.llm.common import batches, documents

PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.iinfo(np.int32).max
#: Bytes of a word that is merged in a matrix at most.
LONG = 128
#: Words whose ids a worker remembers at most; it then starts anew.
CACHE = 400_000


class Vocabulary:
    """Ranks of a vocabulary file (``base64 rank`` lines), its mergeable pairs and its bytes."""

    def __init__(self, data: bytes) -> None:
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        size = max(self.rank.values()) + 1
        self.bytes = np.frombuffer(b"".join(b for b, _ in sorted(self.rank.items(), key=lambda x: x[1])), np.uint8)
        length = np.zeros(size, np.int64)
        for b, r in self.rank.items():
            length[r] = len(b)
        self.start = np.concatenate([[0], np.cumsum(length)])
        self.single = np.array([self.rank[bytes([i])] for i in range(256)], np.int32)
        pairs = [(x << 32 | y, r) for b, r in self.rank.items() for k in range(1, len(b)) if (x := self.rank.get(b[:k])) is not None and (y := self.rank.get(b[k:])) is not None]
        key, rank = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int32)
        order = np.argsort(key)
        self.key, self.value = key[order], rank[order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` where they don't merge."""
        want = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.value[at], NONE)

    def merge_long(self, word: bytes) -> list[int]:
        """Ids of one word, by heap and linked list."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.ranks(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        piece = lambda i: self.bytes[self.start[i] : self.start[i + 1]].tobytes()
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (new := self.rank.get(piece(ids[a]) + piece(ids[b]))) is not None:
                    heapq.heappush(heap, (new, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and the number of each word's."""
        size = np.array([len(w) for w in words], np.int64)
        out: list[np.ndarray | list[int]] = [[]] * len(words)
        step = [1, 2, 4, 6, 8, 12, 16, 24, 32, 64, LONG]
        for lo, hi in zip([0, *step], step):
            at = np.flatnonzero((size > lo) & (size <= hi))
            for a in range(0, len(at), 1 << 15):
                self._matrix(words, at[a : a + (1 << 15)], size, hi, out)
        for i in np.flatnonzero(size > LONG):
            out[i] = self.merge_long(words[i])
        count = np.array([len(x) for x in out], np.int64)
        return np.concatenate([np.asarray(x, np.int32) for x in out]) if len(out) else np.zeros(0, np.int32), count

    def _matrix(self, words: list[bytes], at: np.ndarray, size: np.ndarray, width: int, out: list) -> None:
        n = size[at].copy()
        raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in at), np.uint8).reshape(len(at), width)
        ids = self.single[raw]
        column = np.arange(width)
        rank = np.full((len(at), width), NONE, np.int32)  # of part k and k + 1
        if width > 1:
            rank[:, :-1] = np.where(column[1:] < n[:, None], self.ranks(ids[:, :-1], ids[:, 1:]), NONE)
        live = np.arange(len(at))
        while len(live):
            best = rank[live].argmin(axis=1)
            least = rank[live, best]
            some = least != NONE
            live, best, least = live[some], best[some], least[some]
            if not len(live):
                break
            move = np.minimum(column + (column > best[:, None]), width - 1)  # the boundary after ``best`` goes
            ids[live] = np.take_along_axis(ids[live], move, axis=1)
            shifted = np.take_along_axis(rank[live], np.minimum(column + (column >= best[:, None]), width - 1), axis=1)
            ids[live, best] = least
            n[live] -= 1
            last = n[live] - 1
            shifted[column >= last[:, None]] = NONE
            right = np.flatnonzero(best < last)
            shifted[right, best[right]] = self.ranks(ids[live[right], best[right]], ids[live[right], best[right] + 1])
            left = np.flatnonzero(best > 0)
            shifted[left, best[left] - 1] = self.ranks(ids[live[left], best[left] - 1], ids[live[left], best[left]])
            rank[live] = shifted
        for i, row, k in zip(at, ids, n):
            out[i] = row[:k]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of lists of ids (``offsets`` bounds them)."""
        size = self.start[ids + 1] - self.start[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.start[ids] - total[:-1], size) + np.arange(total[-1])
        data = self.bytes[source]
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(total[offsets]), pa.py_buffer(data)])


class Encoder:
    """Encodes texts; words that were met before are looked up."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN) -> None:
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their bounds."""
        if len(self.index) > CACHE:
            self.clear()
        pieces = [self.find(t) if t else [] for t in texts]
        index, new = self.index, []
        for p in set().union(*pieces):
            if p not in index:
                index[p] = len(index)
                new.append(p.encode())
        if new:
            ids, count = self.vocabulary.merge(new)
            self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        code = np.fromiter((index[p] for ps in pieces for p in ps), np.int64, sum(map(len, pieces)))
        start = np.cumsum(self.count) - self.count
        count = self.count[code]
        total = np.concatenate([[0], np.cumsum(count)])
        flat = self.ids[np.repeat(start[code] - total[:-1], count) + np.arange(total[-1])]
        bound = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        return flat, total[bound]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_encoders: dict[int, Encoder] = {}


def _encoder(data: bytes, pattern: str) -> Encoder:
    """One per worker process and vocabulary."""
    key = hash((data, pattern))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(data), pattern)
    return _encoders[key]


def encode_documents(docs: DataFrame, vocabulary: str, *, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, token_ids, n_tokens, round_trip`` for every row of ``docs``.

    ``vocabulary`` is the path of a rank file; its bytes (under 1 MB, whatever the
    corpus) are broadcast.  ``round_trip`` tells whether the decoded ids are the text.
    A NULL text has NULLs, an empty one no ids.  Repeated rows and rows with a NULL ``doc_id``
    are like any other; other columns are left out, whatever their names.  A text of any
    length is encoded as a whole: its cost grows with its length, a single word of any
    length too."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, pattern)
        for batch in it:
            texts = batch.column("text")
            _, offsets, _ = W.buffers(texts)
            for a, b in W.groups(offsets):
                part = texts.slice(a, b - a)
                ids, bound = encoder.encode(part.to_pylist())
                same = pc.equal(encoder.vocabulary.decode(ids, bound), part.cast(pa.large_string()).cast(pa.large_binary()))
                null = part.is_null().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(ids), mask=pa.array(null))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), lists, pa.array(np.diff(bound).astype(np.int32), mask=null), same], ["doc_id", "token_ids", "n_tokens", "round_trip"])

    return documents(docs).mapInArrow(run, "doc_id long, token_ids array<int>, n_tokens int, round_trip boolean")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, token_ids``; NULL ids give a NULL text, bytes that aren't UTF-8 are replaced by U+FFFD."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("token_ids")
        bound = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]).astype(np.int64)
        raw = _encoder(sent.value, PATTERN).vocabulary.decode(lists.flatten().to_numpy(), bound).to_pylist()
        ok = lists.is_valid().to_pylist()
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r.decode("utf-8", "replace") if v else None for r, v in zip(raw, ok)], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "token_ids").mapInArrow(batches(one), "doc_id long, text string")
