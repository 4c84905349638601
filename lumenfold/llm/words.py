"""Vectorised word splitting and hashing over Arrow string buffers.

A *word* is a maximal run of bytes that are not separators.  Two separator
sets exist: ``SPACE`` (ASCII white space only, so punctuation belongs to the
word) and ``ALNUM`` (every ASCII byte that is not a letter or a digit
separates; all non-ASCII characters belong to words).

``hash64(word) = mix(sum(byte[k] * BASE**k) mod 2**64)``.  The sum is read off
one prefix sum over the buffer, so the cost is a few array operations per byte
and no Python work per word.  The same function can be written in SQL, see
:func:`hash_sql`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x5851F42D4C957F2D
MIX1 = 0x3F58476D1CE4E5B9
MIX2 = 0x14D049BB133111EB
_MASK = (1 << 64) - 1
_INV = pow(BASE, -1, 1 << 64)

#: True where a byte separates words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
ALNUM = np.ones(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = False
ALNUM[128:] = False

#: Texts are handled in groups of about this many bytes, to bound memory.
GROUP_BYTES = 1 << 20

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, GROUP_BYTES + (1 << 16))
        base = np.full(size, BASE, dtype=np.uint64)
        inverse = np.full(size, _INV, dtype=np.uint64)
        base[0] = inverse[0] = 1
        with np.errstate(over="ignore"):
            _powers, _inverse = np.multiply.accumulate(base), np.multiply.accumulate(inverse)
    return _powers, _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64, so that every bit depends on every byte."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX1)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX2)
        return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, int64 offsets (one more than rows) and validity of a string array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    valid = np.ones(n, dtype=bool) if texts.null_count == 0 else texts.is_valid().to_numpy(zero_copy_only=False)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1] if offsets is not None and offsets.size else np.zeros(n + 1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets, valid


def groups(offsets: np.ndarray, size: int = GROUP_BYTES, rows: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes and ``rows`` rows at most; a longer row is alone."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1
        b = min(n, a + rows, max(b, a + 1))
        yield a, b
        a = b


def _rows(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each start; both are in order."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (positions in ``data``) and row of all words of some rows."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    inside = np.zeros(hi - lo + 2, dtype=bool)
    inside[1:-1] = ~separators[data[lo:hi]]
    edge = inside[1:] != inside[:-1]
    # a word ends where its row ends
    cut = offsets[1:-1] - lo
    both = cut[inside[cut] & inside[cut + 1]] if len(cut) else cut
    at = np.flatnonzero(edge)
    if len(both):
        both = np.unique(both)
        at = np.sort(np.concatenate([at, both, both]), kind="stable")
    starts, ends = at[0::2] + lo, at[1::2] + lo
    return starts, ends, _rows(starts, offsets)


#: Byte classes for :func:`tokens`: 0 white space, 1 letters, digits and non-ASCII, 2 other.
CLASSES = np.where(SPACE, 0, np.where(ALNUM, 2, 1)).astype(np.uint8)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like :func:`spans`, but runs of letters and runs of punctuation are both tokens."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    kind = CLASSES[data[lo:hi]]
    new = np.ones(hi - lo + 1, dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=new[1:-1])
    new[offsets - lo] = True
    at = np.flatnonzero(new)
    real = kind[at[:-1]] > 0
    starts, ends = at[:-1][real] + lo, at[1:][real] + lo
    return starts, ends, _rows(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``hash64`` of the spans, which must be in order and must not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lo, hi = int(starts[0]), int(ends[-1])
    powers, inverse = _tables(hi - lo + 1)
    prefix = np.zeros(hi - lo + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(data[lo:hi] * powers[: hi - lo], out=prefix[1:])
        return mix((prefix[ends - lo] - prefix[starts - lo]) * inverse[starts - lo])


def words(texts: pa.Array, separators: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per group of rows: first row, end row, row of each word (from the first
    row), hash, start and end byte in its text.  Null texts have no words."""
    data, offsets, _ = buffers(texts)
    for a, b in groups(offsets):
        starts, ends, rows = spans(data, offsets[a : b + 1], separators)
        base = offsets[a + rows] if len(rows) else starts
        yield a, b, rows, hashes(data, starts, ends), starts - base, ends - base


def hash_one(word: bytes) -> int:
    """``hash64`` of one word, in plain Python (the definition)."""
    h, p = 0, 1
    for byte in word:
        h, p = (h + byte * p) & _MASK, p * BASE & _MASK
    h = ((h ^ h >> 30) * MIX1) & _MASK
    h = ((h ^ h >> 27) * MIX2) & _MASK
    return h ^ h >> 31


def combine(parts: list[np.ndarray], salt: int) -> np.ndarray:
    """Hash of a sequence of word hashes (an n-gram), aligned arrays."""
    with np.errstate(over="ignore"):
        h = np.full(len(parts[0]), salt, dtype=np.uint64)
        for x in parts:
            h = h * np.uint64(BASE) + x
    return mix(h)


def mix_sql(h: str) -> str:
    """DuckDB expression of :func:`mix` over a HUGEINT or UBIGINT below 2**64."""
    two64 = 1 << 64
    step = lambda x, s: f"xor(({x})::UBIGINT, (({x})::UBIGINT) >> {s})"
    a = f"((({step(h, 30)})::HUGEINT * {MIX1}::HUGEINT) % {two64}::HUGEINT)"
    b = f"((({step(a, 27)})::HUGEINT * {MIX2}::HUGEINT) % {two64}::HUGEINT)"
    return step(b, 31)


def hash_sql(word: str, first: int | None = None) -> str:
    """DuckDB expression of ``hash64`` over a VARCHAR expression, or over its ``first`` bytes."""
    two64 = 1 << 64
    byte = f"list_transform(range({first or f'octet_length(encode({word}))::BIGINT'}), lambda i: ('0x' || substr(hex(encode({word})), 2 * i + 1, 2))::INTEGER::HUGEINT)"
    horner = f"list_reduce(list_reverse({byte}), lambda h, b: (h * {BASE}::HUGEINT + b) % {two64}::HUGEINT)"
    return mix_sql(f"({horner})")


def combine_sql(parts: list[str], salt: int) -> str:
    """DuckDB expression of :func:`combine` over UBIGINT expressions."""
    two64, h = 1 << 64, f"{salt}::HUGEINT"
    for x in parts:
        h = f"(({h} * {BASE}::HUGEINT + ({x})::HUGEINT) % {two64}::HUGEINT)"
    return mix_sql(h)
