"""Size, rate and length of videos, from the headers of MP4 (ISO base media) and AVI files."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlparse

NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl"}
Probe = tuple[int | None, int | None, float, int]
UNKNOWN: Probe = (None, None, 30.0, 0)


def _boxes(f: BinaryIO, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Kind, first byte and end of the boxes from here to ``end``."""
    while f.tell() + 8 <= end:
        start = f.tell()
        size, kind = struct.unpack(">I4s", f.read(8))
        if size == 1:
            size = struct.unpack(">Q", f.read(8))[0]
        stop = end if size == 0 else start + size
        if stop <= start or stop > end:
            return
        yield kind, f.tell(), stop
        f.seek(stop)


def _track(f: BinaryIO, end: int, found: dict) -> None:
    for kind, start, stop in _boxes(f, end):
        if kind in NESTED:
            _track(f, stop, found)
        elif kind == b"tkhd":
            f.seek(stop - 8)
            found["size"] = tuple(x >> 16 for x in struct.unpack(">II", f.read(8)))
        elif kind == b"mdhd":
            wide = f.read(4)[0] == 1
            f.seek(start + (20 if wide else 12))
            found["scale"] = struct.unpack(">I", f.read(4))[0]
        elif kind == b"hdlr":
            f.seek(start + 8)
            found["kind"] = f.read(4)
        elif kind == b"stts":
            f.seek(start + 4)
            runs = struct.unpack(">I", f.read(4))[0]
            table = f.read(min(runs * 8, stop - start - 8))
            found["times"] = [struct.unpack_from(">II", table, k) for k in range(0, len(table) - 7, 8)]


def _mp4(f: BinaryIO, end: int) -> Probe:
    for kind, start, stop in _boxes(f, end):
        if kind == b"moov":
            f.seek(start)
            for inner, first, last in _boxes(f, stop):
                if inner == b"trak":
                    t: dict = {}
                    f.seek(first)
                    _track(f, last, t)
                    if t.get("kind") == b"vide":
                        n, ticks = (sum(x) for x in zip(*[(c, c * d) for c, d in t.get("times", [(0, 0)])]))
                        return (*t.get("size", (None, None)), n * t["scale"] / ticks if ticks and t.get("scale") else 30.0, n)
    return UNKNOWN


def _avi(f: BinaryIO) -> Probe:
    head = f.read(4096)
    at = head.find(b"avih")
    if at < 0 or len(head) < at + 48:
        return UNKNOWN
    micros, _, _, _, frames, _, _, _, width, height = struct.unpack_from("<10I", head, at + 8)
    return width, height, 1e6 / micros if micros else 30.0, frames


def probe(path: str) -> Probe:
    """Width, height, frames a second and frames of a file; :data:`UNKNOWN` where it is no such video."""
    try:
        with open(unquote(urlparse(path).path) if path.startswith("file:") else path, "rb") as f:
            start = f.read(12)
            f.seek(0, 2)
            end = f.tell()
            f.seek(0)
            return _avi(f) if start[:4] == b"RIFF" and start[8:] == b"AVI " else _mp4(f, end)
    except (OSError, struct.error, IndexError):
        return UNKNOWN
