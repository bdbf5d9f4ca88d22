"""Word hashes of whole Arrow text columns, without Python strings.

The words of a batch are found and hashed by array operations over its UTF-8 bytes, in blocks that
end between words, so memory stays bounded for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything but ASCII letters and the bytes of other scripts separates words.
NOT_LETTER = np.array([not (chr(b).isalpha() and b < 128) and b < 128 for b in range(256)])
SAME = np.arange(256, dtype=np.uint64)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint64)

_powers: dict[str, np.ndarray] = {}


def powers(n: int, which: str = "up") -> np.ndarray:
    """Powers 0..n-1 of the hash base (``up``) or of its inverse (``down``) modulo 2**64."""
    if which not in _powers or len(_powers[which]) < n:
        steps = np.full(max(n, BLOCK + 4096), _BASE if which == "up" else _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return _powers[which]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of text, so that arrays by word stay small; a longer text is a part."""
    if not batch.num_rows:
        return
    offsets, _ = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Words(NamedTuple):
    hashes: np.ndarray  # of each word, uint64
    first: np.ndarray  # of each text, the index of its first word; one more at the end
    begin: np.ndarray  # byte positions in data
    end: np.ndarray
    data: np.ndarray


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def words(column: pa.Array, fold: np.ndarray = SAME, apart: np.ndarray = SPACE) -> Words:
    """All words of all texts; a word is a run of bytes that are not in ``apart``."""
    if not len(column):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), np.zeros(1, np.int64), none, none, np.zeros(0, np.uint8))
    offsets, data = utf8(column)
    hashes, begins, ends = [], [], []
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        to = min(at + BLOCK, stop)
        if to < stop:
            edge = int(offsets[np.searchsorted(offsets, to)])
            step = 4096
            while to < edge:
                gap = np.flatnonzero(apart[data[to : min(to + step, edge)]])
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(to + step, edge)
        block = data[at:to]
        n = len(block)
        inside = ~apart[block]
        cut = np.zeros(n + 1, dtype=bool)
        cut[offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to, "right")] - at] = True
        cut[0] = cut[n] = True
        begin = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate(([False], inside[:-1]))))
        end = np.flatnonzero(inside & (cut[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((fold[block] + np.uint64(1)) * powers(n)[:n], out=total[1:])
        hashes.append(mix((total[end] - total[begin]) * powers(n, "down")[begin]))
        begins.append(begin + at)
        ends.append(end + at)
        at = to
    if not hashes:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none, data)
    begin = np.concatenate(begins)
    return Words(np.concatenate(hashes), np.searchsorted(begin, offsets), begin, np.concatenate(ends), data)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` hashes; position i covers i to i+width-1."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, size, run, left = None, 0, 1, h, width
    while left:
        factor = np.uint64(pow(_BASE, size, 1 << 64))
        if left & 1:
            piece = run[done : done + n]
            out = piece if out is None else out * factor + piece
            done += size
        left >>= 1
        if left:
            run = run[:-size] * factor + run[size:]
            size *= 2
    return mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
