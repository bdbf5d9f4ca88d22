"""Counting 64-bit keys through a few large rows instead of one row per key.

Each task sorts and sums its keys, cuts them by the top bits of their hash and sends one row per
bucket. A bucket is an even share of the key space, a key comes once at most from each task, so no
frequent key makes a large group. The number of buckets follows the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .tokens import mix

SCHEMA = "bucket int, keys binary, counts binary"
LIMIT = 1 << 21


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of counts of each."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    if counts is None:
        keys = np.sort(keys)
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[at], np.diff(np.concatenate((at, [len(keys)])))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts[order].astype(np.int64), at)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    bits = buckets.bit_length() - 1
    return (mix(keys) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def cut(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts keys of one bucket together, smallest key first, and the bounds of each bucket."""
    b = bucket_of(keys, buckets)
    order = np.argsort(b, kind="stable")
    return order, np.searchsorted(b[order], np.arange(buckets + 1))


class Tally:
    """Sums keys in bounded memory and gives the rows to send."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.held = buckets, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(summed(keys))
        self.held += len(self.parts[-1][0])
        if self.held > LIMIT:
            self.squeeze()
            if self.held > LIMIT // 2:
                yield from self.rows()

    def squeeze(self) -> None:
        if self.parts:
            self.parts = [summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))]
            self.held = len(self.parts[0][0])

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.squeeze()
        if self.held:
            (keys, counts), = self.parts
            order, bound = cut(keys, self.buckets)
            keys, counts = keys[order], counts[order].astype(np.uint32)
            full = [b for b in range(self.buckets) if bound[b] < bound[b + 1]]
            yield pa.record_batch(
                [
                    pa.array(full, pa.int32()),
                    pa.array([shrink(keys[bound[b] : bound[b + 1]]) for b in full], pa.binary()),
                    pa.array([counts[bound[b] : bound[b + 1]].tobytes() for b in full], pa.binary()),
                ],
                names=["bucket", "keys", "counts"],
            )
        self.parts, self.held = [], 0


def shrink(keys: np.ndarray) -> bytes:
    """Ascending keys as their steps, in 4 bytes each where they fit."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return steps.astype(np.uint32).tobytes() if len(steps) and steps.max() < 1 << 32 else steps.tobytes()


def grow(raw: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(raw, dtype=np.uint32 if len(raw) == 4 * n else np.uint64)
    return np.cumsum(steps, dtype=np.uint64)


def pack(x: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs; the first byte says how many."""
    most = int(x.max()) if len(x) else 0
    size = next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k)
    return bytes([size]) + x.astype(f"u{size}").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"u{raw[0]}", offset=1)


def merged(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a bucket's rows with their sums."""
    keys, counts = [], []
    for k, c in zip(t.column("keys"), t.column("counts"), strict=True):
        c = np.frombuffer(c.as_buffer(), dtype=np.uint32)
        counts.append(c)
        keys.append(grow(k.as_py(), len(c)))
    return summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
