"""Netpbm and BMP columns: decode to arrays, resize by area, difference hashes, NPY tiles.

Decoding, resizing and hashing work on one image at a time inside Arrow batches, so memory is that
of a batch. A broken image gives nulls, never an exception.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean

UNIT = 576


def decode(raw: bytes) -> np.ndarray:
    """The samples of a P1-P6 Netpbm (maxval to 65535) or an uncompressed 8-, 24- or 32-bit BMP, (height, width[, 3])."""
    return decode_scaled(raw)[0]


def decode_scaled(raw: bytes) -> tuple[np.ndarray, int]:
    """The samples and the value of full brightness. What is no such image, or shorter than it says, raises ValueError, IndexError or struct.error."""
    return (_bmp(raw), 255) if raw[:2] == b"BM" else _netpbm(raw)


def _netpbm(raw: bytes) -> tuple[np.ndarray, int]:
    kind = raw[:2]
    if len(raw) < 3 or kind[:1] != b"P" or kind[1:] not in b"123456":
        raise ValueError("not a Netpbm or BMP image")
    need, at, numbers = (2 if kind in (b"P1", b"P4") else 3), 2, []
    while len(numbers) < need:
        while raw[at : at + 1].isspace() or raw[at : at + 1] == b"#":
            at = (raw.index(b"\n", at) if raw[at : at + 1] == b"#" else at) + 1
        end = at
        while raw[end : end + 1].isdigit():
            end += 1
        if end - at > 10:
            raise ValueError("a number of the header is too large")
        numbers.append(int(raw[at:end]))
        at = end
    width, height, top = (*numbers, 1)[:3]
    bands = 3 if kind in (b"P3", b"P6") else 1
    n = width * height * bands
    if not n or not 0 < top < 65536 or n > 8 * len(raw):
        raise ValueError("empty or cut image, or bad maximum")
    if kind == b"P4":
        rows = np.frombuffer(raw, np.uint8, height * ((width + 7) // 8), at + 1).reshape(height, -1)
        flat = 1 - np.unpackbits(rows, axis=1)[:, :width].ravel()
    elif kind in (b"P5", b"P6"):
        flat = np.frombuffer(raw, ">u2" if top > 255 else np.uint8, n, at + 1)
    elif kind == b"P1":
        flat = 1 - np.array([c - 48 for c in raw[at:] if c in b"01"][:n], dtype=np.uint8)
    else:
        words = raw[at:].split()[:n]
        if any(len(x) > 10 or not x.isdigit() for x in words):
            raise ValueError("a sample is no number")
        values = np.array([int(x) for x in words], dtype=np.int64)
        flat = values.astype(np.uint16 if top > 255 else np.uint8)
        if (values != flat).any():
            raise ValueError("a sample is too large")
    if len(flat) and flat.max() > top:
        raise ValueError("a sample is above the maximum")
    return flat.reshape((height, width, 3) if bands == 3 else (height, width)), top


def _bmp(raw: bytes) -> np.ndarray:
    start, size, width, height, _, bits, packing = struct.unpack_from("<I I i i H H I", raw, 10)
    if bits not in (8, 24, 32) or packing not in (0, 3) or (packing == 3 and bits != 32) or width < 1 or not height:
        raise ValueError("this kind of BMP is not read")
    stride = (width * bits // 8 + 3) // 4 * 4
    if stride * abs(height) > len(raw) - start or start > len(raw):
        raise ValueError("cut image")
    rows = np.frombuffer(raw, np.uint8, stride * abs(height), start).reshape(abs(height), stride)
    rows = rows[::-1] if height > 0 else rows
    if bits == 8:
        used = struct.unpack_from("<I", raw, 46)[0] or 256
        colours = np.frombuffer(raw, np.uint8, 4 * min(used, 256), 14 + size).reshape(-1, 4)[:, 2::-1]
        out = colours[rows[:, :width]]
        return out[:, :, 0] if (colours[:, 0] == colours[:, 1]).all() and (colours[:, 1] == colours[:, 2]).all() else out
    if packing == 3:
        # each colour lies where its mask says, and fills its mask when at its brightest
        pixels = np.ascontiguousarray(rows[:, : width * 4]).view("<u4").astype(np.int64)
        masks = struct.unpack_from("<III", raw, 54)
        if not all(masks):
            raise ValueError("a colour has no mask")
        full = [m // (m & -m) for m in masks]
        return np.stack([(((pixels & m) // (m & -m)) * 255 + f // 2) // f for m, f in zip(masks, full, strict=True)], axis=2).astype(np.uint8)
    return rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1]


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area that each target cell covers, from an integral image interpolated at the cell edges."""
    image = image.astype(np.float64)
    total = np.zeros((image.shape[0] + 1, image.shape[1] + 1, *image.shape[2:]))
    np.cumsum(np.cumsum(image, axis=0), axis=1, out=total[1:, 1:])

    def edges(a: np.ndarray, n: int) -> np.ndarray:
        at = np.arange(n + 1) * (a.shape[0] - 1) / n
        low = np.minimum(at.astype(np.int64), a.shape[0] - 2)
        part = (at - low).reshape(-1, *[1] * (a.ndim - 1))
        return a[low] * (1 - part) + a[low + 1] * part

    cells = edges(np.swapaxes(edges(total, height), 0, 1), width).swapaxes(0, 1)
    sums = cells[1:, 1:] - cells[:-1, 1:] - cells[1:, :-1] + cells[:-1, :-1]
    return sums * (height * width / (image.shape[0] * image.shape[1]))


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each cell of an 8 x 9 reduction is brighter than the next one in its row."""
    small = np.round(resize(grey(image), 8, 9), 6)
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def tile(image: np.ndarray, side: int, top: int = 255) -> bytes:
    """The image reduced to ``side`` x ``side``, with ``top`` as 255, as the bytes of an NPY file of 8-bit samples."""
    out = io.BytesIO()
    scaled = resize(image, side, side) * (255 / top) if top != 255 else resize(image, side, side)
    np.save(out, np.ascontiguousarray(np.clip(np.rint(scaled), 0, 255), dtype=np.uint8), allow_pickle=False)
    return out.getvalue()


def as_pgm(text: Column, width: int = UNIT) -> Column:
    """A binary column: the UTF-8 bytes (null: none), padded with 255 to full rows, at least one, as a P5 image."""
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    rows = F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / width)).cast("int")
    pad = F.unhex(F.repeat(F.lit("FF"), (rows * width - F.octet_length(raw)).cast("int")))
    return F.concat(F.encode(F.concat(F.lit(f"P5\n{width} "), rows.cast("string"), F.lit("\n255\n")), "UTF-8"), raw, pad)


OUT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, height int, width int, tile binary"


def features(media: DataFrame, side: int = 24) -> DataFrame:
    """Of each row of ``media(doc_id, n_bytes, media)``: digests of the decoded samples, a difference hash and an NPY tile.

    Rows with a null or broken image have nulls in all that comes from the samples.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column("media"):
                raw = x.as_buffer().to_pybytes() if x.is_valid else b""
                try:
                    image, top = decode_scaled(raw)
                except (ValueError, IndexError, struct.error):
                    rows.append((None, None, None, len(raw), hashlib.sha256(raw).hexdigest(), None, None, None, None))
                    continue
                data = image.tobytes()
                npy = tile(image, side, top)
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), f"{difference_hash(image)}-{zlib.crc32(npy):08x}", *image.shape[:2], npy))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.record_batch([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[c.split()[0] for c in OUT.split(", ")])

    lean(media.sparkSession)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, OUT)


def text_media(docs: DataFrame, width: int = UNIT, side: int = 24) -> DataFrame:
    """Store every whole text as a grey image and read it back (``features``). Repeated rows stay; other columns go."""
    stored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).cast("long").alias("n_bytes"), as_pgm(F.col("text"), width).alias("media"))
    return features(stored, side)
