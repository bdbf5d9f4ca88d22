"""Tiles, hashes and features against plain loops; broken images give nulls."""

import hashlib
import io
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest

from bellwether.llm import media_tiles


def plain_resize(rows, height, width):
    """The mean of each cell's area by fractions of pixels."""
    tall, wide = len(rows), len(rows[0])
    out = []
    for y in range(height):
        line = []
        for x in range(width):
            y0, y1, x0, x1 = Fraction(y * tall, height), Fraction((y + 1) * tall, height), Fraction(x * wide, width), Fraction((x + 1) * wide, width)
            total = Fraction(0)
            for i in range(int(y0), min(tall, -(-y1.numerator // y1.denominator))):
                for j in range(int(x0), min(wide, -(-x1.numerator // x1.denominator))):
                    total += (min(y1, i + 1) - max(y0, i)) * (min(x1, j + 1) - max(x0, j)) * rows[i][j]
            line.append(total / ((y1 - y0) * (x1 - x0)))
        out.append(line)
    return out


def plain_hash(rows):
    small = plain_resize(rows, 8, 9)
    bits = "".join("1" if round(float(a), 6) > round(float(b), 6) else "0" for line in small for a, b in zip(line, line[1:], strict=False))
    return f"{int(bits, 2):016x}"


def plain_tile(rows, side, top):
    return np.array([[round(float(v) * 255 / top) for v in line] for line in plain_resize(rows, side, side)], dtype=np.uint8)


@pytest.mark.parametrize("top", [255, 100, 65535, 1000])
def test_tiles_and_hashes(top):
    rng = np.random.default_rng(top)
    px = rng.integers(0, top + 1, (11, 30))
    raw = b"P5 30 11 %d\n" % top + px.astype(">u2" if top > 255 else np.uint8).tobytes()
    image, said = media_tiles.decode_scaled(raw)
    assert said == top and (image == px).all()
    npy = np.load(io.BytesIO(media_tiles.tile(image, 6, top)))
    want = plain_tile(px.tolist(), 6, top)
    assert npy.dtype == np.uint8 and np.abs(npy.astype(int) - want).max() <= (0 if top == 255 else 1)
    assert media_tiles.difference_hash(image) == plain_hash(px.tolist())


def test_features_of_texts(spark):
    rows = [(1, "some text " * 300), (2, None), (3, "ä" * 700), (4, "")]
    got = {r["doc_id"]: r for r in media_tiles.text_media(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        raw = (t or "").encode()
        raw += b"\xff" * (-len(raw) % 576 or (576 if not raw else 0))
        px = [list(raw[i : i + 576]) for i in range(0, len(raw), 576)]
        out = io.BytesIO()
        np.save(out, plain_tile(px, 24, 255))
        assert np.load(io.BytesIO(bytes(got[k]["tile"]))).tolist() == plain_tile(px, 24, 255).tolist()
        assert got[k]["feature"] == f"{plain_hash(px)}-{zlib.crc32(out.getvalue()):08x}"
        media = b"P5\n576 %d\n255\n" % len(px) + raw
        assert (got[k]["media_bytes"], got[k]["media_sha256"], got[k]["height"]) == (len(media), hashlib.sha256(media).hexdigest(), len(px))


def bmp(width, height, bits, packing, data, extra=b""):
    start = 54 + len(extra)
    return b"BM" + struct.pack("<IIIIiiHHIIiiII", start + len(data), 0, start, 40, width, height, 1, bits, packing, len(data), 0, 0, 0, 0) + extra + data


def test_masks_of_a_bitmap():
    # red in the low byte, green of five bits, blue on top
    masks = struct.pack("<III", 0xFF, 0x1F00, 0xFF000000)
    data = struct.pack("<II", 200 | 31 << 8 | 7 << 24, 0 | 16 << 8 | 255 << 24)
    assert media_tiles.decode(bmp(2, 1, 32, 3, data, masks)).tolist() == [[[200, 255, 7], [0, 132, 255]]]


BROKEN = [b"", b"GIF89a", b"P5", b"P5 2 2 255\n\0", b"P3 1 1 255\n1 2 300", b"P2 1 1 255\n-4", b"P2 1 1 255\n" + b"9" * 40, b"P2 1 1 9\n10", b"P5 99999999999 9 255\n0", b"P5 " + b"9" * 5000 + b" 1 255\n",
          b"P5 4294967295 4294967295 255\n0", b"P1 9 9 1", b"P4 900000 90000\n0", b"P6 1 1 70000\n000", b"P5 1 1 0\n0", b"BM", b"BM" + b"\xff" * 60, bmp(2, 1, 24, 0, b""), bmp(2**30, 2**30, 24, 0, b"0" * 9),
          bmp(1, -(2**31), 32, 0, b"0" * 9), bmp(1, 1, 24, 3, b"0" * 9), bmp(1, 1, 32, 3, b"0000", b"\0" * 12), bmp(1, 1, 8, 0, b"\xff000", b"\0" * 8)]


def test_broken_images_give_nulls(spark):
    rows = [(k, 0, bytearray(x)) for k, x in enumerate(BROKEN)] + [(100, 0, None), (101, None, bytearray(b"P5 1 1 255\n\x07"))]
    got = {r["doc_id"]: r for r in media_tiles.features(spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")).collect()}
    assert len(got) == len(rows)
    for k, _, x in rows[:-1]:
        assert got[k]["payload_sha256"] is None and got[k]["feature"] is None and got[k]["tile"] is None and got[k]["media_bytes"] == len(x or b"")
    assert got[101]["payload_sha256"] == hashlib.sha256(b"\x07").hexdigest()
