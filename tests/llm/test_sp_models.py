"""Models of both kinds, with and without byte fallback, a character map and squeezing, against the sentencepiece library."""

import random
import struct

import pytest
import sentencepiece

from bellwether.llm import queries, sp_codec

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789.,éüガ"
POOL = [*"abcxyz 019.,éüガｶﾞ①½﹏\u3000\t\n\u200bﬁÅ︙🙂<>_▁İß", "  ", "<s>", "<0x41>", "<unk>", "e\u0301", "가", "\r\n"]


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def field(n, v):
    if isinstance(v, bytes):
        return varint(n << 3 | 2) + varint(len(v)) + v
    if isinstance(v, float):
        return varint(n << 3 | 5) + struct.pack("<f", v)
    return varint(n << 3) + varint(v)


def model(pieces, kind, by_byte, character_map, prefix=True, squeeze=True):
    out = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, k)) for p, s, k in pieces)
    out += field(2, field(3, kind) + field(35, int(by_byte)) + field(40, 0) + field(41, 1) + field(42, 2) + field(43, 2**64 - 1))
    return out + field(3, (field(2, character_map) if character_map else b"") + field(3, int(prefix)) + field(4, int(squeeze)) + field(5, 1))


def nfkc():
    return sp_codec.read_model(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())["map"]


def unigram_pieces(rng, by_byte):
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + ([(f"<0x{b:02X}>", 0, 6) for b in range(256)] if by_byte else [])
    # no letter twice in a piece and every letter a piece: two ways to cut a text then never score the same
    words = {*"▁", *LETTERS, *(rng.choice(["", "▁"]) + "".join(rng.sample(LETTERS, rng.randint(2, 5))) for _ in range(400))}
    return pieces + [(w, -5 - 6 * rng.random(), 1) for w in sorted(words)]


def texts(rng, n):
    return ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "   ", "\u3000"]


def compare(raw, some):
    c = sp_codec.Codec(raw)
    for t, ids in zip(some, c.encode(some), strict=True):
        assert ids.tolist() == c.plain.encode(t), t
        assert c.decode(ids) == c.plain.decode(ids.tolist())
    return c


@pytest.mark.parametrize("by_byte", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
def test_unigram_models(by_byte, squeeze, prefix):
    rng = random.Random(by_byte + 2 * squeeze + 4 * prefix)
    some = texts(rng, 600)
    c = compare(model(unigram_pieces(rng, by_byte), sp_codec.UNIGRAM, by_byte, nfkc(), prefix, squeeze), some)
    assert all(parity for _, parity in c.checks(some, c.encode(some)))
    if by_byte:
        assert all(back for back, _ in c.checks(some, c.encode(some)))


@pytest.mark.parametrize("squeeze", [False, True])
def test_pair_models_with_a_character_map(squeeze):
    pieces = sp_codec.read_model(queries.model_bytes())["pieces"]
    compare(model(pieces, sp_codec.PAIRS, True, nfkc(), True, squeeze), texts(random.Random(7), 400))


def test_no_map_with_squeezing(spark):
    rng = random.Random(4)
    raw = model(unigram_pieces(rng, True), sp_codec.UNIGRAM, True, b"", True, True)
    some = texts(rng, 50)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(some)], "doc_id long, text string").selectExpr("*", "1 AS `x y`", "2 AS row", "named_struct('a-b', 3) AS raw")
    out = sp_codec.encode(docs, raw)
    rows = sp_codec.decode(out, raw).collect()
    assert out.columns[:5] == ["doc_id", "text", "x y", "row", "raw"] and all(r["parity"] and r["round_trip"] for r in rows)
    normal = sp_codec.Normaliser(sp_codec.read_model(raw))
    assert all(r["decoded"] == normal.readable(r["text"]) for r in rows)
