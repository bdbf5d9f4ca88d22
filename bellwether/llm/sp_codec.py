"""SentencePiece models run by the tokenizers library.

``read_model`` parses the model's protobuf fields; ``build`` makes a tokenizer with the same pieces,
scores, metaspace marker and byte fallback. Both model kinds are rebuilt: unigram models from their
scores, pair-merge models by ranking the merges that the scores imply. ``Normaliser`` does what the model's own does: its character
map, squeezing of spaces, the marker for spaces and before or after the text.

If no piece has the marker after another character, no merge and no best path crosses such a place. If the normaliser then changes nothing but
spaces, raw texts are cut at spaces first, and equal raw stretches are encoded once in a batch, by the library's threads, several joined to one input.
The sentencepiece library gets the same raw stretches, before our normaliser has seen them; models of other kinds get whole raw texts on both sides.
``parity`` compares each text's ids with what that library gives, so a wrong normaliser, merge or score shows. (Of two ways to cut a text that score
exactly the same, a unigram model may take another one there; ``parity`` tells.)
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer, decoders, models

from .common import lean
from .survivors import column, free_name

MARK = "▁"
_SPACES = re.compile(" {2,}")
KNOWN = 400_000  # stretches that a worker remembers within a task
JOINED = 32  # stretches that make one input of the backend
NEW = 8192  # stretches encoded at once: each has an object in the backend
TEXTS = 1024  # texts encoded at once
#: Fixed values of the public model format: piece kinds and model kinds.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, PAIRS = 1, 2


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, raw[at : at + n]
            at += n


def read_model(raw: bytes) -> dict:
    """``pieces`` (text, score, kind) in the order of ids, and the trainer's and normaliser's settings that matter."""
    out: dict = {"pieces": [], "kind": UNIGRAM, "byte_fallback": False, "prefix": True, "squeeze": True, "escape": True, "map": b""}
    for field, value in _fields(raw):
        if field == 1:
            x = dict(_fields(value))
            out["pieces"].append((x.get(1, b"").decode(), struct.unpack("<f", x[2])[0] if 2 in x else 0.0, x.get(3, NORMAL)))
        elif field == 2:
            x = dict(_fields(value))
            out |= {"kind": x.get(3, UNIGRAM), "byte_fallback": bool(x.get(35, 0)), "unknown": x.get(40, 0), "suffix": bool(x.get(24, 0))}
        elif field == 3:
            x = dict(_fields(value))
            out |= {"map": x.get(2, b""), "prefix": bool(x.get(3, 1)), "squeeze": bool(x.get(4, 1)), "escape": bool(x.get(5, 1))}
    return out


class CharacterMap:
    """The model's character map: a double array of prefixes, then the texts that replace them, each closed by a zero byte."""

    def __init__(self, raw: bytes):
        size = int.from_bytes(raw[:4], "little")
        self.units = np.frombuffer(raw[4 : 4 + size], "<u4").tolist()
        self.texts = raw[4 + size :]

    def _longest(self, text: bytes, at: int) -> tuple[int, int]:
        """Length of the longest prefix of ``text[at:]`` that is mapped, and where its replacement begins."""
        units, found, length = self.units, -1, 0
        unit = units[0]
        node = unit >> 10 << (unit >> 6 & 8)
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= unit >> 10 << (unit >> 6 & 8)
            if unit >> 8 & 1:
                found, length = units[node] & 0x7FFFFFFF, k + 1 - at
        return length, found

    def __call__(self, text: str) -> str:
        raw, out, at, copied = text.encode(), [], 0, 0
        while at < len(raw):
            length, found = self._longest(raw, at)
            if length:
                out += [raw[copied:at], self.texts[found : self.texts.index(b"\0", found)]]
                at = copied = at + length
            else:
                b = raw[at]
                at += 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
        return b"".join([*out, raw[copied:]]).decode()


class Normaliser:
    """From a raw text to one with the marker for each space, as the model asks for."""

    def __init__(self, model: dict):
        self.prefix, self.squeeze, self.suffix = model["prefix"], model["squeeze"], model.get("suffix", False)
        self.characters = CharacterMap(model["map"]) if model["map"] else None

    def readable(self, text: str) -> str:
        """The text as decoding gives it back."""
        if self.characters is not None:
            text = self.characters(text)
        if self.squeeze:
            # at the end, the marker itself counts as a space too
            text = _SPACES.sub(" ", text).lstrip(" ").rstrip(" " + MARK)
        return text.replace(MARK, " ")

    def __call__(self, text: str) -> str:
        text = self.readable(text).replace(" ", MARK)
        if not text or not self.prefix:
            return text
        return text + MARK if self.suffix else MARK + text


def _unmatched(piece: str) -> str:
    """A name that no normalised text has in it, as it holds a space."""
    return f" {piece}"


def build(model: dict) -> Tokenizer:
    """A tokenizer for stretches of text that have the marker already. Pieces of other kinds than normal ones match no text."""
    if not model["escape"]:
        raise ValueError("models that do not escape spaces are not rebuilt")
    pieces = model["pieces"]
    if any(k == USER for *_, k in pieces):
        raise ValueError("models with user-defined pieces are not rebuilt")
    if model["kind"] == UNIGRAM:
        # bytes of unknown stretches are put in by the codec, so that byte pieces match no text
        core = models.Unigram([(p if k == NORMAL else _unmatched(p), s) for p, s, k in pieces], unk_id=model.get("unknown", 0), byte_fallback=False)
    elif model["kind"] == PAIRS:
        ids = {p: i for i, (p, _, k) in enumerate(pieces)}
        usable = {p for p, _, k in pieces if k == NORMAL}
        merges = []
        for i, (p, score, k) in enumerate(pieces):
            if k == NORMAL:
                merges += [(-score, i, ids[p[:j]], ids[p[j:]], p[:j], p[j:]) for j in range(1, len(p)) if p[:j] in usable and p[j:] in usable]
        core = models.BPE(ids, [(a, b) for *_, a, b in sorted(merges)], unk_token=pieces[model.get("unknown", 0)][0], fuse_unk=True, byte_fallback=model["byte_fallback"])
    else:
        raise ValueError("word and character models are not rebuilt")
    out = Tokenizer(core)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model["prefix"]:
        steps.append(decoders.Strip(" ", 0, 1) if model.get("suffix") else decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(steps)
    return out


def separable(model: dict) -> bool:
    """Whether no piece has the marker after another character."""
    return not model.get("suffix") and not any(MARK in p.lstrip(MARK) for p, _, k in model["pieces"] if k == NORMAL)


class _Ids:
    """Ids of the stretches seen so far, one after the other."""

    def __init__(self) -> None:
        self.begin = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def add(self, ids: list[list[int]]) -> None:
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(size.sum()))))

    def of(self, row: np.ndarray) -> np.ndarray:
        n = self.size[row]
        return self.flat[np.repeat(self.begin[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

    def keep(self, rows: np.ndarray) -> None:
        self.flat, self.size = self.of(rows), self.size[rows]
        self.begin = np.cumsum(self.size) - self.size


def raw_stretches(text: str, lead: str = "") -> list[str]:
    """The text cut at spaces: each stretch keeps all but one of the spaces before it (``lead`` stands for that one); those at the end stay with the last one."""
    parts = text.split(" ")
    if "" not in parts:
        return parts if not lead else [parts[0], *(lead + p for p in parts[1:])]
    out, run = [], 0
    for p in parts:
        if p:
            out.append((lead if out else "") + " " * run + p)
            run = 0
        else:
            run += 1
    if run:
        out[-1:] = [out[-1] + " " * run] if out else [text] if text else []
    return out


class Codec:
    """Encodes and decodes batches of whole texts."""

    def __init__(self, raw: bytes):
        self.model = read_model(raw)
        self.tokenizer = build(self.model)
        self.normal = Normaliser(self.model)
        # the normaliser works on each stretch as on the whole text
        self.apart = separable(self.model) and not self.model["map"] and not self.model["squeeze"]
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.unknown = self.model.get("unknown", 0)
        self.bytes = {p: i for i, (p, _, k) in enumerate(self.model["pieces"]) if k == BYTE}
        self.by_byte = self.model["kind"] == UNIGRAM and self.model["byte_fallback"]
        # what the backend's decoder reads for each id
        self.shown = ["" if k == CONTROL else " \u2047 " if k == UNKNOWN else p for p, _, k in self.model["pieces"]]
        self.opens = np.array([p.startswith(MARK) and k == NORMAL for p, _, k in self.model["pieces"]])
        self.forget()

    def stretches(self, text: str) -> list[str]:
        """The raw text in parts that are encoded apart."""
        if not self.apart:
            return [text] if text else []
        return raw_stretches(text, "" if self.model["prefix"] else " ") if text else []

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.own = _Ids()
        self.back, self.agrees, self.hits = np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, np.int64)
        self.last: tuple[list[str], list[np.ndarray]] | None = None

    def _forget_rare(self) -> None:
        """Keep the stretches that came again, at most half of ``KNOWN``."""
        least = 2
        while np.count_nonzero(self.hits >= least) > KNOWN // 2:
            least *= 2
        kept = np.flatnonzero(self.hits >= least)
        names = list(self.place)
        self.place = {names[k]: n for n, k in enumerate(kept.tolist())}
        self.own.keep(kept)
        self.back, self.agrees, self.hits = self.back[kept], self.agrees[kept], self.hits[kept] // 2

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text the numbers of its stretches. New stretches are encoded and compared once; rare ones are forgotten when ``KNOWN`` are held."""
        if self.last is not None and self.last[0] is texts:
            return self.last[1]
        if not self.apart:  # whole texts are not worth remembering
            self.forget()
        elif len(self.place) > KNOWN:
            self._forget_rare()
        place, old = self.place, len(self.place)
        # of the stretches of a batch, each is looked up once
        coded, sizes = self._coded(texts)
        number = np.fromiter((place.setdefault(s, len(place)) for s in coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
        out = np.split(number[coded.indices.to_numpy()] if len(coded) else number, np.cumsum(sizes)[:-1])
        fresh = list(islice(place, old, None)) if len(place) > old else []
        for k in range(0, len(fresh), NEW):
            ids, back, agrees = self._learn(fresh[k : k + NEW])
            self.own.add(ids)
            self.back, self.agrees = np.concatenate((self.back, back)), np.concatenate((self.agrees, agrees))
        self.hits = np.bincount(np.concatenate([*out, np.zeros(0, np.int64)]), minlength=len(place)) + np.pad(self.hits, (0, len(place) - len(self.hits)))
        self.last = texts, out
        return out

    def _coded(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The stretches of all texts, one text after the other, and how many each has."""
        column = pa.array(texts, pa.large_string())
        if self.apart and self.model["prefix"]:
            # with single spaces between words only, words are the stretches
            plain = pc.invert(pc.or_(pc.match_substring(column, "  "), pc.or_(pc.starts_with(column, " "), pc.ends_with(column, " "))))
            plain = np.asarray(pc.and_(plain, pc.not_equal(column, "")))
        else:
            plain = np.zeros(len(texts), bool)
        words = pc.split_pattern(column.filter(pa.array(plain)), " ")
        others = [self.stretches(texts[k]) for k in np.flatnonzero(~plain).tolist()]
        sizes = np.zeros(len(texts), np.int64)
        sizes[plain] = words.value_lengths().to_numpy()
        sizes[~plain] = [len(x) for x in others]
        both = pa.chunked_array([words.flatten(), pa.array(list(chain.from_iterable(others)), pa.large_string())])
        if others and plain.any():
            begin = np.empty(len(texts), np.int64)
            begin[plain] = np.cumsum(sizes[plain]) - sizes[plain]
            begin[~plain] = len(words.flatten()) + np.cumsum(sizes[~plain]) - sizes[~plain]
            both = both.take(pa.array(np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))))
        return both.combine_chunks().dictionary_encode(), sizes

    def _learn(self, raw: list[str]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
        """Of new stretches the ids, whether they decode to the stretch, and whether the sentencepiece library gives the same.

        ``JOINED`` stretches that have the marker in front only are one input of the backend, of its decoder and of the library; where the
        whole differs, or its pieces do not tell the stretches apart, each is taken by itself.
        """
        normal = [self.normal(s) for s in raw]
        ids: list[list[int]] = [[] for _ in raw]
        back, agrees = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        simple = [k for k, s in enumerate(normal) if s.rfind(MARK) == 0] if self.apart and self.model["prefix"] and not self.by_byte else []
        groups = [simple[k : k + JOINED] for k in range(0, len(simple), JOINED)]
        done = self.tokenizer.encode_batch_fast(["".join([normal[k] for k in g]) for g in groups], add_special_tokens=False)
        flat = [e.ids for e in done]
        texts = self._decoded(flat)
        library = self.plain.encode([" ".join([raw[k] for k in g]) for g in groups], num_threads=1)
        single = sorted(set(range(len(raw))).difference(simple))
        for g, found, text, theirs in zip(groups, flat, texts, library, strict=True):
            at = np.flatnonzero(self.opens[found]).tolist()
            if len(at) != len(g):
                single += g
                continue
            for k, x, y in zip(g, at, [*at[1:], len(found)], strict=True):
                ids[k] = found[x:y]
            back[g] = text == self._readable("".join([normal[k] for k in g]))
            agrees[g] = found == theirs
            single += [k for k in g if not (back[k] and agrees[k])]
        some = [normal[k] for k in single]
        done = self.tokenizer.encode_batch_fast(some, add_special_tokens=False) if not self.by_byte else self.tokenizer.encode_batch(some, add_special_tokens=False)
        alone = [self._bytes(e, s) for e, s in zip(done, some, strict=True)] if self.by_byte else [e.ids for e in done]
        for k, found, text, theirs in zip(single, alone, self._decoded(alone), self.plain.encode([raw[k] for k in single], num_threads=1), strict=True):
            ids[k], back[k], agrees[k] = found, text == self._readable(normal[k]), found == theirs
        return ids, back, agrees

    def _readable(self, normal: str) -> str:
        """What decoding should give for a normalised stretch."""
        if self.model["prefix"]:
            normal = normal.removesuffix(MARK) if self.normal.suffix else normal.removeprefix(MARK)
        return normal.replace(MARK, " ")

    def _bytes(self, encoding, stretch: str) -> list[int]:  # noqa: ANN001
        """The ids with the bytes of what is unknown."""
        if self.unknown not in encoding.ids:
            return encoding.ids
        out: list[int] = []
        for i, (a, b) in zip(encoding.ids, encoding.offsets, strict=True):
            out += [self.bytes[f"<0x{x:02X}>"] for x in stretch[a:b].encode()] if i == self.unknown else [i]
        return out

    def _decoded(self, ids: list[list[int]]) -> list[str]:
        """The texts of these ids, by the backend's decoder."""
        if self.model["kind"] == PAIRS:  # its pieces have their own names in the backend, which then decodes all at once
            return self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [self.tokenizer.decoder.decode([self.shown[i] for i in x]) for x in ids]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [self.own.of(r) for r in self.rows(texts)]

    def checks(self, texts: list[str], ids: list[np.ndarray]) -> list[tuple[bool, bool]]:
        """Of each text, whether its stretches decode to themselves, and whether ``ids`` are those that the sentencepiece library gives for its raw stretches."""
        return [(bool(self.back[r].all()), bool(self.agrees[r].all()) and np.array_equal(self.own.of(r), x)) for r, x in zip(self.rows(texts), ids, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decoder.decode([self.shown[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def codec(raw: bytes) -> Codec:
    return Codec(raw)


FIELDS = [
    StructField("ids", ArrayType(IntegerType())),
    StructField("n_pieces", IntegerType()),
    StructField("ids_crc32", LongType()),
    StructField("ids_sha256", StringType()),
    StructField("round_trip", BooleanType()),
    StructField("parity", BooleanType()),
]


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with the ids of each whole text and checks on them.

    ``round_trip``: decoding gives the normalised text back (a text with the marker itself gives spaces for it).
    ``parity``: equal to the sentencepiece library's ids for every raw stretch of every text. Null and empty texts have no ids. All rows and columns stay;
    columns of the result's names are replaced. ``model`` (about 0.5 MB) goes to the tasks with the code.
    """
    lean(docs.sparkSession)
    new = [f.name for f in FIELDS]
    kept = [c for c in docs.columns if c.lower() not in new]
    row, text = free_name(docs, "row"), free_name(docs, "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                texts = [t or "" for t in part.column(text).to_pylist()]
                rows = c.encode(texts)
                checks = []
                for ids, (back, parity) in zip(rows, c.checks(texts, rows), strict=True):
                    raw = ids.astype("<i4").tobytes()
                    checks.append((len(ids), zlib.crc32(raw), hashlib.sha256(raw).hexdigest(), back, parity))
                n, crc, sha, back, parity = zip(*checks, strict=True)
                offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows).astype(np.int32)))
                kinds = (pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
                yield pa.record_batch([part.column(row), ids, *(pa.array(x, k) for x, k in zip((n, crc, sha, back, parity), kinds, strict=True))], names=[row, *new])
        # the worker lives on after its task
        c.forget()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.struct(*map(column, kept)).alias(row), F.col("text").alias(text))
    return rows.mapInArrow(run, StructType([rows.schema[row], *FIELDS])).select(f"{row}.*", *new)


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids`` by the backend's decoder; null ids give null."""

    @F.pandas_udf("string")
    def back(ids):  # noqa: ANN001, ANN202
        c = codec(model)
        return ids.map(lambda x: None if x is None else c.decode(np.asarray(x)))

    return encoded.withColumn("decoded", back("ids"))
