"""Format-preserving pseudonyms for personal data by a keyed Feistel network.

Validated numbers and dates (and the user part of mail addresses) are replaced by the value that a keyed
permutation of all values of the same format gives: a card number stays a card number of that length with
a right check digit, a date stays a date, an address keeps its domain's form. Equal values get equal
pseudonyms in every document, different ones different pseudonyms, and the key's owner can undo them.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import lean
from .survivors import column, free_name

ROUNDS = 10
USER = 64  # characters of a mail user that are permuted at once


def _round(key: bytes, tweak: str, size: int, k: int, half: int, modulus: int) -> int:
    """A keyed hash of one half, at least 64 bits longer than ``modulus``."""
    parts = (tweak.encode(), size.to_bytes(size.bit_length() // 8 + 1, "big"), bytes([k]), half.to_bytes(half.bit_length() // 8 + 1, "big"))
    text = b"".join(len(p).to_bytes(4, "big") + p for p in parts)
    need = modulus.bit_length() // 8 + 9
    raw = b"".join(hashlib.blake2b(n.to_bytes(4, "big") + text, key=key).digest() for n in range(-(-need // 64)))
    return int.from_bytes(raw[:need], "big") % modulus


def permute(value: int, size: int, key: bytes, tweak: str, undo: bool = False) -> int:
    """A keyed permutation of range(size): Feistel rounds over two near-equal digits, walked until inside."""
    if size < 2:
        return value
    left = math.isqrt(size - 1) + 1
    right = -(-size // left)
    while True:
        a, b = divmod(value, right)
        for k in reversed(range(ROUNDS)) if undo else range(ROUNDS):
            # rounds change the two halves in turn, each by a keyed hash of the other
            if k % 2 == 0:
                mixed = _round(key, tweak, size, k, b, left)
                a = (a - mixed if undo else a + mixed) % left
            else:
                mixed = _round(key, tweak, size, k, a, right)
                b = (b - mixed if undo else b + mixed) % right
        value = a * right + b
        if value < size:
            return value


def luhn(digits: str) -> int:
    """The check digit to append."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _digits(text: str, new: str) -> str:
    it = iter(new)
    return "".join(next(it) if c.isdigit() else c for c in text)


def _number(kind: str, body: str, key: bytes, undo: bool) -> str:
    return str(permute(int(body), 10 ** len(body), key, f"{kind}{len(body)}", undo)).zfill(len(body))


def card(text: str, key: bytes, undo: bool) -> str | None:
    """13 to 19 digits. Those with a right check digit stay right, the others stay wrong, so each kind is permuted in itself."""
    d = re.sub(r"\D", "", text)
    if not 13 <= len(d) <= 19:
        return None
    off = (int(d[-1]) - luhn(d[:-1])) % 10
    body = _number("card" if off == 0 else "long", d[:-1], key, undo)
    return _digits(text, body + str((luhn(body) + off) % 10))


def phone(text: str, key: bytes, undo: bool) -> str | None:
    """The digits after the country code, or after the leading 0 of a national number; 8 to 15 digits in all."""
    d = re.sub(r"\D", "", text)
    code = re.match(r"\+(\d{1,3})\D", text)
    lead = len(code[1]) if code else int(d[0] == "0")
    return _digits(text, d[:lead] + _number("phone", d[lead:], key, undo)) if 8 <= len(d) <= 15 else None


def ssn(text: str, key: bytes, undo: bool) -> str | None:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    sign = text[3]
    a, g, s = (int(x) for x in text.split(sign))
    if not (0 < a < 900 and a != 666 and g and s):
        return None
    n = permute(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, 898 * 99 * 9999, key, "ssn", undo)
    n, s = divmod(n, 9999)
    a, g = divmod(n, 99)
    return f"{a + 1 + (a >= 665):03d}{sign}{g + 1:02d}{sign}{s + 1:04d}"


def ipv4(text: str, key: bytes, undo: bool) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    n = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ipv4", undo)
    return ".".join(map(str, n.to_bytes(4, "big")))


def ipv6(text: str, key: bytes, undo: bool) -> str | None:
    """The written digits, in groups as they are; capital letters if the text has any. An address of no digits 0-9 stays."""
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    digits = text.replace(":", "")
    if text.count(":") < 2 or not re.search(r"\d", digits) or len(digits) < 4:
        return None
    shape = re.sub(r"[0-9A-Fa-f]", "x", text)
    new = ""
    while not re.search(r"\d", new):  # walked until it can be found again
        new = f"{permute(int(new or digits, 16), 16 ** len(digits), key, 'ipv6' + shape, undo):0{len(digits)}x}"
    it = iter(new.upper() if re.search("[A-F]", text) else new)
    return "".join(c if c == ":" else next(it) for c in text)


def iban(text: str, key: bytes, undo: bool) -> str | None:
    """Letters stay, digits of the account are permuted, the two check digits are made right again."""

    def rest(s: str) -> int:
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97

    flat = text.replace(" ", "")
    if not 15 <= len(flat) <= 34 or rest(flat) != 1:
        return None
    body = re.sub(r"\D", "", flat[4:])
    new = flat[:2] + "00" + _digits(flat[4:], _number("iban", body, key, undo))
    new = f"{new[:2]}{98 - rest(new):02d}{new[4:]}"
    it = iter(new)
    return "".join(c if c == " " else next(it) for c in text)


FIRST, LAST = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)


@lru_cache(maxsize=1)
def _late_days() -> tuple[list[int], dict[int, int]]:
    """The days of 1900-2099 after the 12th of a month, which no one can read with day and month exchanged; and their ranks."""
    days = [k for k in range((LAST - FIRST).days + 1) if (FIRST + datetime.timedelta(k)).day > 12]
    return days, {d: k for k, d in enumerate(days)}


def date(text: str, key: bytes, undo: bool) -> str | None:
    """A day of 1900-2099 as year-month-day, or day and month before the year; the order and the signs stay.

    Day and month before the year are read in this order if that is a date. If only the other order is one, it is a date
    after the 12th, and such dates are permuted among themselves.
    """
    parts, sign = re.split(r"\D", text), re.sub(r"\d", "", text)[0]
    front = len(parts[0]) == 4
    year, *rest = map(int, parts if front else (parts[2], parts[1], parts[0]))
    swapped = False
    try:
        try:
            day = datetime.date(year, *rest)
        except ValueError:
            if front:
                return None
            day, swapped = datetime.date(year, *reversed(rest)), True
    except ValueError:
        return None
    if not FIRST <= day <= LAST:
        return None
    at = (day - FIRST).days
    if swapped:
        days, rank = _late_days()
        at = days[permute(rank[at], len(days), key, "late", undo)]
    else:
        at = permute(at, (LAST - FIRST).days + 1, key, "date", undo)
    new = FIRST + datetime.timedelta(at)
    y, m, d = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
    return sign.join((y, m, d) if front else (m, d, y) if swapped else (d, m, y))


def _letters(user: str, key: bytes, tweak: str, undo: bool) -> str:
    """Each letter and digit among its own kind, by one permutation of them all."""
    sizes = [10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 1 for c in user]
    value, total = 0, 1
    for c, s in zip(user, sizes, strict=True):
        value = value * s + (int(c) if s == 10 else ord(c.lower()) - 97 if s == 26 else 0)
        total *= s
    # one permutation for each shape of user part
    shape = "".join("9" if s == 10 else ("A" if c.isupper() else "a") if s == 26 else c for c, s in zip(user, sizes, strict=True))
    value = permute(value, total, key, tweak + shape, undo)
    out = []
    for c, s in zip(reversed(user), reversed(sizes), strict=True):
        value, d = divmod(value, s)
        out.append(str(d) if s == 10 else chr((65 if c.isupper() else 97) + d) if s == 26 else c)
    return "".join(reversed(out))


def mail(text: str, key: bytes, undo: bool) -> str | None:
    """The user part, in stretches of ``USER`` characters, each by a permutation that depends on all before it; the domain stays."""
    user, _, domain = text.partition("@")
    before, out = hashlib.sha256(), []
    for at in range(0, len(user), USER):
        part = user[at : at + USER]
        new = _letters(part, key, "mail" if not at else f"mail{before.hexdigest()}", undo)
        before.update((new if undo else part).encode())
        out.append(new)
    return "".join(out) + "@" + domain


#: In order of precedence: name, pattern, replacement. Every pattern takes whole runs of digits only.
KINDS: tuple[tuple[str, str, Callable], ...] = (
    ("mail", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", mail),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("ipv6", r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\w:]|\.\d)", ipv6),
    ("ipv4", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", ipv4),
    ("date", r"(?<![\d./-])(?:\d{4}(?P<s1>[./-])\d{2}(?P=s1)\d{2}|\d{2}(?P<s2>[./-])\d{2}(?P=s2)\d{4})(?![\d]|[./-]\d)", date),
    ("ssn", r"(?<![\d-])\d{3}(?P<s3>[- ])\d{2}(?P=s3)\d{4}(?![\d]|-\d)", ssn),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)", phone),
    ("phone", r"(?<![\w+])\+\d{10,15}(?!\d)", phone),
    ("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]\d{1,6}){2,5}(?![\d]|[.-]\d)", phone),
    ("phone", r"(?<![\w+./-])0\d{2,4}[ -]\d{3,8}(?:[ -]\d{3,5})?(?![\d]|[ ./-]\d)", phone),
    ("card", r"(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d]|\.\d)", card),
)
_ANY = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p, _) in enumerate(KINDS)), re.ASCII)


#: Every kind has one of these.
_SIGN = re.compile(r"[0-9@]")


@lru_cache(maxsize=1 << 16)
def _new(kind: int, text: str, key: bytes, undo: bool) -> str | None:
    return KINDS[kind][2](text, key, undo)


def rewrite(text: str, key: bytes, undo: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, begin, end) of each in the new text; what fails validation stays."""
    if _SIGN.search(text) is None:
        return text, []
    out, spans, at, size = [], [], 0, 0
    for m in _ANY.finditer(text):
        kind = int(m.lastgroup[1:])  # the outer group closes last
        new = _new(kind, m[0], key, undo)
        if new is not None:
            out += [text[at : m.start()], new]
            size += m.start() - at
            spans.append((KINDS[kind][0], size, size + len(new)))
            size += len(new)
            at = m.end()
    return "".join([*out, text[at:]]) if spans else text, spans


def pseudonymise(docs: DataFrame, key: str = "corpus key", undo: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a column ``pii`` of (kind, begin, end) in the new text.

    Works row by row on whole texts. Null texts stay null with no spans, empty ones empty; rows, order of
    columns and other columns stay, but for a column named ``pii``, which is replaced.
    """
    lean(docs.sparkSession)
    secret = hashlib.sha256(key.encode()).digest()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))
    kept = [c for c in docs.columns if c != "pii"]
    # names that no column of the result has
    rest, new = free_name(docs, "rest"), free_name(docs, "new")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [(None, []) if t is None else rewrite(t, secret, undo) for t in b.column(new).to_pylist()]
            spans = [[{"kind": k, "begin": x, "end": y} for k, x, y in s] for _, s in done]
            yield pa.record_batch([b.column(rest), pa.array([t for t, _ in done], pa.string()), pa.array(spans, kind)], names=[rest, new, "pii"])

    rows = docs.select(F.struct(F.lit(0).alias(rest), *(column(c) for c in kept if c != "text")).alias(rest), F.col("text").cast("string").alias(new))
    spans_type = StructType([StructField("kind", StringType()), StructField("begin", IntegerType()), StructField("end", IntegerType())])
    out = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("pii", ArrayType(spans_type))]))
    return out.select(*(F.col(new).alias("text") if c == "text" else F.col(rest)[c].alias(c) for c in kept), "pii")
