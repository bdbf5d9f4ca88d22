"""Secrets in whole texts, found through an inverted index of trigrams.

Each rule's regular expression gives a Boolean query of byte trigrams that every match has in it (``trigram_query``): literals and small
classes multiply to the exact strings that may stand there, alternatives are joined by OR, what follows each other by AND. The index has, for each trigram of any query
and each bucket of texts, the sorted keys of the texts with it; texts are folded to lower case first. Within a bucket Spark
intersects and joins the posting lists as the queries say, and only the texts that remain are read again and matched. A rule without a trigram
that every match must have is matched against every text when the index is made.

Keys are hashes of whole texts, so equal texts are one posting; the number of buckets grows with the table, so no posting list does. A false candidate costs a look at
its text and changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from re import _constants as op
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, lean, materialize
from .tokens import slices, utf8

BUCKET = 20_000  # texts in a bucket, about
MOST = 64  # exact strings that are followed at once
KEY = ["k1", "k2"]
SPANS = "array<struct<start:long,kind:int,end:long>>"


class Rule(NamedTuple):
    kind: str
    pattern: str
    either_case: bool = False  # of ASCII letters
    group: int = 0  # whose length counts
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))


#: The three rules of the task (a run of hex digits, or of capitals and digits, is as long as it can be, so the least length may stand in the pattern) ...
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: ... and public formats of keys and tokens.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]{2,12} )?PRIVATE KEY-----"),
    Rule("url", r"://[A-Za-z0-9._~-]{1,64}:[A-Za-z0-9._~!$&*+=-]{3,128}@"),
)
RULES = BASE + MORE

# ---- queries: a trigram is bytes; ("and", (...)) and ("or", (...)) join them; an empty "and" holds for every text


def _all(parts: Iterable) -> tuple:
    out = []
    for p in parts:
        for x in p[1] if isinstance(p, tuple) and p[0] == "and" else [p]:
            if x not in out:
                out.append(x)
    return ("and", tuple(out))


def _any(parts: Iterable) -> tuple:
    out = []
    for p in parts:
        if p == ("and", ()):
            return p
        p = p[1][0] if p[0] == "and" and len(p[1]) == 1 else p
        if p not in out:
            out.append(p)
    # an alternative that asks for more than another one adds nothing
    asked = [set(p[1]) if p[0] == "and" else {p} for p in out]
    out = [p for k, p in enumerate(out) if not any(other < asked[k] for other in asked)]
    return out[0] if len(out) == 1 else ("or", tuple(out))


def _grams(strings: set[bytes]) -> tuple:
    """What holds wherever one of these strings stands."""
    return _any(_all(s[k : k + 3] for k in range(len(s) - 2)) for s in sorted(strings)) if strings else ("and", ())


def _fold(c: int) -> bytes:
    return chr(c).lower().encode() if c < 128 else chr(c).encode()


def _members(items: list) -> set[bytes] | None:
    """The folded characters of a class, if they are few."""
    out: set[bytes] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(_fold(value))
        elif kind is op.RANGE and value[1] - value[0] < MOST:
            out |= {_fold(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


class _Strings:
    """The exact strings that may end here, and what is known to stand before."""

    def __init__(self) -> None:
        self.ends, self.known = {b""}, []

    def cut(self) -> None:
        """Something of any length follows."""
        self.known.append(_grams(self.ends))
        self.ends = {b""}

    def then(self, strings: set[bytes]) -> None:
        if len(self.ends) * len(strings) > MOST:
            self.known.append(_grams(self.ends))
            self.ends = {s[-2:] for s in self.ends}
            if len(self.ends) * len(strings) > MOST:
                self.ends = {b""}
        self.ends = {a + b for a in self.ends for b in strings}


def _exact(parsed: Iterable) -> set[bytes] | None:
    """All strings that this matches, if they are few."""
    out = {b""}
    for kind, value in parsed:
        if kind is op.LITERAL:
            more = {_fold(value)}
        elif kind is op.IN:
            more = _members(value)
        elif kind is op.SUBPATTERN:
            more = _exact(value[3])
        elif kind is op.BRANCH:
            ways = [_exact(x) for x in value[1]]
            more = None if None in ways else set().union(*ways)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] <= 8:
            one = _exact(value[2])
            more, run = (None, None) if one is None else (set(), {b""})
            for n in range(value[1] + 1 if one is not None else 0):
                more |= run if n >= value[0] else set()
                run = {a + b for a in run for b in one}
                if len(run) > MOST:
                    return None
        elif kind is op.AT:
            more = {b""}
        else:
            more = None
        if more is None or len(out) * len(more) > MOST:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(parsed: Iterable, at: _Strings) -> None:
    for item in parsed:
        kind, value = item
        strings = _exact([item])
        if strings is not None:
            at.then(strings)
        elif kind is op.SUBPATTERN:
            _query(value[3], at)
        elif kind is op.BRANCH:
            ways = []
            for x in value[1]:
                inside = _Strings()
                _query(x, inside)
                inside.cut()
                ways.append(_all(inside.known))
            at.cut()
            at.known.append(_any(ways))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            # once on from here, once before what follows; whatever lies between
            first = _exact(value[2])
            if first is not None:
                at.then(first)
                at.cut()
                at.then(first)
            else:
                _query(value[2], at)
                at.cut()
        else:
            at.cut()


def trigram_query(pattern: str) -> tuple:
    """A Boolean query that every text with a match of ``pattern`` satisfies, over lower-case trigrams of UTF-8 bytes."""
    at = _Strings()
    _query(_parser.parse(pattern), at)
    at.cut()
    return _all(at.known)


def needed(query: tuple | bytes) -> set[bytes]:
    return {query} if isinstance(query, bytes) else set().union(*map(needed, query[1]))


# ---- the index


def number(gram: bytes) -> int:
    return int.from_bytes(gram, "big")


def text_grams(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts, which has which of the trigrams in ``table``: rows and trigram numbers, each pair once."""
    offsets, data = utf8(column)
    lo, hi = int(offsets[0]), int(offsets[-1])
    if hi - lo < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = data[lo:hi]
    b = np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint32)
    codes = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    at = np.flatnonzero(table[codes])
    row = np.searchsorted(offsets, at + lo, "right") - 1
    inside = at + lo + 2 < offsets[row + 1]
    pair = np.unique(row[inside] << 24 | codes[at[inside]])
    return pair >> 24, pair & 0xFFFFFF


def matches(rule: Rule, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that do not overlap, without those that are too short."""
    for m in pattern.finditer(text):
        if m.end(rule.group) - m.start(rule.group) >= rule.least:
            yield m.span()


def _spans(rules: list[tuple[int, Rule, re.Pattern]], text: str) -> list[dict]:
    return [{"start": a, "kind": k, "end": b} for k, rule, pattern in rules for a, b in matches(rule, pattern, text)]


SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("text"), text).alias("k2"))


def scan(docs: DataFrame, rules: tuple[Rule, ...], grams: list[bytes]) -> DataFrame:
    """``(doc_id, k1, k2, grams, spans)`` of each row: the trigrams it has, and the spans of ``rules`` that have no query."""
    full = [(k, r) for k, r in enumerate(rules) if trigram_query(r.pattern) == ("and", ())]
    wanted = [number(g) for g in grams]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << 24, dtype=bool)
        table[wanted] = True
        ready = [(k, r, r.compiled()) for k, r in full]
        for b in (part for batch in batches for part in slices(batch)):
            row, gram = text_grams(b.column("text"), table)
            at = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))
            spans = pa.array([_spans(ready, t) for t in b.column("text").to_pylist()], SPAN_TYPE)
            yield pa.record_batch([b.column("doc_id"), b.column("k1"), b.column("k2"), pa.ListArray.from_arrays(at, pa.array(gram.astype(np.int32))), spans], names=["doc_id", *KEY, "grams", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs).mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, grams array<int>, spans {SPANS}")


def postings(scanned: DataFrame) -> DataFrame:
    """The inverted index ``(bucket, gram, keys)``: sorted keys of the texts of a bucket that have the trigram."""
    buckets = -(-max(1, scanned.count()) // BUCKET)
    rows = scanned.select((F.pmod(F.col("k1"), F.lit(buckets))).alias("bucket"), "k1", F.explode("grams").alias("gram"))
    return rows.groupBy("bucket", "gram").agg(F.sort_array(F.collect_set("k1")).alias("keys"))


def _lists(query: tuple | bytes, held: Column) -> Column:
    """The keys that satisfy a query, from the posting lists ``held`` (a map by trigram)."""
    if isinstance(query, bytes):
        return F.coalesce(F.try_element_at(held, F.lit(number(query))), F.array().cast("array<long>"))
    parts = [_lists(q, held) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = F.array_intersect(out, p) if query[0] == "and" else F.array_union(out, p)
    return out


def candidates(index: DataFrame, queries: dict[int, tuple]) -> DataFrame:
    """``(k1, rules)``: the texts that satisfy a query, and the numbers of the rules as bits."""
    held = index.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("held"))
    each = F.array(*(F.struct(F.lit(1 << k).alias("bit"), _lists(q, F.col("held")).alias("keys")) for k, q in queries.items()))
    found = held.select(F.explode(each).alias("found")).select("found.bit", F.explode("found.keys").alias("k1"))
    return found.groupBy("k1").agg(F.bit_or("bit").alias("rules"))


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, spans)`` of each row: ``(start, kind, end)`` in code points, by start, then by the rules' order.

    ``kind`` is the rule's number. Null texts count as empty and have no spans; ids may be null or repeated; equal texts have equal spans; other columns take no part; an empty table
    gives no rows.
    """
    lean(docs.sparkSession)
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern)) != ("and", ())}
    grams = sorted(set().union(*map(needed, queries.values()))) if queries else []
    scanned = materialize(scan(docs, rules, grams))
    if not queries:
        return scanned.select("doc_id", F.sort_array("spans").alias("spans"))
    chosen = materialize(candidates(postings(scanned), queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [(k, rules[k], rules[k].compiled()) for k in queries]
        for b in batches:
            rows = zip(b.column("text").to_pylist(), b.column("rules").to_pylist(), strict=True)
            spans = pa.array([_spans([x for x in ready if bits >> x[0] & 1], t) for t, bits in rows], SPAN_TYPE)
            yield pa.record_batch([b.column("k1"), b.column("k2"), spans], names=[*KEY, "more"])

    # a small table of candidates goes to every task (its size is that of its files), a large one meets the texts by key
    read = _keyed(docs).join(chosen, "k1").select(*KEY, "text", "rules")
    verified = read.mapInArrow(run, f"k1 long, k2 long, more {SPANS}").where(F.size("more") > 0)
    found = materialize(verified.groupBy(*KEY).agg(F.first("more").alias("more")))  # equal keys have equal spans
    discard(chosen)
    none = F.array().cast(SPANS)
    return scanned.join(found, KEY, "left").select("doc_id", F.sort_array(F.concat("spans", F.coalesce("more", none))).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``: counts and digest of the base rules' spans, and all spans as ``kind:start:end``."""
    kinds = F.array(*(F.lit(r.kind) for r in RULES))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{RULES[k].kind}")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return find(docs).select("doc_id", *(count(k) for k in range(len(BASE))), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def _either_case(pattern: str) -> str:
    """The pattern with its literal letters as classes of both cases; classes have both already."""
    out, inside = "", False
    for k, c in enumerate(pattern):
        inside = (inside or c == "[") and c != "]"
        out += f"[{c}{c.upper()}]" if c.islower() and not inside and pattern[k - 1 : k + 1] != r"\x" else c
    return out


def _sql() -> str:
    parts = []
    for k, r in enumerate(RULES):
        p = (_either_case(r.pattern) if r.either_case else r.pattern).replace("'", "''")
        parts.append(f"SELECT row, {k} AS k, '{r.kind}' AS kind, string_split_regex(text, '{p}') AS apart, regexp_extract_all(text, '{p}') AS hits, regexp_extract_all(text, '{p}', {r.group}) AS value, {r.least} AS least FROM rows WHERE regexp_matches(text, '{p}')")
    line = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT)"
    return f"""
WITH rows AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  {' UNION ALL '.join(parts)}
), placed AS (
  SELECT row, k, kind, length(hits[i]) AS size, length(value[i]) AS counted, least,
         list_sum(list_transform(apart[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda z: length(z))), 0) AS start
  FROM parts, unnest(range(1, len(hits) + 1)) AS r(i)
), found AS (
  SELECT row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg({line}, ',' ORDER BY start, k) FILTER (k < {len(BASE)}) AS base, string_agg({line}, ',' ORDER BY start, k) AS spans
  FROM placed WHERE counted >= least GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows LEFT JOIN found USING (row)
"""


SQL = _sql()
