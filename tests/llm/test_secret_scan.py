"""Trigram queries on strings that must match, and the scan against plain regular expressions."""

import hashlib
import random
import re

import duckdb
import pytest

from bellwether.llm import secret_scan
from bellwether.llm.secret_scan import Rule, trigram_query

SCHEMA = "doc_id long, text string"


def holds(query, text):
    if isinstance(query, bytes):
        return query in text
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])


@pytest.mark.parametrize(
    ("pattern", "query"),
    [
        ("abcd", ("and", (b"abc", b"bcd"))),
        ("ab", ("and", ())),
        ("[0-9a-f]+", ("and", ())),
        ("abc|xyz", ("and", (("or", (b"abc", b"xyz")),))),
        ("abc|.", ("and", ())),
        ("abc.*xyz", ("and", (b"abc", b"xyz"))),
        ("(?:abc)?xyz", ("and", (b"xyz",))),
        ("AbC", ("and", (b"abc",))),
        ("é!", ("and", ("é!".encode(),))),
        ("a[bc]d", ("and", (("or", (b"abd", b"acd")),))),
        ("(abc)+d", ("and", (b"abc", b"bcd"))),
        ("x*abc", ("and", (b"abc",))),
    ],
)
def test_queries(pattern, query):
    assert trigram_query(pattern) == query


def sample(parsed, rng):
    """A random string that the parsed pattern matches."""
    out = ""
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            out += chr(value)
        elif name == "IN":
            k, v = rng.choice(value)
            out += chr(v if str(k) == "LITERAL" else rng.randint(*v))
        elif name == "SUBPATTERN":
            out += sample(value[3], rng)
        elif name == "BRANCH":
            out += sample(rng.choice(value[1]), rng)
        else:
            assert name == "MAX_REPEAT", name
            out += "".join(sample(value[2], rng) for _ in range(rng.randint(value[0], min(value[1], value[0] + 5))))
    return out


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_every_match_satisfies_its_query(rule):
    rng = random.Random(3)
    query, pattern = trigram_query(rule.pattern), rule.compiled()
    for _ in range(300):
        text = sample(re._parser.parse(rule.pattern), rng)
        if rule.either_case:
            text = "".join(rng.choice((c.upper(), c.lower())) for c in text)
        assert pattern.fullmatch(text), text
        assert holds(query, text.lower().encode())


def planted(rng):
    """Text with secrets, near misses and letters of other scripts."""
    parts = []
    for _ in range(rng.randrange(12)):
        rule = rng.choice(secret_scan.RULES)
        text = sample(re._parser.parse(rule.pattern), rng)
        parts.append(rng.choice([text, text, text[: rng.randrange(1, len(text) + 1)], "password: short", "token=token=abcdefghijkl", "Sécret ſecret toKen=abcdefghijklmnop", "the order passed key ", "ÄÖ日本"]))
    return rng.choice(["", " ", "x", ", "]).join(parts)


def plain(text):
    text = text or ""
    base = [
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
        re.compile("AKIA[A-Z0-9]+"),
        re.compile("[0-9a-f]+"),
    ]
    spans = [(m.start(), 0, m.end()) for m in base[0].finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), k, m.end()) for k, n in ((1, 18), (2, 16)) for m in base[k].finditer(text) if len(m[0]) >= n]
    every = spans + [(m.start(), k, m.end()) for k, r in enumerate(secret_scan.RULES) if k > 2 for m in r.compiled().finditer(text)]
    shown = lambda x: ",".join(f"{secret_scan.RULES[k].kind}:{a}:{b}" for a, k, b in sorted(x))
    return (*(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(shown(spans).encode()).hexdigest(), shown(every))


def test_scan_equals_plain_expressions_and_sql(spark):
    rng = random.Random(11)
    texts = [planted(rng) for _ in range(400)] + [None, "", "ab", "AKIA", "x" * 50000 + " token = " + "y" * 40 + "é", "-" * 10000]
    rows = [(rng.choice([None, k, 5]), t) for k, t in enumerate(texts)] + [(7, 'secret="abcdefghijklmnop"')] * 500
    got = sorted((tuple(r) for r in secret_scan.report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert any("jwt" in r[-1] for r in got) and any("private_key" in r[-1] for r in got)
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar)")
    db.executemany("insert into documents values (?, ?)", rows)
    assert sorted(db.sql(secret_scan.SQL).fetchall(), key=str) == got


def test_index_names_every_text_with_a_trigram(spark):
    rows = [(k, t) for k, t in enumerate(["a tokEN", "to", "ken token", "tok", "", None, "xtokex", "oke"])]
    scanned = secret_scan.scan(spark.createDataFrame(rows, SCHEMA), (Rule("t", "token"),), [b"tok", b"oke", b"ken"])
    keys = {r["k1"]: r["doc_id"] for r in scanned.collect()}
    found = {}
    for r in secret_scan.postings(scanned).collect():
        found.setdefault(r["gram"].to_bytes(3, "big"), set()).update(keys[k] for k in r["keys"])
    assert found == {b"tok": {0, 2, 3, 6}, b"oke": {0, 2, 6, 7}, b"ken": {0, 2}}


def test_empty_table_clashing_columns_and_rules_without_queries(spark):
    assert secret_scan.report(spark.createDataFrame([], SCHEMA)).count() == 0
    table = spark.createDataFrame([(1, "token=abcdefghijkl", 3, "r", "s")], SCHEMA + ", k1 long, rules string, spans string")
    assert [tuple(r)[:4] for r in secret_scan.report(table).collect()] == [(1, 1, 0, 0)]
    got = secret_scan.find(table, (Rule("digits", "[a-f]{4,}"), Rule("word", "token"))).collect()
    assert [tuple(s) for s in got[0]["spans"]] == [(0, 1, 5), (6, 0, 12)]
    assert secret_scan.find(table, (Rule("digits", "[a-f]{4,}"),)).count() == 1
