"""The manifest against a tree built by lists, and what it says of changed rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from bellwether.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha(*("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def tree(nodes):
    """The top, and of each node its siblings before and after by level."""
    steps, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(where):
            run = at // 16 * 16
            steps[k].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        nodes = [sha(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
        where = [k // 16 for k in where]
    return nodes[0], steps


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = tree([leaf(r, r[1]) for r in groups[s]])
    root, above = tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above, strict=True):
        for r, own in zip(groups[s], trees[s][1], strict=True):
            path = own + up
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            x = leaf(r, text)
            for before, after in path:
                x = sha(before, x, after)
            out.append((r[0], leaf(r, r[1]), trees[s][0], root, sha(*(b + a for b, a in path)), x, x == root))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def check(spark, rows, partitions=3):
    got = [tuple(r) for r in merkle.verify(spark.createDataFrame(rows, SCHEMA).repartition(partitions)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    return got


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1, 2], [300, 256, 257, 15] + [1] * 30])
def test_sizes_about_the_fan(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(rng.randrange(10**9), f"Text {k} Ä", "en", f"s{s}", k) for s, n in enumerate(sizes) for k in range(n)]
    rng.shuffle(rows)
    check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    rng = random.Random(4)
    pick = lambda *x: rng.choice(x)
    rows = [(pick(None, 0, 7, -(2**63), 2**63 - 1, *range(20)), pick(None, "", "A:b", "-", "Ünï", "x" * 20000), pick(None, "de"), pick(None, "", "a", "b", "é", "z"), pick(None, 0, 5)) for _ in range(400)]
    got = check(spark, rows + [(3, "Same", "en", "hot", 4)] * 600)
    assert {r[6] for r in got} == {True, False}


def test_a_path_proves_its_row_and_no_other(spark):
    rows = [(k, f"T{k}", "en", f"s{k % 3}", k) for k in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = merkle.proofs(docs, F.when(F.col("doc_id") == 5, "other").otherwise(F.col("text")))
    told = {r[0]: r[1] for r in out.select("doc_id", merkle.folded(F.col("altered"), F.col("path")) == F.col("root")).collect()}
    assert [k for k, v in told.items() if not v] == [5]


def test_empty_table_and_clashing_columns(spark):
    assert merkle.verify(spark.createDataFrame([], SCHEMA)).count() == 0
    extra = ", idx long, n long, digest string, path string, known boolean"
    rows = [(1, "A", "en", "s", 1, 9, 9, "d", "p", False), (2, "B", None, None, 1, 9, 9, "d", "p", False)]
    got = [tuple(r) for r in merkle.verify(spark.createDataFrame(rows, SCHEMA + extra)).collect()]
    assert sorted(got) == sorted(plain([r[:5] for r in rows]))
