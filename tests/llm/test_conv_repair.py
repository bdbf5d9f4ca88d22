"""Conversation repair against an exhaustive search, against a plain table of best prefixes, and on rows of every kind."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from bellwether.llm import conv_repair
from bellwether.llm.conv_repair import Joined, Row, crossings, derive, edits, repaired

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?$")


def rows_of(spec):
    """``u.`` a user's whole row, ``a`` an assistant's cut short, ``x`` a blank, ``=`` the row before again."""
    out, seen = [], set()
    for k, (role, end) in enumerate(spec):
        text = {".": f"t{k}.", "-": f"t{k}", " ": " "}[end]
        out.append(Row(k, role, text, 1, (role, text) in seen))
        seen.add((role, text))
    return out


def exhaustive(rows, most=3):
    """All ways to delete, keep and give roles, with up to ``most`` insertions at any places."""
    best = None
    options = []
    for r in rows:
        blank, cut = not r.text.strip(" \t\n\x0b\x0c\r"), r.text.rstrip(" ")[-1:] not in ".!?"
        ways = [(3, "D", "")]
        if not blank and not r.repeated:
            ways += [(cut, "K", r.role[:1])] + [(2 + cut, "R", t) for t in "ua"]
        options.append(ways)
    for chosen in itertools.product(*options):
        base = sum(c for c, *_ in chosen)
        for n in range(most + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                for inserted in itertools.product("ua", repeat=n):
                    audit, roles = "", ""
                    for at in range(len(rows) + 1):
                        for p, t in zip(places, inserted, strict=True):
                            if p == at:
                                audit, roles = audit + "I", roles + t
                        if at < len(rows):
                            audit, roles = audit + chosen[at][1], roles + chosen[at][2]
                    if LEGAL.match(roles):
                        found = (base + 2 * n, audit)
                        best = found if best is None else min(best, found)
    return best


def test_lightest_derivation_equals_exhaustive_search():
    rng = random.Random(5)
    for _ in range(120):
        rows = rows_of([(rng.choice(["system", "user", "assistant", "tool", " "]), rng.choice(". -.")) for _ in range(rng.randrange(5))])
        assert derive(edits(rows), 0)["goal",] == exhaustive(rows), rows


def test_segments_join_to_the_whole():
    rng = random.Random(6)
    for n in (1, 7, 40, 90):
        rows = rows_of([(rng.choice(["system", "user", "user", "assistant", "assistant"]), rng.choice(".... -")) for _ in range(n)])
        want = derive(edits(rows), 0)["goal",]
        joined, bounds = Joined(), [*range(0, n, 7), n]
        for a, b in itertools.pairwise(bounds):
            joined.add(crossings(edits(rows[a:b])))
        cost, audit, states = joined.close()
        assert (cost, audit) == want
        whole = list(repaired(rows, audit, 0))
        assert LEGAL.match("".join(x[0] for x in whole))
        each = zip(itertools.pairwise(bounds), itertools.pairwise(states), strict=True)
        assert whole == [x for (a, b), (p, q) in each for x in repaired(rows[a:b], crossings(edits(rows[a:b]))[p, q][1], p)]


def plain(rows):
    """The contract's row of one conversation, by a table of best prefixes. ``rows``: (turn, role, text) before damage."""
    damaged = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        damaged += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
    for _, role, text in damaged:
        words = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
        count[faults[-1]] += 1
        seen.add((role, text))
    turns = {t for t, *_ in damaged if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(damaged))
    step = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}

    def inserted(best):
        for _ in range(3):
            for q, (c, x, lines) in list(best.items()):
                for t, name in (("u", "user"), ("a", "assistant")):
                    if (q, t) in step:
                        new = (c + 2, x + "I", (lines, f"{name}:"))
                        if step[q, t] not in best or new[:2] < best[step[q, t]][:2]:
                            best[step[q, t]] = new
        return best

    best = inserted({"0": (0, "", None)})
    for (_, role, text), found in zip(damaged, faults, strict=True):
        after = {}

        def offer(q, new, after=after):
            if q not in after or new[:2] < after[q][:2]:
                after[q] = new

        for q, (c, x, lines) in best.items():
            offer(q, (c + 3, x + "D", lines))
            if found in ("", "truncated"):
                more = found == "truncated"
                if (q, role[:1]) in step:
                    offer(step[q, role[:1]], (c + more, x + "K", (lines, f"{role}:{text}")))
                for t, name in (("u", "user"), ("a", "assistant")):
                    if (q, t) in step:
                        offer(step[q, t], (c + 2 + more, x + "R", (lines, f"{name}:{text}")))
        best = inserted(after)
    cost, audit, lines = min((best[q] for q in ("0", "A") if q in best), key=lambda b: b[:2])
    out = []
    while lines is not None:
        lines, line = lines
        out.append(line)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(reversed(out)).encode()).hexdigest())


def check(spark, rows, partitions=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = {r["conv_id"]: tuple(r)[1:] for r in conv_repair.repair(conv_repair.damage(table)).collect()}
    ids = {r[0] for r in rows}
    assert got == {c: plain([r for r in rows if r[0] == c]) for c in ids}
    return got


def test_rows_of_every_kind(spark):
    rng = random.Random(8)
    role = lambda: rng.choice(["system", "user", "assistant", "assistant", "", "tool", None, "User"])
    text = lambda: rng.choice(["Yes.", "No", "", None, " \t", "Why? \n", "é…", "x" * 3000 + "!", "Yes."])
    rows = [(rng.choice([*range(60), None]), rng.choice([*range(5), None, -3, 2**40]), role(), text()) for _ in range(700)]
    rows += rows[:100]  # repeated rows
    rows += [(999, t, "user", "a.") for t in range(30) if zlib.crc32(f"999:{t}".encode()) % 20 == 0]  # all of them dropped
    got = check(spark, rows)
    assert got[999] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_a_conversation_of_many_rows_is_cut(spark):
    rng = random.Random(9)
    rows = [(5, t if t % 7 else None, ("user", "assistant")[t % 2] if rng.random() > 0.1 else "system", f"m{rng.randrange(3000)}" + rng.choice(".. ")) for t in range(5200)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{t}.") for c in range(30) for t in range(3)]
    check(spark, rows)


def test_thousands_of_equal_rows(spark):
    rows = [(None, None, "user", "Again.")] * 3000 + [(1, t, "user", "Again.") for t in range(1500)]
    got = check(spark, rows)
    assert got[None][6].count("D") == 2999 + (got[None][6][0] == "D")


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conv_repair.repair(conv_repair.damage(empty)).count() == 0
    table = spark.createDataFrame([(1, 0, "user", "A.", 5, "x", 1)], SCHEMA + ", copies int, part string, seg int")
    assert conv_repair.repair(conv_repair.damage(table)).columns[:2] == ["conv_id", "gaps"]
    assert conv_repair.repair(conv_repair.damage(table)).count() == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_sql_on_generated_rows(spark, seed):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["system", "user", "assistant"]), rng.choice(["Yes.", "No", "", "Why?"])) for c in range(40) for t in rng.sample(range(12), rng.randrange(1, 9))]
    got = sorted(tuple(r) for r in conv_repair.repair(conv_repair.damage(spark.createDataFrame(rows, SCHEMA))).collect())
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert got == sorted(db.sql(conv_repair.SQL).fetchall())
