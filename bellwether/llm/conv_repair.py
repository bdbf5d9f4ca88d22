"""Repair of conversation structure by the lightest derivation of a legal role sequence.

The roles of a repaired conversation spell ``(s?(ua)+)?``: an automaton of four states. Repairing is a weighted
deduction system. Items are ``prefix(i, q)`` (the first ``i`` rows are dealt with, the output so far leads to state
``q``) and ``edit(i, t)`` (row ``i`` becomes the symbol ``t``, or nothing); hyperedges are

* ``prefix(i, q), edit(i, t) -> prefix(i + 1, q.t)`` and ``prefix(i, q), insert(t) -> prefix(i, q.t)``,
* ``prefix(n, q) -> goal`` for the states a conversation may end in.

A derivation weighs ``(cost, audit)``, costs added and the edits' letters joined, compared in that order. Joining is
monotone here and never gives less than its parts (two audits of one item and one cost are never the beginning of one
another, as a letter's cost depends on its row alone), so these functions are superior, and Knuth's agenda may pop items from the lightest on:
each popped item is final, and work ends when the goal is popped.

Rows are dealt by ranges of (conversation, turn, role and text), so that a conversation of any length is spread over
tasks. What lies inside a range is repaired there in one pass over the sorted rows. A conversation that crosses the edge of a range, or has more than
``LONG`` rows, is cut into segments of ``SEGMENT`` rows; the agenda gives each segment's lightest ways between any two states, whose
hyperedge ``prefix(q), segment(q, r) -> prefix(r)`` then joins them. Equal rows are one row with a count from the first shuffle on.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import CRC_TABLE, crc_sql, discard, lean, materialize

SEGMENT = 512  # rows in a segment of a conversation that is cut
LONG = 4096  # most rows of a conversation that one task holds
#: The edits' costs; a kept row that is cut short costs one more.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
BLANK = " \t\n\x0b\x0c\r"
#: States by what has been put out: nothing, the system's message, a user's, an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (NOTHING, ASSISTANT)
LEGAL = ("su", "ua", "au")
Weight = tuple[int, str]

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    copies: int
    repeated: bool  # an earlier row has this role and text


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows damaged by the hash of ``conv_id:turn``; a dropped row has no copies.

    A null counts as one space in role, text and the hash.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def fault(row: Row) -> str:
    """The first fault of the first copy."""
    words = row.text.rstrip(BLANK)
    return "blank" if not words else "duplicate" if row.repeated else "truncated" if words[-1] not in ".!?" else ""


def edits(rows: Iterable[Row]) -> list[list[tuple[str, int, str]]]:
    """Of each row, or run of rows that must go, what it can become: (symbol or nothing, cost, letters)."""
    out = []
    for row in rows:
        found, gone = fault(row), row.copies - 1
        if found in ("blank", "duplicate"):
            gone += 1
        else:
            keep, mine = CUT_SHORT * (found == "truncated"), row.role[:1]
            ways = [(mine, keep, "K")] if mine in ("s", "u", "a") else []
            out.append([*ways, *((t, REROLE + keep, "R") for t in ROLES if t != mine), ("", DELETE, "D")])
        if gone:
            out.append([("", DELETE * gone, "D" * gone)])
    return out


def agenda(axioms: Iterable[tuple[int, str, tuple]], fire, goals: set[tuple]) -> dict[tuple, Weight]:  # noqa: ANN001
    """Final weights of items, lightest first, until all of ``goals`` are final or nothing is left.

    ``fire(item, final)`` gives the conclusions (cost, audit, item) of the hyperedges whose last premise to become final is ``item``.
    """
    waiting, final, open_goals = list(axioms), {}, set(goals)
    heapq.heapify(waiting)
    while waiting and open_goals:
        cost, audit, item = heapq.heappop(waiting)
        if item in final:
            continue
        final[item] = (cost, audit)
        open_goals.discard(item)
        for conclusion in fire(item, final):
            if conclusion[2] not in final:
                heapq.heappush(waiting, conclusion)
    return final


def derive(choices: list[list[tuple[str, int, str]]], entry: int, goals: set[tuple] | None = None) -> dict[tuple, Weight]:
    """The agenda over rows that are entered in state ``entry``; goals: ``("prefix", n, q)``, or ``("goal",)`` for the end of a conversation."""
    n = len(choices)

    def fire(item: tuple, final: dict[tuple, Weight]) -> Iterator[tuple[int, str, tuple]]:
        if item[0] == "prefix":
            _, i, q = item
            cost, audit = final[item]
            if i == n and q in FINAL:
                yield cost, audit, ("goal",)
            for t in ROLES:
                if (q, t) in NEXT:
                    yield cost + INSERT, audit + "I", ("prefix", i, NEXT[q, t])
            pairs = [(item, ("edit", i, t)) for t in ("", "s", "u", "a")]
        elif item[0] == "edit":
            pairs = [(("prefix", item[1], q), item) for q in range(4)]
        else:
            return
        for before, edit in pairs:
            if before in final and edit in final:
                q = NEXT.get((before[2], edit[2])) if edit[2] else before[2]
                if q is not None:
                    (a, x), (b, y) = final[before], final[edit]
                    yield a + b, x + y, ("prefix", edit[1] + 1, q)

    axioms = [(cost, letters, ("edit", i, t)) for i, ways in enumerate(choices) for t, cost, letters in ways]
    return agenda([(0, "", ("prefix", 0, entry)), *axioms], fire, {("goal",)} if goals is None else goals)


def crossings(choices: list[list[tuple[str, int, str]]]) -> dict[tuple[int, int], Weight]:
    """The lightest way through these rows from each state to each other one."""
    n, out = len(choices), {}
    for entry in range(4):
        final = derive(choices, entry, {("prefix", n, q) for q in range(4)})
        out |= {(entry, q): final["prefix", n, q] for q in range(4) if ("prefix", n, q) in final}
    return out


class Joined:
    """Prefixes of a conversation, one segment after the other; what all four have in common is set aside."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.live: dict[int, tuple[int, str, tuple[int, ...]]] = {NOTHING: (0, "", ())}  # cost, audit since then, states entered since then
        self.states: list[int] = []

    def add(self, ways: dict[tuple[int, int], Weight]) -> None:
        def fire(item: tuple, final: dict[tuple, Weight]) -> Iterator[tuple[int, str, tuple]]:
            if item[0] == "before":
                cost, audit = final[item]
                for (p, q), (c, letters) in ways.items():
                    if p == item[1]:
                        yield cost + c, audit + letters, ("after", q, p)

        # of equal audits by two ways, which cannot be, the lower state would be taken
        final = agenda([(c, x, ("before", p)) for p, (c, x, _) in self.live.items()], fire, {("after", q, p) for q in range(4) for p in range(4)})
        after: dict[int, tuple[int, str, tuple[int, ...]]] = {}
        for item, (cost, audit) in final.items():  # lightest first
            if item[0] == "after" and item[1] not in after:
                after[item[1]] = (cost, audit, (*self.live[item[2]][2], item[2]))
        # what all live prefixes begin with is decided
        audits = [x for _, x, _ in after.values()]
        low, high = min(audits), max(audits)
        same = next((k for k, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
        self.settled.append(low[:same])
        paths = [p for *_, p in after.values()]
        known = next((k for k, step in enumerate(zip(*paths, strict=True)) if len(set(step)) > 1), len(paths[0]))
        self.states += paths[0][:known]
        self.live = {q: (c, x[same:], p[known:]) for q, (c, x, p) in after.items()}

    def close(self) -> tuple[int, str, list[int]]:
        """Cost, audit and the state in which each segment is entered, with the last one at the end."""
        cost, audit, path, q = min((c, x, p, q) for q, (c, x, p) in self.live.items() if q in FINAL)
        return cost, "".join([*self.settled, audit]), [*self.states, *path, q]


def repaired(rows: Iterable[Row], audit: str, state: int) -> Iterator[str]:
    """The lines of what the edits of ``audit`` make of these rows, entered in ``state``."""
    todo = iter(audit)
    left = 0
    rows = iter(rows)
    row = None
    for letter in todo:
        if letter != "I":
            while left == 0:
                row = next(rows)
                left = row.copies
            left -= 1
        if letter == "D":
            continue
        symbol = row.role[:1] if letter == "K" else "u" if (state, "u") in NEXT else "a"
        state = NEXT[state, symbol]
        yield f"{row.role}:{row.text}" if letter == "K" else f"{ROLES[symbol]}:{row.text if letter == 'R' else ''}"


def counts(rows: list[Row]) -> dict:
    """Faults and turns of consecutive rows, in a form that adjacent segments can be joined by."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "first_role": None, "last_role": None, "first_turn": None, "last_turn": None, "turns": 0}
    for row in rows:
        if not row.copies:
            continue
        found, role = fault(row), row.role[:1]
        if found:
            out[found] += row.copies if found == "blank" else 1
        if found != "blank":
            out["duplicate"] += row.copies - 1
        out["illegal"] += row.copies - 1 + (out["last_role"] is not None and out["last_role"] + role not in LEGAL)
        out["first_role"], out["last_role"] = role if out["first_role"] is None else out["first_role"], role
        if row.turn is not None:
            out["turns"] += row.turn != out["last_turn"]
            out["first_turn"], out["last_turn"] = row.turn if out["first_turn"] is None else out["first_turn"], row.turn
    return out


def joined_counts(a: dict, b: dict) -> dict:
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["last_role"] is not None and b["first_role"] is not None and a["last_role"] + b["first_role"] not in LEGAL
    out["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    for first, last in (("first_role", "last_role"), ("first_turn", "last_turn")):
        out[first] = b[first] if a[first] is None else a[first]
        out[last] = a[last] if b[last] is None else b[last]
    return out


def gaps(found: dict) -> int:
    return 0 if found["first_turn"] is None else min(found["last_turn"] - found["first_turn"] + 1 - found["turns"], 2**63 - 1)


def whole(rows: list[Row]) -> dict:
    """The result of a conversation that is held whole."""
    rows = [r for r in rows if r.copies]
    if len(rows) <= SEGMENT:
        cost, audit = derive(edits(rows), NOTHING)["goal",]
    else:
        joined = Joined()
        for at in range(0, len(rows), SEGMENT):
            joined.add(crossings(edits(rows[at : at + SEGMENT])))
        cost, audit, _ = joined.close()
    found = counts(rows)
    text = "\n".join(repaired(rows, audit, NOTHING))
    return {k: found[k] for k in ("blank", "duplicate", "truncated", "illegal")} | {"gaps": gaps(found), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return groupby(rows, key=itemgetter(0))


def _first_pass(schema: pa.Schema):  # noqa: ANN202
    """Results of the conversations inside a range; the rows of the others with their segment and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        out, size, at = [], 0, 0

        def cut(conv: object, rows: Iterable[tuple]) -> Iterator[dict]:
            nonlocal at
            for k, (_, turn, role, text, copies) in enumerate(rows):
                at += k % SEGMENT == 0
                yield {"conv_id": conv, "part": {"seg": base + at, "pos": k % SEGMENT, "turn": turn, "role": role, "text": text, "copies": copies}}

        def done(conv: object, rows: list[tuple]) -> dict:
            seen: set[tuple[str, str]] = set()
            made = []
            for _, turn, role, text, copies in rows:
                made.append(Row(turn, role, text, copies, (role, text) in seen))
                if copies:
                    seen.add((role, text))
            return {"conv_id": conv, "result": whole(made)}

        def every() -> Iterator[dict]:
            held: tuple[object, list[tuple]] | None = None  # the conversation before, of which it is not known yet whether it is the last
            first = True
            for conv, rows in _conversations(batches):
                if held is not None:
                    yield done(*held)
                    held = None
                some = []
                for r in rows:
                    some.append(r)
                    if len(some) > LONG:
                        break
                if first or len(some) > LONG:
                    yield from cut(conv, (x for part in (some, rows) for x in part))
                else:
                    held = (conv, some)
                first = False
            if held is not None:
                yield from cut(*held)

        for x in every():
            out.append(x)
            size += len(x["part"]["text"]) if "part" in x else 300
            if size > 1 << 21 or len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


COUNTS = "struct<blank:long,duplicate:long,truncated:long,illegal:long,turns:long,first_role:string,last_role:string,first_turn:long,last_turn:long>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found, ways = [], []
        for rows in b.column("rows").to_pylist():
            rows = [Row(r["turn"], r["role"], r["text"], r["copies"], r["repeated"]) for r in rows if r["copies"]]
            found.append(counts(rows))
            ways.append([{"p": p, "q": q, "cost": c, "audit": x} for (p, q), (c, x) in crossings(edits(rows)).items()])
        kinds = (pa.struct([(k, pa.int64()) for k in ("blank", "duplicate", "truncated", "illegal", "turns")] + [("first_role", pa.string()), ("last_role", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64())]), pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))
        yield pa.record_batch([*(b.column(k) for k in ("c_null", "c_id", "seg")), pa.array(found, kinds[0]), pa.array(ways, kinds[1])], names=["c_null", "c_id", "seg", "found", "ways"])


def _join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation, whose segments come in order, cost, audit, counts and the ways taken."""
    rows = (r for b in batches for r in b.to_pylist())
    for (null, conv), segments in groupby(rows, key=lambda r: (r["c_null"], r["c_id"])):
        joined, found, segs = Joined(), counts([]), []
        for s in segments:
            joined.add({(w["p"], w["q"]): (w["cost"], w["audit"]) for w in s["ways"]})
            found = joined_counts(found, s["found"])
            segs.append(s["seg"])
        cost, audit, states = joined.close()
        taken = [{"seg": s, "p": p, "q": q} for s, p, q in zip(segs, states[:-1], states[1:], strict=True)]
        kinds = pa.struct([("seg", pa.int64()), ("p", pa.int32()), ("q", pa.int32())])
        numbers = [pa.array([v], pa.int64()) for v in (gaps(found), found["blank"], found["duplicate"], found["truncated"], found["illegal"], cost)]
        yield pa.record_batch([pa.array([null]), pa.array([conv], pa.string()), *numbers, pa.array([audit]), pa.array([taken], pa.list_(kinds))], names=["c_null", "c_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "taken"])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for rows, audit, p in zip(*(b.column(k).to_pylist() for k in ("rows", "audit", "p")), strict=True):
            lines = list(repaired((Row(r["turn"], r["role"], r["text"], r["copies"], r["repeated"]) for r in rows if r["copies"]), audit, p))
            out.append("\n".join(lines) if lines else None)
        yield pa.record_batch([*(b.column(k) for k in ("c_null", "c_id", "seg")), pa.array(out, pa.string())], names=["c_null", "c_id", "seg", "lines"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, whose segments come in order; nothing but the hash is held."""
    rows = (r for b in batches for r in b.to_pylist())
    for (null, conv), parts in groupby(rows, key=lambda r: (r["c_null"], r["c_id"])):
        digest, begun = hashlib.sha256(), False
        for x in parts:
            if x["lines"] is not None:
                digest.update((b"\n" if begun else b"") + x["lines"].encode())
                begun = True
        yield pa.record_batch([pa.array([null]), pa.array([conv], pa.string()), pa.array([digest.hexdigest()])], names=["c_null", "c_id", "repaired_sha256"])


def _cut_results(cut: DataFrame) -> DataFrame:
    """Results of the conversations that lie in several segments: ``(c_null, c_id, <RESULT>)``."""
    key = ["c_null", "c_id"]
    same = [*key, "role", "text"]
    firsts = cut.where("copies > 0").groupBy(*same).agg(F.min(F.struct("seg", "pos")).alias("first"))
    told = cut.join(firsts, same, "left").withColumn("repeated", F.coalesce(F.struct("seg", "pos") > F.col("first"), F.lit(False)))
    rows = F.sort_array(F.collect_list(F.struct("pos", "turn", "role", "text", "copies", "repeated"))).alias("rows")
    segments = materialize(told.groupBy(*key, "seg").agg(rows))  # SEGMENT rows at most in each list
    ways = materialize(segments.mapInArrow(_segments, f"c_null boolean, c_id string, seg long, found {COUNTS}, ways array<struct<p:int,q:int,cost:long,audit:string>>"))
    kind = "c_null boolean, c_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, taken array<struct<seg:long,p:int,q:int>>"
    joined = materialize(ways.repartition(*key).sortWithinPartitions(*key, "seg").mapInArrow(_join_segments, kind))
    taken = joined.select(*key, F.explode("taken").alias("t")).select(*key, "t.*")
    chosen = ways.select(*key, "seg", F.explode("ways").alias("w")).select(*key, "seg", "w.p", "w.q", "w.audit").join(taken, [*key, "seg", "p", "q"])
    lines = segments.join(chosen, [*key, "seg"]).mapInArrow(_lines, "c_null boolean, c_id string, seg long, lines string")
    hashed = lines.repartition(*key).sortWithinPartitions(*key, "seg").mapInArrow(_hashed, "c_null boolean, c_id string, repaired_sha256 string")
    out = materialize(joined.drop("taken").join(hashed, key))
    discard(segments, ways, joined)
    return out


def repair(damaged: DataFrame) -> DataFrame:
    """``conv_id`` and ``RESULT`` of each conversation of ``damaged(conv_id, turn, role, text, copies)``, in the order of turns.

    Null turns come first; rows of one turn are taken by role and text; equal rows are repeated ones. A row that is blank, or repeats role and text of an
    earlier one, has to go; others are kept, get another role, or go. ``audit`` has the letter of each edit
    (Delete, Insert, Keep, Rerole); of equally cheap ones the ASCII-least. Roles of other initials than s, u, a can only be given a role or go. A
    conversation without rows (all have 0 copies) has zeros, no audit and the hash of the empty string; null conversation ids are one conversation. Gaps
    stop at the largest long.
    """
    lean(damaged.sparkSession)
    rows = damaged.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("copies"))
    rows = materialize(rows)
    # rows of one turn in the order of role and text; a beginning of it is enough to deal them out
    sort = F.concat("role", F.lit("\0"), "text")
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring(sort, 1, 64)).sortWithinPartitions("conv_id", "turn", sort)
    ids = damaged.schema["conv_id"]
    schema = StructType([ids]).add("result", StructType.fromDDL(RESULT)).add("part", StructType.fromDDL("seg long, pos int, turn long, role string, text string, copies long"))
    passed = materialize(dealt.mapInArrow(_first_pass(to_arrow_schema(schema)), schema))
    cut = passed.where("part is not null").select(F.col("conv_id").isNull().alias("c_null"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("c_id"), "conv_id", "part.*")
    names = cut.groupBy("c_null", "c_id").agg(F.first("conv_id").alias("conv_id"))
    of_cut = _cut_results(cut.drop("conv_id")).join(names, ["c_null", "c_id"])
    fields = [f.name for f in StructType.fromDDL(RESULT)]
    discard(rows)
    return passed.where("result is not null").select("conv_id", "result.*").select("conv_id", *fields).union(of_cut.select("conv_id", *fields))


def _sql() -> str:
    one = lambda state, cost, letter: f"{{'cost': best[{state}].cost + {cost}, 'audit': best[{state}].audit || '{letter}'}}"
    free = "fault IN ('', 'truncated')"
    keep = lambda state, symbol: f"CASE WHEN {free} AND substr(role, 1, 1) = '{symbol}' THEN {one(state, 'short', 'K')} END"
    rerole = lambda state: f"CASE WHEN {free} THEN {one(state, '2 + short', 'R')} END"
    least = lambda *ways: f"list_min(list_filter([{', '.join(ways)}], lambda z: z IS NOT NULL))"
    go = lambda state: one(state, 3, "D")
    plus = lambda x: f"{{'cost': {x}.cost + 2, 'audit': {x}.audit || 'I'}}"
    return rf"""
WITH RECURSIVE {CRC_TABLE}, hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations
), dealt AS (
  SELECT conv_id, turn, role, text, {crc_sql('s')} % 20 AS k FROM hashed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS c(copy)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair
  FROM placed
), faulty AS (
  SELECT *, CAST(fault = 'truncated' AS BIGINT) AS short FROM marked
), every AS (
  SELECT DISTINCT conv_id FROM conversations
), walk(conv_id, i, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), [{{'cost': CAST(0 AS BIGINT), 'audit': ''}}, {{'cost': CAST(1000000 AS BIGINT), 'audit': ''}}, {{'cost': 2, 'audit': 'I'}}, {{'cost': 4, 'audit': 'II'}}] FROM every
  UNION ALL
  SELECT conv_id, i, [z, s, u, {least('a', plus('u'))}] FROM (
    SELECT conv_id, i, z, s, a, {least('u', plus('z'), plus('s'), plus('a'))} AS u FROM (
      SELECT w.conv_id, f.i, {go(1)} AS z, {least(go(2), keep(1, 's'))} AS s,
             {least(go(3), keep(1, 'u'), keep(2, 'u'), keep(4, 'u'), rerole(1), rerole(2), rerole(4))} AS u,
             {least(go(4), keep(3, 'a'), rerole(3))} AS a
      FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1))
), chosen AS (
  SELECT conv_id, list_min([best[1], best[4]]) AS b FROM walk w
  WHERE i = coalesce((SELECT max(i) FROM faulty f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id), 0)
), letters AS (
  SELECT conv_id, b.audit AS audit, j, substr(b.audit, j, 1) AS letter, length(replace(substr(b.audit, 1, j), 'I', '')) AS i, length(replace(substr(b.audit, 1, j), 'D', '')) AS o
  FROM chosen, unnest(range(1, length(b.audit) + 1)) AS r(j)
), outs AS (
  SELECT l.*, f.role, f.text, max(CASE WHEN o = 1 AND letter = 'K' AND substr(f.role, 1, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS led
  FROM letters l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE letter <> 'D'
), fixed AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role ELSE CASE WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' ||
                             CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS body FROM outs GROUP BY conv_id
), summed AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(c.b.cost AS BIGINT) AS cost, c.b.audit AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM every e JOIN chosen c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN summed s ON s.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN fixed x ON x.conv_id IS NOT DISTINCT FROM e.conv_id
"""


SQL = _sql()
