"""Substring dedup by a relative Lempel-Ziv parse against blocks of the whole corpus.

Every run of ``width`` words has an anchor: its smallest ``gram``-word hash, the leftmost of equals.
Consecutive runs with one anchor make a block, at most ``2 * width - gram`` words. All blocks of all
documents are the reference: an index has each distinct block once, with the first and the last place it stands at.

A document is parsed from left to right: a block of it that the index has at another place opens a factor that copies
from there, and the factor is extended as long as the next block goes on at the next words of the same source. Every factor
holds at least one run, so it is long enough to be a duplicate span. What lies between and at the ends of factors
(blocks whose anchor occurs elsewhere, but within other words) is checked run by run: each of these runs is looked up among
the runs of the reference blocks with that anchor, and found ones join the factors. Equal runs have equal anchors at equal places, so this
finds each run that occurs twice. Blocks are told apart by two 64-bit hashes, and so are runs.

Blocks, their anchors and runs meet in buckets by hash. A task sends them in chunks, packed in a few rows: every distinct block once,
with its count and its first and last place, and every anchor once, so no passage and no anchor makes a large group. Only what stands elsewhere is answered, and a
chunk joins it to factors before they go to their rows. One representative stands for all equal blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .common import lean, materialize, power_of_two, text_bytes
from .tokens import Words, mix, slices, sliding_min, window_hashes, words

GRAM = 8
#: A row: whether it has no id, its id (0 then), a hash of its text. Equal rows have one key.
KEY = ["no_id", "doc_id", "text_hash"]
#: Most items of a chunk; least number of buckets; ``base`` of the row that a chunk sends to itself.
CHUNK, BUCKETS, OWN = 1 << 18, 512, -1
WORD = 2**32 - 1


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.col("doc_id").cast("long")
    return docs.select(own.isNull().alias("no_id"), F.coalesce(own, F.lit(0)).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def parse(w: Words, width: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """The blocks of all texts of a batch: text, first word in the batch, number of runs, anchor hash, block hash."""
    none = np.zeros(0, np.int64)
    grams = window_hashes(w.hashes, gram)
    runs = window_hashes(w.hashes, width)
    if not len(runs):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    low = np.uint64(0xFFFFFFFF)
    place = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width - gram + 1) & low
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    whole = np.flatnonzero(np.arange(len(runs)) + width <= w.first[1:][doc[: len(runs)]])
    if not len(whole):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.concatenate(([True], (place[whole][1:] != place[whole][:-1]) | (doc[whole][1:] != doc[whole][:-1])))
    at = np.flatnonzero(new)
    first, last = whole[at], whole[np.append(at[1:], len(whole)) - 1]
    block = mix(runs[first] * np.uint64(3) + runs[last] * np.uint64(7) + (last - first).astype(np.uint64))
    return doc[first], first, last - first + 1, grams[place[first]], block


class Items(NamedTuple):
    """Blocks or single runs, in the order of rows and words: the number of their row, its ``KEY`` and hash, their place and weight, the two hashes they are told apart by."""

    doc: np.ndarray
    no_id: np.ndarray
    doc_id: np.ndarray
    text_hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    runs: np.ndarray
    weight: np.ndarray
    main: np.ndarray
    second: np.ndarray


def _items(b: pa.RecordBatch, doc: np.ndarray, start: np.ndarray, runs: np.ndarray, weight: np.ndarray, main: np.ndarray, second: np.ndarray) -> Items:
    return Items(doc, *(b.column(k).to_numpy(zero_copy_only=False)[doc] for k in (*KEY, "row")), start, runs, weight, main, second)


def _blocks(b: pa.RecordBatch, width: int) -> Items:
    w = words(b.column("text"))
    doc, first, runs, anchor, block = parse(w, width)
    return _items(b, doc, first - w.first[doc], runs, np.ones(len(doc), np.int64), anchor, block)


def _boundary_runs(b: pa.RecordBatch, width: int) -> Items:
    """Of each text, the runs of the blocks in its ``todo``."""
    w = words(b.column("text"))
    runs, second = window_hashes(w.hashes, width), window_hashes(mix(w.hashes ^ np.uint64(0x9D5)), width)
    todo = b.column("todo")
    doc = np.repeat(np.arange(b.num_rows), np.diff(todo.offsets.to_numpy()))
    start, n, weight = (todo.flatten().field(k).to_numpy().astype(np.int64) for k in range(3))
    row = np.repeat(np.arange(len(doc)), n)
    place = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    doc = doc[row]
    at = w.first[doc] + place
    return _items(b, doc, place, np.ones(len(row), np.int64), weight[row], runs[at], second[at])


def _groups(*sorted_by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last index of each run of equal rows."""
    new = np.zeros(len(sorted_by[0]), bool)
    new[:1] = True
    for x in sorted_by:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(new))[: len(first)] - 1


def _place(row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A place as one number: 32 bits of a hash of the row, so that neighbours of one row sort alike, then the word."""
    return (row.astype(np.uint32).view(np.int32).astype(np.int64) << 32) | start.astype(np.int64)


def _unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).view(np.uint64)


def _entries(order: np.ndarray, first: np.ndarray, last: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each group of ordered items the first one and, if there are ``two``, the last one; where each group begins, and that for each item."""
    at = np.arange(len(first)) + np.cumsum(two) - two
    taken = np.empty(len(first) + int(two.sum()), np.int64)
    taken[at], taken[at[two] + 1] = order[first], order[last[two]]
    entry = np.empty(len(order), np.int64)
    entry[order] = np.repeat(at, last - first + 1)
    return taken, at, entry


def _chunk(sender: int, x: Items, buckets: int, anchors: bool) -> pa.RecordBatch:
    """What a chunk of items sends: to each bucket its keys, every key once with its weight and first place (and the last, in an entry of no weight); to itself the items.

    With ``anchors`` every anchor goes to a bucket too, once with the smallest and the largest hash of its blocks, so that
    the blocks of a frequent anchor stay spread over all buckets.
    """
    bits = np.uint64(65 - buckets.bit_length())
    cuts = lambda k: np.searchsorted(k >> bits, np.arange(buckets + 1, dtype=np.uint64))
    key, row = mix(x.main + mix(x.second)), x.row.view(np.uint64) >> np.uint64(32)
    place = _place(row, x.start)
    order = np.lexsort((place, x.second, key))
    first, last = _groups(key[order], x.second[order])
    taken, at, entry = _entries(order, first, last, place[order[first]] != place[order[last]])
    weight = np.zeros(len(taken), np.uint64)
    weight[at] = np.add.reduceat(x.weight[order], first)
    bound = cuts(key[taken])
    columns = [key[taken], x.second[taken], weight, row[taken], *map(_unsigned, (x.start[taken], x.doc_id[taken], x.no_id[taken]))]
    by_anchor, anchor_bound = [np.zeros(0, np.uint64)] * 3, np.zeros(buckets + 1, np.int64)
    if anchors:
        key = mix(x.main)
        order = np.lexsort((x.second, key))
        first, last = _groups(key[order])
        taken, _, of_anchor = _entries(order, first, last, x.second[order[first]] != x.second[order[last]])
        anchor_bound = cuts(key[taken])
        # within a bucket 32 further bits tell anchors apart: two taken for one cost a look at their runs
        by_anchor = [key[taken] & np.uint64(WORD), x.second[taken], _unsigned(of_anchor)]
    # tells chunks of other rows apart, should a task run again and get its rows in another order
    stamp = mix(mix(x.row.view(np.uint64) + x.start.astype(np.uint64)) + np.arange(len(x.doc), dtype=np.uint64)).sum(keepdims=True)
    begin, end = _groups(x.doc)
    step = np.diff(x.start, prepend=0)
    step[begin] = 0
    full = np.flatnonzero((bound[1:] > bound[:-1]) | (anchor_bound[1:] > anchor_bound[:-1])).tolist()
    own = [*(_unsigned(getattr(x, k)[begin]) for k in KEY), row[begin], *map(_unsigned, (x.start[begin], end - begin + 1, step, x.runs, x.weight, entry, by_anchor.pop(), np.array([len(full)]))), stamp]
    parts = [[c[bound[k] : bound[k + 1]] for c in columns] + [c[anchor_bound[k] : anchor_bound[k + 1]] for c in by_anchor] + [_unsigned(anchor_bound[k : k + 1]), stamp] for k in full] + [own]
    return pa.record_batch(
        [
            pa.array([sender] * len(parts), pa.int64()),
            pa.array([*full, *packed.bucket_of(np.array([sender], np.uint64), buckets).tolist()], pa.int32()),
            pa.array([*bound[full].tolist(), OWN], pa.int32()),
            pa.array([[packed.pack(c) for c in p] for p in parts], pa.list_(pa.binary())),
        ],
        names=["sender", "bucket", "base", "parts"],
    )


def _cut(doc: np.ndarray) -> int:
    """The end of the next chunk: that of a row, or of as many items as a chunk holds, counted from where the row begins, so that equal rows are cut alike."""
    begin, _ = _groups(doc)
    begin = begin[(begin > 0) & (begin <= CHUNK)]
    return int(begin[-1]) if len(begin) else CHUNK


def _sent(docs: DataFrame, items: Callable[[pa.RecordBatch, int], Items], width: int, buckets: int) -> DataFrame:
    anchors = items is _blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, before, held = TaskContext.get().partitionId() << 24, 0, None
        for b in (part for b in batches for part in slices(b)):
            x = items(b, width)
            x = x._replace(doc=x.doc + before)
            before += b.num_rows
            held = x if held is None else Items(*map(np.concatenate, zip(held, x, strict=True)))
            while len(held.doc) >= CHUNK:
                to = _cut(held.doc)
                yield _chunk(sender, Items(*(c[:to] for c in held)), buckets, anchors)
                sender, held = sender + 1, Items(*(c[to:] for c in held))
        if held is not None and len(held.doc):
            yield _chunk(sender, held, buckets, anchors)

    return docs.mapInArrow(run, "sender long, bucket int, base int, parts array<binary>")


def _answer(t: pa.Table) -> pa.Table:
    """All entries of the keys and anchors of a bucket meet; each sender hears of its keys that stand at several places, and of its anchors that have several blocks.

    An answer names the first place of the key, and to who sent this place also the last one.
    """
    rows = t.to_pylist()
    asked, kept = [r for r in rows if r["base"] != OWN], [r for r in rows if r["base"] == OWN]
    parts = []
    if asked:
        each = [[packed.unpack(p) for p in r["parts"]] for r in asked]
        bound, anchor_bound = (np.cumsum([0, *(len(x[k]) for x in each)]) for k in (0, 7))
        key, second, weight, row, start, doc, no_id, anchor, block, anchor_base, stamp = (np.concatenate(x) for x in zip(*each, strict=True))
        place = _place(row, start)
        order = np.lexsort((no_id, doc, place, second, key))
        first, last = _groups(key[order], second[order])
        n = np.add.reduceat(weight[order].astype(np.int64), first) if len(order) else first
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(first)), last - first + 1)
        told = np.flatnonzero((n > 1)[group] & (weight > 0))
        first, last = order[first][group], order[last][group]
        mine = told[place[told] == place[first[told]]]
        order = np.lexsort((block, anchor))
        begin, end = _groups(anchor[order])
        several = np.sort(order[np.repeat(block[order[begin]] != block[order[end]], end - begin + 1)])
        for k, r in enumerate(asked):
            i, m = (x[slice(*np.searchsorted(x, bound[k : k + 2]))] for x in (told, mine))
            j = several[slice(*np.searchsorted(several, anchor_bound[k : k + 2]))]
            f, z, base = first[i], last[m], r["base"] - bound[k]
            columns = [i + base, doc[f], no_id[f], start[f], m + base, place[m].view(np.uint64), doc[z], no_id[z], start[z], j - anchor_bound[k] + int(anchor_base[k]), stamp[k : k + 1]]
            parts.append([packed.pack(c) for c in columns])
    return pa.table([pa.array([r["sender"] for r in asked + kept], pa.int64()), pa.array([r["base"] for r in asked + kept], pa.int32()), pa.array(parts + [r["parts"] for r in kept], pa.list_(pa.binary()))], names=["sender", "base", "parts"])


def _find(entry: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``told`` has each entry, and whether it does."""
    if not len(told):
        return np.zeros(len(entry), np.int64), np.zeros(len(entry), bool)
    order = np.argsort(told)
    k = np.minimum(np.searchsorted(told, entry, sorter=order), len(told) - 1)
    return order[k], told[order[k]] == entry


def _gather(t: pa.Table) -> pa.Table:
    """The items of a chunk with their answers, once for equal rows: ``weight`` 0 for what is found, joined to factors, else that of a block whose runs are to be looked up."""
    own, answers = None, []
    for r in t.to_pylist():
        parts = [packed.unpack(p) for p in r["parts"]]
        if r["base"] == OWN:
            own = parts
        else:
            answers.append(parts)
    if own is None or len(answers) != own[-2][0] or any(x[-1][0] != own[-1][0] for x in answers):
        raise RuntimeError("a task that was run again sent other rows; write the table before")
    signed = lambda v: v.astype(np.uint64).view(np.int64)
    no_id, doc_id, text_hash, row, begin, count, step, runs, weight, entry, of_anchor, _, stamp = map(signed, own)
    at, doc, none, start, own_at, own_place, last_doc, last_none, last_start, several_at, _ = (signed(np.concatenate(x)) for x in zip(*answers, strict=True))
    rows = np.repeat(np.arange(len(count)), count)
    moved = np.cumsum(step)
    place = moved + np.repeat(begin - moved[np.cumsum(count) - count], count)
    # rows of one key stand once
    _, same, key = np.unique(np.stack((no_id, doc_id, text_hash)), axis=1, return_index=True, return_inverse=True)
    rows = same[key.ravel()][rows]
    k, whole = _find(entry, at)
    several = _find(of_anchor, several_at)[1] if len(of_anchor) else np.zeros(len(entry), bool)
    i = np.flatnonzero(whole | several)
    i = i[np.unique(rows[i] << 32 | place[i], return_index=True)[1]]
    k, whole, several = k[i], whole[i], several[i]
    source = np.zeros((3, len(i)), np.int64)
    source[:, whole] = np.stack((none, doc, start))[:, k[whole]]
    k, mine = _find(entry[i], own_at)
    mine[mine] = own_place[k[mine]] == _place(row[rows[i[mine]]], place[i[mine]])
    source[:, mine] = np.stack((last_none, last_doc, last_start))[:, k[mine]]
    todo = several & (~whole | mine)
    use = np.flatnonzero(whole & (weight[i] == 1))
    ids, code = np.unique(source[:2, use], axis=1, return_inverse=True)
    of, first, n, code, first_source = chain(rows[i[use]], place[i[use]], runs[i[use]], code.ravel(), source[2, use])
    todo = np.flatnonzero(todo)
    of, rest = np.concatenate((of, rows[i[todo]])), np.zeros(len(todo), np.int64)
    unnamed = np.concatenate((ids[0][code] > 0, rest == 0))
    return pa.table(
        [
            pa.array(no_id[of] > 0),
            pa.array(doc_id[of]),
            pa.array(text_hash[of]),
            pa.array(np.concatenate((first, place[i[todo]])).astype(np.int32)),
            pa.array(np.concatenate((n, runs[i[todo]])).astype(np.int32)),
            pa.array(np.concatenate((ids[1][code], rest)), mask=unnamed),
            pa.array(np.concatenate((first_source, rest)).astype(np.int32)),
            pa.array(np.concatenate((np.zeros(len(first), np.int32), 1 + whole[todo])).astype(np.int32)),
        ],
        names=[*KEY, "start", "runs", "source", "source_start", "weight"],
    )


def _met(docs: DataFrame, items: Callable[[pa.RecordBatch, int], Items], width: int, buckets: int) -> DataFrame:
    """Items go to the buckets of their keys, answers back to the chunk that sent them. Rows must come in the same order when a task is run again, else the job ends in an error."""
    answers = _sent(docs, items, width, buckets).groupBy("bucket").applyInArrow(_answer, "sender long, base int, parts array<binary>")
    return answers.groupBy("sender").applyInArrow(_gather, "no_id boolean, doc_id long, text_hash long, start int, runs int, source long, source_start int, weight int")


def matches(docs: DataFrame, width: int = 35) -> DataFrame:
    """``(<KEY>, start, runs, source, source_start)``, once for equal rows but for the edges of chunks: ``runs`` runs from word ``start`` on also stand at word ``source_start`` of the row ``source``."""
    row = F.xxhash64(*KEY).alias("row")
    found = materialize(_met(docs.select("*", row), _blocks, width, power_of_two(text_bytes(docs) / 16e6, BUCKETS)))
    whole = found.where("weight = 0").drop("weight")
    runs = found.where("weight > 0").agg(F.sum("runs")).first()[0]
    if not runs:
        return whole
    todo = found.where("weight > 0").groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("start", "runs", "weight"))).alias("todo"))
    texts = docs.join(todo, KEY).sortWithinPartitions(*KEY).select("*", row)
    return whole.union(_met(texts, _boundary_runs, width, power_of_two(runs / CHUNK, BUCKETS)).where("weight = 0").drop("weight"))


def chain(doc: np.ndarray, start: np.ndarray, runs: np.ndarray, source: np.ndarray, source_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Greedy factors of matches: each is extended while the next match goes on in the text and in the source."""
    at = np.lexsort((start, doc))
    doc, start, runs, source, source_start = (x[at] for x in (doc, start, runs, source, source_start))
    on = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + runs[:-1]) & (source[1:] == source[:-1]) & (source_start[1:] == source_start[:-1] + runs[:-1])
    begin = np.flatnonzero(np.concatenate((np.ones(min(1, len(doc)), bool), ~on)))
    return doc[begin], start[begin], np.add.reduceat(runs, begin) if len(begin) else runs, source[begin], source_start[begin]


def strip(docs: DataFrame, width: int = 35) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept, spans, factors)`` of every row.

    A word goes if a run of ``width`` words that covers it also starts elsewhere, in the same text or in
    any other row; a repeated row is another place. ``spans`` are the removed (begin, end) word ranges,
    ``kept`` the other words joined by one space, ``factors`` the parse: from word ``begin`` on, ``words`` words copy those
    of document ``source`` from ``source_begin`` on (null: a row without id). Null texts count as empty; texts shorter than ``width``
    words stay whole; null ids come back as null. Other columns are ignored.
    """
    lean(docs.sparkSession)
    docs = _keyed(docs)
    marks = matches(docs, width).groupBy(*KEY).agg(F.collect_set(F.struct("start", "runs", "source", "source_start")).alias("marks"))
    factor = pa.struct([(k, pa.int64()) for k in ("begin", "words", "source", "source_begin")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for b in batches for part in slices(b)):
            w, rows = words(b.column("text")), b.num_rows
            marked = b.column("marks")
            sizes = np.array([0 if x is None else x for x in marked.value_lengths().to_pylist()], dtype=np.int64)
            start, runs, named, source_start = marked.flatten().flatten()
            named = named.dictionary_encode(null_encoding="encode")  # a row without id is a source as well
            fields = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (start, runs, named.indices, source_start)]
            doc, start, runs, source, source_start = chain(np.repeat(np.arange(rows), sizes), *fields)
            # runs of a factor cover runs + width - 1 words; every text closes what it opens
            change = np.zeros(len(w.hashes) + 1, dtype=np.int64)
            np.add.at(change, w.first[doc] + start, 1)
            np.add.at(change, w.first[doc] + start + runs + width - 1, -1)
            gone = np.cumsum(change)[:-1] > 0
            keep = np.flatnonzero(~gone)
            size = w.end[keep] - w.begin[keep] + 1
            at = np.cumsum(size) - size
            text = w.data[np.minimum(np.repeat(w.begin[keep] - at, size) + np.arange(int(size.sum())), max(len(w.data) - 1, 0))] if len(keep) else np.zeros(0, np.uint8)
            text[at + size - 1] = 32
            bound = np.append(at, len(text))[np.searchsorted(keep, w.first)]
            raw = text.tobytes()
            kept = [raw[x : y - 1] if y > x else b"" for x, y in zip(bound.tolist(), bound[1:].tolist(), strict=False)]
            total = np.concatenate(([0], np.cumsum(gone)))
            edge = np.zeros(len(gone) + 2, dtype=bool)
            edge[1:-1] = gone
            opens, closes = edge[1:] & ~edge[:-1], edge[:-1] & ~edge[1:]
            # a span ends where its text ends, even if the next text goes on with one
            first_words = np.zeros(len(gone) + 1, dtype=bool)
            first_words[w.first] = True
            opens |= first_words & edge[1:]
            closes |= first_words & edge[:-1]
            opens, closes = np.flatnonzero(opens[:-1]), np.flatnonzero(closes)
            span_doc = np.searchsorted(w.first, opens, "right") - 1
            span_at = np.searchsorted(span_doc, np.arange(rows + 1)).astype(np.int32)
            flat = np.stack((opens - w.first[span_doc], closes - w.first[span_doc]), axis=1).ravel()
            spans = pa.ListArray.from_arrays(pa.array(span_at), pa.ListArray.from_arrays(pa.array(np.arange(len(opens) + 1, dtype=np.int32) * 2), pa.array(flat)))
            factor_at = pa.array(np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32))
            named = named.dictionary.take(pa.array(source))
            factors = pa.ListArray.from_arrays(factor_at, pa.StructArray.from_arrays([pa.array(start), pa.array(runs + width - 1), named, pa.array(source_start)], fields=list(factor)))
            columns = [pa.array(np.diff(w.first)), pa.array(np.diff(total[w.first])), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array([x.decode() for x in kept], pa.string()), spans, factors]
            yield pa.record_batch([b.column("id"), *columns], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans", "factors"])

    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, spans array<array<long>>, factors array<struct<begin:long,words:long,source:long,source_begin:long>>"
    own = F.when(~F.col("no_id"), F.col("doc_id")).alias("id")
    return docs.join(marks, KEY, "left").select(own, "text", "marks").mapInArrow(run, kind)
