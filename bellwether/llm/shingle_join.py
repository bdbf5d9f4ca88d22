"""Near-duplicates by exact similarity of word shingles.

Two texts are linked if the sets of their 5-word shingles (lower-cased A-Z; a shorter text is one shingle) have a
Jaccard similarity of 4/5 or more. Candidates come from two sides, and each is verified on the whole sets:

* the balls of ``simhash_ball`` on fingerprints of the same shingles, which bring together the closest copies;
* a prefix join, which reaches every other pair: sets of similarity 4/5 share at least 4/5 of the larger one, so in
  any common order of the shingles their first n - ceil(4n/5) + 1 have one in common.

The order puts shingles first that few texts have, by a count of fixed size (``SLOTS``); it decides the cost and not
the pairs. Equal sets are folded first. Prefixes travel as a few packed rows by hash bucket, 16 bytes a shingle, and
a bucket gives out the distinct lists of sets that share one. Verification goes in rounds: each set with the set it
shares most with; then the smallest of each list with its members; then those members of a list that are still in
different components and can be similar at all. In the list of the first shingle that two sets share, what they share lies from there on, so it is
at most what either has left in the order; a pair is made only where that is enough. As shingles of one text alone come first in the order, sets that differ too much fall out
by this count, and a list's pairs are found by the range of sizes that each member allows, not by trying all. Sketches of ``BITS`` bits then bound what two sets
share: the bits that both have, and the shingles that stand behind another one's bit.
A set travels to the smallest member of its list, in parts if that has many, and not with each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .common import HOT, components, discard, lean, materialize, power_of_two, text_bytes
from .simhash_ball import NODES, fingerprint, links
from .survivors import KEY, keep_first, named_by_least, row_key
from .tokens import LOWER, mix, slices, window_hashes, words

SLOTS = 1 << 20  # counters of the order
PARTS = 16  # rows of counters that each task sends
WANTED = 1 << 22  # slots of the filter that spares texts no pair asks for
HELD = 1 << 20  # prefix shingles that a task holds before it sends them
PAIRS = 1 << 20  # pairs looked at at once in a group
BITS = 4096  # of the sketch of a set
SOME = 1 << 13  # pairs whose sketches are compared at once


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as (text, hash), in order of both; a text of fewer words is one shingle."""
    w = words(column, LOWER)
    size = np.diff(w.first)
    whole = window_hashes(w.hashes, width)
    n = np.maximum(size - width + 1, 0)
    text = np.repeat(np.arange(len(size)), n)
    at = np.repeat(w.first[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    short = np.flatnonzero((size > 0) & (size < width))
    few = np.array([window_hashes(w.hashes[w.first[k] : w.first[k + 1]], int(size[k]))[0] for k in short], dtype=np.uint64)
    text, h = np.concatenate((text, short)), np.concatenate((whole[at], mix(few + np.uint64(1))))
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


def _keys(text: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text a hash of its set, and where the set begins; one more at the end."""
    first = np.searchsorted(text, np.arange(rows + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5EED)), dtype=np.uint64)))
    return mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64), first


def _prefix(n: np.ndarray) -> np.ndarray:
    """How many shingles of a set of each size any similar set must share one of."""
    return np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)


def _marked(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """``KEY``, ``key``, ``fp``, ``n`` and ``sketch`` of every row: hash, fingerprint, size and bits of its set; and how many texts have a shingle of each slot."""
    kind = "k_id long, k_null boolean, k_text long, k_rest long, key long, fp long, n long, sketch binary, part int, counts binary"
    names = [c.split()[0] for c in kind.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(SLOTS, dtype=np.uint32)
        for b in (x for y in batches for x in slices(y)):
            text, h = shingles(b.column("text"), width)
            count += np.bincount((h % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS).astype(np.uint32)
            key, first = _keys(text, h, b.num_rows)
            fp = [fingerprint((x.as_buffer().to_pybytes() if x.is_valid else b"").lower().split(), width) for x in b.column("text")]
            bits = np.zeros((b.num_rows, BITS), dtype=bool)
            bits[text, (mix(h ^ np.uint64(0xB175)) % np.uint64(BITS)).astype(np.int64)] = True
            sketch = pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())
            none = sketch, pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())
            yield pa.record_batch([*(b.column(k) for k in KEY), pa.array(key), pa.array(np.array(fp, dtype=np.uint64).view(np.int64), pa.int64()), pa.array(np.diff(first).astype(np.int64)), *none], names=names)
        some = [k for k, x in enumerate(count.reshape(PARTS, -1)) if x.any()]
        if some:
            rows = [pa.nulls(len(some), t) for t in (pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.binary())]
            yield pa.record_batch([*rows, pa.array(some, pa.int32()), pa.array([count.reshape(PARTS, -1)[k].tobytes() for k in some], pa.binary())], names=names)

    def add_up(t: pa.Table) -> pa.Table:
        out = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in t.column("counts").to_pylist())
        return pa.table({"part": t.column("part")[:1], "counts": pa.array([out.tobytes()], pa.binary())})

    both = materialize(docs.select(*row_key(docs), "text").mapInArrow(run, kind))
    order = np.zeros((PARTS, SLOTS // PARTS), dtype=np.int64)
    for r in both.where("part is not null").select("part", "counts").groupBy("part").applyInArrow(add_up, "part int, counts binary").collect():
        order[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return both.where("part is null").select(*KEY, "key", "fp", "n", "sketch"), np.minimum(order.ravel(), 2**32 - 1).astype(np.uint32)


def _lists(docs: DataFrame, width: int, order: np.ndarray, buckets: int) -> DataFrame:
    """``(list, members, rests, weight)``: the distinct lists of two sets or more that share a prefix shingle, and how many shingles each shares.

    ``rests``: of each member, how many of its shingles the order has from the shared one on, the most over the list's shingles (which is that of the first of them, for all members).
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)
    bits = buckets.bit_length() - 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        seen: set[int] = set()

        def rows() -> pa.RecordBatch:
            token, key, rest = (np.concatenate(x) for x in zip(*held, strict=True))
            at, bound = packed.cut(token, buckets)
            # within a bucket 32 further bits tell shingles apart; a chance meeting is one more pair to verify
            token, key, rest = (mix(token[at]) >> np.uint64(32 - bits)).astype(np.uint32), key[at], rest[at]
            full = [k for k in range(buckets) if bound[k] < bound[k + 1]]
            held.clear()
            return pa.record_batch(
                [pa.array(full, pa.int32()), *(pa.array([x[bound[k] : bound[k + 1]].tobytes() for k in full], pa.binary()) for x in (token, key, rest))], names=["bucket", "tokens", "keys", "rests"]
            )

        for b in (x for y in batches for x in slices(y)):
            text, h = shingles(b.column("text"), width)
            key, first = _keys(text, h, b.num_rows)
            new = np.zeros(b.num_rows, dtype=bool)
            for k, x in enumerate(key.tolist()):
                new[k] = x not in seen
                seen.add(x)
            h = h[np.lexsort((h, shared.value[(h % np.uint64(SLOTS)).astype(np.int64)], text))]
            n = np.where(new, _prefix(np.diff(first)), 0)
            at = np.repeat(first[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            held.append((h[at], np.repeat(key, n), (np.repeat(first[1:], n) - at).astype(np.uint32)))
            if sum(len(x) for x, *_ in held) > HELD:
                yield rows()
        if held and sum(len(x) for x, *_ in held):
            yield rows()

    def meet(t: pa.Table) -> pa.Table:
        token = np.concatenate([np.frombuffer(x, np.uint32) for x in t.column("tokens").to_pylist()])
        key = np.concatenate([np.frombuffer(x, np.int64) for x in t.column("keys").to_pylist()])
        rest = np.concatenate([np.frombuffer(x, np.uint32) for x in t.column("rests").to_pylist()]).astype(np.int32)
        at = np.lexsort((-rest, key, token))
        token, key, rest = token[at], key[at], rest[at]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key, rest = token[new], key[new], rest[new]
        begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.append(begin, len(key)))
        begin, size = begin[size > 1], size[size > 1]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(key.view(np.uint64) ^ np.uint64(0x115)), dtype=np.uint64)))
        name = mix(total[begin + size] - total[begin] + size.astype(np.uint64)).view(np.int64)
        # of lists with the same members, that of the shingle which comes first in the order
        at = np.lexsort((-rest[begin], name))
        name, begin, size = name[at], begin[at], size[at]
        name, one, weight = np.unique(name, return_index=True, return_counts=True)
        begin, size = begin[one], size[one]
        flat = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        bound = pa.array(np.concatenate(([0], np.cumsum(size))))
        members, rests = (pa.LargeListArray.from_arrays(bound, pa.array(x[flat])).cast(pa.list_(kind)) for x, kind in ((key, pa.int64()), (rest, pa.int32())))
        return pa.table({"list": pa.array(name), "members": members, "rests": rests, "weight": pa.array(weight.astype(np.int64))})

    sent = docs.select("text").mapInArrow(send, "bucket int, tokens binary, keys binary, rests binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "list long, members array<long>, rests array<int>, weight long")
    first = F.max_by(F.struct("members", "rests"), F.col("rests")[0]).alias("x")
    return materialize(met.groupBy("list").agg(first, F.sum("weight").alias("weight")).select("list", "x.members", "x.rests", "weight"))


def _fit(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The distinct ``(ka, kb)`` of sizes that allow a similarity of 4/5."""
    sizes = nodes.select("key", "n")
    both = pairs.join(sizes.toDF("ka", "na"), "ka").join(sizes.toDF("kb", "nb"), "kb")
    return both.where("5 * least(na, nb) >= 4 * greatest(na, nb)").select("ka", "kb")


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The links ``(a, b)`` of the distinct ``pairs(ka, kb)`` whose sets have a similarity of 4/5 or more; ``nodes`` name a row of each set."""
    hubs = materialize(pairs.groupBy("ka").agg(F.count("*").alias("n")))
    keys = materialize(pairs.select(F.col("kb").alias("key")).union(hubs.select("ka")).distinct().join(nodes.select("key", "row"), "key"))
    slots = keys.select(F.col("row").bitwiseAND(F.lit(WANTED - 1)).alias("slot")).distinct().toArrow().column("slot").to_numpy()
    bits = np.zeros(WANTED, dtype=bool)
    bits[slots] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            b = b.filter(pa.array(wanted[b.column("row").to_numpy() & (WANTED - 1)]))
            for b in slices(b):  # noqa: PLW2901
                text, h = shingles(b.column("text"), width)
                key, first = _keys(text, h, b.num_rows)
                # 40 bits of each shingle, in order
                short = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:])
                yield pa.record_batch([pa.array(key), b.column("row"), pa.array([short[x:y].tobytes() for x, y in zip(first, first[1:], strict=False)], pa.binary())], names=["key", "row", "set"])

    def unpack(x: pa.Scalar) -> np.ndarray:
        short = np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, 5)
        return np.pad(short, ((0, 0), (3, 0))).view("<u8").ravel()

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = unpack(x), unpack(y)
                both = len(np.intersect1d(x, y))
                keep.append(5 * both >= 4 * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    row = F.xxhash64(*row_key(docs)).alias("row")
    sets = docs.select(row, "text").mapInArrow(sets_of, "key long, row long, set binary").join(keys, ["key", "row"], "left_semi").groupBy("key").agg(F.any_value("set").alias("set"))
    count = pairs.count()
    most = max(100, 2 * count // HOT)
    hot = F.broadcast(hubs.where(F.col("n") > most).select("ka", F.ceil(F.col("n") / most).alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    members = pairs.join(hot, "ka", "left").withColumn("salt", F.pmod(F.xxhash64("kb"), salts)).join(sets.toDF("kb", "y"), "kb").select("ka", "salt", "kb", "y")
    centres = hubs.join(hot, "ka", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).join(sets.toDF("ka", "x"), "ka").select("ka", "salt", "x")
    both = members.join(centres, ["ka", "salt"]).select(F.col("ka").alias("a"), F.col("kb").alias("b"), "x", "y")
    out = materialize(both.mapInArrow(similar, "a long, b long"))
    discard(hubs, keys)
    return out


def _possible(component: np.ndarray, key: np.ndarray, n: np.ndarray, rest: np.ndarray, sketch: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of a list that are in different components and can have a similarity of 4/5, each once, some at a time.

    Sets of x and y shingles share 4/9 (x + y) at least, and no more than what either has from the shared shingle on. So a member of n shingles
    and ``rest`` of them left allows partners of 4/5 n up to 9/4 rest - n; only the smaller ones, or equal ones before it, are tried, as they lie together in order of size.
    ``sketch``: the bits of each set as whole words, which bound what two sets share.
    """
    order = np.lexsort((key, n))
    component, key, n, rest = component[order], key[order], n[order].astype(np.int64), rest[order].astype(np.int64)
    if sketch is not None:
        bits = sketch[order]
        hidden = n - np.bitwise_count(bits).sum(axis=1)  # shingles behind another one's bit
    most = 9 * rest // 4 - n
    low = np.searchsorted(n, -(-4 * n // 5))
    high = np.minimum(np.searchsorted(n, most, "right"), np.arange(len(n)))
    size = np.maximum(high - low, 0)
    total = np.cumsum(size)
    at = 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        i = np.repeat(np.arange(at, to), size[at:to])
        j = np.repeat(low[at:to] - (np.cumsum(size[at:to]) - size[at:to]), size[at:to]) + np.arange(len(i))
        use = (component[i] != component[j]) & (most[j] >= n[i])
        i, j = i[use], j[use]
        if sketch is not None and len(i):
            enough = np.concatenate([_enough(n, hidden, bits, i[k : k + SOME], j[k : k + SOME]) for k in range(0, len(i), SOME)])
            i, j = i[enough], j[enough]
        i, j = key[i], key[j]
        if len(i):
            yield np.minimum(i, j), np.maximum(i, j)
        at = to


def _enough(n: np.ndarray, hidden: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the sketches of these pairs allow what they have to share."""
    both = np.bitwise_count(bits[i] & bits[j]).sum(axis=1) + np.minimum(hidden[i], hidden[j])
    return 9 * both >= 4 * (n[i] + n[j])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The possible pairs of each list."""
    for b in batches:
        for members in b.column("members"):
            m = members.values
            sketch = np.frombuffer(b"".join(m.field("sketch").to_pylist()), np.uint64).reshape(len(m), -1)
            for ka, kb in _possible(*(m.field(k).to_numpy() for k in ("component", "key", "n", "rest")), sketch):
                yield pa.record_batch([pa.array(ka), pa.array(kb)], names=["ka", "kb"])


def _grouped(docs: DataFrame, width: int, radius: int) -> DataFrame:
    """``KEY`` and ``label`` of every row: rows of one label are linked, directly or over others."""
    lean(docs.sparkSession)
    marked, order = _marked(docs, width)
    nodes = materialize(marked.groupBy("key").agg(F.min("fp").alias("fp"), F.min("n").alias("n"), F.min(F.xxhash64(*KEY)).alias("row"), F.any_value("sketch").alias("sketch")))

    # the closest: sets of one fingerprint and fingerprints of one ball
    least = materialize(nodes.groupBy("fp").agg(F.min("key").alias("ka")))
    same = nodes.join(least, "fp").where("key <> ka").select("ka", F.col("key").alias("kb"), F.lit(1 << 40).alias("weight"))
    spread = least.select("fp").repartition(power_of_two(least.count() / NODES, 16))
    ball = links(spread, radius).toDF("fa", "fb").join(least.toDF("fa", "ka"), "fa").join(least.toDF("fb", "kb"), "fb").select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb"), F.lit(1 << 40).alias("weight"))

    # all others: the sets that share a prefix shingle
    lists = _lists(docs, width, order, power_of_two(text_bytes(docs) / 12e6, 16))
    hubs = lists.select(F.col("members")[0].alias("ka"), F.explode(F.expr("slice(members, 2, size(members) - 1)")).alias("kb"), "weight")
    found = materialize(same.union(ball).union(hubs).groupBy("ka", "kb").agg(F.sum("weight").alias("weight")))
    pairs = materialize(_fit(found, nodes).join(found, ["ka", "kb"]))
    discard(found)
    best = materialize(pairs.groupBy("kb").agg(F.max_by("ka", F.struct("weight", -F.col("ka"))).alias("ka")).select("ka", "kb"))
    linked = _verified(docs, best, nodes, width)

    def apart(some: DataFrame, labels: DataFrame) -> DataFrame:
        ends = labels.toDF("ka", "ca"), labels.toDF("kb", "cb")
        return some.join(ends[0], "ka", "left").join(ends[1], "kb", "left").where("coalesce(ca, ka) <> coalesce(cb, kb)").select("ka", "kb")

    tried = best
    labels = materialize(components(linked))
    rest = materialize(apart(pairs.select("ka", "kb").join(tried, ["ka", "kb"], "left_anti"), labels))
    if not rest.isEmpty():
        linked = materialize(linked.union(_verified(docs, rest, nodes, width)))
        labels = materialize(components(linked))
        tried = materialize(tried.union(rest))

    member = lists.where("size(members) > 2").select("list", F.explode(F.arrays_zip("members", "rests")).alias("x")).select("list", F.col("x.members").alias("key"), F.col("x.rests").alias("rest")).join(labels.toDF("key", "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    several = member.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("list")
    member = member.join(several, "list").join(nodes.select("key", "n", "sketch"), "key")
    across = member.groupBy("list").agg(F.collect_list(F.struct("component", "key", "n", "rest", "sketch")).alias("members")).select("members").mapInArrow(_across, "ka long, kb long")
    across = materialize(across.distinct().join(tried, ["ka", "kb"], "left_anti"))
    if not across.isEmpty():
        linked = materialize(linked.union(_verified(docs, across, nodes, width)))
        labels = materialize(components(linked))
    name = materialize(nodes.join(labels.toDF("key", "component"), "key", "left").select("key", F.coalesce("component", "key").alias("label")))
    discard(lists, pairs, rest, across, tried, best)
    return marked.select(*KEY, "key").join(name, "key").select(*KEY, "label")


def near_duplicates(docs: DataFrame, width: int = 5, radius: int = 2) -> DataFrame:
    """``(doc_id, component_id)``: the smallest doc_id reachable over links of similarity 4/5 or more.

    Rows, ids and nulls count as in ``simhash_ball.near_duplicates``; texts without words are equal.
    """
    grouped = materialize(_grouped(docs.select("doc_id", "text"), width, radius))
    out = grouped.join(materialize(named_by_least(grouped, "label")), "label")
    return out.select(F.when(~F.col("k_null"), F.col("k_id")).alias("doc_id"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest id (``survivors.keep_first``); all columns stay."""
    return keep_first(docs, _grouped(docs, 5, 2), "label")
