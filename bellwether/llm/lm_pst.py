"""Probabilistic suffix tree: scoring texts with variable-length contexts.

Training counts every word of the training texts. A context (state) is a run of words that ends before a word. Contexts are
kept if their next-word distribution diverges from the one of their suffix without the oldest word. Each
distribution is smoothed towards that of its suffix, down to add-one word frequencies, so it sums to
one over the known words and one unknown word. A token is scored in the longest kept state that ends
the text before it; states do not reach over the start of a text, which counts as an end mark.

The tree has two parts. Contexts of up to ``depth`` words that make up at least ``p_min`` of all training tokens are
its top: there are at most ``1 / p_min`` of each length, and as many pairs of one and a next word, so only
these are broadcast, 20 bytes each. All other contexts hang below the top: the shortest part of a context that is
not in the top, of up to ``reach`` words, is a state of its own from ``tail_least`` occurrences on, whatever the size of the input, so what is learnt grows
with the text. No table of them is broadcast: each position goes to the bucket of its context's hash, which
counts the training positions, tests the divergence and sends back sums by text. Such a context is rare by
definition, so a bucket never gets a large group. The counts of all words are cut by hash in the same way.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .common import lean, materialize, power_of_two, text_bytes
from .tokens import LOWER, mix, slices, words

END = np.uint64(0x656E64)  # the hash of the end mark; words cannot have it but by chance


class Setup(NamedTuple):
    """``p_min`` bounds the top; ``divergence`` (nats, and a share of the count) keeps a state; ``kappa`` smooths."""

    depth: int = 4
    p_min: float = 2e-7
    least: int = 2
    reach: int = 2
    tail_least: int = 2
    kappa: float = 0.5
    divergence: float = 12.0
    divergence_share: float = 0.02


class Model(NamedTuple):
    """What is broadcast. Word ids are indices into ``vocab``; a state of depth d is a pair index of depth d-1."""

    n: int
    v: int
    vocab: np.ndarray  # sorted hashes of frequent words
    count: np.ndarray
    levels: list  # by depth: (kept states, their totals, weight of the suffix), (pair keys, pair counts)
    kappa: float


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id as text leaves 2 when divided by 7; a null id is held out."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text closed by END; of each text, its first token."""
    w = words(batch.column("text"), LOWER)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    out = np.full(first[-1], END, dtype=np.uint64)
    keep = np.ones(first[-1], dtype=bool)
    keep[first[1:] - 1] = False
    out[keep] = w.hashes
    return out, first


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        learn = pa.array([not held_out(i) for i in b.column("doc_id").to_pylist()], pa.bool_())
        yield from slices(b.filter(learn))


def _find(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted array, or -1."""
    if not len(among):
        return np.full(len(keys), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return np.where(among[at] == keys, at, -1)


def _ids(tokens: np.ndarray, first: np.ndarray, model: Model, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For depths 1 to ``depth``: of each token, the pair key (state before it, its word) or -1, and the state.

    The state of depth 1 is the word before; of depth d, the index among the pairs of depth d-1 of
    (the d-1 words before, but for the last; the last). The token before a text is END.
    """
    v = len(model.vocab)
    word = _find(tokens, model.vocab)
    start = np.zeros(len(tokens), dtype=bool)
    start[first[:-1]] = True
    state = np.concatenate(([-1], word[:-1]))
    state[start] = _find(np.array([END]), model.vocab)[0]
    for d in range(1, depth + 1):
        key = np.where((state >= 0) & (word >= 0), state * v + word, -1)
        yield key, state
        if d < depth:
            pair = np.where(key >= 0, _find(key, model.levels[d - 1][1][0]), -1)
            state = np.concatenate(([-1], pair[:-1]))
            state[start] = -1


def _count(docs: DataFrame, buckets: int, keys_of, least: int, keep_all: bool) -> DataFrame:
    """Distributed counts: rows (bucket, keys, counts) of all keys, and of the ones with ``least`` alone."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = packed.Tally(buckets)
        for b in _training(batches):
            yield from tally.add(keys_of(b))
        yield from tally.rows()

    def add_up(t: pa.Table) -> pa.Table:
        keys, counts = packed.merged(t)
        full = [int(counts.sum()), len(keys)]
        if not keep_all:
            keys, counts = keys[counts >= least], counts[counts >= least]
        return pa.table({"bucket": pa.array([t.column("bucket")[0].as_py()], pa.int32()), "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()), "total": pa.array(full[:1], pa.int64()), "kinds": pa.array(full[1:], pa.int64())})

    rows = docs.select("doc_id", "text").mapInArrow(send, packed.SCHEMA)
    return rows.groupBy("bucket").applyInArrow(add_up, packed.SCHEMA + ", total long, kinds long")


def _frequent(counted: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys counted ``least`` times or more, in order: at most total / least of them."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column("keys").to_pylist(), b.column("counts").to_pylist(), strict=True):
                k, c = np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)
                k, c = k[c >= least], c[c >= least]
                yield pa.record_batch([pa.array([k.tobytes()], pa.binary()), pa.array([c.tobytes()], pa.binary())], names=["keys", "counts"])

    return _all(counted.select("keys", "counts").mapInArrow(keep, "keys binary, counts binary"))


def _all(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All keys of rows that hold only frequent ones, in order, and their counts."""
    got = counted.select("keys", "counts").toArrow()
    keys = np.frombuffer(b"".join(got.column("keys").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(got.column("counts").to_pylist()), np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def _base(model: Model, count: np.ndarray) -> np.ndarray:
    return (count + 1) / (model.n + model.v + 1)


def _keep_states(model: Model, d: int, keys: np.ndarray, counts: np.ndarray, setup: Setup) -> tuple:
    """The states of depth ``d`` whose distribution diverges from their suffix's; totals and weights of the rest."""
    v = max(len(model.vocab), 1)
    state, word = keys // v, keys % v
    ids, at = np.unique(state, return_index=True)
    if d == 1:
        total = model.count[ids] if len(ids) else np.zeros(0, np.int64)
        below = _base(model, model.count[word])
    else:
        above_keys, above_counts = model.levels[d - 2][1]
        total = above_counts[ids]
        # the suffix of (.., a, b) is (b) at depth 1 or the pair of the shorter context
        suffix = _suffix(model, d, ids)
        below = _probability(model, d - 1, np.repeat(suffix, np.diff(np.append(at, len(keys)))), word, _base(model, model.count[word]))
    here = counts / np.repeat(total, np.diff(np.append(at, len(keys)))) if len(keys) else np.zeros(0)
    gain = np.add.reduceat(counts * np.log(here / below), at) if len(keys) else np.zeros(0)
    kept = gain >= np.maximum(setup.divergence, setup.divergence_share * total)
    seen = np.add.reduceat(counts, at) if len(keys) else np.zeros(0)
    return ids[kept], total[kept], (total - seen)[kept] + setup.kappa


def _suffix(model: Model, d: int, ids: np.ndarray) -> np.ndarray:
    """The state of depth d-1 that ends each state of depth d, or -1."""
    v = len(model.vocab)
    pair = model.levels[d - 2][1][0][ids]  # (state of depth d-1, last word)
    if d == 2:
        return pair % v
    before = _suffix(model, d - 1, pair // v)
    return np.where(before >= 0, _find(before * v + pair % v, model.levels[d - 3][1][0]), -1)


def _probability(model: Model, d: int, state: np.ndarray, word: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Smoothed probability of each word in the state of depth ``d``, falling back along suffixes."""
    chain = [state]
    for k in range(d, 1, -1):
        s = chain[-1]
        out = np.full(len(s), -1, dtype=np.int64)
        known = s >= 0
        out[known] = _suffix(model, k, s[known])
        chain.append(out)
    p = base
    for k, s in zip(range(1, d + 1), reversed(chain), strict=True):
        p = _step(model, k, s, np.where((s >= 0) & (word >= 0), s * len(model.vocab) + word, -1), p, model.kappa)
    return p


def _step(model, d: int, state: np.ndarray, key: np.ndarray, p: np.ndarray, kappa: float) -> np.ndarray:
    """Probabilities in the states of depth ``d`` that are kept; elsewhere those of the suffix stay."""
    (ids, total, back), (keys, counts) = model.levels[d - 1]
    at = _find(state, ids)
    use = np.flatnonzero(at >= 0)
    pair = _find(key[use], keys)
    c = np.where(pair >= 0, counts[pair] if len(counts) else 0, 0)
    out = p.copy()
    out[use] = (c + back[at[use]] * p[use]) / (total[at[use]] + kappa)
    return out


def train(docs: DataFrame, setup: Setup = Setup()) -> tuple[Model, DataFrame, int]:
    """Learn from the training rows of ``docs(doc_id, text)``.

    Returns the broadcastable model, the table of all word counts and its number of buckets.
    """
    lean(docs.sparkSession)
    buckets = power_of_two(text_bytes(docs) / 12e6, 16)
    counted = materialize(_count(docs, buckets, lambda b: _tokens(b)[0], 1, True))
    n, v = (x or 0 for x in counted.agg(F.sum("total"), F.sum("kinds")).first())
    least = max(setup.least, int(np.ceil(setup.p_min * n)))
    vocab, count = _frequent(counted, least)
    model = Model(n, v, vocab, count, [], setup.kappa)
    for d in range(1, setup.depth + 1):
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def keys_of(b: pa.RecordBatch, d=d, shared=shared) -> np.ndarray:
            *_, (key, _) = _ids(*_tokens(b), shared.value, d)
            return key[key >= 0].astype(np.uint64)

        keys, counts = _all(_count(docs, buckets, keys_of, least, False))
        keys = keys.astype(np.int64)
        model.levels.append((_keep_states(model, d, keys, counts, setup), (keys, counts)))
    return model, counted.select("bucket", "keys", "counts"), buckets


def _tail_roots(tokens: np.ndarray, first: np.ndarray, states: list[np.ndarray], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions whose context leaves the top within ``reach`` words, and a hash of the shortest part that does."""
    left = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first)) + 1  # words before the token within its text, the end mark too
    root, inside = np.zeros(len(tokens), dtype=np.uint64), np.ones(len(tokens), dtype=bool)
    hashed, found = np.zeros(len(tokens), dtype=np.uint64), np.zeros(len(tokens), dtype=bool)
    for d in range(1, reach + 1):
        before = np.concatenate((np.full(min(d, len(tokens)), END, dtype=np.uint64), tokens[: max(len(tokens) - d, 0)]))
        hashed = mix(hashed * np.uint64(3) + before + np.uint64(d))
        here = inside & (left >= d) & (states[d - 1] < 0)
        root[here], found[here] = hashed[here], True
        inside &= (left >= d) & (states[d - 1] >= 0)
    at = np.flatnonzero(found)
    return at, root[at]


def _tail_gains(context: np.ndarray, word: np.ndarray, p: np.ndarray, train: np.ndarray, setup: Setup) -> np.ndarray:
    """Of each position, log10 of its probability in the state of its context over ``p``, that of the top; 0 if it is no state."""
    ids, at = np.unique(context, return_inverse=True)
    total = np.bincount(at[train], minlength=len(ids))
    learnt = train & (word >= 0)
    seen = np.bincount(at[learnt], minlength=len(ids))
    pair = at.astype(np.int64) << 32 | np.maximum(word, 0)
    keys, counts = np.unique(pair[learnt], return_counts=True)
    found = _find(pair, keys)
    c = np.where((found >= 0) & (word >= 0), counts[found] if len(counts) else 0, 0)
    gain = np.bincount(at[learnt], weights=np.log(c[learnt] / total[at[learnt]] / p[learnt]), minlength=len(ids))
    kept = (total >= setup.tail_least) & (gain >= np.maximum(setup.divergence, setup.divergence_share * total))
    back = (total - seen + setup.kappa)[at]
    whole = total[at] + setup.kappa
    out = np.where(word >= 0, np.log10((c + back * p) / whole / p), np.log10(back / whole))
    return np.where(kept[at], out, 0.0)


WORDS, RARE, TEXTS, TAIL = range(4)  # kinds of rows that meet in a bucket
POSITION = np.dtype([("context", "<u4"), ("word", "<i4"), ("p", "<f4")])


def _planes(x: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on: the shuffle's compression finds the many equal ones."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b""


def _values(raw: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def score(docs: DataFrame, model: Model, counted: DataFrame, buckets: int, setup: Setup = Setup()) -> DataFrame:
    """Score every text. Null texts are empty; rows stay apart even if ids repeat; other columns are dropped."""
    lean(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bits = buckets.bit_length() - 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for seq, b in enumerate(part for b in batches for part in slices(b, most=1 << 20)):
            tokens, first = _tokens(b)
            doc = np.repeat(np.arange(b.num_rows), np.diff(first))
            word = _find(tokens, m.vocab)
            known = word >= 0
            p = _base(m, np.where(known, m.count[word] if len(m.count) else 0, 0))
            # a rare word keeps its place as the factor before its own frequency, which is added later
            base = np.log10(p)
            p = np.where(known, p, 1e-12)
            states = []
            for d, (key, state) in enumerate(_ids(tokens, first, m, len(m.levels)), 1):
                p = _step(m, d, state, key, p, m.kappa)
                states.append(state)
            value = np.where(known, np.log10(p), np.log10(p) + 12 - np.log10(m.n + m.v + 1))
            ids = b.column("doc_id").to_pylist()
            held = np.array([held_out(i) for i in ids], dtype=bool)
            here = {
                "ids": ids,
                "held": held.tolist(),
                "tokens": np.diff(first),
                "known": np.bincount(doc[known], minlength=len(ids)),
                "base": np.bincount(doc, weights=base, minlength=len(ids)),
                "score": np.bincount(doc, weights=value, minlength=len(ids)),
            }
            rare = np.flatnonzero(~known)
            key = TaskContext.get().partitionId() << 24 | seq
            order, bound = packed.cut(tokens[rare], buckets)
            rare = rare[order]
            out = [(k, RARE, tokens[r := rare[bound[k] : bound[k + 1]]].tobytes(), doc[r].astype(np.uint32).tobytes()) for k in range(buckets) if bound[k] < bound[k + 1]]
            at, context = _tail_roots(tokens, first, states, min(setup.reach, len(states)))
            order, bound = packed.cut(context, buckets)
            at, context = at[order], context[order]
            rows = np.empty(len(at), dtype=POSITION)
            # within a bucket 32 further bits tell contexts apart
            rows["context"], rows["word"], rows["p"] = mix(context) >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF), word[at], p[at]
            text = (doc[at] << 1 | ~held[doc[at]]).astype(np.uint32)
            out += [(k, TAIL, _planes(rows[bound[k] : bound[k + 1]]), _planes(text[bound[k] : bound[k + 1]])) for k in range(buckets) if bound[k] < bound[k + 1]]
            out.append((key % buckets, TEXTS, pickle.dumps(here), b""))
            bucket, kind, keys, counts = zip(*out, strict=True)
            yield pa.record_batch(
                [pa.array(bucket, pa.int32()), pa.array([key] * len(out), pa.int64()), pa.array(kind, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                names=["bucket", "sender", "kind", "keys", "counts"],
            )

    def look_up(t: pa.Table) -> pa.Table:
        rows: list[list[tuple[int, bytes, bytes]]] = [[], [], [], []]
        for k, *row in zip(t.column("kind").to_pylist(), t.column("sender").to_pylist(), t.column("keys").to_pylist(), t.column("counts").to_pylist(), strict=True):
            rows[k].append(tuple(row))
        known, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, k, c in rows[WORDS]:
            known, count = np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)
        out = [(s, k, b"") for s, k, _ in rows[TEXTS]]
        for s, k, c in rows[RARE]:
            at = _find(np.frombuffer(k, np.uint64), known)
            docs_, where = np.unique(np.frombuffer(c, np.uint32), return_inverse=True)
            got = np.where(at >= 0, count[at] if len(count) else 0, 0)
            out.append((s, docs_.tobytes(), np.concatenate((np.bincount(where, weights=np.log10(got + 1.0)), np.bincount(where, weights=at >= 0), np.zeros(len(docs_)))).tobytes()))
        if rows[TAIL]:
            x = np.concatenate([_values(k, POSITION) for _, k, _ in rows[TAIL]])
            text = np.concatenate([_values(c, np.dtype(np.uint32)) for *_, c in rows[TAIL]])
            gain = _tail_gains(x["context"], x["word"].astype(np.int64), x["p"].astype(np.float64), (text & 1).astype(bool), setup)
            bound = np.cumsum([0, *(len(c) // 4 for *_, c in rows[TAIL])])
            for (s, *_), i, j in zip(rows[TAIL], bound, bound[1:], strict=False):
                use = i + np.flatnonzero(gain[i:j])
                if len(use):
                    docs_, where = np.unique(text[use] >> 1, return_inverse=True)
                    out.append((s, docs_.tobytes(), np.concatenate((np.zeros(2 * len(docs_)), np.bincount(where, weights=gain[use]))).tobytes()))
        return pa.table({"sender": pa.array([x[0] for x in out], pa.int64()), "keys": pa.array([x[1] for x in out], pa.binary()), "sums": pa.array([x[2] for x in out], pa.binary())})

    def gather(t: pa.Table) -> pa.Table:
        here, parts = [], []
        for k, c in zip(t.column("keys").to_pylist(), t.column("sums").to_pylist(), strict=True):
            if c:
                parts.append((np.frombuffer(k, np.uint32), np.frombuffer(c, np.float64).reshape(3, -1)))
            else:
                here.append(pickle.loads(k))
        (x,) = here
        log, known, gain = np.zeros((3, len(x["ids"])))
        for d, (a, b, c) in parts:
            log[d] += a
            known[d] += b
            gain[d] += c
        return pa.table(
            {
                "doc_id": pa.array(x["ids"], pa.int64()),
                "held_out": pa.array(x["held"], pa.bool_()),
                "n_tokens": pa.array(x["tokens"], pa.int64()),
                "n_known": pa.array(x["known"] + known.astype(np.int64), pa.int64()),
                "base_score": pa.array(x["base"] + log, pa.float64()),
                "score": pa.array(x["score"] + log + gain, pa.float64()),
            }
        )

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(send, "bucket int, sender long, kind int, keys binary, counts binary")
    table = counted.select("bucket", F.lit(None).cast("long").alias("sender"), F.lit(WORDS).alias("kind"), "keys", "counts")
    sums = asked.union(table).groupBy("bucket").applyInArrow(look_up, "sender long, keys binary, sums binary")
    return sums.groupBy("sender").applyInArrow(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double").withColumn("train_tokens", F.lit(model.n).cast("long"))


def score_documents(docs: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """Train on the rows that are not held out and score all rows; an empty table gives no rows."""
    model, counted, buckets = train(docs, setup)
    return score(docs, model, counted, buckets, setup)
