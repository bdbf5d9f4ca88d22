"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters, lower-cased A-Z. A text's features are the distinct hashes, modulo
``bits``, of its words, its word pairs and its pairs that skip one word. FTRL-proximal keeps a
learning rate by coordinate, and its L1 term leaves most weights at exactly zero, so the weights that
are broadcast are few and never more than ``2**bits``.

Labels come from a sample of at most ``most`` labelled rows, the smallest by a hash of their id
(a documented bound; a top-k, so no label table is too large). Features of the sample are made by
tasks; one task learns from them. Every text is scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import lean
from .survivors import column, free_name
from .tokens import LOWER, NOT_LETTER, mix, slices, words


class Setup(NamedTuple):
    bits: int = 20
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    passes: int = 4
    most: int = 10_000
    threshold: float = 0.7


def held_out(column: str) -> F.Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def hashed(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All features of all texts as (index of the text, feature), with repeats."""
    w = words(column, LOWER, NOT_LETTER)
    h, doc = w.hashes, np.repeat(np.arange(len(column), dtype=np.int64), np.diff(w.first))
    cut = np.uint64(64 - bits)
    two, skip = mix(h[:-1] * np.uint64(3) + h[1:]), mix(h[:-2] * np.uint64(5) + h[2:] + np.uint64(1))
    same, same2 = doc[:-1] == doc[1:], doc[:-2] == doc[2:]
    return np.concatenate((doc, doc[:-1][same], doc[:-2][same2])), np.concatenate((h, two[same], skip[same2])) >> cut


def learn(rows: list[tuple[np.ndarray, int]], setup: Setup) -> tuple[np.ndarray, np.ndarray, float]:
    """Per-coordinate FTRL-proximal over (distinct features, label): indices and values of non-zero weights, and the bias."""
    z, n = np.zeros(1 << setup.bits), np.zeros(1 << setup.bits)
    bias = bias_n = 0.0

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= setup.l1, 0.0, (np.sign(zi) * setup.l1 - zi) / ((setup.beta + np.sqrt(n[i])) / setup.alpha + setup.l2))

    for _ in range(setup.passes):
        for i, y in rows:
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - y
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / setup.alpha * w
            bias_n += g * g
            bias -= setup.alpha * g / (1 + np.sqrt(bias_n))
    w = weights(np.arange(1 << setup.bits))
    at = np.flatnonzero(w)
    return at, w[at], bias


def train(docs: DataFrame, labels: DataFrame, setup: Setup = Setup()) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights learnt from labelled rows that are not held out. No labels, or labels of one kind, give that share as bias.

    Labels of one id that disagree count as toxic if any does; null labels and ids do not count. Of the texts of one
    id the smallest is learnt from, whatever the order of rows.
    """
    lean(docs.sparkSession)
    sample = (
        labels.where(~held_out("doc_id") & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(setup.most)
    )
    # at most setup.most rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for b in batches for part in slices(b, most=1 << 20)):
            doc, f = hashed(b.column("text"), setup.bits)
            key = np.unique((doc.astype(np.uint64) << np.uint64(32)) | f)
            bound = np.searchsorted(key >> np.uint64(32), np.arange(b.num_rows + 1))
            f = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield pa.record_batch([b.column("doc_id"), b.column("toxic"), pa.array([f[x:y].tobytes() for x, y in zip(bound, bound[1:], strict=False)], pa.binary())], names=["doc_id", "toxic", "f"])

    def fit(t: pa.Table) -> pa.Table:
        order = sorted(range(t.num_rows), key=lambda k: (zlib.crc32(str(ids[k]).encode()), ids[k])) if (ids := t.column("doc_id").to_pylist()) else []
        f, y = t.column("f"), t.column("toxic").to_pylist()
        at, w, bias = learn([(np.frombuffer(f[k].as_buffer(), np.uint32), y[k]) for k in order], setup)
        return pa.table({"at": pa.array([at.astype(np.uint32).tobytes()], pa.binary()), "w": pa.array([w.tobytes()], pa.binary()), "bias": pa.array([bias], pa.float64())})

    got = texts.mapInArrow(feature, "doc_id long, toxic int, f binary").withColumn("task", F.lit(0)).groupBy("task").applyInArrow(fit, "at binary, w binary, bias double").first()
    if got is None:
        return np.zeros(0, np.int64), np.zeros(0), -2.0
    return np.frombuffer(bytes(got["at"]), np.uint32).astype(np.int64), np.frombuffer(bytes(got["w"]), np.float64), got["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], setup: Setup = Setup()) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; null and empty texts get the bias alone. All rows stay.

    Columns of the result's names are replaced.
    """
    lean(docs.sparkSession)
    name = free_name(docs, "row")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = shared.value
        dense = np.zeros(1 << setup.bits)
        dense[at] = w
        for b in batches:
            row = b.column(name)
            total = [np.zeros(0)]
            for part in slices(pa.record_batch([row.field("text")], names=["text"]), most=1 << 20):
                doc, f = hashed(part.column("text"), setup.bits)
                some = np.flatnonzero(dense[f] != 0)
                key = np.unique((doc[some].astype(np.uint64) << np.uint64(32)) | f[some])
                total.append(bias + np.bincount((key >> np.uint64(32)).astype(np.int64), weights=dense[key & np.uint64(0xFFFFFFFF)], minlength=part.num_rows))
            score_ = 1 / (1 + np.exp(-np.clip(np.concatenate(total), -35, 35)))
            yield pa.record_batch([row, pa.array(score_)], names=[name, "score"])

    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    rows = docs.select(F.struct(*map(column, kept)).alias(name))
    out = rows.mapInArrow(rate, StructType([*rows.schema.fields, StructField("score", DoubleType())]))
    return out.select(f"{name}.*", "score", (F.col("score") >= setup.threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``."""
    out = score(docs.select("doc_id", "text"), train(docs, labels, setup), setup)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    model = train(docs, labels, setup)
    if {"score", "predicted"} & {c.lower() for c in docs.columns}:
        named = docs.select(F.struct(*map(column, docs.columns)).alias("row"), "text")
        return score(named, model, setup).where("predicted = 0").select("row.*")
    return score(docs, model, setup).where("predicted = 0").select(*map(column, docs.columns))
