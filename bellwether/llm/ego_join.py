"""Embedding near-duplicates by an epsilon grid order join.

Two unit vectors with cosine t are sqrt(2 - 2t) apart, and no further apart on any projection. Vectors
are projected on leading principal directions (fitted on a bounded sample; they decide what is
skipped, never what is linked), put in the order of their grid cells with that side length, and cut into
blocks of the sequence. Pairs of blocks whose bounding boxes are too far apart are never made; the
others are joined by halving both intervals until boxes are too far apart or small enough to compare all.

Equal vectors are folded into one with a weight first, and a task returns one row per vector and pair of
blocks (weight of its links, and a root of its local component), so a large group of copies neither
makes one large group of rows nor all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, lean, materialize


class Setup(NamedTuple):
    threshold: float = 0.9
    block: int = 4096
    leaf: int = 256
    axes: int = 16
    cells: int = 8
    keys: int = 2
    sample: int = 4096


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # the largest component first, so that no square leaves the range of doubles
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def principal(sample: np.ndarray, axes: int) -> np.ndarray:
    """Leading principal directions as columns."""
    x = _unit(sample)
    _, _, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    return v[:axes].T


def join_blocks(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, direction: np.ndarray, setup: Setup, same: bool) -> tuple[np.ndarray, ...]:
    """Weights of the links of each vector of ``a`` and of ``b``, and the linked pairs thinned to a spanning forest (labels)."""
    reach = 2 - 2 * setup.threshold + 1e-9
    a, b = _unit(a), _unit(b)
    pa_, pb = a @ direction, b @ direction
    la, lb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    label = np.arange(len(a) + len(b))  # of a, then of b; one block with itself uses those of a alone

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    def link(i0: int, i1: int, j0: int, j1: int) -> None:
        mask = a[i0:i1] @ b[j0:j1].T >= setup.threshold
        if same and i0 == j0:
            np.fill_diagonal(mask, False)
        if not mask.any():
            return
        la[i0:i1] += mask @ wb[j0:j1]
        if not (same and i0 == j0):
            lb[j0:j1] += wa[i0:i1] @ mask
        # a forest is enough for components: each row to its first column, each column to its first row, until all agree
        rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        sub = mask[np.ix_(rows, columns)]
        mark_r = np.arange(len(rows))
        big = len(rows)
        while True:
            mark_c = np.where(sub, mark_r[:, None], big).min(axis=0)
            new = np.where(sub, mark_c[None, :], big).min(axis=1)
            if (new == mark_r).all():
                break
            mark_r = new
        shift = 0 if same else len(a)
        for k, m in [*zip(rows + i0, rows[mark_r] + i0, strict=True), *zip(columns + j0 + shift, rows[mark_c] + i0, strict=True)]:
            x, y = root(int(k)), root(int(m))
            label[max(x, y)] = min(x, y)

    def visit(i0: int, i1: int, j0: int, j1: int) -> None:
        gap = np.maximum(0, np.maximum(pb[j0:j1].min(axis=0) - pa_[i0:i1].max(axis=0), pa_[i0:i1].min(axis=0) - pb[j0:j1].max(axis=0)))
        if (gap * gap).sum() > reach:
            return
        if max(i1 - i0, j1 - j0) <= setup.leaf:
            link(i0, i1, j0, j1)
            return
        for x0, x1 in _halves(i0, i1, setup.leaf):
            for y0, y1 in _halves(j0, j1, setup.leaf):
                if not same or x0 <= y0:
                    visit(x0, x1, y0, y1)

    visit(0, len(a), 0, len(b))
    for i in range(len(label)):
        label[i] = root(i)
    return la, lb, label


def _halves(i: int, j: int, leaf: int) -> list[tuple[int, int]]:
    if j - i <= leaf:
        return [(i, j)]
    middle = i + (j - i + 1) // 2
    return [(i, middle), (middle, j)]


def near_duplicates(vectors: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of each row of ``vectors(vec_id, embedding)``.

    Null and zero vectors, vectors with null or non-finite components and rows without an id link with
    nothing; vectors of different lengths do not link. Rows with one id are one vertex. Other columns,
    labels among them, are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    lean(spark)
    inf = float("inf")
    fine = F.coalesce(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, F.col("embedding")).alias("embedding"))
    rows = rows.withColumn("k1", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding"))).withColumn("k2", F.when(F.col("embedding").isNotNull(), F.xxhash64(F.lit(1), F.reverse("embedding"))))
    distinct = materialize(rows.where("embedding is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.any_value("embedding").alias("embedding")))
    linked = None
    for length, count in sorted(tuple(r) for r in distinct.groupBy(F.size("embedding")).count().collect()):
        one = _links(distinct.where(F.size("embedding") == length), count, setup)
        linked = one if linked is None else linked.union(one)
    if linked is None:
        linked = spark.createDataFrame([], "node long, root long, links long")
    linked = materialize(linked)
    found = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    totals = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named = distinct.select("k1", "k2", "node", "weight").join(totals, "node", "left").join(found, "node", "left")
    named = named.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = rows.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(distinct: DataFrame, count: int, setup: Setup) -> DataFrame:
    """``(node, root, links)`` rows of vectors of one length."""
    spark = distinct.sparkSession
    sample = distinct.orderBy(F.xxhash64("node"), "node").limit(setup.sample).select("embedding").toArrow()
    direction = principal(_matrix(sample.column("embedding").combine_chunks()), setup.axes)
    epsilon = float(np.sqrt(2 - 2 * setup.threshold))
    shared = spark.sparkContext.broadcast(direction)  # length x axes

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell = np.floor(_unit(_matrix(b.column("embedding"))) @ shared.value[:, : setup.cells] / epsilon).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(cell) + 1, dtype=np.int32) * cell.shape[1]), pa.array(cell.ravel()))
                yield pa.record_batch([cells, *(b.column(c) for c in ("node", "weight", "embedding"))], names=["cells", "node", "weight", "embedding"])

    kind = distinct.schema["embedding"].dataType.simpleString()
    ordered = distinct.select("node", "weight", "embedding").mapInArrow(place, f"cells array<int>, node long, weight long, embedding {kind}")
    parts = max(1, round(count / setup.block))
    ordered = ordered.repartitionByRange(parts, "cells", F.xxhash64("node")).sortWithinPartitions("cells", "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held, n = [*held, b], n + b.num_rows
            while n >= 2 * setup.block:
                t = pa.Table.from_batches(held)
                yield from block(t.slice(0, setup.block))
                held, n = t.slice(setup.block).combine_chunks().to_batches(), n - setup.block
        if n:
            yield from block(pa.Table.from_batches(held))

    def block(t: pa.Table) -> Iterator[pa.RecordBatch]:
        raw = _matrix(t.column("embedding").combine_chunks())
        p = _unit(raw) @ shared.value
        node = t.column("node").to_numpy()
        yield pa.record_batch(
            [
                pa.array([int(node[0])], pa.int64()),
                pa.array([p.min(axis=0).tolist()], pa.list_(pa.float64())),
                pa.array([p.max(axis=0).tolist()], pa.list_(pa.float64())),
                pa.array([node.tobytes()], pa.binary()),
                pa.array([t.column("weight").to_numpy().tobytes()], pa.binary()),
                pa.array([raw.tobytes()], pa.binary()),
            ],
            names=["block", "low", "high", "nodes", "weights", "vectors"],
        )

    blocks = materialize(ordered.mapInArrow(cut, "block long, low array<double>, high array<double>, nodes binary, weights binary, vectors binary"))
    # blocks meet in the cells of the leading axes that they touch: one side with the neighbouring cells
    left = blocks.select(F.col("block").alias("a"), F.col("low").alias("al"), F.col("high").alias("ah"))
    right = blocks.select(F.col("block").alias("b"), F.col("low").alias("bl"), F.col("high").alias("bh"))
    keys = [f"cell{k}" for k in range(min(setup.keys, direction.shape[1]))]
    for k, name in enumerate(keys):
        left = left.withColumn(name, F.explode(F.sequence(F.floor(F.col("al")[k] / epsilon) - 1, F.floor(F.col("ah")[k] / epsilon) + 1)))
        right = right.withColumn(name, F.explode(F.sequence(F.floor(F.col("bl")[k] / epsilon), F.floor(F.col("bh")[k] / epsilon))))
    gap = F.zip_with(F.zip_with("al", "bh", lambda x, y: x - y), F.zip_with("bl", "ah", lambda x, y: x - y), lambda x, y: F.greatest(F.lit(0.0), x, y))
    near = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= epsilon * epsilon + 1e-9
    pairs = left.join(right, keys).where((F.col("a") <= F.col("b")) & near).select("a", "b").distinct()
    side = lambda s: blocks.select(F.col("block").alias(s), F.col("nodes").alias(f"n{s}"), F.col("weights").alias(f"w{s}"), F.col("vectors").alias(f"v{s}"))
    pairs = materialize(pairs)
    alone = blocks.select(F.col("block").alias("a"), F.col("block").alias("b"), F.col("nodes").alias("na"), F.col("weights").alias("wa"), F.col("vectors").alias("va"))
    nothing = F.lit(None).cast("binary")
    work = pairs.where("a < b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "wa", "va", "nb", "wb", "vb")
    work = work.union(alone.select("*", nothing.alias("nb"), nothing.alias("wb"), nothing.alias("vb")))
    dtype = np.float64 if "double" in kind else np.float32

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column("a")[k] == batch.column("b")[k]
                (na, wa), va = (np.frombuffer(batch.column(c)[k].as_buffer(), np.int64) for c in ("na", "wa")), np.frombuffer(batch.column("va")[k].as_buffer(), dtype).reshape(-1, width)
                nb, wb, vb = na, wa, va
                if not same:
                    (nb, wb), vb = (np.frombuffer(batch.column(c)[k].as_buffer(), np.int64) for c in ("nb", "wb")), np.frombuffer(batch.column("vb")[k].as_buffer(), dtype).reshape(-1, width)
                la, lb, label = join_blocks(va, vb, wa, wb, shared.value, setup, same)
                node = na if same else np.concatenate((na, nb))
                links = la + lb if same else np.concatenate((la, lb))
                hit = np.flatnonzero(links)
                yield pa.record_batch([pa.array(node[hit]), pa.array(node[label[hit]]), pa.array(links[hit])], names=["node", "root", "links"])

    return work.mapInArrow(compare, "node long, root long, links long")
