"""Products of all pairs of a panel's series by tiles: similarity, masked pairs, permutation nulls, spectra.

A panel stays long, (ticker, bar_date, value). Its series are packed by ticker and block of days, tickers are dealt to tiles, and
a task gets the series of two tiles for one block: one matrix product gives all their pairs, partial sums of blocks are added. So N x N
pairs cost N / TILE copies of the panel in the exchange, not N copies of each session, and nothing is collected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize

TILE = 64  # tickers in a tile, about
DAYS = 4096  # calendar days in a block
CELLS = 1 << 23  # numbers that a task holds of each of its two tiles
FAN_IN = 8  # triangles that a task joins


def series(e: DataFrame, value: str, days: int = DAYS) -> DataFrame:
    """``(ticker, part, cells)``: of each block of days the days and values of a ticker."""
    day = F.datediff("bar_date", F.lit("1970-01-01").cast("date"))
    rows = e.select("ticker", F.floor(day / days).alias("part"), F.struct(day.alias("t"), F.col(value).cast("double").alias("v")).alias("cell"))
    return rows.groupBy("ticker", "part").agg(F.collect_list("cell").alias("cells"))


def by_tiles(packed: DataFrame, tile: int = TILE) -> DataFrame:
    """Each row of ``packed`` once for every pair of tiles that its ticker's tile is in: ``(a, b, mine, ...)``, ``a <= b``."""
    tiles = max(1, -(-packed.select("ticker").distinct().count() // tile))
    mine = F.pmod(F.xxhash64("ticker"), F.lit(tiles)).cast("int")
    out = packed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    return out.withColumn("a", F.least("mine", "other")).withColumn("b", F.greatest("mine", "other")).drop("other")


def dense(cells: pa.ChunkedArray, days: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values (0 where there is none) and which are there, one row a series and one column a day; and the days."""
    column = cells.combine_chunks()
    flat = column.flatten()
    t, v = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("t", "v"))
    days = np.unique(t) if days is None else days
    row = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    values, there = np.zeros((len(column), len(days))), np.zeros((len(column), len(days)))
    at = np.searchsorted(days, t)
    values[row, at], there[row, at] = v, 1
    return values, there, days


Product = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]]


def pair_sums(packed: DataFrame, product: Product, names: list[str], tile: int = TILE) -> DataFrame:
    """``(i, j, <names>)`` for ``i <= j``: sums over blocks of what ``product(x, has_x, y, has_y)`` gives for the rows of x against those of y."""

    def run(table: pa.Table) -> pa.Table:
        values, there, _ = dense(table["cells"])
        ticker, mine = table["ticker"].to_pylist(), table["mine"].to_numpy()
        first, second = (np.flatnonzero(mine == table[k][0].as_py()) for k in ("a", "b"))
        sums = product(values[first], there[first], values[second], there[second])
        mirrored = product(values[second], there[second], values[first], there[first])
        i, j = (x.ravel() for x in np.meshgrid(first, second, indexing="ij"))
        name = np.array(ticker, dtype=object)
        ordered = name[i] <= name[j]
        same = table["a"][0].as_py() == table["b"][0].as_py()
        keep = np.flatnonzero(ordered) if same else np.arange(len(i))
        low, high = np.where(ordered, name[i], name[j])[keep], np.where(ordered, name[j], name[i])[keep]
        columns = [np.where(ordered, sums[k].ravel(), mirrored[k].T.ravel())[keep] for k in names]
        return pa.table([pa.array(low, pa.string()), pa.array(high, pa.string()), *map(pa.array, columns)], names=["i", "j", *names])

    parts = by_tiles(packed, tile).groupBy("a", "b", "part").applyInArrow(run, "i string, j string, " + ", ".join(f"{k} double" for k in names))
    return parts.groupBy("i", "j").agg(*(F.sum(k).alias(k) for k in names))


def products(x: np.ndarray, _x: np.ndarray, y: np.ndarray, _y: np.ndarray) -> dict[str, np.ndarray]:
    return {"s": x @ y.T}


def masked_products(x: np.ndarray, has_x: np.ndarray, y: np.ndarray, has_y: np.ndarray) -> dict[str, np.ndarray]:
    """All moments of pairs over what both have, as products of values, squares and masks."""
    return {"t": has_x @ has_y.T, "sx": x @ has_y.T, "sy": has_x @ y.T, "xx": (x * x) @ has_y.T, "yy": has_x @ (y * y).T, "xy": x @ y.T}


# ---- nulls


def centred_distances(x: np.ndarray) -> np.ndarray:
    """Doubly centred distances of each row, flat, one row a series."""
    far = np.abs(x[:, :, None] - x[:, None, :])
    mean = far.mean(axis=2)
    return far - mean[:, :, None] - mean[:, None, :] + mean.mean(axis=1)[:, None, None]


def standardised(x: np.ndarray) -> np.ndarray:
    x = x - x.mean(axis=1, keepdims=True)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-15)


def left_out(p: np.ndarray, k: int) -> np.ndarray:
    """Coverage of the tickers that greedy selection of ``k`` on the similarity ``p`` leaves out."""
    c, chosen = np.zeros(len(p)), []
    for _ in range(min(k, len(p))):
        gain = np.maximum(0, p - c[:, None]).sum(axis=0)
        gain[chosen] = -1
        chosen.append(int(gain.argmax()))
        c = np.maximum(c, p[:, chosen[-1]])
    return np.delete(c, chosen)


def permuted_similarities(first: np.ndarray, second: np.ndarray, same: bool, draws: list[dict[int, np.ndarray]], numbers: tuple[np.ndarray, np.ndarray], measure: str) -> Iterator[np.ndarray]:
    """For each draw the similarities of the rows of two tiles, each row permuted by its own permutation.

    Distance matrices are made and centred once; a draw permutes their rows and columns, which leaves means and norms as they are.
    """
    if measure == "rho2":
        a = standardised(first)
        b = a if same else standardised(second)
        for perms in draws:
            x = np.stack([row[perms[n]] for row, n in zip(a, numbers[0], strict=True)])
            y = x if same else np.stack([row[perms[n]] for row, n in zip(b, numbers[1], strict=True)])
            yield np.minimum(1, (x @ y.T) ** 2)
        return
    a = centred_distances(first)
    b = a if same else centred_distances(second)
    norm = [np.sqrt((x * x).sum(axis=(1, 2))) for x in (a, b)]
    scale = np.outer(*norm)
    for perms in draws:
        x = np.stack([m[perms[n]][:, perms[n]].ravel() for m, n in zip(a, numbers[0], strict=True)])
        y = x if same else np.stack([m[perms[n]][:, perms[n]].ravel() for m, n in zip(b, numbers[1], strict=True)])
        # squared distance correlation: covariance over the root of the product of variances
        yield np.clip(np.divide(x @ y.T, scale, out=np.zeros_like(scale), where=scale > 0), 0, 1)


def permutation_null(e: DataFrame, k: int, replicates: int = 1000, seed: int = 7, measure: str = "rho2", per_task: int = 32, tile: int = TILE) -> DataFrame:
    """Percentiles of non-anchor coverage when each ticker's series is shuffled in itself (G16), for ``rho2`` or ``dcor2``.

    ``per_task`` replicates of two tiles of series are one task, so neither the panel nor a replicate's similarities pass through the driver; the tiles of one
    replicate then meet for its greedy selection, N x N numbers. Replicate ``r`` draws its permutations from the seed ``[seed, r]``, in the order of tickers.
    ``e`` has the same sessions for every ticker; no rows give no coverage.
    """
    if measure not in ("rho2", "dcor2"):
        raise ValueError(f"no such measure: {measure}")
    rows = e.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("bar_date", F.col("e").cast("double").alias("e")))).alias("v")).select("ticker", F.transform("v", lambda x: x["e"]).alias("v"))
    rows = materialize(rows.withColumn("n", F.row_number().over(W.orderBy("ticker")) - 1))  # one row a ticker
    total, t = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if measure == "dcor2":
        tile = max(1, min(tile, CELLS // max(1, t * t)))
    tiles, tasks = max(1, -(-total // tile)), -(-replicates // per_task)
    work = rows.withColumn("mine", F.floor(F.col("n") / tile).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    work = work.select(F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "task", "mine", "n", "v").repartition(min(tasks * tiles * (tiles + 1) // 2, 4096), "a", "b", "task")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("n")
        a, b, task = (table[c][0].as_py() for c in ("a", "b", "task"))
        numbers, mine = table["n"].to_numpy(), table["mine"].to_numpy()
        x = table["v"].combine_chunks().flatten().to_numpy().reshape(len(numbers), t)
        sides = (mine == a, mine == b)
        wanted = range(task * per_task, min(replicates, (task + 1) * per_task))
        draws = []
        for r in wanted:
            rng = np.random.default_rng([seed, r])
            every = [rng.permutation(t) for _ in range(int(numbers.max()) + 1)]
            draws.append({int(n): every[n] for n in numbers})
        found = permuted_similarities(x[sides[0]], x[sides[1]], a == b, draws, (numbers[sides[0]], numbers[sides[1]]), measure)
        return pa.table({"r": pa.array(wanted, pa.int32()), "a": pa.array([a] * len(wanted), pa.int32()), "b": pa.array([b] * len(wanted), pa.int32()), "p": pa.array([m.tobytes() for m in found], pa.binary())})

    def cover(table: pa.Table) -> pa.Table:
        p = np.empty((total, total))
        for a, b, raw in zip(table["a"].to_pylist(), table["b"].to_pylist(), table["p"].to_pylist(), strict=True):
            rows_, columns = (slice(x * tile, min(total, (x + 1) * tile)) for x in (a, b))
            m = np.frombuffer(raw).reshape(rows_.stop - rows_.start, columns.stop - columns.start)
            p[rows_, columns], p[columns, rows_] = m, m.T
        np.fill_diagonal(p, 1)
        return pa.table({"c": pa.array(left_out(p, k))})

    pooled = work.groupBy("a", "b", "task").applyInArrow(run, "r int, a int, b int, p binary").groupBy("r").applyInArrow(cover, "c double")
    return pooled.agg(F.count("*").alias("n"), *(F.percentile("c", F.lit(q)).alias(name) for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))))


# ---- spectra


def _triangle(held: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if held is None else np.vstack([held, rows]), mode="r")


def _square(rows: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    return column.flatten().to_numpy().reshape(-1, width)


def singular_values(rows: DataFrame, width: int) -> DataFrame:
    """``(rank, value)``, largest first, of the matrix whose rows are the arrays ``v`` of ``width`` numbers each.

    A tall QR by a tree: each task keeps the triangle of the rows it has seen (``width`` squared numbers at most), ``FAN_IN`` triangles make one, and
    the last one has the singular values of the whole. They are taken in a task; the driver sees none of it.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if b.num_rows:
                held = _triangle(held, _square(b.column("v"), width))
        if held is not None:
            flat = pa.ListArray.from_arrays(pa.array([0, held.size], pa.int32()), pa.array(held.ravel()))
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), flat], names=["slot", "v"])

    def joined(table: pa.Table) -> pa.Table:
        held = None
        for x in table["v"].chunks:
            held = _triangle(held, x.flatten().to_numpy().reshape(-1, width))
        return pa.table({"slot": pa.array([table["slot"][0].as_py() // FAN_IN], pa.int32()), "v": pa.ListArray.from_arrays(pa.array([0, held.size], pa.int32()), pa.array(held.ravel()))})

    def last(table: pa.Table) -> pa.Table:
        values = np.linalg.svd(_square(table["v"], width), compute_uv=False)
        return pa.table({"rank": pa.array(np.arange(1, len(values) + 1, dtype=np.int32)), "value": pa.array(values)})

    triangles = materialize(rows.select("v").mapInArrow(first, "slot int, v array<double>"))
    while triangles.count() > FAN_IN:
        before, triangles = triangles, materialize(triangles.withColumn("of", F.floor(F.col("slot") / FAN_IN)).groupBy("of").applyInArrow(joined, "slot int, v array<double>"))
        discard(before)
    return triangles.withColumn("of", F.lit(0)).groupBy("of").applyInArrow(last, "rank int, value double")


def spectrum(panel: DataFrame, value: str = "x") -> DataFrame:
    """``(rank, eigenvalue, above)``: correlation eigenvalues, largest first, against the Marchenko-Pastur edge (1 + sqrt(N/T))^2.

    They are the squared singular values of the standardised panel over T, whose rows are sessions or tickers, whichever are more. Of fewer sessions than
    tickers the remaining values are zero. Constant series count as zeros.
    """
    m = panel.groupBy("ticker").agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("sd"))
    z = panel.join(F.broadcast(m), "ticker").select("ticker", "bar_date", F.coalesce(F.try_divide(F.col(value) - F.col("m"), F.when(F.col("sd") > 1e-15, F.col("sd"))), F.lit(0.0)).alias("z"))
    t, n = panel.agg(F.countDistinct("bar_date"), F.countDistinct("ticker")).first()
    if not t:
        return panel.sparkSession.createDataFrame([], "rank int, eigenvalue double, above boolean")
    long, short = ("bar_date", "ticker") if t >= n else ("ticker", "bar_date")
    rows = z.groupBy(long).agg(F.sort_array(F.collect_list(F.struct(short, "z"))).alias("v")).select(F.transform("v", lambda x: x["z"]).alias("v"))
    found = singular_values(rows, min(t, n)).select("rank", (F.col("value") * F.col("value") / t).alias("eigenvalue"))
    ranks = panel.sparkSession.range(1, n + 1).select(F.col("id").cast("int").alias("rank"))
    every = ranks.join(found, "rank", "left").withColumn("eigenvalue", F.coalesce("eigenvalue", F.lit(0.0)))
    return every.withColumn("above", F.col("eigenvalue") > (1 + math.sqrt(n / t)) ** 2)


def spectra(panels: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(matrix, n_values, largest, n_above, above, share)`` of several panels, as returns and residuals: how many values stand above the edge, which, and their share of the trace."""
    out = None
    for name, (panel, value) in panels.items():
        top = F.when(F.col("above"), F.col("eigenvalue"))
        found = spectrum(panel, value).agg(
            F.lit(name).alias("matrix"), F.count("*").alias("n_values"), F.max("eigenvalue").alias("largest"), F.count(top).alias("n_above"),
            F.sort_array(F.collect_list(top), asc=False).alias("above"), F.coalesce(F.try_divide(F.sum(top), F.sum("eigenvalue")), F.lit(0.0)).alias("share"),
        )
        out = found if out is None else out.union(found)
    return out
