"""Exact coverage of k tickers by branch and bound over subset prefixes.

The coverage F(S), the sum over tickers of the best similarity to S, is submodular: what a ticker adds to a prefix it adds at most to
any larger set. So F(prefix) plus the largest gains among later tickers, as many as are missing, bounds all subsets that begin with the prefix.
Pairs of tickers, largest bound first, are dealt to tasks in waves; each wave starts from the best subset that the waves before found, and prefixes
that cannot reach it are never opened. A task goes depth first, all last tickers of a prefix in one array operation.

Bounds and gains are doubles, and a branch is cut only if it stays below the best by more than their rounding; subsets within that of the best are compared by their exact
decimals. The smaller subset wins a tie.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

MOST = 1024  # tickers; their similarities are 8 MB
UNITS = 10**18  # similarities have 18 decimals
SLACK = 1e-9
WAVES = (1, 8, 64)  # shares of the prefixes in the first waves: a 64th of them, an 8th, all that are left


def exact(units: np.ndarray, subset: tuple[int, ...]) -> int:
    """F of a subset in units of the 18th decimal."""
    best = units[:, list(subset)].max(axis=1)
    high, low = np.divmod(best, 10**9)
    return int(high.sum()) * 10**9 + int(low.sum())


class Search:
    """Depth first below a prefix, with the best subset so far: (exact value, subset)."""

    def __init__(self, units: np.ndarray, k: int, best: tuple[int, tuple[int, ...]]):
        self.units, self.k, self.best = units, k, best
        self.p = units / UNITS
        self.opened = 0

    @property
    def floor(self) -> float:
        return self.best[0] / UNITS - SLACK

    def offer(self, subset: tuple[int, ...]) -> None:
        value = exact(self.units, subset)
        if value > self.best[0] or (value == self.best[0] and subset < self.best[1]):
            self.best = (value, subset)

    def below(self, prefix: tuple[int, ...], cover: np.ndarray) -> None:
        self.opened += 1
        after, left = prefix[-1] + 1 if prefix else 0, self.k - len(prefix)
        n = len(self.p)
        if n - after < left:
            return
        total = cover.sum()
        gains = np.maximum(self.p[:, after:] - cover[:, None], 0).sum(axis=0)
        if left == 1:
            for j in np.flatnonzero(total + gains >= self.floor).tolist():
                if total + gains[j] >= self.floor:  # the floor rises
                    self.offer((*prefix, after + j))
            return
        if total + np.sort(gains)[-left:].sum() < self.floor:
            return
        # with ticker j next, at best j and the largest gains behind it follow
        for j in np.argsort(-gains, kind="stable").tolist():
            behind = gains[j + 1 :]
            if len(behind) >= left - 1 and total + gains[j] + np.sort(behind)[len(behind) - left + 1 :].sum() >= self.floor:
                self.below((*prefix, after + j), np.maximum(cover, self.p[:, after + j]))


def greedy_subset(units: np.ndarray, k: int) -> tuple[int, ...]:
    """A good subset to start from: greedy, then exchanges of one ticker while they help."""
    p, cover, chosen = units / UNITS, np.zeros(len(units)), []
    for _ in range(k):
        gains = np.maximum(p - cover[:, None], 0).sum(axis=0)
        gains[chosen] = -1
        chosen.append(int(gains.argmax()))
        cover = np.maximum(cover, p[:, chosen[-1]])
    better = True
    while better:
        better = False
        for at in range(k):
            rest = [x for m, x in enumerate(chosen) if m != at]
            cover = p[:, rest].max(axis=1) if rest else np.zeros(len(p))
            gains = np.maximum(p - cover[:, None], 0).sum(axis=0)
            gains[rest] = -1
            j = int(gains.argmax())
            if gains[j] > gains[chosen[at]] + SLACK:
                chosen[at], better = j, True
    return tuple(sorted(chosen))


def exact_cover(p: DataFrame, k: int) -> DataFrame:
    """``(j1, ..., jk, f)``: the best k tickers of the similarity ``p(i, j, p)`` and their coverage; no row if there are fewer tickers.

    A universe of up to ``MOST`` tickers, else an error: its similarities go to every task.
    """
    if k < 1:
        raise ValueError("k is 1 or more")
    spark = p.sparkSession
    fields = ", ".join(f"j{m} string" for m in range(1, k + 1)) + ", f decimal(38,18)"
    names = [r["j"] for r in p.select("j").distinct().orderBy("j").limit(MOST + 1).collect()]
    if len(names) > MOST:
        raise ValueError(f"more than {MOST} tickers")
    if len(names) < k:
        return spark.createDataFrame([], fields)
    number = {x: m for m, x in enumerate(names)}
    units = np.zeros((len(names), len(names)), dtype=np.int64)
    for r in p.select("i", "j", (F.col("p").cast("decimal(38,18)") * UNITS).cast("long").alias("u")).toLocalIterator():
        units[number[r["i"]], number[r["j"]]] = r["u"]
    start = greedy_subset(units, k)
    best = (exact(units, start), start)
    if k > 2:
        shared = spark.sparkContext.broadcast(units)
        best = _waves(spark, shared, units, k, best)
    else:
        search = Search(units, k, best)
        search.below((), np.zeros(len(names)))
        best = search.best
    return spark.createDataFrame([(*(names[j] for j in best[1]), Decimal(best[0]).scaleb(-18))], fields)


def _waves(spark, shared, units: np.ndarray, k: int, best: tuple[int, tuple[int, ...]]):  # noqa: ANN001, ANN202
    n = len(units)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each first ticker, its pairs and their bounds."""
        p = shared.value / UNITS
        for b in batches:
            for first in b.column("id").to_pylist():
                second = np.arange(first + 1, n)
                cover = np.maximum(p[:, first, None], p[:, second])
                found = []
                for m, j in enumerate(second):
                    gains = np.maximum(p[:, j + 1 :] - cover[:, m, None], 0).sum(axis=0)
                    found.append(cover[:, m].sum() + np.sort(gains)[max(0, len(gains) - k + 2) :].sum() if len(gains) >= k - 2 else -1.0)
                yield pa.record_batch([pa.array(np.full(len(second), first)), pa.array(second), pa.array(found, pa.float64())], names=["first", "second", "bound"])

    prefixes = materialize(spark.range(0, n, 1, min(n, spark.sparkContext.defaultParallelism)).mapInArrow(bounds, "first long, second long, bound double").where("bound >= 0"))
    high = float("inf")
    for share in reversed(WAVES):
        floor = best[0] / UNITS - SLACK
        open_ = prefixes.where((F.col("bound") >= floor) & (F.col("bound") < high))
        size = open_.count()
        if not size:
            break
        # the largest bounds first: the wave's share of what is still open
        low = open_.orderBy(F.desc("bound")).limit(max(1, size // share)).agg(F.min("bound")).first()[0] if share > 1 else floor
        wave = open_.where(F.col("bound") >= low)
        incumbent = best

        def run(batches: Iterator[pa.RecordBatch], incumbent=incumbent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            search = Search(shared.value, k, incumbent)
            for b in batches:
                for _, first, second in sorted(zip(b.column("bound").to_pylist(), b.column("first").to_pylist(), b.column("second").to_pylist(), strict=True), reverse=True):
                    search.below((first, second), np.maximum(search.p[:, first], search.p[:, second]))
            yield pa.record_batch([pa.array([str(search.best[0])]), pa.array([list(search.best[1])], pa.list_(pa.int64()))], names=["value", "subset"])

        dealt = wave.repartition(min(4096, max(spark.sparkContext.defaultParallelism, size // share // 256)))
        found = dealt.mapInArrow(run, "value string, subset array<long>")
        top = found.orderBy(F.desc(F.col("value").cast("decimal(38,0)")), "subset").first()
        if top is not None:
            best = min(best, (int(top["value"]), tuple(top["subset"])), key=lambda x: (-x[0], x[1]))
        high = low
    return best
