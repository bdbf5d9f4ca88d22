"""Pieces shared by the corpus operators: sizing, components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize, shared_folder

__all__ = ["CRC_TABLE", "HOT", "components", "crc_sql", "lean", "discard", "materialize", "power_of_two", "shared_folder", "table", "text_bytes"]

BATCH = "4m"
HOT = 50_000  # most nodes whose minimum is broadcast

#: CRC-32 of an ASCII string ``s`` in DuckDB, which has none: the table of the remainders of all bytes, then a fold.
CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(b))
)"""


def crc_sql(s: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({s}) + 1), lambda i: ascii(({s})[i]))), lambda x, c: xor(x >> 8, t[1 + (xor(x, c) & 255)])), 4294967295)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lean(spark: SparkSession) -> None:
    """Let Arrow batches hold ``BATCH`` of data, unless the session says otherwise: a batch of long texts then costs a task no more memory than one of short ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864", "67108864b", "64m"):  # Spark's own value
        spark.conf.set(key, BATCH)


def power_of_two(n: float, least: int) -> int:
    """The smallest power of two not below ``n`` and ``least``."""
    out = least
    while out < n:
        out *= 2
    return out


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _with_least(edges: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """``edges(a, b)`` with ``m``, the smallest ``b`` of each ``a``; and the table of these minima.

    Nodes of many edges (over ``2 * count / HOT``, so fewer than ``HOT`` of them whatever the input) get their
    minimum from a broadcast and are never dealt out by key; all others meet theirs in a join.
    """
    low = materialize(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
    most = max(100, 2 * count // HOT)
    hot = low.where(F.col("n") > most).select("a", "m")
    first = edges.join(F.broadcast(hot), "a", "left")
    cold = low.where(F.col("n") <= most).select("a", F.col("m").alias("least"))
    rest = first.where("m is null").select("a", "b").join(cold, "a").select("a", "b", F.col("least").alias("m"))
    return first.where("m is not null").select("a", "b", "m").union(rest), low


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges(a, b)`` are undirected links between long ids. Returns ``(node, component)`` for every
    node that has a link to another one; ``component`` is the smallest id reachable. Each step is a few
    shuffles with pre-aggregated minima and is written to the shared folder, so a lost executor costs one
    step at most; tables of earlier steps are removed. Nodes of many links are never dealt out by key.
    Self-links and repeated links are ignored; no edges give no rows.
    """
    linked = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        now = linked.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = linked.union(linked.select("b", "a"))
        met, low = _with_least(both, 2 * now[0])
        large = materialize(met.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        met, least = _with_least(large, now[0])
        small = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        after = materialize(small)
        discard(linked, low, large, least)
        linked = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = linked.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.union(roots)
