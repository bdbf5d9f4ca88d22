"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone.

Each document expects target / source size copies. Within a source the documents are put in order of
size, their expected copies are summed along that order, one random offset by source is added, and a
document is taken once for each integer its interval crosses. In order of size, neighbours stand in for
each other, so the words taken stay within about one large document of the target.

The running sum has three levels, so that no source, and no size, needs one task: size classes of
a source, sub-blocks of a class (about ``BLOCK`` documents, by hash) and documents of a sub-block. Expected
copies are whole numbers of 2**-24, so sums are exact and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize
from .survivors import KEY, column, free_name, row_key

BLOCK = 128
ONE = 1 << 24


def size_of(text: Column) -> Column:
    """Number of words, runs of other than ASCII white space; null: 0."""
    apart = "\t\n\x0b\x0c\r"
    plain = F.translate(text, apart, " " * len(apart))
    return F.coalesce(F.size(F.filter(F.split(plain, " "), lambda w: w != "")), F.lit(0)).cast("long")


def _hash32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sources(source, source_size)`` with ``target``: ``share`` of all words dealt by weight, no more than ``most`` times a source's own.

    Sources by code point, null last, weigh ``weights`` in turn. What a source cannot take is dealt
    again among the rest by weight: in order of limit by weight, the sources that are full are the first ones, so one
    running sum finds the level of all others. One row by source: this order is the only step that needs them all together.
    """
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    dealt = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")).withColumn("limit", most * F.col("source_size"))
    dealt = materialize(dealt)
    whole = share * (dealt.agg(F.sum("source_size")).first()[0] or 0)
    by_fill = W.orderBy(F.col("limit") / F.col("weight"), "source")
    full = F.coalesce(F.sum("limit").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing))
    levels = dealt.select("weight", "limit", ((F.lit(whole) - full) / left).alias("level"))
    level = levels.where("weight * level < limit").agg(F.max("level")).first()[0]
    target = F.col("limit") if level is None else F.least(F.col("limit"), F.col("weight") * level)
    return dealt.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, seed: str = "mix", keys: tuple[str, ...] = (), **shares) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)`` of every row of ``docs``, and its columns ``keys``.

    Null texts and ids, repeated ids and rows are rows of their own; rows that are equal in all of these columns are told
    apart by order alone. A source of no words has target 0 and gives no copies. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text))
    slim = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.md5(key).alias("order_key"), *keys)
    bits = F.length(F.bin("size"))
    steps = F.when(F.col("size") < 16, F.col("size")).otherwise(bits * 8 + F.expr("shiftright(size, length(bin(size)) - 4)") % 8 + 100)
    slim = materialize(slim.withColumn("class", steps.cast("int")).withColumn("u", F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long")))
    goal = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), **shares)
    goal = goal.withColumn("step", F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * ONE)).otherwise(0).cast("long")).withColumn(
        "offset", F.coalesce(_hash32(F.concat_ws(":", F.lit(seed), F.coalesce("source", F.lit("\x00null")))), F.lit(0)) % ONE
    )
    classes = slim.groupBy("source", "class").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("source").orderBy("class").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    classes = classes.withColumn("class_start", before).withColumn("parts", F.ceil(F.col("n") / BLOCK))
    goal = goal.withColumnRenamed("source", "goal_source")
    classes = classes.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    placed = (
        slim.alias("d")
        .join(classes.drop("n").alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.class") == F.col("c.class")))
        .select("d.*", "class_start", "source_size", "target", "step", "offset", F.expr("(u * parts) div 4294967296").alias("part"))
    )
    blocks = placed.groupBy("source", "class", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("source", "class").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("part_start", before).drop("n")
    rows = (
        placed.alias("d")
        .join(blocks.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.class") == F.col("b.class")) & (F.col("d.part") == F.col("b.part")))
        .select("d.*", "part_start")
    )
    inside = F.row_number().over(W.partitionBy("source", "class", "part").orderBy("size", "order_key", "doc_id", *keys))
    rows = rows.withColumn("place", F.col("class_start") + F.col("part_start") + inside)
    crossed = F.expr(f"(place * step + offset) div {ONE} - ((place - 1) * step + offset) div {ONE}")
    return rows.select("doc_id", "source", "size", "source_size", "target", crossed.alias("copies"), *keys)


def taken(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``: the words that the mix takes of each document."""
    return copies(docs, **options).select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows of ``docs``: each as often as it was drawn, with all its columns.

    Rows are told apart by all their columns; of equal rows the draws are added up, and the row comes that often.
    """
    names = [free_name(docs, k) for k in KEY]
    keyed = docs.select(*map(column, docs.columns), *(c.alias(n) for c, n in zip(row_key(docs), names, strict=True)))
    plain = docs.select("doc_id", "source", "text", *row_key(docs))
    times = free_name(docs, "times")
    drawn = copies(plain, keys=tuple(KEY), **options).groupBy(*KEY).agg(F.sum("copies").cast("int").alias(times)).where(F.col(times) > 0)
    drawn = drawn.select(*(F.col(k).alias(n) for k, n in zip(KEY, names, strict=True)), times)
    again = F.explode(F.array_repeat(F.lit(1), F.col(times)))
    return keyed.dropDuplicates(names).join(drawn, names).withColumn(times, again).select(*map(column, docs.columns))


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS order_key
  FROM documents
), slim AS (
  SELECT *, CASE WHEN size < 16 THEN size ELSE length(bin(size)) * 8 + (size >> CAST(length(bin(size)) - 4 AS BIGINT)) % 8 + 100 END AS class,
         CAST('0x' || substr(order_key, 1, 8) AS BIGINT) AS u
  FROM sized
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM slim GROUP BY source
), ranked AS (
  SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
         2.0::DOUBLE * source_size AS cap, sum(source_size) OVER () AS whole
  FROM by_source
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS k,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM ranked
), level AS (
  SELECT max((1.5::DOUBLE * whole - cap_before) / weight_left) AS level FROM ordered
  WHERE weight * ((1.5::DOUBLE * whole - cap_before) / weight_left) < cap
), goal AS (
  SELECT source, source_size, least(cap, weight * level) AS target,
         CASE WHEN source_size > 0 THEN CAST(round(least(cap, weight * level) / source_size * {ONE}) AS BIGINT) ELSE 0 END AS step,
         CAST('0x' || substr(md5('mix:' || coalesce(source, chr(0) || 'null')), 1, 8) AS BIGINT) % {ONE} AS off
  FROM ordered, level
), parted AS (
  SELECT s.*, g.source_size, g.target, g.step, g.off,
         (u * CAST(ceil(count(*) OVER (PARTITION BY s.source, class) / {BLOCK}.0) AS BIGINT)) // 4294967296 AS part
  FROM slim s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, part, size, order_key, doc_id) AS place FROM parted
)
SELECT doc_id, size, source_size, target,
       size * ((place * step + off) // {ONE} - ((place - 1) * step + off) // {ONE}) AS taken
FROM placed
"""
