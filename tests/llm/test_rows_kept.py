"""Stages neither lose nor invent rows: null, repeated and huge ids, equal rows, clashing columns, empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from bellwether.llm import common, mixing, shingle_join, simhash_ball

DOCS = "doc_id long, text string, source string"
HUGE = 2**63 - 1
ROWS = [
    (None, "one two three four five six", "a"),
    (None, "seven eight nine ten eleven twelve", "a"),
    (None, "a b c d e f g h i j", None),
    (1, "alpha beta gamma delta epsilon", "b"),
    (1, "zeta eta theta iota kappa", "b"),
    (1, "zeta eta theta iota kappa", "b"),
    (HUGE, "lambda mu nu xi omicron pi", "a"),
    (HUGE - 1, "LAMBDA mu nu xi omicron pi", "a"),
    (-(2**63), "rho sigma tau upsilon phi chi", None),
    (5, None, "a"),
    (6, "", "b"),
    (None, "   ", "b"),
]
#: Of each group of equal words, the row with the smallest id; null ids last.
KEPT = [ROWS[0], ROWS[1], ROWS[2], ROWS[3], ROWS[4], ROWS[7], ROWS[8], ROWS[9]]


@pytest.mark.parametrize("keep", [simhash_ball.keep_one, shingle_join.keep_one])
def test_one_row_of_each_group_stays(spark, keep):
    docs = spark.createDataFrame(ROWS, DOCS)
    got = keep(docs.withColumn("k_text", F.lit("own")).withColumn("K_ID", F.lit(None)).withColumn("a b`c", F.lit(1)))
    assert got.columns == ["doc_id", "text", "source", "k_text", "K_ID", "a b`c"]
    assert Counter(tuple(r)[:3] for r in got.collect()) == Counter(KEPT)
    assert keep(docs.limit(0)).count() == 0


def test_huge_and_null_ids_name_components(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash_ball.near_duplicates(docs).collect())
    want = [(None, None), (None, None), (None, None), (1, 1), (1, 1), (1, 1), (HUGE, HUGE - 1), (HUGE - 1, HUGE - 1), (-(2**63), -(2**63)), (5, 5), (6, 5), (None, 5)]
    assert got == Counter(want)


def test_mix_returns_as_many_rows_as_it_drew(spark):
    rows = [*ROWS, *[(None, f"word{k} " * (k % 5), "a") for k in range(40)], *[(9, f"other{k}", "b") for k in range(20)], *[(7, "same row", None)] * 15]
    docs = spark.createDataFrame(rows, DOCS).withColumn("times", F.lit("own")).withColumn("k_id", F.lit(0))
    drawn = {tuple(r)[:2]: r["n"] for r in mixing.copies(docs, keys=("text",)).groupBy("doc_id", "text").agg(F.sum("copies").alias("n")).collect()}
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "text", "source", "times", "k_id"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter({k: n for k, n in drawn.items() if n})
    assert sum(r["copies"] for r in mixing.copies(docs).collect()) == got.count()


def test_targets_in_one_pass_equal_dealing_again_and_again(spark):
    sizes = {f"s{k:04d}": (k * k) % 997 for k in range(1200)}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    full, whole = set(), 1.5 * sum(sizes.values())
    while True:
        level = (whole - sum(2 * sizes[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in sizes if s not in full and weight[s] * level >= 2 * sizes[s]}
        if not more:
            break
        full |= more
    assert got == pytest.approx({s: min(2 * sizes[s], weight[s] * level) for s in sizes})


def test_a_node_of_many_links(spark):
    edges = spark.range(3000).select(F.lit(-1).cast("long").alias("a"), F.col("id").alias("b")).union(spark.range(50).select((F.col("id") + 5000).alias("a"), (F.col("id") + 5001).alias("b")))
    got = Counter(r["component"] for r in common.components(edges).collect())
    assert got == {-1: 3001, 5000: 51}
