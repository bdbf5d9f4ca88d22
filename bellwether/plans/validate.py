"""Checks V1-V14 over the tables of a run, and its fingerprint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

VERSION = 1


def fingerprint(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: SHA-256 over the sorted hashes of all rows of all tables, times left out."""
    parts = []
    for name in sorted(tables):
        cols = sorted(c for c, kind in tables[name].dtypes if kind != "timestamp" and c not in ("run_id", "content_hash", "is_active"))
        parts.append(tables[name].select(F.sha2(F.concat(F.lit(name), F.to_json(F.struct(*cols))), 256).alias("h")))
    rows = reduce(DataFrame.union, parts)
    # sums of row hashes do not depend on order, and need no one task for all rows
    words = [F.sum(F.conv(F.substring("h", 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(8)]
    return rows.agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), *words), 256).alias("content_hash")).withColumn("run_id", F.substring("content_hash", 1, 12))


def validate(run: DataFrame, universe: DataFrame, params: DataFrame, steps: DataFrame, assigned: DataFrame, groups: DataFrame, p: DataFrame, content: DataFrame) -> DataFrame:
    """``(check, passed, n_bad)`` for the 14 checks.

    ``run``: version, content_hash, run_id, n, t, q, k, k_max, window_start, window_end, prior_close_date, f_total.
    """
    def bad(name: str, df: DataFrame, *wrong: Column) -> DataFrame:
        return df.agg(F.count_if(F.coalesce(reduce(lambda a, b: a | b, wrong), F.lit(True))).alias("n_bad")).select(F.lit(name).alias("check"), "n_bad")

    eps = 1e-9
    place = universe.withColumn("__p", F.row_number().over(W.orderBy("ticker")) - 1)
    size = universe.agg(F.count("*").alias("n_u"))
    gain = steps.withColumn("prev", F.lag("gain").over(W.orderBy("step"))).withColumn("sum", F.sum("gain").over(W.orderBy("step"))).withColumn("__s", F.row_number().over(W.orderBy("step")))
    own = assigned.join(p, (F.col("ticker") == F.col("i")) & (F.col("anchor") == F.col("j")), "left")
    both = p.alias("a").join(p.alias("b"), (F.col("a.i") == F.col("b.j")) & (F.col("a.j") == F.col("b.i")), "left")
    best = p.join(F.broadcast(assigned.select(F.col("anchor").alias("j")).distinct()), "j").groupBy("i").agg(F.max("p").alias("best"))
    again = assigned.groupBy("anchor").agg(F.count("*").alias("n_again"))
    checks = [
        bad("V01 version", run, F.col("version") != VERSION),
        bad("V02 content", run.join(F.broadcast(content.withColumnRenamed("content_hash", "h").drop("run_id"))), F.col("content_hash") != F.col("h")),
        bad("V03 id", run, F.col("run_id") != F.substring("content_hash", 1, 12)),
        bad("V04 positions", place, F.col("position") != F.col("__p")),
        bad("V05 dimensions", run.join(F.broadcast(size)), F.col("n") != F.col("n_u"), F.abs(F.col("q") - F.try_divide("n", "t")) > eps),
        bad("V06 window", run, F.col("window_start") > F.col("window_end"), F.col("prior_close_date") >= F.col("window_start")),
        bad("V07 k", run, F.col("k") > F.col("k_max"), F.col("k") < 1, F.col("k_max") > F.col("n")),
        bad("V08 params", params, ~(F.col("sigma") > 0), ~F.col("r2").between(0, 1)),
        bad("V09 coverage", own, F.col("c") != F.col("p")),
        bad("V10 steps", gain, F.col("step") != F.col("__s")),
        bad("V11 gains", gain, F.col("gain") < 0, F.coalesce(F.col("gain") > F.col("prev"), F.lit(False))),
        bad("V12 totals", gain, F.col("f") != F.col("sum")),
        bad("V13 matrix", both, F.col("a.p") != F.col("b.p"), (F.col("a.i") == F.col("a.j")) & (F.col("a.p") != 1), ~F.col("a.p").between(0, 1)),
        bad("V14 groups", assigned.join(best, F.col("ticker") == F.col("i"), "left").join(again, "anchor").join(groups.select("anchor", "size"), "anchor", "left"), F.col("c") != F.col("best"), F.col("size") != F.col("n_again")),
    ]
    out = reduce(DataFrame.union, checks)
    return out.select("check", (F.col("n_bad") == 0).alias("passed"), "n_bad")


def fit_identities(e: DataFrame, assigned: DataFrame, steps: DataFrame, k: int) -> DataFrame:
    """Residual means are zero and the published coverage is the sum of its parts (Q13)."""
    mean = e.groupBy("ticker").agg(F.avg("e").alias("m")).agg(F.coalesce(F.max(F.abs("m")), F.lit(0.0)).alias("worst_mean"))
    total = assigned.agg(F.sum(F.col("c").cast("decimal(38,18)")).alias("f_parts"))
    f = steps.where(F.col("step") == k).select("f")
    return mean.join(F.broadcast(total)).join(F.broadcast(f)).withColumn("passed", (F.col("worst_mean") < 1e-9) & (F.col("f") == F.col("f_parts")))
