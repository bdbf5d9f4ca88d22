"""Runs as stored tables: written with their fingerprint, read back, and compared field by field."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tables of a run and what tells their rows apart.
KEYS = {"universe": ["ticker"], "params": ["ticker"], "steps": ["step"], "assigned": ["ticker"], "groups": ["anchor"], "p": ["i", "j"], "under": ["tau", "ticker"]}


def write_run(tables: dict[str, DataFrame], head: DataFrame, path: str) -> None:
    """The tables named in ``KEYS`` that the run has, and its one row; the row comes last, so a run without it is not complete."""
    for name in KEYS:
        if name in tables:
            tables[name].write.parquet(f"{path}/{name}")
    head.write.parquet(f"{path}/run")


def read_run(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All tables of a stored run by name, its row as ``run``."""
    out = {"run": spark.read.parquet(f"{path}/run")}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in KEYS:
        at = hadoop(f"{path}/{name}")
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            out[name] = spark.read.parquet(f"{path}/{name}")
    return out


def _shown(df: DataFrame, name: str) -> Column:
    """A value as text that tells any two values of its type apart; null stays null."""
    kind = dict(df.dtypes)[name]
    return F.to_json(F.struct(name)) if kind.startswith(("array", "struct", "map")) else F.col(name).cast("string")


def fields(tables: dict[str, DataFrame], keys: dict[str, list[str]] = KEYS) -> DataFrame:
    """``(table, key, field, kind, value)``: every value of every table, a row each; a row of keys alone has one of the field ``*``."""
    parts = []
    for name, key in keys.items():
        if name not in tables:
            continue
        df = tables[name]
        kinds = dict(df.dtypes)
        values = [F.struct(F.lit(c).alias("field"), F.lit(kinds[c]).alias("kind"), _shown(df, c).alias("value")) for c in df.columns if c not in key]
        there = F.struct(F.lit("*").alias("field"), F.lit("row").alias("kind"), F.lit("").alias("value"))
        parts.append(df.select(F.lit(name).alias("table"), F.to_json(F.struct(*key)).alias("key"), F.explode(F.array(there, *values)).alias("x")).select("table", "key", "x.*"))
    return reduce(DataFrame.union, parts)


def difference(a: dict[str, DataFrame], b: dict[str, DataFrame], keys: dict[str, list[str]] = KEYS, tolerance: float = 0.0) -> DataFrame:
    """``(table, key, field, left, right, verdict)`` of every value that either run has: ``equal``, ``differs``, ``left`` or ``right`` (only there).

    Doubles within ``tolerance`` of one another are equal, similarities and other decimals only if they are the same to the last digit; so are types.
    Both sides are dealt by (table, key, field) once, and each value meets its counterpart there.
    """
    at = ["table", "key", "field"]
    x, y = (fields(t, keys).select(*at, F.struct("kind", "value").alias(side)) for t, side in ((a, "x"), (b, "y")))
    both = x.join(y, at, "full_outer")
    near = (F.col("x.kind") == "double") & (F.abs(F.expr("try_cast(x.value AS double)") - F.expr("try_cast(y.value AS double)")) <= tolerance)
    same = (F.col("x.kind") == F.col("y.kind")) & (F.col("x.value").eqNullSafe(F.col("y.value")) | F.coalesce(near, F.lit(False)))
    verdict = F.when(F.col("y").isNull(), "left").when(F.col("x").isNull(), "right").when(same, "equal").otherwise("differs")
    return both.select(*at, F.col("x.value").alias("left"), F.col("y.value").alias("right"), verdict.alias("verdict"))


def by_field(found: DataFrame) -> DataFrame:
    """``(table, field, n_equal, n_differs, n_left, n_right)``: counts of ``difference``."""
    return found.groupBy("table", "field").agg(*(F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("equal", "differs", "left", "right")))
