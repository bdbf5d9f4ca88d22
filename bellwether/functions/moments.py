"""Moments over trailing windows in one pass, whatever the window's length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FIELDS = ("k", "mx", "my", "vx", "vy", "c")


def _moments(x: str, y: str, w) -> Column:  # noqa: ANN001
    made = (F.count("*"), F.avg(x), F.avg(y), F.var_pop(x), F.var_pop(y), F.covar_pop(x, y))
    return F.struct(*(m.over(w).alias(name) for m, name in zip(made, FIELDS, strict=True)))


def _joined(a: Column, b: Column) -> Column:
    """Moments of two sets of rows together, about their common mean."""
    k = a["k"] + b["k"]
    share = a["k"] * b["k"] / (k * k)
    dx, dy = b["mx"] - a["mx"], b["my"] - a["my"]
    both = lambda f: (a["k"] * a[f] + b["k"] * b[f]) / k
    made = (k, both("mx"), both("my"), both("vx") + dx * dx * share, both("vy") + dy * dy * share, both("c") + dx * dy * share)
    return F.struct(*(m.alias(name) for m, name in zip(made, FIELDS, strict=True)))


def trailing_moments(rows: DataFrame, keys: list[str], x: str, y: str, n: int, name: str = "m") -> DataFrame:
    """``rows`` with ``name``: count, means, variances and covariance of ``x`` and ``y`` over the last ``n`` sessions of each key; null before.

    Each key's sessions are cut into blocks of ``n``. A window is the end of one block and the beginning of the next: running moments from
    either side of a block meet, so a session costs the same for any ``n``, and nothing is taken away again that could cancel.
    """
    order = W.partitionBy(*keys).orderBy("bar_date")
    rows = rows.withColumn("__r", F.row_number().over(order) - 1).withColumn("__b", F.floor(F.col("__r") / n))
    block = W.partitionBy(*keys, "__b")
    begin = block.orderBy("__r").rowsBetween(W.unboundedPreceding, 0)
    end = block.orderBy(F.desc("__r")).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("__from", _moments(x, y, begin)).withColumn("__to", _moments(x, y, end)).withColumn("__old", F.lag("__to", n - 1).over(order))
    whole = F.col("__r") % n == n - 1
    made = F.when(whole, F.col("__from")).when(F.col("__r") >= n, _joined(F.col("__old"), F.col("__from")))
    return rows.withColumn(name, made).drop("__r", "__b", "__from", "__to", "__old")
