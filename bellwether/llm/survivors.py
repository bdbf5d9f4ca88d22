"""Keeping one row of each group of near-duplicates, whatever ids and columns the rows have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What tells rows apart: the id (a null one counts as 0), whether it is null, the text and all other columns.
KEY = ["k_id", "k_null", "k_text", "k_rest"]


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(docs: DataFrame) -> list[Column]:
    """The columns of ``KEY`` for each row of ``docs``; equal rows have equal keys."""
    others = [column(c) for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("long")
    made = (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("doc_id").cast("long").isNull(), F.xxhash64("text"), rest)
    return [c.alias(n) for c, n in zip(made, KEY, strict=True)]


def named_by_least(marked: DataFrame, label: str) -> DataFrame:
    """``(label, component_id)``: the smallest id of the rows of each label; null if all their ids are."""
    return marked.groupBy(label).agg(F.min(F.when(~F.col("k_null"), F.col("k_id"))).alias("component_id"))


def keep_first(docs: DataFrame, marked: DataFrame, label: str) -> DataFrame:
    """One row of ``docs`` for each value of ``label`` in ``marked`` (``KEY`` of each row, and its label).

    The row with the smallest id stays, null ids last; ties go to the smaller hash of text and of other columns,
    and of equal rows one stays. Equal rows meet after a partial aggregation in each task, and the rows chosen
    are found by a join on the whole key, so no group is collected.
    """
    chosen = marked.groupBy(label).agg(F.min(F.struct("k_null", "k_id", "k_text", "k_rest")).alias("first")).select("first.*")
    names = [free_name(docs, k) for k in KEY]
    rows = docs.select(*map(column, docs.columns), *(c.alias(n) for c, n in zip(row_key(docs), names, strict=True))).dropDuplicates(names)
    chosen = chosen.select(*(F.col(k).alias(n) for k, n in zip(KEY, names, strict=True)))
    return rows.join(chosen, names, "left_semi").select(*map(column, docs.columns))
