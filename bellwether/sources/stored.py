"""Derived tables that are written once and then read, as a warehouse keeps its bars and indicators, until the tables they come from change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .scratch import discard, materialize

#: What the derived tables are made of.
INPUTS = ("lineitem", "part")
_TABLES: dict[tuple[str, str, str], tuple[tuple, DataFrame]] = {}


def files(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = INPUTS) -> tuple[tuple[str, int, int], ...]:
    """Name, length and time of each file of these tables, as their file system tells them; a table that is not there has none."""
    jvm, found = spark.sparkContext._jvm, []
    for name in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path):
            listed = fs.listFiles(path, True)
            while listed.hasNext():
                f = listed.next()
                found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` derived from the tables in ``sf_dir``: as it was written, if the files of ``INPUTS`` are the same as then, else written anew."""
    key, now = (spark.sparkContext.applicationId, sf_dir, name), files(spark, sf_dir)
    if key in _TABLES and _TABLES[key][0] != now:
        discard(_TABLES.pop(key)[1])
    if key not in _TABLES:
        made = build()
        _TABLES[key] = (now, made if hasattr(made, "written") else materialize(made))
    table = _TABLES[key][1]
    return spark.read.schema(table.schema).parquet(table.written)


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Remove all stored tables of ``sf_dir``; the next question derives them anew."""
    for key in [k for k in _TABLES if k[:2] == (spark.sparkContext.applicationId, sf_dir)]:
        discard(_TABLES.pop(key)[1])
