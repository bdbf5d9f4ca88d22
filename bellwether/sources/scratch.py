"""Tables that cut a lineage, in the folder that all executors share. What is still there when the driver's Python ends goes then, or with ``clear``."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a single-machine session without one gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=8)
def _own_folder(application: str) -> str:
    return f"file://{tempfile.mkdtemp(prefix=f'spark-shared-{application}-')}"


#: What was written and not yet removed, by application.
_WRITTEN: dict[str, tuple[SparkSession, set[str]]] = {}


def temporary(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes with ``clear``."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, (spark, set()))[1].add(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = temporary(spark, "table")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
    if context.applicationId in _WRITTEN:
        _WRITTEN[context.applicationId][1].discard(path)


def discard(*tables: DataFrame | None) -> None:
    """Remove what ``materialize`` wrote for these tables; they, and what is derived from them, must not be read again."""
    for df in tables:
        path = getattr(df, "written", None)
        if path is not None:
            _remove(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Remove all that ``materialize`` and ``temporary`` made in this application; nothing derived from it can be read again."""
    for path in list(_WRITTEN.get(spark.sparkContext.applicationId, (spark, set()))[1]):
        _remove(spark, path)


@atexit.register
def _clear_all() -> None:
    for spark, _ in list(_WRITTEN.values()):
        try:
            if spark.sparkContext._jsc is not None:
                clear(spark)
        except Exception:  # noqa: BLE001, S110
            pass  # the application has ended already; its folder is the cluster's to clean
