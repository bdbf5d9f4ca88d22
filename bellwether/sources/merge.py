"""A keyed table that takes batches by rewriting only the partitions they touch.

The folder has data folders, each written by one batch, and manifests, one by version: which folder holds each live partition. A batch reads the
partitions it touches, writes them anew, and then adds a manifest that names the new folders and, for all other partitions, the old ones. A manifest appears by one
rename, after all its data: a batch that fails leaves the version before it as it was, and readers of that version keep their files until ``vacuum``.
A manifest also has the number of its batch, so a batch that a stream hands over again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .store import upsert

PART = "__part"


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, base: str) -> list[int]:
    """Versions that are complete, the newest last."""
    at, fs = _fs(spark, f"{base}/manifests")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict | None:
    """``{"version", "batch", "schema", "parts": {partition: folder}}`` of a version (the newest one); None if there is none."""
    known = versions(spark, base)
    if not known:
        return None
    at, fs = _fs(spark, f"{base}/manifests/{known[-1] if version is None else version}.json")
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _commit(spark: SparkSession, base: str, entry: dict) -> None:
    at, fs = _fs(spark, f"{base}/manifests/{entry['version']}.json")
    part, _ = _fs(spark, f"{base}/manifests/{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if fs.exists(at) or not fs.rename(part, at):
        fs.delete(part, False)
        raise RuntimeError(f"version {entry['version']} of {base} was written by another batch meanwhile")


def read(spark: SparkSession, base: str, version: int | None = None, parts: set[str] | None = None) -> DataFrame:
    """The table at a version (the newest one), or some partitions of it."""
    entry = manifest(spark, base, version)
    if entry is None:
        raise FileNotFoundError(f"no version of a table in {base}")
    schema = StructType.fromJson(entry["schema"])
    paths = [f"{base}/{folder}" for name, folder in entry["parts"].items() if parts is None or name in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge(base: str, batch: DataFrame, keys: list[str], part: Column, keep: tuple[str, ...] = (), number: int | None = None, how: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> int:
    """Upsert ``batch`` into the table in ``base``, or join them by ``how(old, batch)``, and give the version after it.

    ``part`` is the partition of a row, a function of its keys (their years, say). Only partitions with rows in ``batch`` are read and written; one line by partition of the batch
    comes to the driver. ``number`` is that of a stream's batch: one that is in already changes nothing, and only batch 0 may come without a table before it.
    """
    spark = batch.sparkSession
    before = manifest(spark, base)
    if number is not None:
        if before is not None and before["batch"] is not None and before["batch"] >= number:
            return before["version"]
        if before is None and number > 0:
            raise FileNotFoundError(f"batch {number} has no version of a table in {base} to go on from")
    named = batch.withColumn(PART, part.cast("string"))
    touched = {r[0] for r in named.select(PART).distinct().collect()}
    if None in touched:
        raise ValueError("a row has no partition")
    parts = dict(before["parts"]) if before else {}
    if touched:
        old = read(spark, base, parts=touched) if before else batch.limit(0)
        folder = f"data/{uuid.uuid4().hex}"
        (upsert(old, batch, keys, keep) if how is None else how(old, batch)).withColumn(PART, part.cast("string")).write.partitionBy(PART).parquet(f"{base}/{folder}")
        parts |= {name: f"{folder}/{PART}={name}" for name in touched}
    elif before and number is None:
        return before["version"]
    entry = {"version": before["version"] + 1 if before else 0, "batch": number, "schema": before["schema"] if before else batch.schema.jsonValue(), "parts": parts}
    _commit(spark, base, entry)
    return entry["version"]


def vacuum(spark: SparkSession, base: str, versions_kept: int = 1) -> int:
    """Remove all but the newest versions, and data that none of the kept ones has; gives the number of folders that went. No batch may run meanwhile."""
    known = versions(spark, base)
    kept = known[-versions_kept:]
    used = {folder.rsplit("/", 1)[0] for v in kept for folder in manifest(spark, base, v)["parts"].values()}
    live = {folder for v in kept for folder in manifest(spark, base, v)["parts"].values()}
    for v in known[: len(known) - len(kept)]:
        at, fs = _fs(spark, f"{base}/manifests/{v}.json")
        fs.delete(at, False)
    at, fs = _fs(spark, f"{base}/data")
    gone = 0
    for one in fs.listStatus(at) if fs.exists(at) else []:
        name = f"data/{one.getPath().getName()}"
        if name not in used:
            fs.delete(one.getPath(), True)
            gone += 1
            continue
        for inner in fs.listStatus(one.getPath()):
            if inner.isDirectory() and f"{name}/{inner.getPath().getName()}" not in live:
                fs.delete(inner.getPath(), True)
                gone += 1
    return gone
