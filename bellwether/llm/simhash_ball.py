"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a common variant that is within half the radius of
both. So every distinct fingerprint emits all variants within half the radius (rounded up), and the
variants are the shuffle key. A variant's ball holds a bounded number of fingerprints, whatever the
size of the input: copies share one fingerprint and are folded into it first.

With an odd radius, ``near`` members (half the radius, rounded down) meet all members; any such pair
is within the radius, so linking all of them to the smallest near one loses no connection.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, lean, materialize, power_of_two
from .survivors import KEY, keep_first, named_by_least, row_key

NODES = 1 << 17  # most fingerprints whose variants one task makes


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of all shingles; no words give zero."""
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(p, 42) for p in parts], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``KEY`` of each row and ``fp``: the fingerprint of its whole text, lower-cased A-Z, as a signed long; null counts as empty."""

    lean(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [fingerprint((x.as_buffer().to_pybytes() if x.is_valid else b"").lower().split(), shingle) for x in b.column("text")]
            yield pa.record_batch([*(b.column(k) for k in KEY), pa.array(np.array(out, dtype=np.uint64).view(np.int64), pa.int64())], names=[*KEY, "fp"])

    return docs.select(*row_key(docs), "text").mapInArrow(run, "k_id long, k_null boolean, k_text long, k_rest long, fp long")


def masks(radius: int) -> list[int]:
    """All changes of up to half the radius (rounded up) as signed longs."""
    out = [0]
    for k in range(1, (radius + 1) // 2 + 1):
        out += [sum(1 << b for b in bits) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` between fingerprints of ``prints(fp)``, which are distinct, that connect all pairs within ``radius``."""
    at = ", ".join(f"{m}L" if m != -(1 << 63) else "shiftleft(1L, 63)" for m in masks(radius))
    ball = prints.select("fp", F.explode(F.expr(f"transform(array({at}), m -> fp ^ m)")).alias("variant"))
    near = F.when(F.bit_count(F.col("fp").bitwiseXOR(F.col("variant"))) <= radius // 2, F.col("fp"))
    met = ball.groupBy("variant").agg(F.min(near).alias("hub"), F.collect_list("fp").alias("members")).where("size(members) > 1 and hub is not null")
    pairs = met.select("hub", F.explode("members").alias("fp")).where("fp <> hub")
    return pairs.where(F.bit_count(F.col("hub").bitwiseXOR(F.col("fp"))) <= radius).select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def _grouped(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """``KEY``, ``fp`` and ``label`` of every row: rows of one label are linked, directly or over others."""
    marked = materialize(fingerprints(docs, shingle))
    prints = marked.select("fp").distinct()
    # every print becomes many variants: tasks by number of prints, not by bytes read
    prints = materialize(prints.repartition(power_of_two(prints.count() / NODES, 16)))
    found = components(links(prints, radius))
    name = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("label"))
    # a written table, so that Spark can split the rows of a frequent print
    return marked.join(materialize(name), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: the smallest doc_id reachable over links of ``radius`` bits or fewer.

    Every row of ``docs`` gives a row; repeated ids and texts, empty and null texts (fingerprint zero)
    link like any other. Rows with a null id keep their fingerprint and take part in a component
    without naming it; one of null ids alone has a null component. Ids may be any long. Other columns are ignored.
    """
    grouped = materialize(_grouped(docs.select("doc_id", "text"), shingle, radius))
    out = grouped.join(materialize(named_by_least(grouped, "label")), "label")
    return out.select(F.when(~F.col("k_null"), F.col("k_id")).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest id (``survivors.keep_first``); all columns stay."""
    return keep_first(docs, _grouped(docs, shingle, radius), "label")
