"""A Merkle manifest of a dataset: a tree by source over its rows, and one over the sources.

Nodes are numbered within their group without sorting a group in one task: rows are dealt by ranges of (group, order), each range is
counted, and a node's number is the count of the ranges before it plus its place in its own. Runs of ``FAN`` numbers have one parent.
At each level a window by run lays the other nodes beside each one by ``lag`` and ``lead`` at every fixed offset below ``FAN``; an offset counts
where the node's slot, and the length of its run, reach that far. These columns are its siblings, and the row of a run's first child, which has all others behind it, hashes the
parent. So no window, group or join key holds more than ``FAN`` rows of a level, whatever the size of a source.

Proofs come down from the root: each node's path is its own siblings, then its parent's path. Only the nodes above the documents, a sixteenth of the rows, are sent along with
their paths; a document's row meets its run's path in the exchange that its window needs anyway.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import CRC_TABLE, crc_sql, discard, materialize

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A source as two columns without nulls; a null source comes first.
SOURCE = ["known", "source"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STEP = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts, one after the other, as lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def leaf(**changed: Column) -> Column:
    """The digest of a row: of each field ``-`` if it is null, else its UTF-8 length, a colon and its value."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*parts)


def tampered() -> Column:
    """The text of a tampered row: lower case, where 5 divides the hash of the id."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(chosen, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their number within ``group`` from 0 on in ``order`` (which tells rows apart), and ``n``, the size of the group. Groups have no nulls."""
    dealt = materialize(rows.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()))
    parts = dealt.groupBy(*group, "part").agg(F.count("*").alias("size"))
    before = W.partitionBy(*group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("n", F.sum("size").over(W.partitionBy(*group))).drop("size")
    placed = dealt.join(parts, [*group, "part"])
    out = materialize(placed.withColumn("idx", F.col("base") + F.row_number().over(W.partitionBy(*group, "part").orderBy(*order)) - 1).drop("base", "part"))
    discard(dealt)
    return out


def with_siblings(nodes: DataFrame, group: list[str]) -> DataFrame:
    """``nodes(<group>, idx, n, digest, ...)`` with ``run``, ``slot`` and the joined digests ``before`` and ``after`` each one in its run."""
    nodes = nodes.withColumn("run", F.floor(F.col("idx") / FAN)).withColumn("slot", (F.col("idx") % FAN).cast("int"))
    nodes = nodes.withColumn("length", F.least(F.lit(FAN).cast("long"), F.col("n") - F.col("run") * FAN))
    w = W.partitionBy(*group, "run").orderBy("idx")
    before = [F.when(F.col("slot") >= k, F.lag("digest", k).over(w)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(F.col("slot") + k < F.col("length"), F.lead("digest", k).over(w)) for k in range(1, FAN)]
    return nodes.withColumns({"before": F.concat_ws("", *before), "after": F.concat_ws("", *after)}).drop("length")


def climb(nodes: DataFrame, group: list[str]) -> list[DataFrame]:
    """The levels above ``nodes(<group>, idx, n, digest)``: ``[nodes, parents, ...]``, each written, until every group has one node."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = with_siblings(levels[-1].where("n > 1").select(*group, "idx", "n", "digest"), group).where("slot = 0")
        parent = first.select(*group, F.col("run").alias("idx"), F.ceil(F.col("n") / FAN).alias("n"), digest(F.col("digest"), F.col("after")).alias("digest"))
        levels.append(materialize(parent))
        most = -(-most // FAN)
    return levels


def tops(levels: list[DataFrame], group: list[str]) -> DataFrame:
    """``(<group>, digest)``: the last node of each group."""
    return reduce(DataFrame.union, [x.where("n = 1").select(*group, "digest") for x in levels])


def descend(levels: list[DataFrame], group: list[str], base: DataFrame, carried: list[str]) -> DataFrame:
    """``(<group>, idx, path, <carried>)`` of the nodes one level above ``levels[0]``: all siblings from there to the root.

    ``base(<group>, path, <carried>)`` is the path of each group's last node. A group that is one node has its row at ``idx`` 0.
    """
    lone = levels[0].where("n = 1").select(*group).join(base, group).withColumn("idx", F.lit(0).cast("long"))
    below = lone.select(*group, "idx", "path", *carried).where("false")
    written = []
    for level in reversed(levels[1:]):
        alone = level.where("n = 1").select(*group, "idx").join(base, group)
        beside = with_siblings(level.where("n > 1"), group).join(below.withColumnRenamed("idx", "run"), [*group, "run"])
        beside = beside.withColumn("path", F.concat(F.array(F.struct("before", "after")), "path"))
        below = materialize(alone.select(*group, "idx", "path", *carried).union(beside.select(*group, "idx", "path", *carried)))
        written.append(below)
    discard(*written[:-1])
    return below.union(lone.select(*group, "idx", "path", *carried))


def proofs(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """``(doc_id, source, leaf, subroot, root, path, altered)`` of every row.

    ``path`` has the joined digests before and after the row's node, level by level up to the root; ``altered`` is the leaf of the row with the
    text of the column ``altered``. Rows of a source are in the order of their ids, null ids first, and rows of one id in that of their leaves; repeated rows are leaves of their own.
    Null sources are a source, the first one. An empty table gives no rows. Other columns of ``docs`` take no part.
    """
    rows = docs.select(*(F.col(c).cast("long") if c in ("doc_id", "n_chars") else F.col(c) for c in FIELDS))
    source = (F.col("source").isNotNull().alias("known"), F.coalesce("source", F.lit("")).alias("source"))
    leaves = rows.select("doc_id", *source, leaf().alias("digest"), (leaf(text=altered) if altered is not None else leaf()).alias("altered"), F.monotonically_increasing_id().alias("copy"))
    # ids without nulls, so that one order serves the ranges and the places in them; equal leaves are told apart by their place in the table
    leaves = materialize(leaves.withColumn("named", F.col("doc_id").isNotNull()).withColumn("id", F.coalesce("doc_id", F.lit(0))))
    nodes = numbered(leaves, SOURCE, ["named", "id", "digest", "copy"]).drop("named", "id", "copy")
    discard(leaves)
    levels = climb(nodes, SOURCE)
    subroots = materialize(tops(levels, SOURCE).withColumn("every", F.lit(0)))
    sources = numbered(subroots, ["every"], SOURCE)
    above = climb(sources, ["every"])
    root = tops(above, ["every"]).first()
    one = docs.sparkSession.range(1).select(F.lit(0).alias("every"), F.array().cast(STEP).alias("path"), F.lit(None if root is None else root["digest"]).cast("string").alias("root"))
    top = _joined(sources, ["every"], descend(above, ["every"], one, ["root"]), ["root"])
    base = materialize(top.select(*SOURCE, "path", "root", F.col("digest").alias("subroot")))
    return _joined(nodes, SOURCE, descend(levels, SOURCE, base, ["root", "subroot"]), ["root", "subroot"]).select(
        "doc_id", F.when(F.col("known"), F.col("source")).alias("source"), F.col("digest").alias("leaf"), "subroot", "root", "path", "altered"
    )


def _joined(nodes: DataFrame, group: list[str], above: DataFrame, carried: list[str]) -> DataFrame:
    """``nodes`` with their whole path."""
    beside = with_siblings(nodes, group).join(above.select(*group, F.col("idx").alias("run"), F.col("path").alias("rest"), *carried), [*group, "run"])
    own = F.when(F.col("n") > 1, F.array(F.struct("before", "after"))).otherwise(F.array().cast(STEP))
    return beside.withColumn("path", F.concat(own, "rest")).drop("before", "after", "run", "slot", "rest")


def folded(node: Column, path: Column) -> Column:
    """The root that a node and the siblings of its path give."""
    return F.aggregate(path, node, lambda x, step: F.sha2(F.concat(step["before"], x, step["after"]), 256))


def verify(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``: each row's proof, and whether the row as it may have been tampered with still gives the root.

    Where 5 divides the CRC-32 of the id, tampering lower-cases the text; null ids and texts stay. See ``proofs`` for order, nulls and repeated rows.
    """
    out = proofs(docs, tampered())
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    out = out.withColumn("proof_sha256", F.sha2(siblings, 256)).withColumn("folded_root", folded(F.col("altered"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    parts = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


def _tree_sql(name: str, first: str, group: str) -> str:
    by, both = (f"{group}, ", f"a.{group} IS NOT DISTINCT FROM b.{group} AND ") if group else ("", "")
    mine = f"a.{group}, " if group else ""
    return f"""{name}_nodes(level, {by}idx, n, digest) AS (
  SELECT 0, {by}idx, n, digest FROM {first}
  UNION ALL
  SELECT level + 1, {by}idx // {FAN}, (max(n) + {FAN - 1}) // {FAN}, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name}_nodes WHERE n > 1 GROUP BY level, {by}idx // {FAN}
), {name}_steps AS (
  SELECT a.level, {mine}a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM {name}_nodes a JOIN {name}_nodes b ON {both}a.level = b.level AND a.idx // {FAN} = b.idx // {FAN} WHERE a.n > 1 GROUP BY a.level, {mine}a.idx
)"""


SQL = f"""
WITH RECURSIVE {CRC_TABLE}, marked AS (
  SELECT *, CASE WHEN {crc_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN translate(text, '{UPPER}', '{UPPER.lower()}') ELSE text END AS altered_text FROM documents, crc_table
), hashed AS (
  SELECT doc_id, source, {_leaf_sql('text')} AS digest, {_leaf_sql('altered_text')} AS altered FROM marked
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM hashed
), {_tree_sql('low', 'leaves', 'source')}, subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM low_nodes WHERE n = 1
), {_tree_sql('high', 'subroots', '')}, up(doc_id, source, leaf, leaf_idx, level, idx, x, siblings) AS (
  SELECT doc_id, source, digest, idx, 0, idx, altered, '' FROM leaves
  UNION ALL
  SELECT doc_id, u.source, leaf, leaf_idx, u.level + 1, u.idx // {FAN}, sha256(before || x || after), siblings || before || after
  FROM up u JOIN low_steps s ON s.source IS NOT DISTINCT FROM u.source AND s.level = u.level AND s.idx = u.idx
), met AS (
  SELECT u.*, s.digest AS subroot, s.idx AS place FROM up u JOIN low_nodes l ON l.source IS NOT DISTINCT FROM u.source AND l.level = u.level AND l.idx = u.idx AND l.n = 1
  JOIN subroots s ON s.source IS NOT DISTINCT FROM u.source
), over(doc_id, source, leaf, leaf_idx, subroot, level, idx, x, siblings) AS (
  SELECT doc_id, source, leaf, leaf_idx, subroot, 0, place, x, siblings FROM met
  UNION ALL
  SELECT doc_id, source, leaf, leaf_idx, subroot, u.level + 1, u.idx // {FAN}, sha256(before || x || after), siblings || before || after
  FROM over u JOIN high_steps s ON s.level = u.level AND s.idx = u.idx
)
SELECT doc_id, leaf, subroot, digest AS root, sha256(siblings) AS proof_sha256, x AS folded_root, x = digest AS verified
FROM over o JOIN high_nodes h ON h.level = o.level AND h.idx = o.idx AND h.n = 1
"""
