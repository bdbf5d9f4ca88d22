"""Multi-party perspective rotation of dialogues.

For every participant of a conversation (a role that is not the system's), the whole dialogue is one rendering
with that speaker as the assistant and all others as named users, and a training mask over exactly the
assistant's words. It is kept as rows of ``PAGE`` messages: a page has its place in the rendering, masks count from the rendering's beginning, and the pages of a
rendering, one after the other, are its text. So a dialogue of any length is one rendering, and none needs one task.

Messages are numbered within their dialogue over ranges of (dialogue, turn, role and text), equal ones together with their count.
They meet the participants in a join on the dialogue, whose long side Spark's skew join splits, and are grouped by (dialogue, participant, page). Where a page begins is the sum of the
lengths before it, over blocks of ``BLOCK`` pages and within each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, materialize

PAGE = 32
BLOCK = 1024
#: A dialogue as two columns without nulls.
DIALOGUE = ["known", "conv"]
END = "<|end|>\n"


def _placed(turns: DataFrame, page: int) -> DataFrame:
    """``(known, conv, role, text, at, page)``: every message with its number in its dialogue, by turn (none: last), role and text."""
    turn = F.col("turn").cast("long")
    rows = turns.select(
        F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), turn.isNull().alias("late"), F.coalesce(turn, F.lit(0)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    fields = [*DIALOGUE, "late", "turn", "role", "text"]
    sort = F.concat("role", F.lit("\0"), "text")
    # the beginning of role and text is enough to deal rows out; those that share it lie in one range, in order
    dealt = rows.groupBy(*fields).agg(F.count("*").alias("copies")).repartitionByRange(*DIALOGUE, "late", "turn", F.substring(sort, 1, 64)).sortWithinPartitions(*DIALOGUE, "late", "turn", sort)
    dealt = materialize(dealt.select(*DIALOGUE, "role", "text", "copies", F.monotonically_increasing_id().alias("mid"))).withColumn("part", F.shiftright("mid", 33))
    parts = dealt.groupBy(*DIALOGUE, "part").agg(F.sum("copies").alias("size"))
    earlier = W.partitionBy(*DIALOGUE).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(*DIALOGUE, "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy(*DIALOGUE, "part").orderBy("mid").rowsBetween(W.unboundedPreceding, -1)
    first = F.col("base") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    out = dealt.join(parts, [*DIALOGUE, "part"]).withColumn("first", first).withColumn("at", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)))
    return out.select(*DIALOGUE, "role", "text", "at", F.floor(F.col("at") / page).alias("page"))


def _begins(pages: DataFrame, by: list[str]) -> DataFrame:
    """``pages(<by>, page, n_chars)`` with ``begin``, the characters of the pages before."""
    lengths = pages.select(*by, "page", "n_chars", F.floor(F.col("page") / BLOCK).alias("block"))
    up_to = lambda keys, order: W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    blocks = lengths.groupBy(*by, "block").agg(F.sum("n_chars").alias("all")).withColumn("base", F.coalesce(F.sum("all").over(up_to(by, "block")), F.lit(0))).drop("all")
    inside = F.coalesce(F.sum("n_chars").over(up_to([*by, "block"], "page")), F.lit(0))
    return lengths.withColumn("inside", inside).join(blocks, [*by, "block"]).select(*by, "page", (F.col("base") + F.col("inside")).alias("begin"))


def rotate(turns: DataFrame, system: str = "system", page: int = PAGE) -> DataFrame:
    """``(conv_id, speaker, page, begin, n_turns, text, mask, n_trained)`` of every page of every perspective.

    A rendering is its pages' ``text`` in order; ``begin`` is where the page begins in it, and ``mask`` has the (begin, end) character ranges of the rendering to train on: what the speaker says on this page, and the
    end mark after it. Null texts are empty messages; a null role is the participant "unknown"; null ids are
    one conversation. Messages are in order of their turn numbers, those without one last; ties are put in order of
    role and text, repeated rows stay. A conversation of system messages alone has no perspective; an empty
    table gives no rows. Other columns are ignored.
    """
    said = materialize(_placed(turns, page))
    speakers = said.where(F.col("role") != system).select(*DIALOGUE, F.col("role").alias("speaker")).distinct()
    both = said.join(speakers, DIALOGUE)
    mine = F.col("role") == F.col("speaker")
    head = F.when(F.col("role") == system, F.lit("<|system|>\n")).when(mine, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), F.col("role"), F.lit("|>\n")))
    message = F.struct("at", F.col("text").alias("body"), head.alias("head"), mine.alias("mine"))
    by = [*DIALOGUE, "speaker"]
    rendered = both.groupBy(*by, "page").agg(F.sort_array(F.collect_list(message)).alias("m"))  # ``page`` messages at most
    rendered = rendered.withColumn("text", F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["body"], F.lit(END))), ""))
    # running position: each step appends (begin, end) where the speaker talks
    walk = F.aggregate(
        "m",
        F.struct(F.lit(0).cast("long").alias("to"), F.array().cast("array<array<bigint>>").alias("mask")),
        lambda s, x: F.struct(
            (s["to"] + F.length(x["head"]) + F.length(x["body"]) + len(END)).alias("to"),
            F.when(x["mine"], F.concat(s["mask"], F.array(F.array(s["to"] + F.length(x["head"]), s["to"] + F.length(x["head"]) + F.length(x["body"]) + len(END) - 1)))).otherwise(s["mask"]).alias("mask"),
        ),
    )
    trained = F.aggregate("here", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    pages = rendered.withColumn("here", walk["mask"]).select(*by, "page", F.size("m").cast("long").alias("n_turns"), "text", "here", trained.alias("n_trained"), F.length("text").cast("long").alias("n_chars"))
    pages = materialize(pages)
    discard(said)
    out = pages.join(_begins(pages, by), [*by, "page"])
    mask = F.transform("here", lambda x: F.transform(x, lambda at: at + F.col("begin")))
    conv = F.when(F.col("known"), F.col("conv").cast(turns.schema["conv_id"].dataType))
    return out.select(conv.alias("conv_id"), "speaker", "page", "begin", "n_turns", "text", mask.alias("mask"), "n_trained")


SQL = f"""
WITH said AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS k FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'
), parts AS (
  SELECT a.*, speaker, k // {PAGE} AS page, role = speaker AS mine,
         CASE WHEN role = 'system' THEN '<|system|>' || chr(10) WHEN role = speaker THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || role || '|>' || chr(10) END AS head
  FROM said a JOIN speakers b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
), placed AS (
  SELECT *, CAST(coalesce(sum(length(head) + length(text) + 8) OVER (PARTITION BY conv_id, speaker ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM parts
)
SELECT conv_id, speaker, page, min(start) AS "begin", count(*) AS n_turns,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(CASE WHEN mine THEN CAST(start + length(head) AS VARCHAR) || '-' || CAST(start + length(head) + length(text) + 7 AS VARCHAR) END, ',' ORDER BY k), '') AS mask,
       CAST(sum(CASE WHEN mine THEN length(text) + 7 ELSE 0 END) AS BIGINT) AS n_trained
FROM placed GROUP BY conv_id, speaker, page
"""
