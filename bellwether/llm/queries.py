"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_rotation, conv_repair, ego_join, lm_pst, media_tiles, merkle, mixing, pii_feistel, rlz_dedup, secret_scan, simhash_ball, sp_codec, toxicity_ftrl
from .common import table

#: Where the model file of the SentencePiece operator lies.
SP_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@lru_cache(maxsize=4)
def model_bytes(path: str = SP_MODEL) -> bytes:
    return Path(path).read_bytes()


def op1_pst_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_pst.score_documents(table(spark, sf_dir, "documents"))


def op2_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat_rotation.rotate(table(spark, sf_dir, "conversations"))
    return out.withColumn("mask", F.array_join(F.transform("mask", lambda x: F.concat_ws("-", x[0].cast("string"), x[1].cast("string"))), ","))


def op3_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_ftrl.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sp_codec.encode(table(spark, sf_dir, "documents"), model_bytes())
    return out.select("doc_id", "n_pieces", "ids_crc32", "ids_sha256", "round_trip", "parity")


def op6_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ball.near_duplicates(table(spark, sf_dir, "documents"))


def op7_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_feistel.pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text", F.size("pii").alias("n_found"), "pii")


def op8_media_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_tiles.text_media(table(spark, sf_dir, "documents"))


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op10_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.strip(table(spark, sf_dir, "documents")).drop("kept", "spans", "factors")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv_repair.repair(conv_repair.damage(table(spark, sf_dir, "conversations")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pst_scoring, op2_chat_rotation, op3_toxicity_ftrl, op4_ego_join, op5_sentencepiece, op6_simhash_ball, op7_pii_feistel, op8_media_tiles, op9_systematic_mix, op10_rlz_dedup, op11_conversation_repair, op12_merkle_manifest, op13_secret_scan)
}

OP4_SQL = """
WITH RECURSIVE fine AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM fine UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least_id AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM fine JOIN least_id l ON l.a = vec_id LEFT JOIN degree d ON d.a = vec_id
"""

OP10_SQL = """
WITH worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM worded, unnest(range(1, greatest(len(w) - 33, 1))) AS t(i)
), again AS (
  SELECT h FROM runs GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, j FROM runs JOIN again USING (h), unnest(range(i, i + 35)) AS t(j)
), kept AS (
  SELECT doc_id, j, w[j] AS word, gone.j IS NOT NULL AS removed
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM worded) LEFT JOIN gone USING (doc_id, j)
), summed AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT removed) AS kept
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN summed USING (doc_id)
"""

SQL: dict[str, str] = {"op2_chat_rotation": chat_rotation.SQL, "op4_ego_join": OP4_SQL, "op9_systematic_mix": mixing.SQL, "op10_rlz_dedup": OP10_SQL, "op11_conversation_repair": conv_repair.SQL, "op12_merkle_manifest": merkle.SQL, "op13_secret_scan": secret_scan.SQL}
