"""A training corpus from raw documents: five stages, each written and read again as Parquet.

All stages take rows as they come: null ids, texts and sources, repeated ids and equal rows, texts of any length, further columns (which stay, also where an
operator has columns of the same name), empty tables (which stay empty).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bellwether.llm import mixing, pii_feistel, shingle_join, sp_codec, toxicity_ftrl
from bellwether.llm.common import discard, materialize, table
from bellwether.llm.queries import model_bytes


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. A null text is scored as an empty one; rows of one id are judged by their own texts."""
    return toxicity_ftrl.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more (5-word shingles), one document stays: that with the smallest id, null ids last."""
    return shingle_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms, equal values equal ones. Every row stays; null and empty texts stay as they are."""
    return pii_feistel.pseudonymise(docs).drop("pii")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as it was drawn, none or twice included. Texts without words, null ones too, have size 0 and are never drawn; a null source is a source; rows of a source are ordered by size class, then by a hash of id and text, and equal rows are drawn as often together."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text beside its columns; null and empty texts have none. Equal texts have equal ids."""
    return sp_codec.encode(docs, model_bytes())


STAGES = [("toxicity", toxicity), ("simhash", near_duplicates), ("pii", personal_data), ("mix", mix), ("sentencepiece", encode)]

#: The stages learn weights, permute by keyed hashes and cut pieces, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read as the next one's input, which then goes."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir))
        discard(before)
    return docs
