"""The pipeline on null, repeated and huge ids, odd columns, and an empty table."""

from collections import Counter

import corpus_pipeline
from bellwether.llm import mixing, pii_feistel

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
HUGE = 2**63 - 1


def rows():
    words = [f"w{k}" for k in range(4000)]
    text = lambda k: " ".join(words[20 * k : 20 * k + 20])
    out = [(k, text(k), "en", ("a", "b", None)[k % 3], 1) for k in range(60)]
    out += [(None, text(k), "en", "a", 1) for k in range(60, 75)]
    out += [(7, text(k), "en", "b", 1) for k in range(75, 80)] + [(7, text(75), "en", "b", 1)] * 4
    out += [(HUGE, text(80), "en", "a", 1), (HUGE - 1, text(80) + " tail", "en", "b", 1), (100, text(5).upper(), "en", "a", 1), (None, text(6), "en", None, 1)]
    return [*out, (200, None, "en", "a", None), (201, "", "en", "a", 0), (202, "card 4111 1111 1111 1111 " + text(90), "en", "b", 1)]


def test_rows_of_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame(rows(), DOCS).selectExpr("*", "'own' AS ids", "1 AS `x y`", "2 AS k_id", "3 AS row", "4 AS times")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 9 == 0)) for k in range(60)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = stages["toxicity"](spark, given, str(tmp_path))
    assert kept.columns == given.columns and kept.count() == len(rows())
    single = stages["simhash"](spark, kept, str(tmp_path))
    left = Counter(tuple(r)[:2] for r in single.collect())
    want = Counter((i, t) for i, t, *_ in dict.fromkeys(rows()))
    for gone in ((HUGE, rows()[84][1]), (100, rows()[86][1]), (None, rows()[87][1]), (201, "")):
        want.subtract([gone])
    assert single.columns == given.columns and left == +want
    masked = stages["pii"](spark, single, str(tmp_path))
    secret = __import__("hashlib").sha256(b"corpus key").digest()
    assert Counter((r["doc_id"], r["text"]) for r in masked.collect()) == Counter((i, None if t is None else pii_feistel.rewrite(t, secret)[0]) for i, t in left)
    mixed = stages["mix"](spark, masked, str(tmp_path))
    assert mixed.columns == given.columns and mixed.count() == mixing.copies(masked).agg({"copies": "sum"}).first()[0]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert out.where("parity AND round_trip").count() == out.count() and {"x y", "k_id", "row", "times"} <= set(out.columns)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
