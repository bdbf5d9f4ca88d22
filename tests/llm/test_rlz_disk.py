"""What the substring dedup sends and writes, and that it does not matter where chunks end."""

from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from bellwether.llm import packed, rlz_dedup

DOCS = "doc_id long, text string"


def texts(n, words=400):
    rng = np.random.default_rng(10)
    names = np.array([f"{x:x}" for x in rng.integers(1 << 8, 1 << 28, 5000)])
    passage = list(rng.choice(names, 300))
    rows = []
    for k in range(n):
        w = list(rng.choice(names, words))
        if k % 3 == 0:
            a = int(rng.integers(0, 200))
            w[50:50] = passage[a : a + 100]
        rows.append((k, " ".join(w)))
    return rows


def exchanged(spark):
    """The exchange files of a local session, with their bytes."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f): f.stat().st_size for x in folders for f in Path(x.getPath()).rglob("shuffle_*.data")}


def test_exchanges_hold_no_more_than_the_texts_and_a_third(spark):
    rows = texts(3000)
    docs = spark.createDataFrame(rows, DOCS)
    before = exchanged(spark)
    rlz_dedup.strip(docs).write.format("noop").mode("overwrite").save()
    sent = sum(n for f, n in exchanged(spark).items() if f not in before)
    # 0.9 times the texts, 1.8 when blocks were rows of their own
    assert 0 < sent < 1.3 * sum(len(t) for _, t in rows)


def test_chunks_of_any_size_give_the_same_rows(spark, monkeypatch):
    rows = texts(60, 120)
    rows += [(None, rows[0][1])] * 5 + [rows[3]] * 4 + [(70, "same " * 200), (71, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    plain = lambda: Counter(str((r["doc_id"], r["n_removed"], r["kept_sha256"], r["spans"], r["factors"])) for r in rlz_dedup.strip(docs).collect())
    want = plain()
    for chunk in (7, 100):
        monkeypatch.setattr(rlz_dedup, "CHUNK", chunk)
        got = plain()
        if chunk == 100:  # no row has so many blocks, so none is cut
            assert got == want
        assert sum(got.values()) == len(rows)
    assert Counter(x.split("[")[0] for x in got.elements()) == Counter(x.split("[")[0] for x in want.elements())


def test_chunks_end_where_rows_do(monkeypatch):
    monkeypatch.setattr(rlz_dedup, "CHUNK", 4)
    assert [rlz_dedup._cut(np.array(x)) for x in ([1, 1, 2, 2, 2], [1, 1, 1, 1], [1, 1, 1, 1, 1, 2], [1, 1, 1, 1, 2], [1, 2, 2, 2, 2, 2])] == [2, 4, 4, 4, 1]


def test_a_frequent_anchor_is_spread():
    n, buckets = 20_000, 512
    one, rng = np.ones(n, np.int64), np.random.default_rng(3)
    items = rlz_dedup.Items(np.arange(n), one == 0, np.arange(n), np.arange(n), rng.integers(0, 2**62, n), one, one, one, np.full(n, 77, np.uint64), rng.integers(0, 2**62, n).astype(np.uint64))
    sent = [[packed.unpack(p) for p in r["parts"]] for r in rlz_dedup._chunk(0, items, buckets, True).to_pylist() if r["base"] != rlz_dedup.OWN]
    assert max(len(p[0]) for p in sent) < 4 * n / buckets and sum(len(p[0]) for p in sent) == n
    assert sorted(len(p[7]) for p in sent)[-2:] == [0, 2]  # its smallest and its largest block
    own = Counter(r["bucket"] for k in range(100) for r in rlz_dedup._chunk(k << 24, items._replace(**{f: v[:9] for f, v in items._asdict().items()}), buckets, True).to_pylist() if r["base"] == rlz_dedup.OWN)
    assert max(own.values()) < 6


def test_chunks_of_other_rows_do_not_meet():
    def answered(seed):
        rng, one = np.random.default_rng(seed), np.ones(9, np.int64)
        items = rlz_dedup.Items(np.arange(9), one == 0, np.arange(9), np.arange(9), rng.integers(0, 2**62, 9), one, one, one, np.arange(9).astype(np.uint64), np.arange(9).astype(np.uint64))
        sent = pa.Table.from_batches([rlz_dedup._chunk(5, items, 512, True)])
        return [rlz_dedup._answer(sent.slice(k, 1)) for k in range(sent.num_rows)]

    first, again = answered(1), answered(2)
    assert rlz_dedup._gather(pa.concat_tables(first)).num_rows == 0  # nothing stands twice
    for mixed in (first[:-1], first[1:], again[:1] + first[1:], first[:-1] + again[-1:]):
        with pytest.raises(RuntimeError):
            rlz_dedup._gather(pa.concat_tables(mixed))
