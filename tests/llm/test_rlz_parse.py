"""The factors of the substring dedup against a greedy parse over plain tuples of words."""

from collections import defaultdict

import numpy as np
import pyarrow as pa

from bellwether.llm import rlz_dedup
from bellwether.llm.tokens import window_hashes, words

DOCS = "doc_id long, text string"
WIDTH, GRAM = 35, rlz_dedup.GRAM


def rows_with_passages():
    rng = np.random.default_rng(12)
    passages = [[f"p{i}x{k}" for k in range(n)] for i, n in enumerate((200, 90, 60))]
    rows = []
    for k in range(50):
        w = [f"own{k}x{j}" for j in range(int(rng.integers(5, 60)))]
        for p in passages:
            if rng.random() < 0.6:
                a = int(rng.integers(0, len(p) // 2))
                at = int(rng.integers(0, len(w)))
                w[at:at] = p[a : a + int(rng.integers(20, len(p)))]
        rows.append((k, " ".join(w)))
    return rows + [(50, rows[0][1]), (51, "same " * 120), (52, None), (53, ""), (54, " ".join(passages[0] + passages[0]))]


def gram_order(w):
    """The order of the grams is the one thing taken from the operator."""
    h = window_hashes(words(pa.array([" ".join(w)])).hashes, GRAM)
    return [(int(x) >> 32 << 32, i) for i, x in enumerate(h)]


def plain_parse(rows, doc_place):
    blocks, runs_at = defaultdict(list), defaultdict(list)
    cut = {}
    for k, t in rows:
        w = (t or "").split()
        order = gram_order(w)
        anchor = [min(order[i : i + WIDTH - GRAM + 1])[1] for i in range(len(w) - WIDTH + 1)]
        cut[k] = []
        for i, a in enumerate(anchor):
            runs_at[tuple(w[i : i + WIDTH])].append((doc_place[k], i, k))
            if i and anchor[i - 1] == a:
                cut[k][-1][1] += 1
            else:
                cut[k].append([i, 1, a])
        for i, n, a in cut[k]:
            blocks[tuple(w[i : i + n + WIDTH - 1]), a - i].append((doc_place[k], i, k))
    out = {}
    for k, t in rows:
        w, found = (t or "").split(), []
        for i, n, a in cut[k]:
            places = blocks[tuple(w[i : i + n + WIDTH - 1]), a - i]
            if len(places) > 1:
                first = min(places)
                found.append((i, n, max(places) if (doc_place[k], i) == first[:2] else first))
            else:
                # the ends of factors, run by run; of equal blocks the first one stands for all
                for j in range(i, i + n):
                    run = runs_at[tuple(w[j : j + WIDTH])]
                    if len(run) > 1:
                        found.append((j, 1, None))
        factors = []
        for i, n, source in found:
            last = factors[-1] if factors else None
            if source and last and last[2] and last[0] + last[1] == i and last[2][2] == source[2] and last[2][1] + last[1] == source[1]:
                last[1] += n
            else:
                factors.append([i, n, source])
        out[k] = factors
    return out


def test_factors_equal_a_greedy_parse(spark):
    rows = rows_with_passages()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    place = {r["doc_id"]: r["h"] for r in rlz_dedup._keyed(docs).selectExpr("doc_id", "shiftright(xxhash64(no_id, doc_id, text_hash), 32) AS h").collect()}
    text = {k: (t or "").split() for k, t in rows}
    want = plain_parse(rows, place)
    whole = 0
    for r in rlz_dedup.strip(docs).collect():
        k = r["doc_id"]
        for f in r["factors"]:
            # every factor is a copy of what it names, and not of itself
            assert text[k][f["begin"] : f["begin"] + f["words"]] == text[f["source"]][f["source_begin"] : f["source_begin"] + f["words"]]
            assert f["words"] >= WIDTH and (f["source"], f["source_begin"]) != (k, f["begin"])
        got = {(f["begin"], f["words"] - WIDTH + 1, f["source"], f["source_begin"]) for f in r["factors"]}
        for i, n, source in want[k]:
            if source and not any(s is None and (j + 1 == i or j == i + n) for j, _, s in want[k]):
                whole += 1
                assert (i, n, source[2], source[1]) in got  # factors between no run-by-run neighbours are the same
        covered = {j for i, n, *_ in got for j in range(i, i + n)}
        assert covered == {j for i, n, _ in want[k] for j in range(i, i + n)}
        gone = {j for i, n, _ in want[k] for j in range(i, i + n + WIDTH - 1)}
        assert {j for a, b in r["spans"] for j in range(a, b)} == gone and r["n_removed"] == len(gone)
        assert r["kept"] == " ".join(x for j, x in enumerate(text[k]) if j not in gone)
    assert whole > 20


def test_spans_of_neighbouring_texts_stay_apart(spark):
    passage = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, passage), (2, passage), (3, f"x {passage}"), (None, f"{passage} y")], DOCS).coalesce(1)
    got = sorted((str(r["doc_id"]), [list(x) for x in r["spans"]], r["kept"]) for r in rlz_dedup.strip(docs).collect())
    assert got == [("1", [[0, 40]], ""), ("2", [[0, 40]], ""), ("3", [[1, 41]], "x"), ("None", [[0, 40]], "y")]


def test_chain_extends_while_source_and_text_go_on():
    x = lambda *v: np.array(v, dtype=np.int64)
    got = rlz_dedup.chain(x(0, 0, 0, 0, 1), x(5, 0, 9, 12, 0), x(4, 5, 3, 2, 1), x(7, 7, 7, 8, 8), x(15, 10, 19, 22, 24))
    assert [tuple(c.tolist()) for c in got] == [(0, 0, 1), (0, 12, 0), (12, 2, 1), (7, 8, 8), (10, 22, 24)]


def test_thousands_of_equal_rows(spark):
    text = " ".join(f"w{k % 977}v{k}" for k in range(3000))
    rows = [(None, text)] * 2000 + [(5, text + " own")] * 700 + [(-(2**63), text[:600] + " alone"), (0, "x " * 20)]
    got = rlz_dedup.strip(spark.createDataFrame(rows, DOCS).repartition(4)).groupBy("doc_id", "n_words", "n_removed").count().collect()
    alone = len(text[:600].split()) + 1
    # the last word before " alone" is cut short, so it is no word of the passage
    kept = 2 if text[600] != " " and text[599] != " " else 1
    want = {(None, 3000, 3000, 2000), (5, 3001, 3001, 700), (-(2**63), alone, alone - kept, 1), (0, 20, 0, 1)}
    assert {tuple(r) for r in got} == want
