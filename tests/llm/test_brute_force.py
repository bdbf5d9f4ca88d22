"""The suffix tree and the whole pipeline against plain forms that share none of their array code."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash

from bellwether.llm import lm_pst, mixing, pii_feistel, queries, simhash_ball, toxicity_ftrl

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = object()


def plain_tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), END]


def contexts(tokens, t, depth):
    """The words before token ``t``; the place before a text is an end, and nothing lies before that."""
    before = [END, *tokens[:t]]
    return tuple(before[-depth:]) if len(before) >= depth else None


def plain_tree(texts, setup):
    """The tree by dictionaries: the top of frequent contexts, and below it the states of the first context that leaves it."""
    depths = range(1, max(setup.depth, setup.reach) + 1)
    count, follow = Counter(), {d: defaultdict(Counter) for d in depths}
    for text in texts:
        tokens = plain_tokens(text)
        count.update(tokens)
        for t, w in enumerate(tokens):
            for d in depths:
                if (c := contexts(tokens, t, d)) is not None:
                    follow[d][c][w] += 1
    n, v = sum(count.values()), len(count)
    least = max(setup.least, math.ceil(setup.p_min * n))

    def total(context):
        return count[context[0]] if len(context) == 1 else follow[len(context) - 1][context[:-1]][context[-1]]

    def frequent(context):
        return all(count[x] >= least for x in context) and total(context) >= least and (len(context) == 1 or frequent(context[:-1]))

    top, tail = {}, {}

    def probability(context, w):
        """In the longest kept state that ends the context."""
        p = (count[w] + 1) / (n + v + 1)
        for d in range(1, len(context) + 1):
            state = top.get(context[-d:]) if d <= setup.depth else None
            if state is None:
                state = tail.get(context[-d:])
            if state is not None:
                size, back, seen = state
                p = (seen.get(w, 0) + back * p) / (size + setup.kappa)
        return p

    def fill(kept, context, words, size):
        gain = sum(c * math.log(c / size / probability(context[1:], w)) for w, c in words.items())
        if words and gain >= max(setup.divergence, setup.divergence_share * size):
            kept[context] = (size, size - sum(words.values()) + setup.kappa, words)

    for d in range(1, setup.depth + 1):
        new = {}
        for context, words in follow[d].items():
            if frequent(context):
                fill(new, context, {w: c for w, c in words.items() if c >= least and count[w] >= least}, total(context))
        top.update(new)
    new = {}
    for d in range(1, min(setup.reach, setup.depth) + 1):
        for context, words in follow[d].items():
            size = sum(words.values())
            if not frequent(context) and (d == 1 or frequent(context[1:])) and size >= setup.tail_least:
                fill(new, context, {w: c for w, c in words.items() if count[w] >= least}, size)
    tail.update(new)

    def score(text):
        tokens = plain_tokens(text)
        reach = max(setup.depth, setup.reach)
        return sum(math.log10(probability(next(c for d in range(reach, 0, -1) if (c := contexts(tokens, t, d)) is not None), w)) for t, w in enumerate(tokens))

    return score, top, tail


@pytest.mark.parametrize("setup", [lm_pst.Setup(), lm_pst.Setup(depth=3, p_min=0.004, divergence=4.0), lm_pst.Setup(depth=2, p_min=0.02, divergence=3.0, reach=1), lm_pst.Setup(depth=5)])
def test_suffix_tree_against_plain_form(spark, setup):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(["a", "b", "C d e i j k", "f g h", "f x", "d y z", f"rare{k}", f"few{k // 6} more{k // 6} b"], 40)), "en", "s", 0) for k in range(120)]
    rows += [(120, None, "en", "s", 0), (121, "", "en", "s", 0), (122, "never seen", "en", "s", 0), (5, rows[5][1], "en", "s", 0)]
    got = lm_pst.score_documents(spark.createDataFrame(rows, DOCS), setup).collect()
    score, top, tail = plain_tree([t for k, t, *_ in rows if zlib.crc32(str(k).encode()) % 7 != 2], setup)
    assert {len(s) for s in top} >= set(range(1, min(setup.depth, 3) + 1)) if setup.p_min < 0.001 else len(top) > 3
    assert not tail if setup.p_min < 0.001 else {len(s) for s in tail} == set(range(1, setup.reach + 1))
    assert sorted((r["doc_id"], round(r["score"], 4)) for r in got) == sorted((k, round(score(t), 4)) for k, t, *_ in rows)


def features(text):
    w = re.findall(r"[^\W\d_]+", text.lower())
    return {*((x,) for x in w), *zip(w, w[1:], strict=False), *((x, "", y) for x, y in zip(w, w[2:], strict=False))}


def plain_ftrl(rows, setup):
    """FTRL-proximal over unhashed features, in the order of the ids' crc32."""
    z, n, bias, bias_n = defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(f):
        if abs(z[f]) <= setup.l1:
            return 0.0
        return (math.copysign(setup.l1, z[f]) - z[f]) / ((setup.beta + math.sqrt(n[f])) / setup.alpha + setup.l2)

    for _ in range(setup.passes):
        for _, text, y in sorted(rows, key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0])):
            at = {f: weight(f) for f in features(text)}
            g = 1 / (1 + math.exp(-bias - sum(at.values()))) - y
            for f, w in at.items():
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / setup.alpha * w
                n[f] += g * g
            bias_n += g * g
            bias -= setup.alpha * g / (1 + math.sqrt(bias_n))
    return lambda text: 1 / (1 + math.exp(-bias - sum(weight(f) for f in features(text))))


def test_toxicity_scores_against_plain_form(spark):
    rows, labels = fixture_rows()
    rows = [(k, t, lang) for k, t, lang, *_ in rows] + [(None, rows[6][1], "en"), (1, None, "en"), (1, "a second text of one id", "en"), (2, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS `x y`", "'own' AS Score").repartition(5)
    setup, toxic = toxicity_ftrl.Setup(l1=1.0), dict(labels)
    texts = {}
    for k, t, _ in rows:
        if t is not None:
            texts[k] = min(t, texts.get(k, t))
    score = plain_ftrl([(k, t, toxic[k]) for k, t in texts.items() if k in toxic and zlib.crc32(str(k).encode()) % 3 != 1], setup)
    model = toxicity_ftrl.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), setup)
    assert len(model[0]) > 100
    got = toxicity_ftrl.score(docs, model, setup)
    assert got.columns == ["doc_id", "text", "lang", "x y", "score", "predicted"]
    # the operator hashes its features, so a few of them share a weight
    want = sorted((str(k), t or "", score(t or "")) for k, t, _ in rows)
    for r, (k, t, s) in zip(sorted(got.collect(), key=lambda r: (str(r["doc_id"]), r["text"] or "")), want, strict=True):
        assert (str(r["doc_id"]), r["text"] or "") == (k, t) and abs(r["score"] - s) < 0.005


def plain_fingerprint(text):
    w = [x.encode() for x in plain_tokens(text)[:-1]]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, radius):
    label = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            low = min(label[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= radius)
            changed |= low < label[i]
            label[i] = min(low, label[i])
    return label


def fixture_rows():
    rng = np.random.default_rng(8)
    vocabulary = [a + b for a in ("lo", "mi", "ra", "te", "su", "no", "vi", "pe", "ka") for b in ("n", "r", "st", "l", "dy", "m", "sh", "k", "x")]
    rows, labels = [], []
    for k in range(360):
        bad = k % 6 == 0
        words = [*rng.choice(vocabulary, int(rng.integers(20, 60))), *(["vile", "rude"] if bad else [])]
        text = " ".join(map(str, rng.permutation(words)))
        if k % 7 == 1:
            text += f" card 4111 1111 1111 1111 on 2024-02-{k % 28 + 1:02d}"
        rows.append((k, text, "en", ["alpha", "alpha", "alpha", "beta", None][k % 5], len(text)))
        labels.append((k, int(bad)))
    rows += [(1000 + k, rows[k][1], "en", "beta", 0) for k in range(1, 60, 4)]  # exact copies
    rows += [(2000 + k, rows[k][1].upper(), "en", "alpha", 0) for k in range(2, 60, 4)]  # equal but for case
    return rows, labels


def test_pipeline_against_plain_form(spark, tmp_path):
    import corpus_pipeline

    rows, labels = fixture_rows()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    setup, toxic = toxicity_ftrl.Setup(), dict(labels)
    score = plain_ftrl([(k, t, toxic[k]) for k, t, *_ in rows if k in toxic and zlib.crc32(str(k).encode()) % 3 != 1], setup)
    kept = {k: (t, *rest) for k, t, *rest in rows if score(t) < setup.threshold}
    assert all(k in kept for k, *_ in rows if toxic.get(k % 1000) == 0)
    label = groups({k: plain_fingerprint(v[0]) for k, v in kept.items()}, 2)
    kept = {k: v for k, v in kept.items() if label[k] == k}
    assert not any(k >= 1000 for k in kept)
    secret = hashlib.sha256(b"corpus key").digest()
    kept = {k: (pii_feistel.rewrite(v[0], secret)[0], *v[1:]) for k, v in kept.items()}
    assert not any("4111 1111 1111 1111" in v[0] for v in kept.values())

    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(k, v[0], v[2]) for k, v in kept.items()])
    copies = {k: taken // size for k, size, taken in db.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall()}
    assert sum(copies.values()) > len(kept)
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.model_bytes())
    want = Counter({(k, v[0], tuple(library.encode(v[0]))): copies[k] for k, v in kept.items() if copies[k]})
    assert Counter((r["doc_id"], r["text"], tuple(r["ids"])) for r in got) == want


def test_near_duplicate_stage_equals_its_operator(spark):
    rows, _ = fixture_rows()
    docs = spark.createDataFrame(rows, DOCS)
    label = groups({k: plain_fingerprint(t) for k, t, *_ in rows}, 2)
    assert {r["doc_id"]: r["component_id"] for r in simhash_ball.near_duplicates(docs).collect()} == label


@pytest.mark.parametrize("text", ["", "   ", "one"])
def test_plain_fingerprint_of_short_texts(text):
    assert plain_fingerprint(text) == simhash_ball.fingerprint(text.lower().encode().split())
