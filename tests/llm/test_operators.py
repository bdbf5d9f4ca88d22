"""Corpus operators against brute force, round trips and edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bellwether.llm import chat_rotation, common, ego_join, lm_pst, media_tiles, mixing, pii_feistel, queries, rlz_dedup, simhash_ball, sp_codec, toxicity_ftrl

DOCS = "doc_id long, text string, source string, extra string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{k}" for k in range(3000))


def odd_docs(spark):
    rows = [(1, None, "a", "x"), (2, "", None, "x"), (3, "  \t\n", "a", None), (4, "one", "b", "x"), (5, LONG, "b", "x"), (6, LONG + " end", "c", "x"), (7, "Same Text here", None, "x"), (7, "Same Text here", None, "x"), (None, "same text HERE", "a", "x"), (8, "é 😀 ünï " * 40, "c", "x")]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_suffix_tree_scores(spark):
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(rng.choice(["a", "b", "c d e", "f g h"], 30)), "s", "x") for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r for r in lm_pst.score_documents(docs).collect()}
    count, n = Counter(), 0
    for k, t, *_ in rows:
        if zlib.crc32(str(k).encode()) % 7 != 2:
            count.update([*t.split(), None])
            n += len(t.split()) + 1
    for k, t, *_ in rows:
        tokens = [*t.split(), None]
        assert got[k]["n_tokens"] == len(tokens) and got[k]["n_known"] == sum(w in count for w in tokens) and got[k]["train_tokens"] == n
        assert got[k]["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in tokens))
    held = [r for r in got.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # "c d e" is learnt


def test_suffix_tree_sums_to_one(spark):
    docs = spark.createDataFrame([(k, "a b a c a b d", "s", "x") for k in range(40)], DOCS)
    model, *_ = lm_pst.train(docs)
    words = np.concatenate((np.arange(len(model.vocab)), [-1]))
    base = lm_pst._base(model, np.append(model.count, 0))
    for d, ((ids, *_), _) in enumerate(model.levels, 1):
        for s in ids:
            p = lm_pst._probability(model, d, np.full(len(words), s), words, base)
            assert p.sum() == pytest.approx(base.sum()) == pytest.approx(1)


def test_suffix_tree_edges(spark):
    assert lm_pst.score_documents(empty(spark)).count() == 0
    got = lm_pst.score_documents(odd_docs(spark)).collect()
    assert len(got) == 10 and all(r["n_tokens"] >= 1 and math.isfinite(r["score"]) for r in got)


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "ann", "tie"), (2, None, "ann", "late"), (None, 0, None, "who")]
    out = chat_rotation.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r["conv_id"], r["speaker"]) for r in out} == {(1, "ann"), (1, "bob"), (2, "ann"), (None, "unknown")}
    for r in out:
        said = [t for c, _, role, t in rows if c == r["conv_id"] and (role or "unknown") == r["speaker"]]
        assert sorted(r["text"][a:b] for a, b in r["mask"]) == sorted((t or "") + "<|end|>" for t in said)
        assert r["n_trained"] == sum(b - a for a, b in r["mask"])
    assert chat_rotation.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_pages_of_a_long_dialogue(spark):
    rows = [(1, k, f"p{k % 3}", f"m{k}") for k in range(200)]
    out = chat_rotation.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert out.count() == 3 * 7 and out.where("speaker = 'p0'").agg(F.sum("n_turns")).first()[0] == 200


def toxic_table(spark, n=900):
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for k in range(n):
        bad = k % 6 == 0
        words = list(rng.choice([f"v{i}" for i in range(80)], 30)) + (["vile", "rude"] if bad else [])
        docs.append((k, " ".join(rng.permutation(words)), "s", "x"))
        labels.append((k, int(bad)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = toxic_table(spark)
    got = toxicity_ftrl.classify(docs, labels).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if r["held_out"]}
    assert sum((r["predicted"] == 1) == (r["doc_id"] % 6 == 0) for r in held) >= 0.98 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    kept = toxicity_ftrl.drop_toxic(docs.withColumn("score", F.lit("own")), labels)
    assert kept.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "score"] and 0 < kept.count() < 900


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity_ftrl.classify(odd_docs(spark), none).collect()} == {0}
    assert toxicity_ftrl.classify(empty(spark), none).count() == 0


def brute_components(n, linked):
    label = list(range(n))
    for _ in range(n):
        new = [min([label[i], *(label[j] for j in range(n) if linked(i, j))]) for i in range(n)]
        if new == label:
            return label
        label = new
    return label


def test_ego_join_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(8, 12))[rng.integers(0, 8, 150)] + rng.normal(size=(150, 12)) * 0.25
    x[20] = x[21] = x[22]
    x = x.astype(np.float32)
    odd = [(150, None), (151, [0.0] * 12), (152, [float("nan")] * 12), (153, [None] * 12), (154, [1.0, 0.0]), (155, [2.0, 0.0]), (None, [1.0, 0.0]), (156, [float("inf")] * 12)]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + odd, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in ego_join.near_duplicates(df, ego_join.Setup(block=16, leaf=4)).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    g = u @ u.T >= 0.9
    np.fill_diagonal(g, False)
    label = brute_components(150, lambda i, j: g[i, j])
    for k in range(150):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (g[k].sum(), label[k], label[k] == k)
    assert [got[k]["n_links"] for k in (150, 151, 152, 153, 154, 155, 156, None)] == [0, 0, 0, 0, 1, 1, 0, 0]
    # components whose squares leave the range of doubles
    far = [(k, [float(v) * scale for v in x[0]]) for k, scale in enumerate((1e200, 1e-200, 1.0, 1e-300))] + [(9, [1e300, -1e-300] + [0.0] * 10)]
    wide = {r["vec_id"]: r["n_links"] for r in ego_join.near_duplicates(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()}
    assert wide == {0: 3, 1: 3, 2: 3, 3: 3, 9: 0}
    assert ego_join.near_duplicates(df.limit(0)).count() == 0


def test_sentencepiece_parity_and_round_trip(spark):
    raw = queries.model_bytes()
    out = sp_codec.encode(odd_docs(spark).withColumn("ids", F.lit("own")), raw)
    rows = out.collect()
    assert len(rows) == 10 and all(r["round_trip"] and r["parity"] for r in rows)
    back = sp_codec.decode(out, raw).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert sp_codec.encode(empty(spark), raw).count() == 0


def test_sentencepiece_refuses_models_that_it_would_read_otherwise():
    for model in ({"escape": False, "pieces": [], "kind": 2}, {"escape": True, "pieces": [("x", 0.0, sp_codec.USER)], "kind": 1}, {"escape": True, "pieces": [], "kind": 3}):
        with pytest.raises(ValueError):
            sp_codec.build(model)


def brute_fingerprint(text):
    import xxhash

    w = [x.encode() for x in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(k, " ".join(rng.choice(["a", "b", "c"], 4)), "s", "x") for k in range(80)]
    got = {r["doc_id"]: r for r in simhash_ball.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    fp = [brute_fingerprint(t) for _, t, *_ in rows]
    label = brute_components(80, lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 2)
    assert all((got[k]["fingerprint"], got[k]["component_id"]) == (f"{fp[k]:016x}", label[k]) for k in range(80))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_ball_links_reach_all_pairs(spark, radius):
    rng = np.random.default_rng(radius)
    fp = sorted({int(x) ^ int(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4)))) for x in rng.integers(0, 1 << 62, 3) for _ in range(25)} | {0, 1 << 63})
    signed = [x - (1 << 64) if x >> 63 else x for x in fp]
    found = {r["node"]: r["component"] for r in common.components(simhash_ball.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius)).collect()}
    label = brute_components(len(fp), lambda i, j: i != j and (fp[i] ^ fp[j]).bit_count() <= radius)
    least = {k: min(x for x, m in zip(signed, label, strict=True) if m == k) for k in label}
    assert [found.get(x, x) for x in signed] == [least[k] for k in label]


def test_simhash_edges(spark):
    got = simhash_ball.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == 10 and {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {1}
    assert {r["component_id"] for r in got if r["doc_id"] in (7, None)} == {7}
    assert {r["doc_id"] for r in simhash_ball.keep_one(odd_docs(spark)).collect()} >= {1, 4, 7, 8}
    assert simhash_ball.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(5, 5), (100, 101), (101, 100)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_feistel_is_a_permutation():
    for n in (2, 7, 100, 1009):
        assert sorted(pii_feistel.permute(k, n, b"k", "t") for k in range(n)) == list(range(n))
        assert all(pii_feistel.permute(pii_feistel.permute(k, n, b"k", "t"), n, b"k", "t", True) == k for k in range(n))


def test_pii_round_trip(spark):
    text = "Mail Th.34@mail7.example.com, card 4111 1111 1111 1111 or 9807915762804490!! tel +1 (017) 555-7713 at 97.51.17.173 on 2024-02-29 / 31.12.1999, 123-45-6789, DE89 3704 0044 0532 0130 00; not 1.2.3.4.5 2024-13-01 v2.0."
    docs = spark.createDataFrame([(1, text, "s", "x"), (2, text, "s", "x"), (3, None, "s", "x"), (4, "", "s", "x")], DOCS).withColumn("pii", F.lit("own"))
    rows = {r["doc_id"]: r for r in pii_feistel.pseudonymise(docs).collect()}
    new = rows[1]["text"]
    assert new == rows[2]["text"] != text and rows[3]["text"] is None and rows[4]["text"] == ""
    for value in ("Th.34@", "4111 1111", "9807915762804490", "555-7713", "97.51.17.173", "2024-02-29", "31.12.1999", "123-45-6789", "0532 0130"):
        assert value not in new
    assert new.endswith("not 1.2.3.4.5 2024-13-01 v2.0.") and len(rows[1]["pii"]) == 9
    card = next(new[s["begin"] : s["end"]] for s in rows[1]["pii"] if s["kind"] == "card").replace(" ", "")
    assert pii_feistel.luhn(card[:-1]) == int(card[-1])
    assert pii_feistel.pseudonymise(pii_feistel.pseudonymise(docs), undo=True).where("doc_id = 1").first()["text"] == text
    assert pii_feistel.pseudonymise(empty(spark)).count() == 0


def test_media_payloads(spark):
    for r in media_tiles.text_media(odd_docs(spark)).collect():
        raw = next(((t or "").encode() for k, t in [(x["doc_id"], x["text"]) for x in odd_docs(spark).collect()] if k == r["doc_id"]))
        padded = raw + b"\xff" * ((-len(raw)) % 576 if raw else 576)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
    assert media_tiles.text_media(empty(spark)).count() == 0


def test_image_formats():
    px = np.arange(30, dtype=np.uint8).reshape(2, 5, 3)
    assert (media_tiles.decode(b"P6 5 2 255\n" + px.tobytes()) == px).all()
    assert (media_tiles.decode(b"P3\n# note\n5 2\n255\n" + " ".join(map(str, px.ravel())).encode()) == px).all()
    assert media_tiles.decode(b"P1 3 1 1 0 1").tolist() == [[0, 1, 0]] and media_tiles.decode(b"P4 3 1\n\xa0").tolist() == [[0, 1, 0]]
    rows = b"".join(px[y, :, ::-1].tobytes() + b"\0" for y in (1, 0))
    head = b"BM" + (54 + len(rows)).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (5).to_bytes(4, "little") + (2).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + b"\0" * 24
    assert (media_tiles.decode(head + rows) == px).all()
    with pytest.raises(ValueError):
        media_tiles.decode(b"GIF89a")
    big = np.arange(48, dtype=float).reshape(6, 8)
    assert np.allclose(media_tiles.resize(big, 3, 4), big.reshape(3, 2, 4, 2).mean(axis=(1, 3))) and np.allclose(media_tiles.resize(big, 5, 3).mean(), big.mean())


def test_mixing_targets_and_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(k, "w " * int(rng.integers(1, 60)), f"s{min(int(rng.integers(0, 9)), 4)}", "x") for k in range(1500)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.taken(docs).collect()
    source = {k: s for k, _, s, _ in rows}
    sums, goal = Counter(), {}
    for r in got:
        sums[source[r["doc_id"]]] += r["taken"]
        goal[source[r["doc_id"]]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert sum(goal.values()) == pytest.approx(1.5 * sum(r["size"] for r in got))
    assert all(abs(sums[s] - goal[s]) <= 0.03 * goal[s] + 60 for s in goal)
    again = mixing.taken(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert {r["size"] for r in mixing.taken(odd_docs(spark)).where("doc_id in (1, 2, 3)").collect()} == {0}
    assert mixing.taken(odd_docs(spark)).count() == 10 and mixing.taken(empty(spark)).count() == 0
    assert mixing.mix(odd_docs(spark)).columns == odd_docs(spark).columns


def test_substring_dedup_brute_force(spark):
    rng = np.random.default_rng(6)
    passage = [f"p{k}" for k in range(90)]
    rows = []
    for k in range(60):
        w = list(rng.choice([f"v{i}" for i in range(400)], int(rng.integers(0, 120))))
        if k % 3 == 0:
            a = int(rng.integers(0, 50))
            w[10:10] = passage[a : a + int(rng.integers(30, 90))]
        if k % 10 == 0:
            w = ["x"] * int(rng.integers(30, 50)) + w
        rows.append((k, " ".join(w), "s", "x"))
    rows += [(k, t, s, x) for k, t, s, x in rows[:5]]
    got = rlz_dedup.strip(spark.createDataFrame(rows, DOCS)).collect()
    seen = Counter()
    for _, t, *_ in rows:
        w = t.split()
        seen.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    want = Counter()
    for k, t, *_ in rows:
        w = t.split()
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[k, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want


def test_substring_dedup_edges(spark):
    got = rlz_dedup.strip(odd_docs(spark)).collect()
    assert len(got) == 10 and {r["doc_id"]: r["n_removed"] for r in got}[5] == 3000
    assert rlz_dedup.strip(empty(spark)).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    docs, labels = toxic_table(spark, 300)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "pii", "mix", "sentencepiece"]
    kept = toxicity_ftrl.drop_toxic(docs, labels)
    assert kept.where(F.col("doc_id") % 6 != 0).count() == docs.where(F.col("doc_id") % 6 != 0).count()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.where("not round_trip").count() == 0
