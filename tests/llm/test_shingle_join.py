"""The near-duplicate stage of the pipeline against all pairs by plain sets."""

import numpy as np

import corpus_pipeline
from bellwether.llm import shingle_join

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(x, y):
    return 5 * len(x & y) >= 4 * len(x | y)


def plain_groups(rows):
    sets = [(k, plain_set(t)) for k, t, *_ in rows]
    label = {k: k for k, _ in sets}
    pairs = [(i, j) for i, x in sets for j, y in sets if i < j and similar(x, y)]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = low
    return label


def near_rows():
    """Texts with one to eight changed words, chains of changes, a passage that many share, short and empty texts."""
    rng = np.random.default_rng(5)
    texts = []
    for k in range(40):
        w = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(30, 160)))]
        texts.append(" ".join(w))
        for edits in (1, 2, 4, 8):
            v = list(w)
            for at in rng.choice(len(v), edits, replace=False):
                v[at] = f"new{at}"
            texts.append(" ".join(v))
        if k % 5 == 0:
            for step in range(6):
                w = w[2:] + [f"step{k}x{step}", f"end{k}x{step}"]
                texts.append(" ".join(w).upper())
    passage = " ".join(f"p{x}" for x in range(60))
    texts += [f"{passage} {' '.join(f'q{k}x{x}' for x in range(k % 30))}" for k in range(60)]
    texts += ["one two", "One TWO", "one two three", "", "   ", None]
    return [(int(k), t, "en", "s", 0) for k, t in zip(rng.permutation(len(texts)), texts, strict=True)]


def test_near_copies_of_unequal_texts_against_all_pairs(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    label = plain_groups(rows)
    assert {r["doc_id"]: r["component_id"] for r in shingle_join.near_duplicates(docs).collect()} == label
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == sorted(k for k in label if label[k] == k)
    assert len(set(label.values())) < len({frozenset(plain_set(t)) for _, t, *_ in rows})


def test_repeated_and_null_ids(spark):
    rows = [(7, "a b c d e f", "en", "s", 0), (7, "g h i j k l", "en", "s", 0), (9, "G h i j k l", "en", "s", 0), (None, "a b c d e f", "en", "s", 0), (None, "alone in here", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in shingle_join.near_duplicates(docs).collect())
    assert got == [("7", "7"), ("7", "7"), ("9", "7"), ("None", "7"), ("None", "None")]


def test_possible_pairs_lose_no_similar_one():
    """Of all pairs of sets, each similar one is possible in the list of the first shingle that both have; few others are."""
    rng = np.random.default_rng(3)
    pool = [f"t{x}" for x in range(60)]
    sets = []
    for k in range(120):
        base = list(rng.choice(pool, int(rng.integers(20, 55)), replace=False)) if k % 3 == 0 else list(base)
        sets.append({*base[: len(base) - int(rng.integers(0, 4))], *(f"own{k}x{x}" for x in range(int(rng.integers(0, 12))))})
    count = {}
    for x in sets:
        for t in x:
            count[t] = count.get(t, 0) + 1
    ordered = [sorted(x, key=lambda t: (count[t], t)) for x in sets]
    lists = {}
    for k, x in enumerate(ordered):
        for at, t in enumerate(x[: len(x) - (4 * len(x) + 4) // 5 + 1]):
            lists.setdefault(t, []).append((k, len(x), len(x) - at))
    bits = np.zeros((len(sets), 64), dtype=bool)  # few bits, so that many shingles share one
    for k, x in enumerate(sets):
        bits[k, [hash(t) % 64 for t in x]] = True
    sketch, close = np.packbits(bits, axis=1).view(np.uint64), set()
    made = set()
    for members in lists.values():
        key, n, rest = (np.array(c) for c in zip(*members, strict=True))
        for ka, kb in shingle_join._possible(key, key, n, rest):
            assert (ka < kb).all()
            made |= set(zip(ka.tolist(), kb.tolist(), strict=True))
        for ka, kb in shingle_join._possible(key, key, n, rest, sketch[key]):
            close |= set(zip(ka.tolist(), kb.tolist(), strict=True))
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if similar(sets[i], sets[j])}
    assert want <= close <= made and 10 * len(made) < len(sets) * (len(sets) - 1) // 2
