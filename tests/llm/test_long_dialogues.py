"""Long dialogues against the query's own SQL over a generated table, and against a plain loop."""

from collections import Counter, defaultdict

import duckdb
import numpy as np

from bellwether.llm import chat_rotation, queries

TURNS = "conv_id long, turn int, role string, text string"


def dialogues():
    rng = np.random.default_rng(2)
    rows = []
    for conv in range(12):
        people = [f"p{k}" for k in range(int(rng.integers(1, 5)))]
        rows += [(conv, 0, "system", f"rules of {conv}")] * (conv % 3)
        for turn in range(int(rng.integers(1, 300))):
            rows.append((conv, turn + 1, str(rng.choice([*people, "system"] if conv % 4 == 0 else people)), f"says {turn} " * int(rng.integers(0, 3))))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rows += [(20, None, f"q{k % 3}", f"loose {k}") for k in range(150)] + [(20, 5, "q0", "the one with a number"), (20, 2, "system", "opening")]
    rows += [(None, k, None if k % 2 else "a", None if k % 5 == 0 else f"m{k}") for k in range(70)] + [(21, None, "system", "alone"), (22, -3, "z", "before zero"), (22, 40, "z", "later")]
    return rows


def plain(rows):
    """Each whole rendering and its mask."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is None, t or 0, r or "unknown", x or ""))
    out = {}
    for conv, said in by.items():
        for speaker in {m[2] for m in said} - {"system"}:
            text, mask = "", []
            for *_, role, body in sorted(said):
                text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == speaker else f"<|user name={role}|>\n"
                if role == speaker:
                    mask.append((len(text), len(text) + len(body) + 7))
                text += body + "<|end|>\n"
            out[conv, speaker] = (text, mask)
    return out


def test_long_dialogues(spark, tmp_path):
    rows = dialogues()
    spark.createDataFrame(rows, TURNS).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op2_chat_rotation(spark, str(tmp_path)).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    names = ("conv_id", "speaker", "page", "begin", "n_turns", "text", "mask", "n_trained")
    want = Counter(db.execute("SELECT " + ", ".join(f'"{n}"' for n in names) + f" FROM ({chat_rotation.SQL})").fetchall())
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    whole = {}
    for r in sorted(got, key=lambda r: r["page"]):
        text, mask = whole.get((r["conv_id"], r["speaker"]), ("", []))
        assert r["begin"] == len(text) and r["n_turns"] <= chat_rotation.PAGE
        whole[r["conv_id"], r["speaker"]] = (text + r["text"], mask + [tuple(map(int, x.split("-"))) for x in r["mask"].split(",") if x])
    assert whole == plain(rows)
    # every word of a speaker is trained on once
    assert sum(r["n_trained"] for r in got) == sum(len(x or "") + 7 for _, _, r, x in rows if r != "system")


def test_repeated_turn_numbers_and_rows_make_no_long_page(spark):
    rows = [(1, 7, f"p{k % 2}", f"said {k % 900}") for k in range(3000)] + [(1, 7, "p0", "again")] * 2000
    out = chat_rotation.rotate(spark.createDataFrame(rows, TURNS).repartition(4)).collect()
    assert max(r["n_turns"] for r in out) == chat_rotation.PAGE and sum(r["n_turns"] for r in out) == 2 * 5000
    whole = {s: "".join(r["text"] for r in sorted(out, key=lambda r: r["page"]) if r["speaker"] == s) for s in ("p0", "p1")}
    assert whole == {s: plain(rows)[1, s][0] for s in whole}
    for r in out[:50]:
        assert all(whole[r["speaker"]][a:b].endswith("<|end|>") for a, b in r["mask"])
