"""Every text is compared with the sentencepiece library, not one in so many."""

from bellwether.llm import queries, sp_codec


def test_every_text_has_parity(spark, tmp_path):
    rows = [(k, f"Text number {k}, with  spaces and ümlauts." if k else None) for k in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op5_sentencepiece(spark, str(tmp_path)).collect()
    assert len(got) == 200 and all(r["parity"] is True for r in got)


def test_one_text_encoded_differently_is_reported():
    c = sp_codec.codec(queries.model_bytes())
    texts = ["one", "only this one", "two", "", "only this one"]
    ids = c.encode(texts)
    ids[1] = ids[1][:-1]
    assert [parity for _, parity in c.checks(texts, ids)] == [True, False, True, True, True]


def test_parity_is_that_of_whole_texts():
    c = sp_codec.codec(queries.model_bytes())
    texts = [" ", "   two  spaces ", "▁mark ▁▁ in it", "tab\tand\nline", "日本語 текст 🙂 é", "<s> </s> <unk> <0x41>", "a" * 3000]
    for t, ids in zip(texts, c.encode(texts), strict=True):
        assert ids.tolist() == c.plain.encode(t) and c.decode(ids) == t.replace("▁", " ") == c.plain.decode(ids.tolist())


def test_a_wrong_normaliser_is_reported():
    c = sp_codec.Codec(queries.model_bytes())
    right = c.normal

    class Dropping(sp_codec.Normaliser):
        def readable(self, text):
            return super().readable(text).replace("a", "")

    c.normal = Dropping(c.model)
    texts = ["no such letter: bcd", "an apple", "", "two  spaces and a tail  ", "one\ntwo"]
    told = [parity for _, parity in c.checks(texts, c.encode(texts))]
    assert told == [True, False, True, False, True]
    c.forget()
    c.normal = right
    assert all(parity for _, parity in c.checks(list(texts), c.encode(texts)))


def test_raw_stretches_join_to_the_text():
    for text in ["", " ", "   ", "a", " a", "a ", "  a  b c   ", "a b", "▁ a▁▁b"]:
        for lead in ("", " "):
            parts = sp_codec.raw_stretches(text, lead) if text else []
            assert ("" if lead else " ").join(parts) == text
            assert not text.strip(" ") or not any(p.strip(" ") == "" for p in parts)
