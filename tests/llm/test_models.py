import zlib

import numpy as np
import pyarrow as pa

from cartloom.llm import language, toxicity, wordhash

from . import cases


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array([None, "", "a", "ab", "a  b", " \t", "A b", "x" * 5000, "é ü  é"] * 3)
    data, starts = wordhash.text_bytes(texts)
    whole, firsts = wordhash.word_hashes(data, starts, wordhash.plain_words(), (1,))
    assert np.diff(firsts)[:9].tolist() == [0, 0, 1, 1, 2, 0, 2, 1, 3]
    monkeypatch.setattr(wordhash, "PIECE", 7)
    pieces, again = wordhash.word_hashes(data, starts, wordhash.plain_words(), (1,))
    assert all((a == b).all() for a, b in zip(whole, pieces, strict=True)) and (firsts == again).all()
    assert whole[0][firsts[4]] == whole[0][firsts[6]]


def test_ngram_counts_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["abc def", None, "", "Zürich", "a" * 300])
    whole = language.counts(texts, 64)
    monkeypatch.setattr(wordhash, "PIECE", 5)
    assert (language.counts(texts, 64) == whole).all() and whole[0].sum() == 7 + 6 + 5


def test_language(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = language.report(docs).collect()
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert held and all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.95


def test_language_odd(spark):
    rows = language.report(cases.odd_documents(spark)).collect()
    assert len(rows) == 13
    silent = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in silent)
    assert language.report(cases.empty_documents(spark)).count() == 0
    digits = spark.createDataFrame([(1, "123 ...", None), (2, "word", None)], "doc_id bigint, text string, lang string")
    assert {r["lang_pred"] for r in language.report(digits).collect()} == {"und"}


def planted(spark, count=300):
    draw, rows, marks = np.random.default_rng(1), [], []
    for i in range(count):
        text = [f"w{draw.integers(200)}".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(draw.integers(5, 60))]
        toxic = int(i % 3 == 0)
        if toxic:
            text.insert(int(draw.integers(len(text))), ["nastyone", "nastytwo", "NASTYIER"][i % 9 // 3])
        rows.append((i, " ".join(text), "en", "x"))
        marks.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string"), spark.createDataFrame(marks, "doc_id bigint, toxic int")


def test_toxicity(spark):
    docs, labels = planted(spark)
    rows = toxicity.report(docs, labels).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 300 and held and all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held]) >= 0.95
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == {r["doc_id"] for r in rows if not r["predicted"]}


def test_toxicity_odd(spark):
    _, labels = planted(spark)
    rows = toxicity.report(cases.odd_documents(spark), labels).collect()
    assert len(rows) == 13 and all(0 <= r["score"] <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["score"] for r in toxicity.report(cases.odd_documents(spark), none).collect()} == {0.0}
    assert toxicity.report(cases.empty_documents(spark), labels).count() == 0


def test_long_texts_are_scored_in_slices(monkeypatch):
    settings = toxicity.Settings(slots=64)
    draw = np.random.default_rng(2)
    model = toxicity.Model(
        draw.normal(0, 1, (3, 64, 8)).astype(np.float32), [draw.normal(0, 1, (w, 24, 16)).astype(np.float32) for w in (1, 2, 3)],
        [np.zeros(16, dtype=np.float32)] * 3, draw.normal(0, 1, 48).astype(np.float32), 0.0, np.zeros((64, 1)), np.zeros(1), 1.0,
    )
    texts = pa.array(["a b c " * 200, "", "zz", None, "q w e r t y " * 50])
    slots, firsts = toxicity.tokens(texts, settings)
    whole = model.logits(slots, firsts)
    monkeypatch.setattr(toxicity, "SLICE", 16)
    assert np.allclose(model.logits(slots, firsts), whole, atol=1e-4)
