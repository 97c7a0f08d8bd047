import __spark_entry__ as contract
import corpus_pipeline
from cartloom.llm import catalogue, neardup, packing, pii

from . import cases


def test_registered():
    names = contract.queries()
    assert set(catalogue.queries()) | {"pipeline"} <= set(names)
    assert [n.split("_")[0] for n in catalogue.queries()] == [f"op{i}" for i in range(1, 14)]


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    frames = [docs]
    for name, function in corpus_pipeline.STAGES:
        from cartloom.session import stage

        frames.append(stage(function(spark, frames[-1], small), name))
    documents, clean, single, masked, mixed, packed = frames
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert 0.8 * documents.count() <= clean.count() < documents.count()
    assert neardup.near_duplicates(single).filter("NOT kept").count() == 0 and single.count() < clean.count()
    assert masked.count() == single.count()
    assert pii.report(masked).filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert masked.filter("n_chars <> length(text)").count() == 0
    assert mixed.count() > 0 and packed.columns[-2:] == ["sequence_id", "offset"]
    pieces = [tuple(r)[:5] for r in packing.pack(mixed).collect()]
    assert sorted(pieces) == sorted(tuple(r)[:5] for r in packed.collect())


def test_lightly_edited_documents_stay(spark, small):
    edits = {1: [50], 2: [10, 50], 3: [10, 40, 70], 4: [10, 30, 60, 90], 5: [10, 30, 50, 70, 90]}
    texts = {}
    for n, at in edits.items():
        words = [f"g{n}w{i}" for i in range(100)]
        texts[10 * n] = " ".join(words)
        texts[10 * n + 1] = " ".join("edit" if i in at else w for i, w in enumerate(words))
    copies = {}
    for size in (2, 5):
        sets = {n: cases.shingles(t, size) for n, t in texts.items()}
        copies[size] = {b for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert copies == {2: {11, 21, 31, 41, 51}, 5: {11, 21}}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r["doc_id"] for r in corpus_pipeline.drop_copies(spark, docs, small).collect()} == set(texts) - copies[5]
