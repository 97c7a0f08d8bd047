import hashlib
import zlib

import numpy as np
from tokenizers import Tokenizer

from cartloom.llm import fingerprint, mixing, packing

from . import cases


def test_fingerprints(spark):
    rows = [(i, t) for i, t in enumerate([None, "", "one", cases.words(1, 4), cases.words(2, 300), cases.words(2, 300), cases.words(2, 280) + " x y z", "É😀 " * 7])]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, key string")
    found = {r["doc_id"]: r for r in fingerprint.report(frame).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        text, after = text or "", dict(rows)[(i - 1) % len(rows)] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = cases.shingles(text, 5), cases.shingles(other, 5)
            wanted = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(row[name] - wanted) < 0.15, (i, name, row[name], wanted)
    assert found[4]["fingerprint"] == found[5]["fingerprint"] != found[6]["fingerprint"]
    assert found[0]["fingerprint"] == found[1]["fingerprint"] == "" and len(found[2]["fingerprint"]) == 2 * fingerprint.BINS


def test_fingerprints_odd(spark):
    odd = cases.odd_documents(spark)
    assert sorted(r["doc_id"] or 0 for r in fingerprint.report(odd).collect()) == sorted(r["doc_id"] or 0 for r in odd.collect())
    assert fingerprint.report(cases.empty_documents(spark)).count() == 0
    alone = fingerprint.report(odd.filter("doc_id = 12")).first()
    assert alone["near_next"] == 1.0


def test_targets():
    mix = mixing.Mix()
    assert mixing.targets([], mix) == [] and mixing.targets([0, 0], mix) == [0.0, 0.0]
    assert mixing.targets([80, 80, 80], mix) == [150.0, 60.0, 30.0]
    assert mixing.targets([10, 100, 10], mix) == [30.0, 60.0, 30.0]
    assert sum(mixing.targets([5, 70, 900, 4, 3, 0], mix)) <= 982 + 1e-9


def test_permutation_and_shards():
    for size in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(size), size, 9).tolist()) == list(range(size))
    counts, mix = np.array([700, 41, 0, 259]), mixing.Mix(slots=64)
    shards = -(-counts.sum() // mix.slots)
    draws = [mixing.shard_draw(i, shards, counts, mix) for i in range(shards)]
    assert (sum(d for d, _ in draws) == counts).all()
    assert all((b == sum((d for d, _ in draws[:i]), np.zeros(4, dtype=int))).all() for i, (_, b) in enumerate(draws))
    assert {int(d.sum()) for d, _ in draws[:-1]} == {64}


def test_mix(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows, again = (sorted(tuple(r) for r in mixing.mix_documents(docs).collect()) for _ in range(2))
    assert rows == again and len(rows) == docs.count()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for name in set(source.values()):
        own = [r for r in rows if source[r[0]] == name]
        assert sum(r[1] for r in own) == own[0][2] and abs(sum(r[4] for r in own) - own[0][3]) <= 0.01 * own[0][3] + 2
    assert all(r[4] <= 3 * r[1] for r in rows)
    copies = mixing.mixed_documents(docs).collect()
    taken = {}
    for r in copies:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert taken == {r[0]: r[4] for r in rows if r[4]} and copies[0].__fields__ == docs.columns


def test_mix_odd(spark):
    odd = cases.odd_documents(spark)
    rows = mixing.mix_documents(odd).collect()
    assert len(rows) == 13 and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sum(r["size"] for r in rows) == sum(len((r["text"] or "").split()) for r in odd.collect())
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix_documents(cases.empty_documents(spark)).count() == 0 and mixing.mixed_documents(cases.empty_documents(spark)).count() == 0


def test_combinations():
    draw = np.random.default_rng(0)
    for histogram in ({}, {1024: 3}, {1: 5}, {600: 7, 424: 5, 5: 1}, {int(n): int(c) for n, c in zip(draw.integers(1, 1024, 80), draw.integers(1, 30, 80), strict=True)}):
        found, held = packing.combinations(histogram, 1024), {}
        for copies, inside in found:
            assert sum(n * m for n, m in inside) <= 1024
            for n, m in inside:
                held[n] = held.get(n, 0) + copies * m
        assert held == histogram
        assert sum(c for c, _ in found) <= max(1, 1.25 * -(-sum(n * c for n, c in histogram.items()) // 1024)) + 2


def test_pack(spark):
    odd = cases.odd_documents(spark)
    extra = spark.createDataFrame([(50, "a<|endoftext|>b", "x"), (51, "  tab\t " * 900, "x"), (52, "🙂" * 400, "x")], "doc_id bigint, text string, lang string")
    docs = odd.select("doc_id", "text", "lang").unionByName(extra)
    tokens = packing.default_tokens()
    tokenizer = Tokenizer.from_file(tokens.vocabulary)
    wanted = []
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first, start, piece = len(ids) % 1024 or 1024, 0, 0
        while start < len(ids):
            own = ids[start : start + (first if not start else 1024)]
            wanted.append((r["doc_id"], piece, start, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())))
            start, piece = start + len(own), piece + 1
    placed = packing.pack(docs, with_ids=True)
    rows = placed.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(wanted, key=str)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert len(by) <= 1.1 * -(-sum(w[3] for w in wanted) // 1024) + 1
    assert packing.sequences(placed).count() == len(by)
    assert packing.pack(cases.empty_documents(spark)).count() == 0
