import random
import re
from collections import Counter

import numpy as np

from cartloom.llm import phrases

from . import cases

SMALL = phrases.Settings(least=4, top=25, slot_bits=15, task_rows=60)


def brute(rows, least, top):
    counts, words_of = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = words_of[lang], []
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {
            p[i : i + k] for p, a in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= f[p[i : i + k]]
        }
        for p, a in often.items():
            if p not in hidden:
                score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def test_three_way_counts_prefixes():
    draw = np.random.default_rng(3)
    keys = draw.integers(-1, 4, (300, 4))
    keys[:, 0] = np.abs(keys[:, 0])
    for row in keys:
        gone = np.flatnonzero(row < 0)
        if len(gone):
            row[gone[0] :] = -1
    weights = draw.integers(1, 5, 300)
    counts = Counter()
    for row, weight in zip(keys.tolist(), weights.tolist()):
        for k in range(1, 5):
            if row[k - 1] >= 0:
                counts[tuple(row[:k])] += weight
    for least, ends in ((1, ()), (30, ()), (30, (0, 299)), (10**6, (7,))):
        got = {tuple(keys[p, :d].tolist()): n for p, d, n in phrases.three_way(keys, weights, least, ends)}
        edges = {tuple(keys[e, :d].tolist()) for e in ends for d in range(1, 5) if keys[e, d - 1] >= 0}
        assert got == {k: n for k, n in counts.items() if n >= least or k in edges}


def collected(frame, settings):
    return sorted(tuple(r) for r in phrases.collocations(frame, settings).collect())


def test_equals_brute_force(spark):
    draw = random.Random(4)
    vocabulary = ["Of", "of", "the", "a\x01", "a", "b\x00c", "new", "york", "é", "É", "\U0001f600", "￿", "zz", "A"]
    rows = []
    for _ in range(150):
        text = ""
        for _ in range(draw.randint(0, 60)):
            text += draw.choice(vocabulary) if draw.random() < 0.7 else "New  York\tof the"
            text += draw.choice([" ", "\t", "  ", ". ", ",", "\n", "\x0b", " ", " "])
        rows.append((text, draw.choice(["en", "de", None, ""])))
    rows += [(None, "en"), ("", None), ("!!! . ,", "fr"), ("one two three four five six " * 400, "en"), ("one two three four five six. " * 9, "xx")]
    frame = spark.createDataFrame([(t, lang, "clash", 1) for t, lang in rows], "text string, lang string, phrase string, n int").repartition(7)
    for least, bits in ((2, 15), (4, 20), (300, 16)):
        settings = phrases.Settings(least=least, top=25, slot_bits=bits, task_rows=60)
        assert collected(frame, settings) == brute(rows, least, 25)


def test_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PART", 37)
    rows = [("alpha beta gamma. " * 30 + "x" * 500 + " tail alpha beta", "en"), ("beta gamma", "en"), ("", "en"), ("gamma delta " * 20, "en")]
    whole = []
    for words in phrases.read_words(__import__("pyarrow").array([t for t, _ in rows])):
        text = bytes(words.joined).decode()
        places = words.places
        whole += [(int(t), text[a : b - 1]) for t, a, b in zip(words.text, places[:-1], places[1:])]
    assert whole == [(i, w) for i, (t, _) in enumerate(rows) for w in re.findall(r"[^\x20.]+", t)]


def test_odd_and_empty(spark):
    frame = cases.odd_documents(spark)
    rows = [(r["text"], r["lang"]) for r in frame.collect()]
    assert collected(frame, phrases.Settings(least=2, top=50, slot_bits=15)) == brute(rows, 2, 50)
    assert collected(cases.empty_documents(spark), SMALL) == []
