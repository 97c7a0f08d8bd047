"""Small awkward tables: nulls, empty and long texts, repeated rows, clashing column names."""

from __future__ import annotations

import re

ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, score string, _n int"


def words(number: int, count: int) -> str:
    """Words that another number doesn't have."""
    return " ".join(f"w{number}x{i}" for i in range(count))


def odd_documents(spark):
    long = words(9, 3000)
    rows = [
        (1, None, "en", "a"), (2, "", "de", None), (3, "   \t\n", None, "b"), (4, "x", "en", "a"), (None, "alone here", "en", None),
        (6, long, "fr", "b"), (7, long, "fr", "b"), (8, long + " tail", "fr", "c"), (9, words(1, 40), "en", "a"), (9, words(1, 40), "en", "a"),
        (11, "X", None, "a"), (12, words(2, 30) + " " + words(3, 2), "en", "é"), (13, words(2, 30) + " " + words(4, 2), "en", "\U0001f600"),
    ]
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "clash", "clash", 1) for i, t, lang, s in rows], ODD_SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def shingles(text: str | None, size: int) -> set:
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}
