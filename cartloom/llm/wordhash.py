"""Hashes of words over whole Arrow batches of texts, without a Python loop over words.

A byte table says which bytes belong to words and what they fold to (say, A-Z to a-z); all others
separate words. A word's hash is a polynomial of its bytes modulo 2^64, mixed at the end, and comes
from one running sum over the bytes. Texts are taken in pieces of about PIECE bytes that end between
words, so memory depends on the piece, not on the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    size = 1 << max(21, count.bit_length())
    if size not in _POWERS:
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            table = np.full(size, factor, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _POWERS.clear()
        _POWERS[size] = (tables[0], tables[1])
    return _POWERS[size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def plain_words() -> np.ndarray:
    """Words are runs of anything but space and tab to carriage return; A-Z fold to a-z."""
    table = np.arange(1, 257, dtype=np.uint16)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    table[ord("A") : ord("Z") + 1] += 32
    return table


def letter_words() -> np.ndarray:
    """Words are runs of ASCII letters and of all bytes beyond ASCII; A-Z fold to a-z."""
    table = np.zeros(256, dtype=np.uint16)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a") + 1, ord("z") + 2)
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    table[128:] = np.arange(129, 257)
    return table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text starts and the last ends; null is empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, table: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about PIECE bytes; a cut inside a text comes after a byte that separates words."""
    at, total = 0, len(data)
    while at < total:
        end = min(at + PIECE, total)
        while end < total:
            window = np.flatnonzero(table[data[end : end + 4096]] == 0)
            if len(window):
                end += int(window[0]) + 1
                break
            end = min(end + 4096, total)
        yield at, end
        at = end


def word_hashes(
    data: np.ndarray, starts: np.ndarray, table: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[list[np.ndarray], np.ndarray]:
    """Word hashes in text order (and hashes of the words' first bytes, for each of `prefixes`), and each text's first word.

    The second result has one element more than there are texts.
    """
    found: list[list[np.ndarray]] = [[] for _ in range(1 + len(prefixes))]
    firsts: list[np.ndarray] = []
    for at, end in _cuts(data, table):
        folded = table[data[at:end]]
        inside = folded > 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        # A text starts a word even if the text before ended in one.
        edges = starts[np.searchsorted(starts, at, "left") : np.searchsorted(starts, end, "left")] - at
        begins[edges] = inside[edges]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        before = edges[edges > 0] - 1
        ends[before] = inside[before]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        if not len(first):
            continue
        power, inverse = _powers(end - at)
        sums = np.empty(end - at + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(folded.astype(np.uint64) * power[: end - at], out=sums[1:])
        for k, length in enumerate((None, *prefixes)):
            stop = last if length is None else np.minimum(last, first + length)
            found[k].append(mix((sums[stop] - sums[first]) * inverse[first]))
        firsts.append(first + at)
    if not firsts:
        none = np.empty(0, dtype=np.uint64)
        return [none for _ in found], np.zeros(len(starts), dtype=np.int64)
    places = np.concatenate(firsts)
    return [np.concatenate(parts) for parts in found], np.searchsorted(places, starts, "left")
