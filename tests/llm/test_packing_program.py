"""The configuration program on histograms small enough for an exact optimum, and the texts that tokenizers find hard."""

import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartloom.llm import packing


def fewest(pieces, space):
    """The least number of bins by trying all ways, longest piece first."""
    pieces = sorted(pieces, reverse=True)

    @lru_cache(None)
    def best(i, rooms):
        if i == len(pieces):
            return 0
        out = 1 + best(i + 1, tuple(sorted((*rooms, space - pieces[i]))))
        for n, room in enumerate(rooms):
            if room >= pieces[i] and (n == 0 or rooms[n - 1] != room):
                out = min(out, best(i + 1, tuple(sorted((*rooms[:n], room - pieces[i], *rooms[n + 1 :])))))
        return out

    return best(0, ())


def test_close_to_the_optimum():
    draw = random.Random(1)
    for _ in range(60):
        space = draw.choice([10, 16, 30])
        pieces = [draw.randint(1, space) for _ in range(draw.randint(1, 9))]
        histogram = {n: pieces.count(n) for n in set(pieces)}
        found = packing.combinations(histogram, space)
        assert all(sum(n * m for n, m in inside) <= space for _, inside in found)
        placed = {}
        for copies, inside in found:
            for n, m in inside:
                placed[n] = placed.get(n, 0) + copies * m
        assert placed == histogram
        assert sum(copies for copies, _ in found) <= fewest(pieces, space) + 1
        short = sorted({n for n in pieces if n < space})
        if short:
            counts = np.array([histogram[n] for n in short], dtype=float)
            solution = packing.solve(np.array(short), counts, space)
            assert solution.covered.min() > 1 - 1e-6
            assert solution.bound <= fewest([n for n in pieces if n < space], space) + 1e-9


@pytest.mark.parametrize("times", [1, 1000])
def test_program_places_nearly_all(times):
    draw = random.Random(2)
    histogram = {}
    for _ in range(3000):
        n = min(127, int(draw.expovariate(1 / 50)) + 1)
        histogram[n] = histogram.get(n, 0) + times
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[int(n)] for n in lengths], dtype=float)
    solution = packing.solve(lengths, counts, 128)
    assert solution.covered.min() > 1 - 1e-6 and solution.covered.max() < 1 + 1e-6
    assert solution.bound <= solution.value <= 1.01 * solution.bound
    begun, left = packing.rounded(solution, lengths, histogram)
    assert sum(copies * len(inside) for copies, inside in begun) >= (0.8 if times == 1 else 0.99) * sum(histogram.values())
    assert sum(copies for copies, _ in packing.combinations(histogram, 128)) <= 1.01 * solution.bound + 2


@pytest.mark.parametrize("blank", [" ", "\n", "\t"])
def test_long_runs_of_white_space(blank):
    encode = packing.encoder(packing.default_tokens())
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in (blank * 2_000_000 + "end", "a" + blank * (packing.LONG - 2) + "b"):
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids
