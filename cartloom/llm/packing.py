"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents are tokenised once; longer ones are cut into whole sequences and a first piece that may be
shorter. Only the histogram of piece lengths (at most `length` numbers) goes to the driver. There a
configuration linear program, whose variables say how often each combination of lengths fills a
sequence, is solved by multiplicative weights: every round prices each length by its share of a sequence and by how little of
it is covered yet, and a knapsack dynamic program finds the dearest combination with each length. Rounds go on until all
lengths are covered. The solution is rounded with a running remainder, so small amounts count, too; the pieces that rounding
leaves over are put best-fit, longest first, into the combinations' free space and new sequences. The result is a list of
combinations with counts; every piece finds its place in it from its own number among the pieces of its length, so no task
ever holds a group.

Cases: a null text is empty and gives one piece, the end token alone. Repeated rows and ids are packed
row by row. Only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.session import stage

#: Fixed value: the one string that this vocabulary turns into a single id wherever it stands.
SPECIAL = "<|endoftext|>"
# Code points from which on the reference library takes a text.
LONG = 250_000


@dataclass(frozen=True)
class Tokens:
    """Vocabulary files (the same byte-pair vocabulary in two formats), the id after each document, the sequence length."""

    vocabulary: str = ""
    ranks: str = ""
    end_id: int = 2
    length: int = 1024


def default_tokens() -> Tokens:
    import public_tokenizers

    return Tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def encoder(tokens: Tokens):
    """text -> ids as an array. Texts with the special string and very long ones take the reference library, all others a faster one.

    The faster one's patterns give up on a run of about a million blanks.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(tokens.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text or len(text) > LONG:
            if not exact:
                exact.append(Tokenizer.from_file(tokens.vocabulary))
            return np.array(exact[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")

    return encode


_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint"


def _cut(tokens: Tokens, with_ids: bool):
    """Pieces of every document, numbered by length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, length = encoder(tokens), TaskContext.get().partitionId(), tokens.length
        end, seen = np.array([tokens.end_id], dtype="<u4"), np.zeros(length + 1, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows: list[list] = [[] for _ in range(8)]
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([encode(text or ""), end])
                    start, piece = 0, 0
                    while start < len(ids):
                        size = (len(ids) - start) % length or length
                        own = ids[start : start + size]
                        for column, value in zip(rows, (doc_id, piece, start, size, zlib.crc32(own.tobytes()), part, int(seen[size]), own.tolist() if with_ids else None), strict=True):
                            column.append(value)
                        seen[size] += 1
                        start, piece = start + size, piece + 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(rows, kinds, strict=False)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
                if with_ids:
                    arrays.append(pa.array(rows[7], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


Combination = tuple[int, tuple[tuple[int, int], ...]]  # copies, ((length, how many), ...)


def _knapsack(lengths: np.ndarray, prices: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to `space` the highest total price of lengths in it, and one length of that combination (or -1)."""
    best, last = np.zeros(space + 1), np.full(space + 1, -1, dtype=np.int64)
    fitting = np.searchsorted(lengths, np.arange(space + 1), "right")
    for room in range(1, space + 1):
        best[room] = best[room - 1]
        if k := fitting[room]:
            worth = best[room - lengths[:k]] + prices[:k]
            at = int(worth.argmax())
            if worth[at] > best[room]:
                best[room], last[room] = worth[at], at
    return best, last


def _inside(lengths: np.ndarray, last: np.ndarray, room: int) -> dict[int, int]:
    """How many of each length are in the best combination for a room."""
    found: dict[int, int] = {}
    while room > 0:
        if last[room] < 0:
            room -= 1
            continue
        found[int(last[room])] = found.get(int(last[room]), 0) + 1
        room -= int(lengths[last[room]])
    return found


@dataclass(frozen=True)
class Fractions:
    """amounts: how often to use each combination ((place of the length, how many), ...); covered: share of each length;
    bound: no packing has fewer sequences."""

    amounts: dict[tuple, float]
    covered: np.ndarray
    bound: float

    @property
    def value(self) -> float:
        return sum(self.amounts.values())


def solve(lengths: np.ndarray, counts: np.ndarray, space: int, step: float = 0.05, near: float = 0.99, sharp: float = 0.2) -> Fractions:
    """The configuration program by multiplicative weights.

    A round raises no length by more than `step`; the dearest combination is used until one of its lengths has risen so far
    or is covered, so rounds end. Far fewer than (1 / step + 1) per length are needed, as a round uses a combination for every
    length that has one worth `near` times the dearest. `sharp` is how fast prices fall with cover.
    """
    covered, bound = np.zeros(len(lengths)), 0.0
    used: dict[tuple, float] = {}
    while (open_ := covered < 1 - 1e-9).any():
        # A length's price falls by a factor with all that covers it.
        prices = np.where(open_, lengths / space * np.exp(sharp * (covered[open_].min() - covered)), 0.0)
        best, last = _knapsack(lengths, prices, space)
        # Prices at which no combination is worth more than one sequence bound all packings from below.
        bound = max(bound, float(counts @ prices / best[space]))
        worth = np.where(open_, prices + best[space - lengths], 0.0)
        ceiling = np.minimum(covered + step, 1.0)
        for place in np.argsort(-worth, kind="stable"):
            if worth[place] < near * best[space]:
                break
            combination = _inside(lengths, last, space - int(lengths[place]))
            combination[int(place)] = combination.get(int(place), 0) + 1
            places = np.array(list(combination))
            per_copy = np.array(list(combination.values())) / counts[places]
            amount = float(((ceiling[places] - covered[places]) / per_copy).min())
            if amount > 1e-12:
                covered[places] += amount * per_copy
                key = tuple(sorted(combination.items()))
                used[key] = used.get(key, 0.0) + amount
    return Fractions(used, covered, bound)


def best_fit(counts: dict[int, int], space: int, begun: list[tuple[int, tuple[int, ...]]] | None = None) -> list[Combination]:
    """Best-fit decreasing over a histogram, into bins already begun (copies, lengths inside) and new ones: equal bins are handled together."""
    open_bins: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for copies, inside in begun or []:
        open_bins.setdefault(space - sum(inside), []).append((copies, inside))
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_bins if r >= length), default=None)
            copies, inside = (left, ()) if room is None else open_bins[room].pop()
            if room is None:
                room = space
                copies = max(1, left // (space // length))
            elif not open_bins[room]:
                del open_bins[room]
            each = min(room // length, max(1, left // copies))
            used = min(copies, left // each)
            if used < copies and inside:
                open_bins.setdefault(room, []).append((copies - used, inside))
            left -= used * each
            open_bins.setdefault(room - each * length, []).append((used, inside + (length,) * each))
    merged: dict[tuple, int] = {}
    for bins in open_bins.values():
        for copies, inside in bins:
            key = tuple(sorted((n, inside.count(n)) for n in set(inside)))
            merged[key] = merged.get(key, 0) + copies
    return [(copies, key) for key, copies in sorted(merged.items())]


def rounded(solution: Fractions, lengths: np.ndarray, counts: dict[int, int]) -> tuple[list[tuple[int, tuple[int, ...]]], dict[int, int]]:
    """Whole copies of the combinations (copies, lengths inside), never more than there are pieces, and the pieces left over."""
    left, rest = dict(counts), 0.5
    out: list[tuple[int, tuple[int, ...]]] = []
    for key, amount in solution.amounts.items():
        rest += amount
        copies = min(int(rest), *(left[int(lengths[i])] // m for i, m in key))
        rest -= int(rest)
        if copies:
            out.append((copies, tuple(int(lengths[i]) for i, m in key for _ in range(m))))
            for i, m in key:
                left[int(lengths[i])] -= copies * m
    return out, left


def combinations(histogram: dict[int, int], space: int, step: float = 0.05) -> list[Combination]:
    """Combinations with copies that hold every piece of the histogram exactly once."""
    whole = [(histogram[space], ((space, 1),))] if histogram.get(space) else []
    rest = {n: c for n, c in histogram.items() if c and n < space}
    if not rest:
        return whole
    lengths = np.array(sorted(rest))
    counts = np.array([rest[int(n)] for n in lengths], dtype=np.float64)
    begun, left = rounded(solve(lengths, counts, space, step), lengths, rest)
    return whole + best_fit({n: c for n, c in left.items() if c}, space, begun)


def _places(found: list[Combination]) -> dict[int, np.ndarray]:
    """Per length rows (first number, pieces per copy, first sequence, offset of the first piece)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for copies, inside in found:
        offset = 0
        for length, many in inside:
            rows.setdefault(length, []).append((used.get(length, 0), many, sequence, offset))
            used[length] = used.get(length, 0) + copies * many
            offset += length * many
        sequence += copies
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def _place(places: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = np.asarray(batch.column("length")), np.asarray(batch.column("number"))
            sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            order = np.argsort(lengths, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if len(own):
                    length = int(lengths[own[0]])
                    table = places[length]
                    row = table[np.searchsorted(table[:, 0], numbers[own], "right") - 1]
                    copy, place = np.divmod(numbers[own] - row[:, 0], row[:, 1])
                    sequence[own], offset[own] = row[:, 2] + copy, row[:, 3] + place * length
            kept = [c for c in batch.schema.names if c not in ("part", "number")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokens: Tokens | None = None, *, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    with_ids adds the piece's token ids; `sequences` puts those together.
    """
    tokens = tokens or default_tokens()
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    more = ", ids array<bigint>" if with_ids else ""
    pieces = stage(slim.mapInArrow(_cut(tokens, with_ids), _PIECES + more), "packing-pieces")
    each = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = each.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # At most as many rows as a sequence has tokens.
    histogram = {int(r["length"]): int(r["n"]) for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(combinations(histogram, tokens.length))
    numbered = pieces.join(starts, ["part", "length"]).withColumn("number", F.col("number") + F.col("before"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "number"]
    schema = f"doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint{more}, sequence_id bigint, offset bigint"
    return numbered.select(*columns).mapInArrow(_place(places), schema)


def sequences(placed: DataFrame) -> DataFrame:
    """Token sequences from `pack(..., with_ids=True)`: sequence_id, ids."""
    rows = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    return rows.select("sequence_id", F.flatten("pieces.ids").alias("ids"))
