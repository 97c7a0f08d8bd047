"""Boosted trees grown from distributed histograms, for ranking by NDCG and for two classes.

Features become bins (one byte each, bin 0 for nulls) and rows are put together by session in chunks of at most
CHUNK rows. Several models, such as those of all folds, are fitted in the same passes over them.

A round is two kinds of jobs. The first adds the last trees to the scores, finds every session's best k rows and from them the
gradients, and writes the rows anew with both. In NDCG@k a pair of rows changes nothing unless one of the two is among the best
k, so each row meets only those, whatever the session's size; no pairs are formed as rows. A session of one chunk is worked out where
it lies, without an exchange; only sessions of several chunks bring their chunks' best rows together first. The second adds up
histograms of the gradients for all leaves that may be split next, in the tasks first, and of two sides of a split only for the
smaller: the other's is the difference from their parent's. Trees grow best-first: leaves that the order of gains may reach are
looked at ahead, so a tree takes about as many passes as it has levels and not one per leaf. A leaf of at most LOCAL rows goes to one
task, which grows all that may come below it.

Bin edges, the summed histograms of the leaves in question (as many bytes as bins, features and leaves make, whatever the rows), and
sums of NDCG come to the driver, which finds the best bin and the better side for nulls. Of the tables written, the last two are kept.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.session import drop_written, write_new

# Rows of one session that travel together, rows of a written record of whole sessions, and rows that are worked on at once.
CHUNK, BLOCK, SLAB = 4096, 2048, 65536
# Rows of a leaf that one task takes to grow all that may come below it.
LOCAL = 65536
TRAIN, WATCH, HELD = 0, 1, 2


def _packed(rows: np.ndarray, firsts: np.ndarray | None = None) -> pa.Array:
    """The lines of a matrix as binary values, without a Python object for each; with `firsts`, the lines between two of these as one value."""
    rows = np.ascontiguousarray(rows)
    firsts = np.arange(len(rows) + 1) if firsts is None else firsts
    ends = np.ascontiguousarray(firsts, dtype=np.int64) * (rows.dtype.itemsize * math.prod(rows.shape[1:]))
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(rows)]).cast(pa.binary())


def _unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers of all binary values, one after the other."""
    if not len(column):
        return np.empty(0, dtype=kind)
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if ends[-1] == ends[0]:
        return np.empty(0, dtype=kind)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]].view(kind)


@dataclass(frozen=True)
class Settings:
    """objective: "ndcg" or "logistic"; k: places that count; patience: rounds without a gain after which a model is done."""

    objective: str = "ndcg"
    rounds: int = 1000
    rate: float = 0.05
    leaves: int = 31
    least_rows: int = 20
    least_hessian: float = 1e-3
    feature_share: float = 0.8
    row_share: float = 0.8
    bins: int = 63
    k: int = 5
    patience: int = 10
    seed: int = 23


@dataclass
class Tree:
    """Arrays over nodes; feature -1 marks a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    nulls_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, nulls_left: bool, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.nulls_left[node], self.gain[node] = feature, at, nulls_left, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            for column, value in zip((self.feature, self.bin, self.nulls_left, self.left, self.right, self.value, self.gain), (-1, 0, False, -1, -1, 0.0, 0.0), strict=True):
                column.append(value)
        return self.left[node], self.right[node]

    def reach(self, columns: np.ndarray, rows: np.ndarray, wanted: Sequence[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Those of `rows` that come to each leaf, or to each of the `wanted` nodes; `columns` has the bins by feature."""
        ends = {n for n, f in enumerate(self.feature) if f < 0} if wanted is None else set(wanted)
        parent = {child: node for node, f in enumerate(self.feature) if f >= 0 for child in (self.left[node], self.right[node])}
        on_the_way = set()
        for node in ends:
            while node not in on_the_way:
                on_the_way.add(node)
                node = parent.get(node, 0)
        todo = [(0, rows)] if ends else []
        while todo:
            node, rows = todo.pop()
            if node in ends:
                yield node, rows
                continue
            goes_left = np.arange(256) <= self.bin[node]
            goes_left[0] = self.nulls_left[node]
            side = goes_left.take(columns[self.feature[node]].take(rows))
            for child, own in ((self.right[node], ~side), (self.left[node], side)):
                if child in on_the_way:
                    todo.append((child, rows[own]))

    def add_values(self, columns: np.ndarray, to: np.ndarray) -> None:
        for node, rows in self.reach(columns, np.arange(columns.shape[1])):
            to[rows] += self.value[node]

    def values(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        self.add_values(np.ascontiguousarray(x.T), out)
        return out


@dataclass(frozen=True)
class Bins:
    """Per feature the upper edges of its bins (numbers), or its values in order (text)."""

    features: tuple[str, ...]
    edges: tuple[tuple, ...]

    def of(self, columns: Sequence[pa.Array]) -> np.ndarray:
        out = np.zeros((len(columns[0]), len(columns)), dtype=np.uint8)
        for place, (column, edges) in enumerate(zip(columns, self.edges, strict=True)):
            if pa.types.is_string(column.type):
                number = pc.index_in(column, pa.array(edges, pa.string()), skip_nulls=True)
                out[:, place] = pc.fill_null(number, -1).to_numpy(zero_copy_only=False) + 1
            else:
                value = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
                out[:, place] = np.where(np.isnan(value), 0, 1 + np.searchsorted(np.array(edges, dtype=np.float64), value))
        return out


@dataclass(frozen=True)
class Model:
    """Trees over binned features; a row's score is the sum of their leaves' values."""

    bins: Bins
    trees: tuple[Tree, ...]
    watched: tuple[float, ...] = ()

    def importance(self) -> dict[str, float]:
        total = dict.fromkeys(self.bins.features, 0.0)
        for tree in self.trees:
            for place, gain in zip(tree.feature, tree.gain, strict=True):
                if place >= 0:
                    total[self.bins.features[place]] += gain
        whole = sum(total.values()) or 1.0
        return {k: v / whole for k, v in total.items()}


def _inputs(df: DataFrame, features: Sequence[str]) -> list[Column]:
    kinds = dict(df.dtypes)
    return [F.col(c) if kinds[c] == "string" else F.col(c).cast("double").alias(c) for c in features]


def find_bins(df: DataFrame, features: Sequence[str], bins: int = 63) -> Bins:
    """Edges at quantiles, found in one pass by mergeable sketches; of text the most frequent values."""
    slim, kinds = df.select(*_inputs(df, features)), dict(df.dtypes)
    numbers = [c for c in features if kinds[c] != "string"]
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    plain = [F.percentile_approx(F.when(~F.isnan(c), F.col(c)), shares, 2000).alias(c) for c in numbers]
    row = slim.agg(F.count(F.lit(1)).alias("_rows"), *plain).first()
    found = {c: tuple(sorted(set(row[c] or ()))) for c in numbers}
    for c in features:
        if kinds[c] == "string":
            most = slim.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(bins).collect()
            found[c] = tuple(sorted(r[0] for r in most))
    return Bins(tuple(features), tuple(found[c] for c in features))


def chunks(df: DataFrame, bins: Bins, roles: Sequence[Column], *, row: str = "interaction_id", label: str = "add_to_cart", k: int = 5) -> DataFrame:
    """The table of chunks: session_id, chunk, parts (the session's chunks), roles (one per model), ideal, and per row: x, label, row.

    `roles` must be the same for all rows of a session (TRAIN, WATCH, HELD). ideal: the session's highest DCG@k.
    """
    names = [f"_f{i}" for i in range(len(bins.features))]
    given = [c.alias(n) for c, n in zip(_inputs(df, bins.features), names, strict=True)]
    marks = [r.cast("tinyint").alias(f"_r{i}") for i, r in enumerate(roles)]
    labelled = F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("label")
    known = df.filter(F.col("session_id").cast("bigint").isNotNull())
    slim = known.select(F.col("session_id").cast("bigint").alias("session_id"), F.col(row).cast("bigint").alias("row"), labelled, *marks, *given)

    first = 3 + len(marks)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = bins.of(batch.columns[first:])
            held = np.stack([np.asarray(c) for c in batch.columns[3:first]], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _packed(held), _packed(x)], names=["session_id", "row", "label", "roles", "x"]
            )

    rows = slim.mapInArrow(binned, "session_id bigint, row bigint, label int, roles binary, x binary")
    # Sessions of more than a chunk, of three columns: at most one for every CHUNK rows. Their first row is in chunk 0, which so is never empty.
    sizes = slim.select("session_id", "row", "label").groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.min("row").alias("start"))
    long = sizes.filter(F.col("n") > CHUNK).select("session_id", "positives", "start", F.ceil(F.col("n") / CHUNK).alias("parts"))
    placed = rows.join(long, "session_id", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    number = F.when(F.col("row") == F.col("start"), 0).otherwise(F.pmod(F.xxhash64("row"), F.col("parts")))
    packed = placed.withColumn("chunk", number).groupBy("session_id", "chunk").agg(
        F.first("roles").alias("roles"), F.first("parts").cast("int").alias("parts"), F.coalesce(F.first("positives"), F.sum("label")).alias("positives"),
        F.sort_array(F.collect_list(F.struct("row", "label", "x"))).alias("rows"),
    )
    gains = F.aggregate(F.sequence(F.lit(1), F.lit(k)), F.lit(0.0), lambda acc, i: acc + F.when(i <= F.col("positives"), F.lit(1.0) / F.log2(i + F.lit(1.0))).otherwise(0.0))
    return packed.select("session_id", "chunk", "parts", "roles", gains.alias("ideal"), F.col("rows.row").alias("row"), F.col("rows.label").alias("label"), F.col("rows.x").alias("x"))


@dataclass
class _Block:
    """A batch of chunks or of packed records as flat arrays; `chunk` is the line (session, or chunk of one) of every row."""

    session: np.ndarray
    roles: np.ndarray
    ideal: np.ndarray
    chunk: np.ndarray
    row: np.ndarray
    label: np.ndarray
    x: np.ndarray
    score: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch, models: int, trees: list[list[Tree]]) -> _Block:
        rows = batch.column("row")
        if pa.types.is_list(rows.type):
            count = np.diff(rows.offsets.to_numpy())
            session, ideal = np.asarray(batch.column("session_id")), np.asarray(batch.column("ideal"))
            row, label, x = np.asarray(rows.flatten()), np.asarray(batch.column("label").flatten()), _unpacked(batch.column("x").flatten(), np.uint8)
        else:
            count, ideal = _unpacked(batch.column("sizes"), np.int32), _unpacked(batch.column("ideal"), np.float64)
            session = np.repeat(np.asarray(pc.fill_null(batch.column("session_id"), -1)), _lines(batch))
            row, label, x = (_unpacked(batch.column(c), kind) for c, kind in (("row", np.int64), ("label", np.uint8), ("x", np.uint8)))
        x = x.reshape(int(count.sum()), -1)
        score = _unpacked(batch.column("base"), np.float64).reshape(len(x), models).copy()
        if any(trees):
            columns = np.ascontiguousarray(x.T)
            for m, own in enumerate(trees):
                total = np.ascontiguousarray(score[:, m])
                for tree in own:
                    tree.add_values(columns, total)
                score[:, m] = total
        roles = _unpacked(batch.column("roles"), np.uint8).reshape(-1, models)
        return cls(session, roles, ideal, np.repeat(np.arange(len(count)), count), row, label, x, score)

    def places(self, chunk: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where these rows of these chunks are, -1 where they are not; a chunk's rows are in order."""
        if not len(self.row):
            return np.full(len(row), -1)
        known, number = np.unique(self.row, return_inverse=True)
        nearest = np.minimum(np.searchsorted(known, row), len(known) - 1)
        keys, wanted = self.chunk * len(known) + number, chunk * len(known) + nearest
        at = np.searchsorted(keys, wanted, side="right") - 1
        return np.where((at >= 0) & (keys[at] == wanted) & (known[nearest] == row), at, -1)


def _sizes(column: pa.Array, width: int) -> np.ndarray:
    """Bytes of binary values in units of `width`."""
    return np.asarray(pc.binary_length(column)) // width


def _lines(batch: pa.RecordBatch) -> np.ndarray:
    return _sizes(batch.column("sizes"), 4)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about SLAB rows."""
    for batch in batches:
        rows = batch.column("row")
        count = np.diff(rows.offsets.to_numpy()) if pa.types.is_list(rows.type) else _sizes(rows, 8)
        slab = (np.cumsum(count) - 1) // SLAB
        firsts = np.append(np.flatnonzero(np.append(True, slab[1:] != slab[:-1])), len(slab)) if len(slab) else np.zeros(1, dtype=np.int64)
        for at, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            yield batch.slice(at, end - at)


#: Columns that the rows of all rounds have.
_STATE = "session_id bigint, chunk int, sizes binary, roles binary, ideal binary, row binary, label binary, x binary, base binary"
_STATE_NAMES = [c.split()[0] for c in _STATE.split(", ")]


def _pack(models: int):
    """Chunks as records of flat arrays, scores 0: about BLOCK rows of whole sessions each, or one chunk of a session of several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = np.asarray(batch.column("parts"))
            for long in (False, True):
                some = batch.filter(pa.array((parts > 1) == long))
                if not some.num_rows:
                    continue
                count = np.diff(some.column("row").offsets.to_numpy())
                ends = np.cumsum(count)
                record = np.arange(len(count)) if long else (ends - 1) // BLOCK
                lines = np.append(np.flatnonzero(np.append(True, record[1:] != record[:-1])), len(record))
                rows = np.append(0, ends)[lines]
                x = _unpacked(some.column("x").flatten(), np.uint8).reshape(int(ends[-1]), -1)
                sessions = some.column("session_id") if long else pa.nulls(len(lines) - 1, pa.int64())
                chunk = some.column("chunk").cast(pa.int32()) if long else pa.array(np.zeros(len(lines) - 1, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        sessions, chunk, _packed(count.astype(np.int32), lines), _packed(_unpacked(some.column("roles"), np.uint8).reshape(-1, models), lines),
                        _packed(np.asarray(some.column("ideal")), lines), _packed(np.asarray(some.column("row").flatten()), rows),
                        _packed(np.asarray(some.column("label").flatten()).astype(np.uint8), rows), _packed(x, rows), _packed(np.zeros((len(x), models)), rows),
                    ],
                    names=_STATE_NAMES,
                )

    return run


def _rank(group: np.ndarray) -> np.ndarray:
    """Position of every element in its run of equal groups."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.empty(0, dtype=np.int64)
    return np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))


def _best_rows(models: int, trees: list[list[Tree]], k: int):
    """The best k rows of every chunk for every model: session_id, model, less (minus the score), row, label, x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _each(batches):
            block = _Block.read(batch, models, trees)
            for m in range(models):
                order = np.lexsort((block.row, -block.score[:, m], block.chunk))
                top = order[_rank(block.chunk[order]) < k]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.session[block.chunk[top]]), pa.array(np.full(len(top), m, dtype=np.int32)), pa.array(-block.score[top, m]),
                        pa.array(block.row[top]), pa.array(block.label[top].astype(np.int32)), _packed(block.x[top]),
                    ],
                    names=["session_id", "model", "less", "row", "label", "x"],
                )

    return run


def pair_gradients(
    score: np.ndarray, label: np.ndarray, session: np.ndarray, place: np.ndarray,
    top_score: np.ndarray, top_label: np.ndarray, usable: np.ndarray, ideal: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of NDCG@k's pairs: of the rows, and what the rows outside the best k add to those (session x place).

    `session` numbers the sessions' lines in top_* (best rows, those that are `usable`) and `ideal`; `place` is a row's place among
    the best, -1 outside. Returns (gradient, hessian, gradient of the best, hessian of the best).
    """
    places = top_score.shape[1]
    discount = 1 / np.log2(np.arange(places) + 2)
    own_discount, outside = np.append(discount, 0.0)[place], place < 0
    share = 1 / np.where(ideal > 0, ideal, 1.0)
    # The label a row must have to form a pair with a best row; 2 where there is none.
    other = np.where(usable & (ideal > 0)[:, None], 1 - top_label, 2).astype(np.uint8)
    label = label.astype(np.uint8)
    gradient, hessian = np.zeros(len(score)), np.zeros(len(score))
    top_gradient, top_hessian = np.zeros(top_score.shape), np.zeros(top_score.shape)
    for t in range(places):
        pair = np.flatnonzero(np.ascontiguousarray(other[:, t]).take(session) == label)
        if not len(pair):
            continue
        line = session.take(pair)
        sign = 2.0 * label.take(pair) - 1.0
        worse = 1 / (1 + np.exp(np.clip(sign * (score.take(pair) - np.ascontiguousarray(top_score[:, t]).take(line)), -50, 50)))
        change = np.abs(discount[t] - own_discount.take(pair)) * share.take(line)
        force = worse * change
        bend = force * (1 - worse)
        force *= sign
        gradient[pair] -= force
        hessian[pair] += bend
        out = np.flatnonzero(outside.take(pair))
        line = line.take(out)
        top_gradient[:, t] = np.bincount(line, weights=force.take(out), minlength=len(ideal))
        top_hessian[:, t] = np.bincount(line, weights=bend.take(out), minlength=len(ideal))
    return gradient, hessian, top_gradient, top_hessian


def _best_here(score: np.ndarray, line: np.ndarray, firsts: np.ndarray, k: int) -> np.ndarray:
    """Where the best k rows of every line are (line x place), the earlier of equal ones first; -1 past a line's rows."""
    left = score.copy()
    out = np.full((len(firsts) - 1, k), -1)
    counts = np.diff(firsts)
    for t in range(k):
        hit = np.flatnonzero(left == np.maximum.reduceat(left, firsts[:-1]).take(line))
        of = line.take(hit)
        at = hit[np.append(True, of[1:] != of[:-1])]
        out[:, t] = np.where(t < counts, at, -1)
        left[at] = -np.inf
    return out


def _tops(batch: pa.RecordBatch, models: int, k: int, width: int):
    """The joined best rows of every chunk's session as arrays chunk x model x place: score, label, row, x, and which are there."""
    lists = batch.column("tops")
    count = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    chunk, model = np.repeat(np.arange(batch.num_rows), count), np.asarray(flat.field("model"))
    place = _rank(chunk * models + model)
    used = np.flatnonzero(place < k)
    at = (chunk[used], model[used], place[used])
    shape = (batch.num_rows, models, k)
    score, label, row, x = np.zeros(shape), np.zeros(shape, dtype=np.int64), np.full(shape, -1, dtype=np.int64), np.zeros((*shape, width), dtype=np.uint8)
    score[at] = -np.asarray(flat.field("less"))[used]
    label[at], row[at] = np.asarray(flat.field("label"))[used], np.asarray(flat.field("row"))[used]
    x[at] = _unpacked(flat.field("x").take(pa.array(used)), np.uint8).reshape(len(used), width)
    filled = np.zeros(shape, dtype=bool)
    filled[at] = True
    return score, label, row, x, filled


def _bagged(row: np.ndarray, seed: int, share: float) -> np.ndarray:
    mixed = (row.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(11)).astype(np.float64) < share * 2.0**53


_GRADS = "x binary, g binary, h binary, n binary, model int, role int, total double, sessions bigint"
_GRADS_NAMES = [c.split()[0] for c in _GRADS.split(", ")]
_ROUND = f"{_STATE}, {_GRADS.removeprefix('x binary, ')}"


def _gradients(models: int, trees: list[list[Tree]], turn: int, settings: Settings, active: Sequence[int] | None = None, written: bool = False):
    """Rows of bins with gradient, hessian and weight (0 or 1) for every model, and each task's sums of NDCG by model and role.

    `trees` are added to the scores first. With `written`, records stay as they are but for their new scores, and get the gradients
    of all their rows in single precision; without, every row with a weight is a record of its own, in double precision. Records
    without `tops` are of whole sessions.
    """
    precision = np.float32 if written else np.float64
    discount = 1 / np.log2(np.arange(settings.k) + 2)
    active = range(models) if active is None else active
    kinds = {"session_id": pa.int64(), "chunk": pa.int32(), "model": pa.int32(), "role": pa.int32(), "total": pa.float64(), "sessions": pa.int64()}
    names = [c.split()[0] for c in _ROUND.split(", ")] if written else _GRADS_NAMES

    def out(**columns: pa.Array) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, kinds.get(c, pa.binary())) for c in names], names=names)

    def bag(row: np.ndarray, m: int) -> np.ndarray:
        return _bagged(row, settings.seed + 7919 * turn + m, settings.row_share)

    def work(batch: pa.RecordBatch, whole: bool, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        block = _Block.read(batch, models, trees)
        size = (models, len(block.row))
        g, h, n = np.zeros(size), np.zeros(size), np.zeros(size, dtype=np.uint8)
        if whole:
            firsts = np.searchsorted(block.chunk, np.arange(len(block.ideal) + 1))
            first = np.ones(len(block.ideal), dtype=bool)
        else:
            tops = _tops(batch, models, settings.k, block.x.shape[1])
            first = np.asarray(batch.column("chunk")) == 0
        share = 1 / np.where(block.ideal > 0, block.ideal, 1)
        for m in active:
            score = np.ascontiguousarray(block.score[:, m])
            if whole:
                at = _best_here(score, block.chunk, firsts, settings.k)
                filled = at >= 0
                top_score, top_label = score[at], np.where(filled, block.label[at], 0).astype(np.int64)
            else:
                top_score, top_label, top_row, top_x, filled = (t[:, m] for t in tops)
            gains = np.where(block.ideal > 0, (top_label * discount).sum(axis=1) * share, 0.0)
            for role in range(3):
                own = first & (block.roles[:, m] == role)
                sums[m, role] += (gains[own].sum(), own.sum())
            trained = block.roles[:, m] == TRAIN
            used = trained[block.chunk] & bag(block.row, m)
            if settings.objective == "ndcg":
                place = np.full(len(score), -1)
                if whole:
                    place[at[filled]] = np.nonzero(filled)[1]
                else:
                    for t in range(settings.k):
                        place[(top_row[block.chunk, t] == block.row) & filled[block.chunk, t]] = t
                found = pair_gradients(score, block.label, block.chunk, place, top_score, top_label, filled & trained[:, None], block.ideal)
                g[m], h[m] = found[:2]
                # What a best row gets from the others goes to its own chunk's row, or on a row of its own where that is elsewhere.
                c, t = np.nonzero(found[3] > 0)
                to = at[c, t] if whole else block.places(c, top_row[c, t])
                here = to >= 0
                g[m][to[here]] += found[2][c[here], t[here]]
                h[m][to[here]] += found[3][c[here], t[here]]
                if not here.all():
                    c, t = c[~here], t[~here]
                    c, t = (v[bag(top_row[c, t], m)] for v in (c, t))
                    more = np.zeros((3, len(c), models))
                    more[0, :, m], more[1, :, m] = found[2][c, t], found[3][c, t]
                    if len(c):
                        yield out(x=_packed(top_x[c, t]), g=_packed(more[0].astype(precision)), h=_packed(more[1].astype(precision)), n=_packed(more[2].astype(np.uint8)))
            else:
                p = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
                g[m], h[m] = p - block.label, p * (1 - p)
            g[m][~used], h[m][~used], n[m] = 0, 0, used
        if written:
            lines = np.append(0, np.cumsum(_sizes(batch.column("row"), 8)))
            same = {c: batch.column(c) for c in _STATE_NAMES if c != "base"}
            yield out(**same, base=_packed(block.score, lines), g=_packed(g.T.astype(precision), lines), h=_packed(h.T.astype(precision), lines), n=_packed(n.T, lines))
        elif (some := n.any(axis=0)).any():
            yield out(x=_packed(block.x[some]), g=_packed(g.T[some]), h=_packed(h.T[some]), n=_packed(n.T[some]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((models, 3, 2))
        for batch in _each(batches):
            whole = batch.column("tops").is_null()
            for part, flag in ((batch.filter(whole), True), (batch.filter(pc.invert(whole)), False)):
                if part.num_rows:
                    yield from work(part, flag, sums)
        number = np.arange(3 * models)
        yield out(
            model=pa.array((number // 3).astype(np.int32)), role=pa.array((number % 3).astype(np.int32)),
            total=pa.array(sums[:, :, 0].ravel()), sessions=pa.array(sums[:, :, 1].ravel().astype(np.int64)),
        )

    return run


def _sums(columns: np.ndarray, chosen: np.ndarray, rows: np.ndarray, leaf: np.ndarray, length: int, g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(gradient, hessian, rows) x features x slots of these rows, whose slot is their `leaf` and their bin; g, h and n are theirs."""
    out, counted = np.empty((3, len(chosen), length)), bool(n.all())
    for place, feature in enumerate(chosen):
        slot = leaf + columns[feature].take(rows)
        out[0, place] = np.bincount(slot, weights=g, minlength=length)
        out[1, place] = np.bincount(slot, weights=h, minlength=length)
        out[2, place] = np.bincount(slot if counted else slot[n > 0], minlength=length)
    return out


_SUMS = "model int, node int, place int, sums binary, x binary, g binary, h binary, n binary"
_SUMS_NAMES = [c.split()[0] for c in _SUMS.split(", ")]
#: The place of a leaf's rows, or of what was grown from them, where sums have that of their feature.
ROWS = -1


def _histograms(asked: list[tuple[int, int]], local: list[tuple[int, int]], trees: list[Tree], chosen: list[np.ndarray], bins: int, width: int):
    """Per task and `asked` (model, node) and feature the sums of gradient, hessian and rows in each bin; the rows of `local` nodes themselves."""

    models = len(trees)
    nodes = [sorted(node for m, node in asked if m == own) for own in range(models)]
    whole = [sorted(node for m, node in local if m == own) for own in range(models)]

    def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = max(1, SLAB * batch.num_rows // max(1, int(_sizes(batch.column(0), width).sum())))
            for at in range(0, batch.num_rows, each):
                yield batch.slice(at, each)

    def out(m: int, node: int, places: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
        keys = [pa.array(np.full(len(places), v, dtype=np.int32)) for v in (m, node)] + [pa.array(places.astype(np.int32))]
        rest = [columns[c] if c in columns else pa.nulls(len(places), pa.binary()) for c in _SUMS_NAMES[3:]]
        return pa.RecordBatch.from_arrays([*keys, *rest], names=_SUMS_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((3, len(used), len(own) * (bins + 1))) for own, used in zip(nodes, chosen, strict=True)]
        for batch in slabs(batches):
            columns = np.ascontiguousarray(_unpacked(batch.column(0), np.uint8).reshape(-1, width).T)
            n = _unpacked(batch.column(3), np.uint8).reshape(-1, models)
            precision = np.float64 if _sizes(batch.column(1), 8).sum() == n.size else np.float32
            g, h = (_unpacked(batch.column(c), precision) for c in (1, 2))
            # Weighed rows, and rows that only carry what they got from elsewhere.
            carrying = ~n.any(axis=1)
            for m, (wanted, taken) in enumerate(zip(nodes, whole, strict=True)):
                if not wanted and not taken:
                    continue
                own = np.flatnonzero((n[:, m] > 0) | carrying)
                found = dict(trees[m].reach(columns, own, [*wanted, *taken]))
                if wanted:
                    parts = [found[node] for node in wanted]
                    rows, leaf = np.concatenate(parts), np.repeat(np.arange(len(wanted)) * (bins + 1), [len(r) for r in parts])
                    flat = rows * models + m
                    totals[m] += _sums(columns, chosen[m], rows, leaf, totals[m].shape[2], g.take(flat).astype(np.float64), h.take(flat).astype(np.float64), n.ravel().take(flat))
                for node in taken:
                    if len(rows := found[node]):
                        flat, one = rows * models + m, np.array([0, len(rows)])
                        given = (columns[:, rows].T, g.take(flat).astype(np.float64), h.take(flat).astype(np.float64), n.ravel().take(flat))
                        yield out(m, node, np.array([ROWS]), **{c: _packed(v, one) for c, v in zip("xghn", given, strict=True)})
        for m, wanted in enumerate(nodes):
            cube = totals[m].reshape(3, len(chosen[m]), len(wanted), bins + 1)
            for i, node in enumerate(wanted):
                some = np.flatnonzero(cube[1:, :, i].any(axis=(0, 2)))
                yield out(m, node, some, sums=_packed(cube[:, some, i].transpose(1, 0, 2)))

    return run


def _added(room: list[int], chosen: list[np.ndarray], settings: Settings):
    """The tasks' histograms of the same model, node and feature as one, and what grows from the rows of the same model and node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, np.ndarray] = {}
        rows: dict[tuple, list[list[bytes]]] = {}
        for batch in batches:
            for *key, sums, x, g, h, n in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                if key[2] == ROWS:
                    rows.setdefault(tuple(key), []).append([x, g, h, n])
                else:
                    sums = np.frombuffer(sums, dtype=np.float64)
                    totals[tuple(key)] = totals[tuple(key)] + sums if tuple(key) in totals else sums
        blobs = {key: value.tobytes() for key, value in totals.items()}
        while rows:
            key, parts = rows.popitem()
            x, g, h, n = (np.frombuffer(b"".join(part), dtype=kind) for part, kind in zip(zip(*parts, strict=True), (np.uint8, np.float64, np.float64, np.uint8), strict=True))
            columns = np.ascontiguousarray(x.reshape(len(n), -1).T)
            blobs[key] = pickle.dumps(grow_here(columns, g, h, n, chosen[key[0]], replace(settings, leaves=room[key[0]] + 1)).found())
        if blobs:
            keys = [pa.array(c, pa.int32()) for c in zip(*blobs, strict=True)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(list(blobs.values()), pa.binary())], names=_SUMS_NAMES[:4])

    return run


Split = tuple[float, int, bool, float, float, float, float, float, float]


def best_splits(sums: np.ndarray, least_rows: int, least_hessian: float) -> list[Split | None]:
    """`best_split` of every feature's histogram: (gradient, hessian, rows) x features x bins."""
    whole = sums.sum(axis=2)
    steps = np.cumsum(sums[:, :, 1:], axis=2)
    before = whole[0] ** 2 / (whole[1] + 1e-9)
    best: list[Split | None] = [None] * sums.shape[1]
    for nulls_left in (False, True):
        left = steps + sums[:, :, :1] if nulls_left else steps
        right = whole[:, :, None] - left
        ok = (np.rint(left[2]) >= least_rows) & (np.rint(right[2]) >= least_rows) & (left[1] >= least_hessian) & (right[1] >= least_hessian)
        gains = np.where(ok, left[0] ** 2 / (left[1] + 1e-9) + right[0] ** 2 / (right[1] + 1e-9) - before[:, None], -np.inf)
        at = gains.argmax(axis=1)
        most = gains[np.arange(len(at)), at]
        for f in np.flatnonzero(most > 1e-9).tolist():
            if best[f] is None or most[f] > best[f][0] + 1e-12 * abs(best[f][0]):
                best[f] = (float(most[f]), int(at[f]) + 1, nulls_left, *left[:, f, at[f]].tolist(), *right[:, f, at[f]].tolist())
    return best


def best_split(sums: np.ndarray, least_rows: int, least_hessian: float) -> Split | None:
    """Of a histogram (gradient, hessian, rows) x bins the best: gain, bin, nulls left, and both sides' sums; None if no cut is allowed.

    Bin 0 holds the nulls, which go to the side that gains more. Ties go to the smaller bin, then to nulls on the right.
    """
    return best_splits(sums[:, None, :], least_rows, least_hessian)[0]


_SPLIT_NAMES = ("gain", "bin", "nulls_left", "lg", "lh", "ln", "rg", "rh", "rn")


class Growth:
    """One tree grown best-first, with splits looked up ahead of the order in which they are taken."""

    def __init__(self, settings: Settings, chosen: np.ndarray, rows: int | None = None, alone: bool = False) -> None:
        """`rows`: as many as there are at most, if known. `alone`: by one task, which looks nothing up ahead and leaves nothing to others."""
        self.settings, self.chosen, self.alone, self.tree, self.ahead = settings, chosen, alone, Tree(), {}
        # The tree with all known splits, and per node its split or None.
        self.known: dict[int, dict | None] = {}
        self.pending = [0]
        self.room = settings.leaves - 1
        # Histograms (gradient, hessian, rows) x features x bins by node, each node's parent and sibling, and its rows.
        self.sums: dict[int, np.ndarray] = {}
        self.family: dict[int, tuple[int, int]] = {}
        self.rows: dict[int, float] = {0: math.inf if rows is None else rows}

    def local(self) -> list[int]:
        """Pending nodes of so few rows that one task grows all below them."""
        return [] if self.alone else [node for node in self.pending if self.rows[node] <= LOCAL]

    def asked(self) -> list[int]:
        """Nodes whose histograms are needed: the other pending ones, of two siblings only the one with fewer rows."""
        local, out = set(self.local()), []
        for node in self.pending:
            if node not in local:
                out.append(min(node, self.family[node][1], key=lambda n: (self.rows[n], n)) if node in self.family else node)
        return list(dict.fromkeys(out))

    def found(self) -> tuple[dict[int, dict | None], dict[int, tuple[int, int]]]:
        """All known splits, and the children of split nodes."""
        return self.known, self.ahead

    def histogram(self, node: int) -> np.ndarray:
        """The node's, as found or as what its sibling leaves of their parent's."""
        if node not in self.sums:
            parent, sibling = self.family[node]
            rest = self.sums[parent] - self.sums[sibling]
            # Bins without rows: what is left there is rounding.
            self.sums[node] = np.where((np.rint(rest[2]) == 0) & (rest[1] <= 1e-9 * self.sums[parent][1]), 0.0, rest)
        return self.sums[node]

    def split_of(self, node: int) -> dict | None:
        """The split that gains most, of equal ones that of the first feature."""
        found = best_splits(self.histogram(node), self.settings.least_rows, self.settings.least_hessian)
        place = max((f for f, split in enumerate(found) if split), key=lambda f: (found[f][0], -f), default=None)
        return None if place is None else {"feature": int(self.chosen[place]), **dict(zip(_SPLIT_NAMES, found[place], strict=True))}

    def open(self, node: int, split: dict | None) -> tuple[int, ...]:
        """Take note of a node's split; its children."""
        self.known[node] = split
        if not split:
            return ()
        left, right = self.ahead[node] = self.tree.split(node, split["feature"], split["bin"], split["nulls_left"], split["gain"])
        self.family |= {left: (node, right), right: (node, left)}
        for child, side in ((left, "l"), (right, "r")):
            self.tree.value[child] = -split[f"{side}g"] / (split[f"{side}h"] + 1e-9)
            self.rows[child] = round(split[f"{side}n"])
            if self.rows[child] < 2 * self.settings.least_rows:
                self.known[child] = None
        return left, right

    def add(self, sums: dict[int, np.ndarray], grown: dict[int, tuple[dict, dict]] | None = None) -> None:
        """Histograms of the `asked` nodes and what was `found` from the `local` ones; finds the nodes that have to be known next."""
        empty = np.zeros((3, len(self.chosen), self.settings.bins + 1))
        local = set(self.local())
        self.sums |= {node: sums.get(node, empty) for node in self.asked()}
        for node in self.pending:
            if node not in local:
                self.open(node, self.split_of(node))
                continue
            known, ahead = (grown or {}).get(node, ({0: None}, {}))
            todo = [(0, node)]
            while todo:
                there, here = todo.pop(0)
                if there in known:
                    todo += zip(ahead.get(there, ()), self.open(here, known[there]))
        taken, waiting, unknown = self.order()
        self.room = self.settings.leaves - 1 - len(taken)
        # All that the order may come to: leaves on its way, and those below the best splits still waiting.
        below = [] if self.alone else [c for _, node in sorted(waiting)[: self.room] for c in self.ahead[node]]
        self.pending = [n for n in dict.fromkeys([*unknown, *below]) if n not in self.known] if unknown and self.room > 0 else []

    def order(self) -> tuple[list[int], list[tuple[float, int]], list[int]]:
        """Nodes split best-first as far as all gains are known, splits still waiting, and unknown leaves met."""
        heap: list[tuple[float, int]] = []
        taken: list[int] = []
        unknown: list[int] = []

        def meet(node: int) -> None:
            if node not in self.known:
                unknown.append(node)
            elif self.known[node]:
                heapq.heappush(heap, (-self.known[node]["gain"], node))

        meet(0)
        while heap and not unknown and len(taken) < self.settings.leaves - 1:
            taken.append(heapq.heappop(heap)[1])
            for child in self.ahead[taken[-1]]:
                meet(child)
        return taken, heap, unknown

    def finished(self, rate: float) -> Tree:
        """The tree of the splits taken, leaves' values times the rate."""
        taken = set(self.order()[0])
        out, todo = Tree(), [(0, 0)]
        while todo:
            old, new = todo.pop()
            if old in taken:
                left, right = out.split(new, self.tree.feature[old], self.tree.bin[old], self.tree.nulls_left[old], self.tree.gain[old])
                todo += list(zip(self.ahead[old], (left, right), strict=True))
            else:
                out.value[new] = rate * self.tree.value[old]
        return out


def grow_here(columns: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, chosen: np.ndarray, settings: Settings) -> Growth:
    """All that grows from these rows; `columns` has the bins by feature."""
    growth, every, length = Growth(settings, chosen, alone=True), np.arange(len(n)), settings.bins + 1
    while asked := growth.asked():
        found = dict(growth.tree.reach(columns, every, asked))
        growth.add({node: _sums(columns, chosen, r, np.zeros(len(r), dtype=np.int64), length, g.take(r), h.take(r), n.take(r)) for node, r in found.items()})
    return growth


def grow(grads: DataFrame, models: Sequence[int], of: int, width: int, turn: int, settings: Settings, rows: int | None = None) -> list[Tree]:
    """One tree for each of the `models` (of `of` in all) from a table of gradients of `rows` rows, all in the same passes."""
    rng = np.random.default_rng([settings.seed, turn])
    wanted = max(1, round(settings.feature_share * width))
    chosen = [np.sort(rng.choice(width, wanted, replace=False)) for _ in range(of)]
    growing = [Growth(settings, chosen[m], rows) if m in set(models) else None for m in range(of)]
    given = grads.filter("x IS NOT NULL").select("x", "g", "h", "n")
    while any(growth and growth.pending for growth in growing):
        asked, local = ([(m, node) for m, growth in enumerate(growing) if growth for node in of_growth(growth)] for of_growth in (Growth.asked, Growth.local))
        trees = [growth.tree if growth else Tree() for growth in growing]
        sums = given.mapInArrow(_histograms(asked, local, trees, chosen, settings.bins, width), _SUMS).repartition("model", "node", "place")
        added = _added([growth.room if growth else 0 for growth in growing], chosen, settings)
        found: list[dict[int, np.ndarray]] = [{} for _ in growing]
        grown: list[dict[int, tuple[dict, dict]]] = [{} for _ in growing]
        for r in sums.mapInArrow(added, "model int, node int, place int, sums binary").collect():
            m, node = r["model"], r["node"]
            if r["place"] == ROWS:
                grown[m][node] = pickle.loads(r["sums"])
            else:
                cube = found[m].setdefault(node, np.zeros((3, len(chosen[m]), settings.bins + 1)))
                cube[:, r["place"]] = np.frombuffer(r["sums"], dtype=np.float64).reshape(3, -1)
        for m, growth in enumerate(growing):
            if growth and growth.pending:
                growth.add(found[m], grown[m])
    return [growing[m].finished(settings.rate) for m in models]


def boost(table: DataFrame, bins: Bins, models: int, settings: Settings = Settings(), report: Callable[[int, dict], None] | None = None) -> list[Model]:
    """Models fitted together on a table of `chunks`, model m on the rows whose mth role is TRAIN.

    A model with WATCH rows ends at the round at which their NDCG@k was highest, `patience` rounds after it at the latest; one without,
    at its last tree with a split.
    """
    spark, settings = table.sparkSession, replace(settings, bins=max(settings.bins, 1))
    tops_kind = "array<struct<model:int,less:double,row:bigint,label:int,x:binary>>"
    # Records of many rows: a reader holds a row group's worth of them. Files alike in size, as many for each core, are read by tasks alike.
    options = {"parquet.block.size": 32 << 20, "compression": "lz4_raw"}
    packed = table.mapInArrow(_pack(models), _STATE).repartition(2 * spark.sparkContext.defaultParallelism)
    state, path = write_new(packed, "boosting-rows", **options)
    long = bool(state.filter("session_id IS NOT NULL").select("chunk").head(1))
    rows = state.agg(F.coalesce(F.sum(F.octet_length("label")), F.lit(0)).alias("rows")).first()["rows"]
    width = len(bins.features)
    done: list[list[Tree]] = [[] for _ in range(models)]
    trees: list[list[Tree]] = [[] for _ in range(models)]
    watched: list[list[float]] = [[] for _ in range(models)]
    active = list(range(models))
    for turn in range(settings.rounds + 1):
        given = (state.filter("session_id IS NULL") if long else state).withColumn("tops", F.lit(None).cast(tops_kind))
        if long:
            spread = state.filter("session_id IS NOT NULL")
            best = spread.mapInArrow(_best_rows(models, trees, settings.k), "session_id bigint, model int, less double, row bigint, label int, x binary")
            tops = best.groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("model", "less", "row", "label", "x"))).alias("tops"))
            given = given.unionByName(spread.join(tops, "session_id"))
        made, new_path = write_new(given.mapInArrow(_gradients(models, trees, turn, settings, active, True), _ROUND), "boosting-rows", **options)
        drop_written(spark, path)
        path, state = new_path, made.filter("row IS NOT NULL").select(*_STATE_NAMES)
        sums: dict[tuple[int, int], list] = {}
        for r in made.filter("model IS NOT NULL").select("model", "role", "total", "sessions").collect():
            sums.setdefault((r["model"], r["role"]), []).append((r["total"], r["sessions"]))
        quality = {key: math.fsum(t for t, _ in parts) / count for key, parts in sums.items() if (count := sum(n for _, n in parts))}
        if report:
            report(turn, quality)
        for m in list(active):
            watched[m].append(quality.get((m, WATCH), float(sum(len(tree.feature) > 1 for tree in done[m]))))
            best_turn = int(np.argmax(watched[m]))
            if turn - best_turn >= settings.patience:
                active.remove(m)
        if not active or turn == settings.rounds:
            break
        trees = [[] for _ in range(models)]
        for m, tree in zip(active, grow(made, active, models, width, turn, settings, rows), strict=True):
            trees[m].append(tree)
            done[m].append(tree)
    drop_written(spark, path)
    ends = [int(np.argmax(w)) for w in watched]
    return [Model(bins, tuple(own[:end]), tuple(w)) for own, end, w in zip(done, ends, watched, strict=True)]


def predict(df: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """`df` with the model's score as a last column; `model` is a few kilobytes per tree."""
    return predict_all(df, [model], [out])


def predict_all(df: DataFrame, models: Sequence[Model], out: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """`df`, or its columns `keep`, with the scores of models of the same bins in the columns `out`; every row is looked at once."""
    bins, kept = models[0].bins, list(df.columns if keep is None else keep)
    names = [f"_f{i}" for i in range(len(bins.features))]
    wide = df.select(*kept, *[c.alias(n) for c, n in zip(_inputs(df, bins.features), names, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.ascontiguousarray(bins.of(batch.columns[len(kept):]).T)
            scores = np.zeros((len(models), batch.num_rows))
            for model, score in zip(models, scores, strict=True):
                for tree in model.trees:
                    tree.add_values(columns, score)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *map(pa.array, scores)], names=[*kept, *out])

    return wide.mapInArrow(run, df.select(*kept, *[F.lit(0.0).alias(name) for name in out]).schema)
