"""Unit vectors grouped around centres, so that a search can leave out groups that cannot hold an answer.

For every group the least and largest angle between a member and its centre are known. By the triangle
inequality of angles a vector at angle a from a centre is at least max(a - largest, least - a) from every member.

Groups are packed into blocks of about `block_rows` vectors, neighbouring groups together; a larger group is cut
into several blocks by hash. There are FEW_BLOCKS of them until a block reaches BLOCK_BYTES: up to there the vectors moved grow with
their number and not with its square. The centres come from a bounded sample and are at most MAX_GROUPS; the layout
kept in the driver grows with neither rows nor blocks. Zero vectors, whose cosine is 0 with everything, have a group
that is never left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vectors the centres are learned from, and the most centres.
SAMPLE_ROWS = 4096
MAX_GROUPS = 1024
# Groups per block's worth of vectors, and vectors per group where blocks are large: smaller groups have tighter bounds.
GROUPS_PER_BLOCK = 8
GROUP_ROWS = 512
# Blocks that all vectors are dealt to, the least rows of one, and what one may take in a task.
FEW_BLOCKS, LEAST_ROWS, BLOCK_BYTES = 16, 4096, 40 << 20
# Vectors whose angles to all centres are held at a time, cosines held at a time, and pairs multiplied at a time.
ANGLE_ROWS, CHUNK_COSINES, CHUNK_PAIRS = 1024, 1 << 22, 1 << 16
# Cosines are compared at this many decimals, so that rounding noise breaks no ties.
DECIMALS = 9
# Rounding of angles and cosines never hides a reachable group.
SLACK = 1e-7


@dataclass(frozen=True)
class Groups:
    """Centres (the last one stands for zero vectors), angles of the members, and the blocks of each group."""

    centres: np.ndarray
    least: np.ndarray
    largest: np.ndarray
    first: np.ndarray
    blocks: np.ndarray
    block_rows: int

    def reachable(self, units: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        """Per vector and group: may a member have at least this cosine with the vector?"""
        angles = np.arccos(np.clip(units @ self.centres.T, -1, 1))
        nearest = np.maximum(np.maximum(angles - self.largest, self.least - angles) - SLACK, 0)
        open_ = np.cos(nearest) >= cosines[:, None] - SLACK
        open_[:, -1] = True
        open_[~units.any(axis=1)] = True
        open_[:, self.blocks == 0] = False
        return open_

    def targets(self, units: np.ndarray, cosines: np.ndarray) -> list[list[int]]:
        """Per vector the first blocks of all reachable groups."""
        return [
            np.unique(self.first[row]).tolist() for at in range(0, len(units), ANGLE_ROWS)
            for row in self.reachable(units[at:at + ANGLE_ROWS], cosines[at:at + ANGLE_ROWS])
        ]


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float, copy=False)


def most_rows(width: int) -> int:
    """Vectors of this many numbers that a block may hold."""
    return max(1, BLOCK_BYTES // (8 * max(width, 1)))


def _kth(sim: np.ndarray, k: int) -> np.ndarray:
    """Per row a lower bound of the kth highest value: the kth of the maxima of 1,024 or more columns' groups."""
    parts = max(1024, 8 * k)
    if sim.shape[1] < k:
        return np.full(len(sim), -np.inf)
    maxima = sim
    if sim.shape[1] > 2 * parts:
        maxima = sim[:, :parts].copy()
        for at in range(parts, sim.shape[1] - parts + 1, parts):
            np.maximum(maxima, sim[:, at:at + parts], out=maxima)
    return np.partition(maxima, maxima.shape[1] - k, axis=1)[:, maxima.shape[1] - k]


def close_pairs(mat: np.ndarray, other_mat: np.ndarray, least: np.ndarray, k: int | None = None):
    """(row, column, cosine) arrays, chunk by chunk, of the cosines from the row's `least` up, with `k` of the k best at most.

    Single precision finds all that may be among them (its error is bounded by the width), double precision decides.
    Rows of one chunk come in order, their best first, ties to the smaller column.
    """
    narrow, other_narrow = mat.astype(np.float32), np.ascontiguousarray(other_mat.astype(np.float32).T)
    slack = 2 * (mat.shape[1] + 4) * 2.0**-24 + 2e-7
    step = int(np.clip(CHUNK_COSINES // max(len(other_mat), 1), 16, 1024))
    for start in range(0, len(mat), step):
        sim = narrow[start:start + step] @ other_narrow
        floor = least[start:start + step]
        if k is not None:
            floor = np.maximum(floor, _kth(sim, k))
        hit = np.flatnonzero(sim >= (floor - slack).astype(np.float32)[:, None])
        row, column = np.divmod(hit, sim.shape[1])
        row += start
        cosine = np.empty(len(hit))
        for at in range(0, len(hit), CHUNK_PAIRS):
            some = slice(at, at + CHUNK_PAIRS)
            cosine[some] = np.einsum("ij,ij->i", mat[row[some]], other_mat[column[some]])
        # Plus zero: no minus zero.
        cosine = np.round(cosine, DECIMALS) + 0.0
        kept = cosine >= least[row]
        row, column, cosine = row[kept], column[kept], cosine[kept]
        if k is not None:
            order = np.lexsort((column, -cosine, row))
            row, column, cosine = row[order], column[order], cosine[order]
            starts = np.searchsorted(row, row)
            best = np.arange(len(row)) - starts < k
            row, column, cosine = row[best], column[best], cosine[best]
        yield row, column, cosine


def best_lists(mat: np.ndarray, other_mat: np.ndarray, others: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[list, list]:
    """Per row of `mat` the k best `others` (in order of id) and minus their cosines, best first."""
    least = np.full(len(mat), -2.0) if least is None else least
    ids, less = [], []
    done = 0
    step = int(np.clip(CHUNK_COSINES // max(len(other_mat), 1), 16, 1024))
    for row, column, cosine in close_pairs(mat, other_mat, least, k):
        upto = min(done + step, len(mat))
        cuts = np.searchsorted(row, np.arange(done + 1, upto))
        ids += np.split(others[column], cuts)
        less += np.split(-cosine, cuts)
        done = upto
    return ids, less


def train_centres(sample: np.ndarray, wanted: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centres by spherical k-means; a centre that loses all its vectors keeps its place."""
    sample = sample[sample.any(axis=1)]
    if not len(sample):
        return np.zeros((0, sample.shape[1]))
    draw = np.random.default_rng(seed)
    centres = sample[draw.choice(len(sample), min(wanted, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        own = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def sample_vectors(units: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """A bounded sample by hash, the same on every run."""
    drawn = units.select("unit", F.xxhash64("rep", F.lit(11)).alias("_h"), "rep").orderBy("_h", "rep").limit(rows)
    found = [r.unit for r in drawn.select("unit").collect()]
    return np.array(found, dtype=float) if found else np.zeros((0, 0))


def assign(units: DataFrame, centres: np.ndarray) -> DataFrame:
    """`units` (rep, unit, copies) with the nearest centre as `group` and the angle to it; zero vectors go to the last group."""

    def run(frames):
        for pdf in frames:
            if len(pdf):
                mat = matrix(pdf["unit"])
                sim = mat @ centres.T
                group = np.argmax(sim, axis=1) if len(centres) else np.zeros(len(pdf), dtype=int)
                angle = np.arccos(np.clip(sim[np.arange(len(pdf)), group], -1, 1)) if len(centres) else np.zeros(len(pdf))
                zero = ~mat.any(axis=1)
                group[zero], angle[zero] = len(centres), 0.0
                yield pdf.assign(group=group.astype("int32"), angle=angle)

    return units.mapInPandas(run, "rep long, unit array<double>, copies long, group int, angle double")


def _chain(centres: np.ndarray) -> list[int]:
    """Centres in an order in which each follows its nearest one not yet taken."""
    if not len(centres):
        return []
    left, order = set(range(1, len(centres))), [0]
    sim = centres @ centres.T
    while left:
        rest = np.fromiter(left, dtype=int)
        order.append(int(rest[np.argmax(sim[order[-1], rest])]))
        left.remove(order[-1])
    return order


def _pack(order: list[int], counts: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each group."""
    first, blocks = np.zeros(len(counts), dtype=int), np.zeros(len(counts), dtype=int)
    at, filled = -1, block_rows
    for group in order:
        size = int(counts[group])
        if not size:
            continue
        if size > block_rows:
            blocks[group] = -(-size // block_rows)
            first[group] = at + 1
            at, filled = at + int(blocks[group]), block_rows
            continue
        if filled + size > block_rows:
            at, filled = at + 1, 0
        first[group], blocks[group] = at, 1
        filled += size
    return first, blocks


def fit_groups(units: DataFrame, block_rows: int | None = None) -> Groups:
    """Centres, angles and blocks for `units` (rep, unit), a table that reads the same each time."""
    sample, rows = sample_vectors(units), units.count()
    if block_rows is None:
        block_rows = min(max(LEAST_ROWS, -(-rows // FEW_BLOCKS)), most_rows(sample.shape[1]))
    wanted = max(-(-GROUPS_PER_BLOCK * rows // block_rows), -(-rows // GROUP_ROWS))
    wanted = int(np.clip(wanted, 1, min(MAX_GROUPS, max(len(sample) // 4, 1))))
    centres = train_centres(sample, wanted)
    found = assign(units, centres).groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.min("angle").alias("least"), F.max("angle").alias("largest")
    ).collect()
    total = len(centres) + 1
    counts, least, largest = np.zeros(total, dtype=int), np.zeros(total), np.zeros(total)
    for row in found:
        counts[row.group], least[row.group], largest[row.group] = row.n, row.least, row.largest
    first, blocks = _pack([*_chain(centres), total - 1], counts, block_rows)
    return Groups(np.vstack([centres, np.zeros((1, sample.shape[1]))]), least, largest, first, blocks, block_rows)


def placed(units: DataFrame, groups: Groups) -> DataFrame:
    """(rep, unit, block, copies): every vector with the block it is kept in."""
    spark = units.sparkSession
    rows = [(g, int(groups.first[g]), int(n)) for g, n in enumerate(groups.blocks) if n]
    # At most MAX_GROUPS + 1 rows.
    layout = F.broadcast(spark.createDataFrame(rows, "group int, first int, blocks int"))
    block = (F.col("first") + F.pmod(F.xxhash64("rep"), F.col("blocks"))).cast("int")
    return assign(units, groups.centres[:-1]).join(layout, "group").select("rep", "unit", block.alias("block"), "copies")


def _visits(asking: DataFrame, groups: Groups, wanted: str) -> DataFrame:
    """`asking` with one row for each block a vector has to see."""
    spans = {int(groups.first[g]): int(n) for g, n in enumerate(groups.blocks) if n}
    layout = F.broadcast(asking.sparkSession.createDataFrame(list(spans.items()), "first int, blocks int"))
    opened = asking.withColumn("first", F.explode("targets")).join(layout, "first")
    each = opened.withColumn("target", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)))
    return each.filter(wanted).drop("first", "blocks", "targets")


def meet(asking: DataFrame, groups: Groups, wanted: str, kernel: Callable, schema: str) -> DataFrame:
    """Bring vectors together with the blocks they have to see, `kernel(asking, kept)` per task, which yields frames.

    `asking`: a written table (rep, unit, copies, block, least, targets). However many vectors ask for one block, a task holds
    about `block_rows` of them and that block.
    """
    block_rows = groups.block_rows
    # Counted without the vectors: only the narrow columns are read.
    demand = _visits(asking.select("rep", "block", "targets"), groups, wanted).groupBy("target").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("parts")
    )
    asked = _visits(asking, groups, wanted).join(demand, "target").select(
        "target", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("parts")).cast("int").alias("part"), "rep", "unit", "copies", "block", "least", F.lit(True).alias("asks")
    )
    kept = asking.select(F.col("block").alias("target"), "rep", "unit", "copies").join(demand, "target").select(
        "target", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "rep", "unit", "copies",
        F.col("target").alias("block"), F.lit(None).cast("double").alias("least"), F.lit(False).alias("asks"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        asks = pdf["asks"].to_numpy(dtype=bool)
        asking_, kept_ = pdf[asks].sort_values("rep"), pdf[~asks].sort_values("rep")
        if len(asking_) and len(kept_):
            yield from kernel(asking_, kept_)

    return asked.unionByName(kept).groupBy("target", "part").applyInPandas(run, schema)


def moved(asking: DataFrame, groups: Groups, wanted: str) -> DataFrame:
    """(vectors, blocks, sent, all_blocks): vectors that `meet` moves, and what sending each to every block would move."""
    demand = _visits(asking.select("rep", "block", "targets"), groups, wanted).groupBy("target").agg(F.count(F.lit(1)).alias("asked"))
    sizes = asking.groupBy(F.col("block").alias("target")).agg(F.count(F.lit(1)).alias("kept"))
    each = sizes.join(demand, "target", "left").withColumn("asked", F.coalesce("asked", F.lit(0)))
    copies = F.ceil(F.col("asked") / F.lit(groups.block_rows)) * F.col("kept")
    totals = each.agg(
        F.coalesce(F.sum("kept"), F.lit(0)).alias("vectors"), F.count(F.lit(1)).alias("blocks"),
        F.coalesce(F.sum(F.col("asked") + copies + F.col("kept")), F.lit(0)).alias("sent"),
    )
    return totals.withColumn("all_blocks", F.col("vectors") * F.col("blocks"))
