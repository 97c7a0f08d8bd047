"""Exact top-k by inner product: a Voronoi join of query vectors with data vectors.

Vectors are grouped by their nearest pivot. Every group has a summary: number of vectors, radius, and the
distances of the few vectors closest to its pivot. From the summaries alone each query gets a score
that at least k vectors surely reach; by the Cauchy-Schwarz inequality a group can matter only if
query x pivot + |query| x radius reaches that. Queries, the smaller side, are sent to just the groups that matter; large groups are
cut into chunks, queries into blocks, and every (chunk, block) is solved by itself with one matrix product.
Of equal vectors only the k+1 smallest ids take part, which can't change a result.

Cases: vectors that are null or hold null or non-finite components take no part. Shorter vectors count
as padded with zeros. Ids are compared with the query's, so a repeated row of a query is no candidate;
rows with a null id take no part. With fewer than k candidates all are returned. Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.session import stage


@dataclass(frozen=True)
class Join:
    """pivots: groups, at most; their summaries are broadcast. chunk, block: data and query vectors per local problem."""

    k: int = 5
    scale: float = 256.0
    pivots: int = 256
    chunk: int = 8192
    block: int = 1024


def whole_vectors(table: DataFrame, join: Join) -> DataFrame:
    """vec_id and v: floor(scale * x) of every component; only rows that take part."""
    component = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), component.alias("x"), F.coalesce(sound, F.lit(False)).alias("sound"))
    return rows.filter("sound AND vec_id IS NOT NULL").select("vec_id", F.transform("x", lambda x: F.floor(x * join.scale)).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, padded with zeros."""
    rows = column.to_pylist()
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _nearest(pivots: np.ndarray):
    """The group and the distance to its pivot, for every vector."""
    norms = (pivots * pivots).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column(1), pivots.shape[1]).astype(np.float64)
            group = (norms - 2 * points @ pivots.T).argmin(axis=1)
            # A little more than the distance, so that rounding never makes a bound too tight.
            far = np.sqrt(((points - pivots[group]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group), pa.array(far)], names=["vec_id", "v", "group", "far"])

    return run


@dataclass(frozen=True)
class Summary:
    """Of every group: pivot, vectors, radius, distances of the vectors closest to the pivot (inf where there are fewer)."""

    pivots: np.ndarray
    count: np.ndarray
    radius: np.ndarray
    closest: np.ndarray
    chunks: np.ndarray


def _needed(summary: Summary, join: Join):
    """For every query the chunks it needs, and the score to reach."""
    norms_p = summary.pivots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column("v"), norms_p.shape[1]).astype(np.float64)
            norm = np.sqrt((points * points).sum(axis=1)) * (1 + 1e-9)
            middle = points @ norms_p.T
            own = np.asarray(batch.column("group"))
            rows: list[int] = []
            group_of: list[int] = []
            least: list[float] = []
            for i in range(len(points)):
                # What the vectors closest to each pivot reach at least. The query itself may be one of its own
                # group's, so the best of those doesn't count.
                sure = middle[i][:, None] - norm[i] * summary.closest
                sure[own[i], 0] = -np.inf
                flat = sure[np.isfinite(sure)]
                floor = np.partition(flat, len(flat) - join.k)[len(flat) - join.k] if len(flat) >= join.k else -np.inf
                floor -= 1e-6 * (1 + abs(floor)) if np.isfinite(floor) else 0
                for g in np.flatnonzero(middle[i] + norm[i] * summary.radius >= floor).tolist():
                    rows.append(i)
                    group_of.append(g)
                    least.append(floor)
            out = batch.select(["vec_id", "v"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(group_of, pa.int64()), pa.array(least, pa.float64()), pa.array(summary.chunks[group_of] if group_of else [], pa.int64())],
                names=["vec_id", "v", "group", "floor", "chunks"],
            )

    return run


_FOUND = "query_id long, vec_id long, score long"


def _product(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating-point matrix product where all sums stay below 2^53."""
    if not queries.size or not points.size:
        return np.zeros((len(queries), len(points)), dtype=np.int64)
    if float(np.abs(queries).max()) * float(np.abs(points).max()) * queries.shape[1] < 2**53:
        return (queries.astype(np.float64) @ points.T.astype(np.float64)).astype(np.int64)
    return np.stack([(points * q).sum(axis=1) for q in queries])


def _solve(join: Join):
    """Best k of one chunk for every query of one block."""

    def run(_key: tuple, queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or points.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = max(max(map(len, queries["v"])), max(map(len, points["v"])))
        points = points.sort_values("vec_id", kind="stable")
        ids, data = points["vec_id"].to_numpy(), _matrix(pa.array(points["v"]), width)
        asked, wanted = queries["vec_id"].to_numpy(), _matrix(pa.array(queries["v"]), width)
        out = []
        for at in range(0, len(asked), 128):
            score = _product(wanted[at : at + 128], data)
            for i, row in enumerate(score):
                row = np.where(ids == asked[at + i], np.iinfo(np.int64).min, row)
                # k+1 by score; equal scores at the edge are all looked at.
                edge = np.partition(row, -min(join.k, len(row)))[-min(join.k, len(row))]
                near = np.flatnonzero((row >= edge) & (ids != asked[at + i]))
                best = near[np.lexsort((ids[near], -row[near]))][: join.k]
                out.append((np.full(len(best), asked[at + i]), ids[best], row[best]))
        return pd.DataFrame({name: np.concatenate([o[k] for o in out]) for k, name in enumerate(("query_id", "vec_id", "score"))})

    return run


def top_k(table: DataFrame, is_query, join: Join = Join()) -> DataFrame:
    """The k best other vectors of every row where `is_query` (a condition on vec_id): query_id, rank, vec_id, score."""
    spark = table.sparkSession
    vectors = whole_vectors(table, join)
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    none = "query_id bigint, rank int, vec_id bigint, score bigint"
    if width is None:
        return spark.createDataFrame([], none)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(join.pivots).collect()
    pivots = np.unique(np.array([[*r["v"], *[0] * (width - len(r["v"]))] for r in sample], dtype=np.float64).reshape(len(sample), width), axis=0)
    grouped = stage(
        vectors.mapInArrow(_nearest(pivots), "vec_id bigint, v array<bigint>, group bigint, far double"), "knn-grouped"
    )
    # Of equal vectors the smallest ids; Spark cuts each task's rows to so many before the shuffle.
    equal = Window.partitionBy("v").orderBy("vec_id")
    data = stage(
        grouped.withColumn("n", F.row_number().over(equal)).filter(F.col("n") <= join.k + 1).drop("n"), "knn-data"
    )
    nearby = Window.partitionBy("group").orderBy("far", "vec_id")
    closest = data.select("group", "far", F.row_number().over(nearby).alias("n")).filter(F.col("n") <= join.k + 1)
    # One row per pivot and a few distances each.
    rows = data.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    near = closest.collect()
    count, radius = np.zeros(len(pivots), dtype=np.int64), np.full(len(pivots), -np.inf)
    for r in rows:
        count[r["group"]], radius[r["group"]] = r["n"], r["far"]
    table_near = np.full((len(pivots), join.k + 1), np.inf)
    for r in near:
        table_near[r["group"], r["n"] - 1] = r["far"]
    summary = Summary(pivots, count, radius, table_near, np.maximum(1, -(-count // join.chunk)))
    chunks = F.array(*[F.lit(int(c)) for c in summary.chunks])
    routed = grouped.filter(is_query).dropDuplicates(["vec_id"]).mapInArrow(
        _needed(summary, join), "vec_id bigint, v array<bigint>, group bigint, floor double, chunks bigint"
    )
    routed = stage(routed, "knn-routed")
    # Queries per group, to cut them into blocks of about equal size: one row per pivot.
    blocks = np.ones(len(pivots), dtype=np.int64)
    for r in routed.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect():
        blocks[r["group"]] = -(-r["n"] // join.block)
    block_count = F.array(*[F.lit(int(b)) for b in blocks])
    asked = routed.select(
        "group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("vec_id"), F.get(block_count, F.col("group").cast("int"))).alias("block"), "vec_id", "v",
    )
    held = data.select(
        "group", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.get(chunks, F.col("group").cast("int"))).cast("bigint").alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.get(block_count, F.col("group").cast("int")).cast("bigint") - 1)).alias("block"), "vec_id", "v",
    )
    key = ["group", "chunk", "block"]
    found = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(_solve(join), _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= join.k).select("query_id", "rank", "vec_id", "score")
