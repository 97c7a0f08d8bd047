"""Approximate nearest vectors: inverted lists of coarse centroids, product-quantised residuals, exact re-ranking.

A vector is kept as the number of its nearest centroid and one byte for each short stretch of what the centroid leaves
over. A query looks into the lists of its nearest centroids, adds up looked-up products there, and only the
best few are compared exactly. Centroids and code books come from a bounded sample and are the only things in the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.vectors import with_unit_vector
from cartloom.operators import vector_groups as G
from cartloom.session import stage

# Numbers per byte of code, and different values of a byte.
STRETCH = 2
CODES = 256
# Queries and codes that meet in a task: a table of products per query, a matrix of scores per chunk.
QUERY_ROWS = 4096
LIST_ROWS = 65_536
CHUNK_ROWS = 128


@dataclass(frozen=True)
class Index:
    """Coarse centres and one code book (codes x stretch) for each stretch of the residual."""

    centres: np.ndarray
    books: np.ndarray

    def _stretches(self, rows: np.ndarray) -> np.ndarray:
        parts, _, stretch = self.books.shape
        padded = np.zeros((len(rows), parts * stretch))
        padded[:, : rows.shape[1]] = rows
        return padded.reshape(len(rows), parts, stretch)

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each vector and its codes."""
        lists = np.argmax(units @ self.centres.T, axis=1)
        parts = self._stretches(units - self.centres[lists])
        codes = np.empty(parts.shape[:2], dtype=np.uint8)
        for m, book in enumerate(self.books):
            codes[:, m] = np.argmin((book**2).sum(axis=1) - 2 * parts[:, m] @ book.T, axis=1)
        return lists, codes

    def scores(self, units: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Estimated cosines of queries with the members of one list: looked up, never multiplied out."""
        parts = self._stretches(units)
        total = np.repeat((units @ self.centres[centre])[:, None], len(codes), axis=1)
        for m, book in enumerate(self.books):
            total += (parts[:, m] @ book.T)[:, codes[:, m]]
        return total


def _code_book(rows: np.ndarray, codes: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Plain k-means of short stretches; always `codes` rows, repeated where the sample has fewer."""
    draw = np.random.default_rng(seed)
    book = rows[draw.choice(len(rows), codes, replace=len(rows) < codes)].copy()
    for _ in range(rounds):
        own = np.argmin((book**2).sum(axis=1) - 2 * rows @ book.T, axis=1)
        counts, sums = np.bincount(own, minlength=codes), np.zeros_like(book)
        np.add.at(sums, own, rows)
        filled = counts > 0
        book[filled] = sums[filled] / counts[filled, None]
    return book


def train(units: DataFrame, lists: int, stretch: int = STRETCH, codes: int = CODES) -> Index | None:
    """Fit on a bounded sample of `units` (rep, unit); None where there is no vector other than zero."""
    sample = G.sample_vectors(units)
    centres = G.train_centres(sample, int(np.clip(lists, 1, max(len(sample) // 4, 1))))
    if not len(centres):
        return None
    residuals = sample - centres[np.argmax(sample @ centres.T, axis=1)]
    parts = -(-sample.shape[1] // stretch)
    padded = np.zeros((len(sample), parts * stretch))
    padded[:, : sample.shape[1]] = residuals
    return Index(centres, np.stack([_code_book(p, codes) for p in padded.reshape(len(sample), parts, stretch).swapaxes(0, 1)]))


def build(units: DataFrame, index: Index) -> DataFrame:
    """(rep, list, codes): every vector, none left out."""

    def run(frames):
        for pdf in frames:
            if len(pdf):
                lists, codes = index.encode(G.matrix(pdf["unit"]))
                yield pd.DataFrame({"rep": pdf["rep"], "list": lists.astype("int32"), "codes": [c.tobytes() for c in codes]})

    return units.mapInPandas(run, "rep long, list int, codes binary")


def _probing(units: DataFrame, index: Index, probes: int) -> DataFrame:
    """(rep, unit, list): each vector once for every list it looks into."""

    def run(frames):
        for pdf in frames:
            if len(pdf):
                order = np.argsort(-(G.matrix(pdf["unit"]) @ index.centres.T), axis=1, kind="stable")[:, :probes]
                yield pdf.assign(lists=list(order.astype("int32")))

    found = units.mapInPandas(run, "rep long, unit array<double>, lists array<int>")
    return found.select("rep", "unit", F.explode("lists").alias("list"))


@dataclass(frozen=True)
class _Cells:
    """The (list, part, block) in which queries and members of a list meet.

    Long lists are cut into blocks, many queries into parts; every part meets every block.
    """

    plan: DataFrame
    probing: DataFrame
    coded: DataFrame

    def members(self, *columns: str) -> DataFrame:
        part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        return self.coded.join(self.plan, "list").select("list", part, _slot("blocks").alias("block"), *columns)

    def queries(self, *columns: str) -> DataFrame:
        block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        return self.probing.join(self.plan, "list").select("list", _slot("parts").alias("part"), block, *columns)


def _slot(count: str) -> Column:
    return F.pmod(F.xxhash64("rep"), F.col(count)).cast("int")


def _cells(units: DataFrame, coded: DataFrame, index: Index, probes: int) -> _Cells:
    rows = min(LIST_ROWS, G.most_rows(index.centres.shape[1]))
    # One row per centre.
    sizes = coded.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias("blocks"))
    probing = _probing(units, index, probes)
    demand = probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_ROWS)).cast("int").alias("parts"))
    return _Cells(F.broadcast(sizes.join(F.broadcast(demand), "list")), probing, coded)


def _short_lists(cells: _Cells, index: Index, shortlist: int) -> DataFrame:
    """(rep, short): the vectors with the best estimates for each query, each as (others, list, block)."""
    width = index.books.shape[0]

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["unit"].notna().to_numpy()
        asking, kept = pdf[asks], pdf[~asks].sort_values("rep")
        if not len(asking) or not len(kept):
            return pd.DataFrame({"rep": [], "list": [], "block": [], "others": [], "less": []})
        own, others = asking["rep"].to_numpy(), kept["rep"].to_numpy()
        mat, near, less = G.matrix(asking["unit"]), [], []
        codes = np.frombuffer(b"".join(kept["codes"]), dtype=np.uint8).reshape(-1, width)
        for start in range(0, len(own), CHUNK_ROWS):
            score = np.round(index.scores(mat[start:start + CHUNK_ROWS], int(pdf["list"].iat[0]), codes), 9)
            best = np.argsort(-score, axis=1, kind="stable")[:, :shortlist]
            near += list(others[best])
            less += list(-np.take_along_axis(score, best, axis=1))
        return pd.DataFrame({"rep": own, "list": pdf["list"].iat[0], "block": pdf["block"].iat[0], "others": near, "less": less})

    asked = cells.queries("rep", "unit", F.lit(None).cast("binary").alias("codes"))
    kept = cells.members("rep", F.lit(None).cast("array<double>").alias("unit"), "codes")
    # A query's best of one list travel as one row.
    local = asked.unionByName(kept).groupBy("list", "part", "block").applyInPandas(kernel, "rep long, list int, block int, others array<long>, less array<double>")
    entries = F.transform(F.arrays_zip("less", "others"), lambda n: F.struct(n["less"].alias("less"), n["others"].alias("others"), F.col("list").alias("list"), F.col("block").alias("block")))
    merged = local.groupBy("rep").agg(F.flatten(F.collect_list(entries)).alias("_all"))
    short = F.transform(F.slice(F.sort_array("_all"), 1, shortlist), lambda n: F.struct(n["others"].alias("others"), n["list"].alias("list"), n["block"].alias("block")))
    return merged.select("rep", short.alias("short"))


def _exact(short: DataFrame, units: DataFrame, cells: _Cells, k: int) -> DataFrame:
    """(rep, others, less): exact cosines of the short lists, negated, from the vectors themselves, per list the k best.

    A query goes once to each list that its short list has entries of, not once to each entry.
    """

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["wanted"].notna().to_numpy()
        asking, kept = pdf[asks], pdf[~asks].sort_values("rep")
        if not len(asking) or not len(kept):
            return pd.DataFrame({"rep": [], "others": [], "less": []})
        mat, other_mat, others = G.matrix(asking["unit"]), G.matrix(kept["unit"]), kept["rep"].to_numpy()
        near, less = [], []
        for own, wanted in zip(mat, asking["wanted"], strict=True):
            at = np.sort(np.searchsorted(others, np.asarray(wanted)))
            cosine = np.round(other_mat[at] @ own, G.DECIMALS) + 0.0
            best = np.argsort(-cosine, kind="stable")[:k]
            near.append(others[at[best]])
            less.append(-cosine[best])
        return pd.DataFrame({"rep": asking["rep"].to_numpy(), "others": near, "less": less})

    spots = F.array_distinct(F.transform("short", lambda n: F.struct(n["list"].alias("list"), n["block"].alias("block"))))
    each = short.join(units, "rep").select("rep", "unit", "short", F.explode(spots).alias("_spot"))
    here = F.filter("short", lambda n: (n["list"] == F.col("_spot.list")) & (n["block"] == F.col("_spot.block")))
    wanted = F.transform(here, lambda n: n["others"])
    asked = each.select(F.col("_spot.list").alias("list"), F.col("_spot.block").alias("block"), "rep", "unit", wanted.alias("wanted"))
    asked = asked.join(cells.plan, "list").select("list", _slot("parts").alias("part"), "block", "rep", "unit", "wanted")
    kept = cells.members("rep").join(units, "rep").select("list", "part", "block", "rep", "unit", F.lit(None).cast("array<long>").alias("wanted"))
    return asked.unionByName(kept).groupBy("list", "part", "block").applyInPandas(kernel, "rep long, others array<long>, less array<double>")


@dataclass(frozen=True)
class Settings:
    """lists: centroids (default: one per about 500 vectors, at most 1,024); probes: lists a query looks into;
    shortlist: exact comparisons per query, as a multiple of the neighbours wanted."""

    lists: int | None = None
    probes: int = 16
    shortlist: int = 8


def nearest_indexed(reps: DataFrame, k: int, settings: Settings) -> DataFrame:
    """(rep, others, less): of the short list of each vector, the most similar, k of each list; minus the exact cosines."""
    units = stage(with_unit_vector(reps, "embedding", "unit").select("rep", "unit"), "units")
    index = train(units, settings.lists or min(G.MAX_GROUPS, -(-units.count() // 500)))
    if index is None:
        return units.select("rep", F.array("rep").alias("others"), F.array(F.lit(-1.0)).alias("less"))
    coded = stage(build(units, index), "codes")
    cells = _cells(units, coded, index, settings.probes)
    short = stage(_short_lists(cells, index, settings.shortlist * k), "short")
    return _exact(short, units, cells, k)
