"""Language by nearest centroid over TF-IDF n-gram vectors.

A text's vector counts hashed n-grams of one to three bytes (A-Z lowered, everything but letters folded
to one space), damped by a logarithm, weighed by inverse document frequency and brought to length one.
Per language several centroids come from spherical k-means; a text gets the language of the
nearest one by cosine. A text further from that centroid than nearly all of the centroid's own
training texts is rejected: `language` then says `und`, `nearest` still names the language.

The model is fitted on at most Settings.rows labelled texts, shared out evenly among the languages, of
which only the hashed counts go to the driver. Prediction reads whole texts and nothing but the text.

Cases: a null text, or one without a letter, is `und` with score 0. Without a labelled text everything
is `und`. Repeated rows are predicted one by one; ties go to the first language by code point. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm import wordhash
from cartloom.llm.batches import in_one_task

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """rows: labelled texts for the fit, at most; width: hashed n-grams; centroids: per language; reject: share of training texts that are not."""

    rows: int = 4000
    width: int = 4096
    centroids: int = 4
    rounds: int = 12
    reject: float = 0.995


def _letters() -> np.ndarray:
    """Bytes as they are counted: lower-case letters and bytes beyond ASCII stay, all others become a space."""
    table = np.full(256, 32, dtype=np.uint32)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    table[128:] = np.arange(128, 256)
    return table


def counts(column: pa.Array, width: int) -> np.ndarray:
    """Hashed n-gram counts of every text, one row each."""
    data, starts = wordhash.text_bytes(column)
    table, out = _letters(), np.zeros((len(column), width), dtype=np.float32)
    for at in range(0, len(data), wordhash.PIECE):
        # Two bytes more than the piece, for n-grams that reach beyond its end.
        piece = table[data[at : at + wordhash.PIECE + 2]]
        size = min(wordhash.PIECE, len(data) - at)
        first, last = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + size, "left")
        code = np.zeros(len(piece), dtype=np.uint32)
        for n in range(3):
            code[: len(piece) - n] = (code[: len(piece) - n] << np.uint32(8)) | piece[n:] if n else piece
            slot = ((code * np.uint32(2654435761)) ^ np.uint32(0x5BD1E995 * (n + 1) & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            slot >>= np.uint32(32 - (width - 1).bit_length())
            for text in range(first, last):
                low = max(int(starts[text]) - at, 0)
                high = min(int(starts[text + 1]) - n - at, size)
                if high > low:
                    out[text] += np.bincount(slot[low:high], minlength=width)
    return out


def vectors(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighed = np.log1p(raw) * idf
    return weighed / np.maximum(np.sqrt((weighed * weighed).sum(axis=1, keepdims=True)), 1e-9)


@dataclass(frozen=True)
class Model:
    """languages, one per centroid; `least` is the cosine below which the centroid rejects."""

    languages: tuple[str, ...]
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray
    width: int


def _clusters(points: np.ndarray, settings: Settings, seed: int) -> np.ndarray:
    """Spherical k-means; empty clusters are dropped."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(settings.centroids, len(points)), replace=False)]
    for _ in range(settings.rounds):
        own = (points @ centres.T).argmax(axis=1)
        sums = np.stack([points[own == k].sum(axis=0) for k in np.unique(own)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


def _counted(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = counts(batch.column(1), width)
                sparse = [np.flatnonzero(r) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([s.tolist() for s in sparse], pa.list_(pa.int32())), pa.array([r[s].tolist() for r, s in zip(rows, sparse, strict=True)], pa.list_(pa.float32()))],
                    names=["lang", "slots", "counts"],
                )

    return run


def _sample(labelled: DataFrame, settings: Settings) -> DataFrame:
    """At most Settings.rows different texts (lang, text): the first ones by hash in each language, as many of each as possible.

    Chosen by hashes alone, a text that is there often counting once; only the texts chosen leave their tasks.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("draw")
    )
    each = Window.partitionBy("lang").orderBy("draw")
    ranked = rows.select("lang", "draw").distinct().withColumn("n", F.row_number().over(each)).filter(F.col("n") <= settings.rows)
    chosen = ranked.orderBy("n", "draw", "lang").limit(settings.rows)
    # At most Settings.rows hashes, hence the hint. One text stays of each, put together in the tasks first.
    texts = rows.join(F.broadcast(chosen.drop("n")), ["lang", "draw"]).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    return texts.select("lang", "text", "draw")


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model | None:
    """A model from rows (text, lang), fitted in one task on a sample of at most Settings.rows texts."""
    kinds = "lang string, slots array<int>, counts array<float>"
    counted = _sample(labelled, settings).repartition(16).mapInArrow(_counted(settings.width), kinds)
    return in_one_task(counted.orderBy("lang", F.xxhash64("slots", "counts"), "slots").limit(settings.rows), lambda sample: _fitted(sample, settings))


def _fitted(sample: pa.Table, settings: Settings) -> Model:
    raw = np.zeros((sample.num_rows, settings.width), dtype=np.float32)
    for i, (slots, found) in enumerate(zip(sample.column("slots"), sample.column("counts"), strict=True)):
        raw[i, slots.values.to_numpy()] = found.values.to_numpy()
    idf = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 0.1).astype(np.float32)
    points = vectors(raw, idf).astype(np.float32)
    del raw
    labels = np.array(sample.column("lang").to_pylist())
    names: list[str] = []
    centres: list[np.ndarray] = []
    for number, name in enumerate(sorted(set(labels.tolist()))):
        found = _clusters(points[labels == name], settings, number)
        centres.append(found)
        names += [name] * len(found)
    centroids = np.concatenate(centres).astype(np.float32)
    cosine = points @ centroids.T
    own = cosine.argmax(axis=1)
    least = np.array([
        np.quantile(cosine[own == k, k], 1 - settings.reject) if (own == k).any() else 0.0 for k in range(len(names))
    ])
    return Model(tuple(names), centroids, idf, least.astype(np.float32), settings.width)


def _predicted(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = batch.num_rows
                spoken = pc.fill_null(pc.match_substring_regex(batch.column(1), r"\pL"), False).to_numpy(zero_copy_only=False)
                nearest, score = np.full(rows, UNKNOWN, dtype=object), np.zeros(rows)
                sure = np.zeros(rows, dtype=bool)
                if model and spoken.any():
                    cosine = vectors(counts(batch.column(1), model.width), model.idf) @ model.centroids.T
                    best = cosine.argmax(axis=1)
                    value = cosine[np.arange(rows), best]
                    nearest = np.where(spoken, np.array(model.languages, dtype=object)[best], UNKNOWN)
                    score = np.where(spoken, np.clip(value, 0, 1), 0.0)
                    sure = spoken & (value >= model.least[best])
                language = np.where(sure, nearest, UNKNOWN)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(nearest, pa.string()), pa.array(score, pa.float64()), pa.array(language, pa.string())],
                    names=["doc_id", "nearest", "score", "language"],
                )

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row: doc_id, nearest (language of the nearest centroid), score (its cosine), language (`und` where rejected)."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_predicted(model), "doc_id bigint, nearest string, score double, language string")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo `folds`; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def report(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, language. Fold 2 of 4 is held out of the fit."""
    model = fit(docs.filter(fold(F.col("doc_id"), 4) != 2).select("text", "lang"), settings)
    return predict(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("nearest").alias("lang_pred"), "score", "language"
    )
