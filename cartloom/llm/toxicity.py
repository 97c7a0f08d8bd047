"""Toxicity by a convolutional text classifier on hashed word embeddings, fitted in numpy.

A word (a run of letters, lower case) is embedded as three hashed vectors side by side: one of the whole
word, one of its first four and one of its first six bytes, so that inflected forms share a part. Filters over
one, two and three words run along the text, each keeps its largest value, and a dense layer turns those
into a logit. Thresholds are calibrated by language, which is guessed from the words themselves by naive
Bayes; the score is 0.5 just at the threshold of the guessed language.

The fit uses at most Settings.rows labelled texts, half of them toxic if there are so many, of at most
Settings.longest words each. Embeddings start from how much more often their words occur in toxic texts.
Scoring reads whole texts, in slices that overlap, and nothing but the text.

Cases: null and empty texts are scored as texts without a word. Repeated rows are scored one by one. Labels
that are null don't count; of several labels for an id the largest counts. Without both labels in the
fit every score is 0. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm import wordhash
from cartloom.llm.batches import in_one_task
from cartloom.llm.language import fold


@dataclass(frozen=True)
class Settings:
    """rows, longest: bounds of the fit; slots: rows per embedding table; size: of one of the three vectors; filters: per width."""

    rows: int = 4000
    longest: int = 5000
    slots: int = 1 << 16
    size: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 16
    epochs: int = 3
    rate: float = 0.05
    languages: int = 16
    prefixes: tuple[int, ...] = (4, 6)
    seed: int = 5

    @property
    def views(self) -> int:
        return 1 + len(self.prefixes)


#: Empty places after every text, so that no filter reaches into the next one.
PAD = 3
SLICE = 1 << 15


def tokens(column: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Embedding slots (views x words) of all texts, one after another, and each text's first word. Slot 0 is empty."""
    data, starts = wordhash.text_bytes(column)
    views, firsts = wordhash.word_hashes(data, starts, wordhash.letter_words(), settings.prefixes)
    slots = np.stack([(v % np.uint64(settings.slots - 1)).astype(np.int32) + 1 for v in views])
    return slots, firsts


@dataclass
class Model:
    """embedding: views x slots x size; kernels: per width (width, views * size, filters); profile: slots x languages."""

    embedding: np.ndarray
    kernels: list[np.ndarray]
    bias: list[np.ndarray]
    dense: np.ndarray
    offset: float
    profile: np.ndarray
    threshold: np.ndarray
    slope: float

    def vectors(self, slots: np.ndarray) -> np.ndarray:
        return np.concatenate([table[own] for table, own in zip(self.embedding, slots, strict=True)], axis=1)

    def activations(self, points: np.ndarray, kernel: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """A filter bank at every place; what lies beyond the end counts as zero."""
        out = points @ kernel[0] + bias
        for k in range(1, len(kernel)):
            out[:-k] += points[k:] @ kernel[k]
        return out

    def pooled(self, slots: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Largest value of each filter between begins and ends (padded texts), one row per text."""
        points = self.vectors(slots)
        edges = np.stack([begins, ends], axis=1).ravel()
        return np.concatenate(
            [np.maximum.reduceat(self.activations(points, k, b), edges, axis=0)[::2] for k, b in zip(self.kernels, self.bias, strict=True)],
            axis=1,
        )

    def logits(self, slots: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Logits of texts with words at firsts[i]..firsts[i+1]."""
        texts = len(firsts) - 1
        best = np.full((texts, len(self.dense)), -np.inf, dtype=np.float32)
        at = 0
        while at < texts:
            until = max(at + 1, int(np.searchsorted(firsts, firsts[at] + SLICE, "right")) - 1)
            until = min(until, texts)
            # Several texts that fit one slice, or one long text in slices that overlap by the widest filter.
            for low in range(int(firsts[at]), max(int(firsts[until]), int(firsts[at]) + 1), SLICE):
                high = min(low + SLICE + PAD, int(firsts[until])) if until == at + 1 else int(firsts[until])
                inner = np.array([low, high]) if until == at + 1 else firsts[at : until + 1]
                sizes = np.diff(inner)
                shift = np.arange(len(sizes)) * PAD
                padded = np.zeros((len(slots), int(sizes.sum()) + PAD * len(sizes)), dtype=np.int32)
                where = np.arange(int(sizes.sum())) + np.repeat(shift, sizes)
                padded[:, where] = slots[:, inner[0] : inner[-1]]
                begins = inner[:-1] - inner[0] + shift
                # What a slice holds beyond SLICE is only there for the filters to look at.
                found = self.pooled(padded, begins, begins + np.maximum(sizes if until > at + 1 else np.minimum(sizes, SLICE), 1))
                best[at:until] = np.maximum(best[at:until], found)
                if until > at + 1:
                    break
            at = until
        return np.maximum(best, 0) @ self.dense + self.offset

    def guess(self, slots: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The likeliest language of each text by its words' second view."""
        sums = np.zeros((len(slots[0]) + 1, self.profile.shape[1]), dtype=np.float64)
        np.cumsum(self.profile[slots[min(1, len(slots) - 1)]], axis=0, out=sums[1:])
        return (sums[firsts[1:]] - sums[firsts[:-1]]).argmax(axis=1)

    def scores(self, slots: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        above = self.logits(slots, firsts) - self.threshold[self.guess(slots, firsts)]
        return 1 / (1 + np.exp(-np.clip(self.slope * above, -30, 30)))


def _log_odds(slots: np.ndarray, texts: np.ndarray, toxic: np.ndarray, size: int) -> np.ndarray:
    """Per slot, how much likelier it is to occur in a toxic text; drawn to 0 where there is little to go by."""
    pairs = np.unique(slots.astype(np.int64) * (len(toxic) + 1) + texts)
    slot, text = pairs // (len(toxic) + 1), pairs % (len(toxic) + 1)
    hits = np.bincount(slot, weights=toxic[text], minlength=size)
    all_ = np.bincount(slot, minlength=size)
    share = toxic.mean()
    few = 6.0
    return np.log((hits + few * share) / share) - np.log((all_ - hits + few * (1 - share)) / (1 - share))


def _profile(slots: np.ndarray, texts: np.ndarray, language: np.ndarray, kinds: int, size: int) -> np.ndarray:
    joint = np.bincount(slots.astype(np.int64) * kinds + language[texts], minlength=size * kinds).reshape(size, kinds) + 0.1
    return np.log(joint / joint.sum(axis=0)).astype(np.float32)


def _train(samples: list[np.ndarray], toxic: np.ndarray, language: np.ndarray, kinds: int, share: float, settings: Settings) -> Model:
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(samples))
    apart = set(order[: len(samples) // 4].tolist())
    used = [i for i in range(len(samples)) if i not in apart]
    slots = np.concatenate([samples[i] for i in used], axis=1)
    texts = np.repeat(np.arange(len(used)), [samples[i].shape[1] for i in used])
    width, views = settings.size * settings.views, settings.views
    embedding = rng.normal(0, 0.05, (views, settings.slots, settings.size)).astype(np.float32)
    for v in range(views):
        embedding[v, :, 0] = _log_odds(slots[v], texts, toxic[used], settings.slots)
    embedding[:, 0] = 0
    kernels = [rng.normal(0, 0.1, (w, width, settings.filters)).astype(np.float32) for w in settings.widths]
    for kernel in kernels:
        # To begin with, one filter reads what all views say together, and one more each view alone.
        kernel[0, :: settings.size, 0] += 1.0 / views
        for v in range(views):
            kernel[0, v * settings.size, 1 + v] += 1.0
    model = Model(
        embedding, kernels, [np.zeros(settings.filters, dtype=np.float32) for _ in kernels],
        rng.normal(0, 0.1, settings.filters * len(kernels)).astype(np.float32), -1.0,
        _profile(slots[min(1, views - 1)], texts, language[used], kinds, settings.slots), np.zeros(kinds), 1.0,
    )
    model.dense.reshape(len(kernels), -1)[:, : 1 + views] += 0.3
    for epoch in range(settings.epochs):
        rate = settings.rate / (1 + epoch)
        for i in rng.permutation(used).tolist():
            _step(model, samples[i], toxic[i], rate, settings)
    _calibrate(model, [samples[i] for i in sorted(apart)], toxic[sorted(apart)], kinds, share)
    return model


def _step(model: Model, own: np.ndarray, label: float, rate: float, settings: Settings) -> None:
    """One gradient step; each filter passes it on to the words at its largest value only."""
    count = own.shape[1]
    padded = np.concatenate([own, np.zeros((len(own), PAD), dtype=np.int32)], axis=1)
    points = model.vectors(padded)
    places, peaks = [], []
    for kernel, bias in zip(model.kernels, model.bias, strict=True):
        values = model.activations(points, kernel, bias)[: max(count, 1)]
        places.append(values.argmax(axis=0))
        peaks.append(values.max(axis=0))
    hidden = np.maximum(np.concatenate(peaks), 0)
    logit = float(hidden @ model.dense + model.offset)
    error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label
    if abs(error) < 1e-3:
        return
    back = np.clip(error * model.dense * (hidden > 0), -1, 1)
    model.dense -= rate * error * hidden / (1 + np.linalg.norm(hidden))
    model.offset -= rate * error
    for n, (kernel, bias) in enumerate(zip(model.kernels, model.bias, strict=True)):
        down = back[n * settings.filters : (n + 1) * settings.filters]
        if not down.any():
            continue
        bias -= rate * 0.1 * down
        for k in range(len(kernel)):
            at = places[n] + k
            seen = points[at]
            moved = kernel[k].T * down[:, None]
            kernel[k] -= (rate * 0.1 * down[:, None] * seen / (1 + np.linalg.norm(seen, axis=1, keepdims=True))).T
            for v in range(settings.views):
                part = slice(v * settings.size, (v + 1) * settings.size)
                filled = padded[v, at] > 0
                np.subtract.at(model.embedding[v], padded[v, at[filled]], rate * moved[filled, part])


def _cut(values: np.ndarray, toxic: np.ndarray, share: float) -> float:
    """The threshold with the fewest errors where `share` of all texts are toxic, in the middle of the gap it lies in."""
    order = np.argsort(values)
    value, label = values[order], toxic[order]
    edges = np.concatenate([[value[0] - 2], (value[1:] + value[:-1]) / 2, [value[-1] + 2]])
    missed = np.concatenate([[0], np.cumsum(label)]) / max(label.sum(), 1)
    alarms = 1 - np.concatenate([[0], np.cumsum(1 - label)]) / max((1 - label).sum(), 1)
    cost = share * missed + (1 - share) * alarms
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    gaps = np.concatenate([[0], np.diff(value), [0]])
    return float(edges[best[gaps[best].argmax()]])


def _calibrate(model: Model, samples: list[np.ndarray], toxic: np.ndarray, kinds: int, share: float) -> None:
    if not samples:
        return
    slots = np.concatenate(samples, axis=1)
    firsts = np.concatenate([[0], np.cumsum([s.shape[1] for s in samples])])
    values, guess = model.logits(slots, firsts), model.guess(slots, firsts)
    common = _cut(values, toxic, share) if 0 < toxic.sum() < len(toxic) else 0.0
    for kind in range(kinds):
        own = guess == kind
        enough = min(toxic[own].sum(), (1 - toxic[own]).sum()) >= 10
        model.threshold[kind] = _cut(values[own], toxic[own], share) if enough else common


def _tokenised(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                slots, firsts = tokens(batch.column(0), settings)
                blobs = [slots[:, firsts[i] : firsts[i + 1]].tobytes() for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), batch.column(1), batch.column(2)], names=["slots", "lang", "toxic"])

    return run


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """A model from the texts and languages of `docs` and the marks `toxic` of `labels`, by doc_id."""
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    share = marks.agg(F.avg("toxic")).first()[0] or 0.5
    drawn = marks.withColumn("draw", F.xxhash64("doc_id"))
    # The first of each kind in a pseudorandom order, and of those as many of each as possible: 2 * rows marks at most are ranked.
    first = [drawn.filter(F.col("toxic") == kind).orderBy("draw", "doc_id").limit(settings.rows) for kind in (0, 1)]
    each = Window.partitionBy("toxic").orderBy("draw", "doc_id")
    chosen = first[0].union(first[1]).withColumn("n", F.row_number().over(each)).orderBy("n", "toxic").limit(settings.rows).select("doc_id", "toxic")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    # At most Settings.rows marks, hence the hint.
    joined = texts.join(F.broadcast(chosen), "doc_id").select("text", "lang", "toxic")
    bound = settings.views * settings.longest * 4
    rows = (
        joined.mapInArrow(_tokenised(settings), "slots binary, lang string, toxic int")
        .filter(F.octet_length("slots") <= bound).orderBy(F.xxhash64("slots", "toxic"), "slots", "toxic", "lang").limit(settings.rows)
    )
    return in_one_task(rows, lambda sample: _fitted(sample, share, settings))


def _fitted(sample: pa.Table, share: float, settings: Settings) -> Model | None:
    marks = sample.column("toxic").to_pylist()
    if len(set(marks)) < 2:
        return None
    samples = [np.frombuffer(b.as_buffer(), dtype=np.int32).reshape(settings.views, -1) for b in sample.column("slots")]
    names = sample.column("lang").to_pylist()
    # Languages beyond the most frequent ones are one kind together, whose threshold is the common one if it has too few texts.
    kinds = sorted(set(names), key=lambda n: (-names.count(n), n or ""))
    own = {n: i for i, n in enumerate(kinds[: settings.languages])}
    language = np.array([own.get(n, settings.languages) for n in names])
    return _train(samples, np.array(marks, dtype=np.float64), language, int(language.max()) + 1, share, settings)


def _scored(model, settings: Settings, column: int, out: str):
    """Adds the score as a last column; `model` is a broadcast of bounded size (views * slots * size numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                score = np.zeros(batch.num_rows)
                if model.value is not None and batch.num_rows:
                    slots, firsts = tokens(batch.column(column), settings)
                    score = model.value.scores(slots, firsts)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, out])

    return run


def with_score(docs: DataFrame, model: Model | None, settings: Settings = Settings(), out: str = "score") -> DataFrame:
    """`docs` with a last column `out`, 0 to 1; `out` must be a new name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(_scored(shared, settings, docs.columns.index("text"), out), schema)


def _seen(frame: DataFrame) -> DataFrame:
    """Rows that labels may be learned from: fold 0 of 5 is held out."""
    return frame.filter(fold(F.col("doc_id"), 5) != 0)


def report(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(_seen(docs), _seen(labels), settings)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_score(slim, model, settings).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    model = fit(_seen(docs), _seen(labels), settings)
    out = "__toxic_score"
    while out in docs.columns:
        out += "_"
    return with_score(docs, model, settings, out).filter(F.col(out) < 0.5).drop(out)
