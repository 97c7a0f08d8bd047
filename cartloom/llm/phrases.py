"""Phrase collocations per language: suffix pointers sorted by multikey three-way quicksort.

A text is cut into pieces at `.,;:!?` and line breaks, a piece into words at spaces and tabs. Every word starts a
suffix: itself and up to four more words of its piece. A phrase's count is the number of suffixes that start with it.

1. Routing by leading words. Tasks count hashes of the leading two words of all suffixes in a fixed table of slots, then, where
   these are frequent, those of three to five words in another. A slot whose total lies below the wanted count holds
   no frequent phrase, so suffixes end before it and nothing of them is shuffled. A table has one bit per slot,
   2 MB whatever the data. Nothing else is dropped: with much more data than slots the tables pass more,
   more suffixes are shuffled, and the result stays the same.
2. The suffixes, counted in each task first, are dealt to tasks by ranges of (language, words). A very
   frequent word or word pair is spread over as many tasks as its followers need.
3. Each task sorts pointers to its suffixes by multikey three-way quicksort: split by the word at the current depth into
   smaller, equal and larger; the equal part's weight is the count of a phrase and goes one word deeper, down to five.
   A part whose weight is below the wanted count is abandoned. Only phrases at the two ends of a task's range may
   go on in the neighbouring ranges: their part counts are kept at any size and added up.
4. Scores, the lowest cut and the phrases covered by longer ones come from joins on the frequent phrases.

Cases: null and empty texts have no words; a null language is `und`. Texts of any length are read whole, in parts that
end between pieces. Repeated rows count as often as they are there. Only `text` and `lang` are read. Ties are broken by
the phrase's bytes. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm import wordhash
from cartloom.llm.batches import small_batches
from cartloom.session import stage

#: Longest phrase in words.
DEPTH = 5


@dataclass(frozen=True)
class Settings:
    """least: occurrences a phrase needs; top: phrases per language.

    slot_bits: 2^slot_bits slots in each table of leading words; task_rows: suffixes that one task sorts.
    """

    least: int = 100
    top: int = 2000
    slot_bits: int = 24
    task_rows: int = 150_000


BLANK, BREAK = np.frombuffer(b"\x20\x09", np.uint8), np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8)
# Bytes of a batch that are looked at together.
PART = 1 << 18
# Bytes of suffixes that a task counts before it hands them on, and rows it hands on at once.
HELD, ROWS = 24 << 20, 8192
# Slots that travel together.
CHUNK = 1 << 15


def _folded() -> np.ndarray:
    """What a byte folds to, plus one; 0 between words."""
    table = np.arange(1, 257, dtype=np.uint16)
    table[ord("A") : ord("Z") + 1] += 32
    table[BLANK] = 0
    table[BREAK] = 0
    return table


FOLDED, IS_BREAK = _folded(), np.isin(np.arange(256), BREAK)


@dataclass(frozen=True)
class Words:
    """The words of some texts in order: text number, hash, whether the next word is in the same piece, and their bytes.

    `joined` holds all words with one space after each; word i is joined[places[i] : places[i + 1] - 1].
    """

    text: np.ndarray
    hash: np.ndarray
    goes_on: np.ndarray
    joined: np.ndarray
    places: np.ndarray


def _parts(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about PART bytes that end with a piece."""
    at, total = 0, len(data)
    while at < total:
        end = min(at + PART, total)
        while end < total:
            window = np.flatnonzero(IS_BREAK[data[end : end + PART]])
            new = np.searchsorted(starts, end)
            stop = min(end + int(window[0]) + 1 if len(window) else total + 1, int(starts[new]))
            if stop <= end + PART:
                end = stop
                break
            end = min(end + PART, total)
        yield at, end
        at = end


def read_words(column: pa.Array) -> Iterator[Words]:
    data, starts = wordhash.text_bytes(column)
    for at, end in _parts(data, starts):
        raw = data[at:end]
        edges = starts[np.searchsorted(starts, at, "left") : np.searchsorted(starts, end, "left")] - at
        (hashes,), _ = wordhash.word_hashes(raw, np.unique(edges), FOLDED)
        folded = FOLDED[raw]
        inside = folded > 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[edges] = inside[edges]
        first = np.flatnonzero(begins)
        if not len(first):
            continue
        text = np.searchsorted(starts, first + at, "right") - 1
        piece = np.cumsum(IS_BREAK[raw])[first]
        goes_on = np.zeros(len(first), dtype=bool)
        goes_on[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        # A word's bytes, without what separates it from the next one.
        before = np.concatenate([[0], np.cumsum(inside)])
        lengths = np.diff(np.append(before[first], before[-1]))
        places = np.concatenate([[0], np.cumsum(lengths + 1)])
        joined = np.full(places[-1], 0x20, dtype=np.uint8)
        own = np.ones(places[-1], dtype=bool)
        own[places[1:] - 1] = False
        joined[own] = (folded[inside] - 1).astype(np.uint8)
        yield Words(text, hashes, goes_on, joined, places)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, Words]]:
    """Words with their languages: the languages' names, the language number of every word, the words."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            coded = whole.column(0).slice(at, 256).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            for words in read_words(whole.column(1).slice(at, 256)):
                yield coded.dictionary, codes[words.text], words


def _leading(
    names: pa.Array, language: np.ndarray, words: Words, slot_bits: int, pairs: np.ndarray | None = None, deeper: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For two to five leading words: which suffixes have them and may be frequent by the tables given, and their slots."""
    salts = [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names.to_pylist()]
    acc = wordhash.mix(words.hash ^ np.array(salts, dtype=np.uint64)[language])
    usable, linked = np.ones(len(acc), dtype=bool), words.goes_on
    for more in range(1, DEPTH):
        acc = wordhash.mix(acc[:-1] * np.uint64(0xA0761D6478BD642F) + words.hash[more:])
        slots = (acc >> np.uint64(64 - slot_bits)).astype(np.int64)
        usable = usable[:-1] & linked[more - 1 : len(linked) - 1]
        table = pairs if more == 1 else deeper
        if table is not None:
            usable = usable & _is_set(table, slots)
        if more == 1:
            linked = np.append(usable, False)
        yield usable, slots
        if not len(slots):
            return


def _is_set(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _count_slots(settings: Settings, pairs: np.ndarray | None):
    """Per task the counts of all slots, held to the wanted count, in chunks: of pairs, or of more words where pairs are frequent."""
    kind = np.min_scalar_type(settings.least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << settings.slot_bits, dtype=np.uint32)
        for found in _texts(batches):
            for number, (usable, slots) in enumerate(_leading(*found, settings.slot_bits, pairs)):
                if (number == 0) == (pairs is None):
                    np.add.at(counts, slots[usable], 1)
                if pairs is None:
                    break
        for chunk in range(0, len(counts), CHUNK):
            part = counts[chunk : chunk + CHUNK]
            if part.any():
                part = np.minimum(part, settings.least).astype(kind)
                yield pa.RecordBatch.from_arrays([pa.array([chunk // CHUNK], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["chunk", "counts"])

    return run


def _sum_slots(settings: Settings):
    """Chunks of all tasks to one bit per slot, set where the total reaches the wanted count."""
    kind = np.min_scalar_type(settings.least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(counts.as_buffer(), dtype=kind).astype(np.uint32)
                totals[chunk] = np.minimum(totals[chunk] + part, settings.least) if chunk in totals else part
        for chunk, total in totals.items():
            bits = np.packbits(total >= settings.least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([bits], pa.binary())], names=["chunk", "bits"])

    return run


def _table(texts: DataFrame, settings: Settings, pairs: np.ndarray | None = None) -> np.ndarray:
    """One bit per slot of leading words. Comes to the driver: 2 MB at 24 slot bits."""
    counted = texts.mapInArrow(_count_slots(settings, pairs), "chunk int, counts binary")
    summed = counted.repartition("chunk").mapInArrow(_sum_slots(settings), "chunk int, bits binary")
    table = np.zeros((1 << settings.slot_bits) // 8, dtype=np.uint8)
    for row in summed.collect():
        at = row["chunk"] * CHUNK // 8
        table[at : at + len(row["bits"])] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return table


_SUFFIXES = pa.schema([("lang", pa.string()), ("suffix", pa.string()), ("n", pa.int64())])


def _counted(parts: list[pa.Table]) -> pa.Table:
    """Equal suffixes together."""
    total = pa.concat_tables(parts).group_by(["lang", "suffix"], use_threads=False).aggregate([("n", "sum")])
    return total.rename_columns(["lang", "suffix", "n"]).combine_chunks()


def _strings(words: Words, more: np.ndarray) -> pa.Array:
    """Every word with so many more words as a string, one space between."""
    low = words.places[:-1]
    lengths = words.places[np.arange(len(low)) + more + 1] - 1 - low
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    index = np.repeat(low - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(low), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(words.joined[index]))


def _suffixes(settings: Settings, pairs: np.ndarray, deeper: np.ndarray):
    """(lang, text) to the suffixes with their counts within the task; the empty suffix counts the language's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        base = size = 0
        totals: dict[str, int] = {}
        for names, language, words in _texts(batches):
            for name, n in zip(names.to_pylist(), np.bincount(language, minlength=len(names)).tolist(), strict=True):
                totals[name] = totals.get(name, 0) + n
            more = np.zeros(len(language), dtype=np.int64)
            for usable, _ in _leading(names, language, words, settings.slot_bits, pairs, deeper):
                more[: len(usable)] += usable
            ones = pa.array(np.ones(len(language), dtype=np.int64))
            held.append(_counted([pa.table({"lang": names.take(pa.array(language)), "suffix": _strings(words, more), "n": ones})]))
            size += held[-1].nbytes
            if size > base + HELD // 2:
                held = [_counted(held)]
                base = size = held[0].nbytes
                if base > HELD:
                    yield from held[0].cast(_SUFFIXES).to_batches(ROWS)
                    held, base, size = [], 0, 0
        if held:
            yield from _counted(held).cast(_SUFFIXES).to_batches(ROWS)
        words_of = [(name, n) for name, n in totals.items() if n]
        if words_of:
            columns = [pa.array([name for name, _ in words_of]), pa.array([""] * len(words_of)), pa.array([n for _, n in words_of], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=_SUFFIXES)

    return run


def three_way(keys: np.ndarray, weights: np.ndarray, least: int, ends: tuple[int, ...] = ()) -> list[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to the rows of `keys`; -1 ends a row.

    Returns (row, depth, weight) for every prefix with a weight of `least`: a row that starts with it, its length,
    and the weight of all rows that do. Prefixes of the rows `ends` are returned at any weight.
    """
    found: list[tuple[int, int, int]] = []
    edge = np.zeros(len(keys), dtype=bool)
    edge[list(ends)] = True
    parts = [(np.arange(len(keys)), 0)]
    while parts:
        pointers, depth = parts.pop()
        at = keys[pointers, depth]
        pivot = np.median(at[[0, len(at) // 2, len(at) - 1]])
        equal = pointers[at == pivot]
        for side in (pointers[at < pivot], pointers[at > pivot]):
            if len(side) and (int(weights[side].sum()) >= least or edge[side].any()):
                parts.append((side, depth))
        if pivot < 0:
            continue
        weight = int(weights[equal].sum())
        if weight >= least or edge[equal].any():
            found.append((int(equal[0]), depth + 1, weight))
            if depth + 1 < keys.shape[1]:
                parts.append((equal, depth + 1))
    return found


def _first_row(ranks: np.ndarray) -> int:
    """The row that comes first, column by column."""
    rows = np.arange(len(ranks))
    for column in range(ranks.shape[1]):
        at = ranks[rows, column]
        rows = rows[at == at.min()]
    return int(rows[0])


def _ranks(strings: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Every string's rank among the different ones in byte order, and those in order."""
    coded = strings.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy(zero_copy_only=False)], coded.dictionary.take(pa.array(order)).to_pylist()


def _sort_range(settings: Settings):
    """Counts of the phrases in one range of suffixes: lang, phrase, words, f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        languages, names = _ranks(rows.column("lang").combine_chunks())
        lists = pc.split_pattern(rows.column("suffix").combine_chunks(), " ")
        offsets = lists.offsets.to_numpy()
        flat, words = _ranks(lists.values.slice(offsets[0], offsets[-1] - offsets[0]))
        lengths = np.diff(offsets)
        keys = np.full((len(lengths), 1 + DEPTH), -1, dtype=np.int64)
        keys[:, 0] = languages
        row = np.repeat(np.arange(len(lengths)), lengths)
        keys[row, 1 + np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat
        ends = (_first_row(keys), _first_row(-keys))
        out = [(p, depth - 1, n) for p, depth, n in three_way(keys, rows.column("n").to_numpy(), settings.least, ends) if depth > 1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[keys[p, 0]] for p, _, _ in out], pa.string()),
                pa.array([" ".join(words[w] for w in keys[p, 1 : 1 + d]) for p, d, _ in out], pa.string()),
                pa.array([d for _, d, _ in out], pa.int32()),
                pa.array([n for _, _, n in out], pa.int64()),
            ],
            names=["lang", "phrase", "words", "f"],
        )

    return run


def frequent(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to five words with their counts f (lang, phrase, words, f), and words per language (lang, n)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with small_batches(docs.sparkSession):
        pairs = _table(texts, settings)
        deeper = _table(texts, settings, pairs)
        written = stage(texts.mapInArrow(_suffixes(settings, pairs, deeper), "lang string, suffix string, n bigint"), "phrases-suffixes")
        totals = written.filter("suffix = ''").groupBy("lang").agg(F.sum("n").alias("n"))
        suffixes = written.filter("suffix <> ''")
        tasks = max(1, math.ceil(suffixes.count() / settings.task_rows), _shuffles(docs.sparkSession))
        # By words and not by the string: control characters inside words sort before the space.
        ranged = suffixes.repartitionByRange(tasks, F.col("lang"), F.split("suffix", " "))
        parts = ranged.mapInArrow(_sort_range(settings), "lang string, phrase string, words int, f bigint")
        whole = parts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
        return stage(whole.filter(F.col("f") >= settings.least), "phrases-frequent"), totals


def _shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    a, l and r count the phrase and the two parts of its lowest-scoring cut, n the language's words.
    """
    phrases, totals = frequent(docs, settings)
    several = phrases.filter("words >= 2")
    cuts = several.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substr(phrase, length(substring_index(phrase, ' ', k)) + 2)").alias("right"),
    )
    lefts = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = "cast({} as decimal(18,0))".format
    score = F.expr(f"({whole('a')} * {whole('n')} * 1000) div ({whole('l')} * {whole('r')})")
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(totals, "lang").withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))"
    )
    covered = several.filter("words >= 3").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    kept = lowest.join(covered, ["lang", "phrase"], "left").filter("cover IS NULL OR cover < a")
    flat = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
