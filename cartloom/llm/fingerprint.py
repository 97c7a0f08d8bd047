"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Each five-word shingle is hashed once. The top bits of the hash choose one of BINS bins, the smallest
hash of a bin stands for it. A bin without a shingle takes the value of another one, found by trying
bins in an order of its own that is the same for every document. Of each value the low BITS bits are
kept, as two hex digits per bin. Two fingerprints agree in a bin by chance with probability 2^-BITS;
`likeness` corrects for that.

Everything is a column expression; only `next_in_order` shuffles.

Cases: a null text is empty. A text with fewer than five words is one shingle. A text without a word
has the empty fingerprint, which is like another empty one (1) and like nothing else (0). A-Z are
lowered. Repeated rows give equal rows. Null and repeated ids: see `next_in_order`.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.session import stage

BINS, BITS, WORDS = 256, 8, 5
_BIN_BITS = BINS.bit_length() - 1
#: So many bins are tried for an empty one before the fallback, which ranks all filled bins of the document.
TRIES = 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FINGERPRINT_TYPE = "array<tinyint>"


def word_list(text: Column) -> Column:
    """The words of a text: runs of anything but space and tab to carriage return, A-Z lowered."""
    words = F.split(F.translate(text, _UPPER, _LOWER), r"[\x20\x09-\x0D]+")
    return F.filter(words, lambda w: w != "")


def shingle_hashes(hashes: Column) -> Column:
    """One 64-bit hash per shingle of five words from the hashes of the words; of a shorter text one, of an empty one none."""
    count = F.size(hashes)
    shingles = F.transform(
        F.sequence(F.lit(0), count - WORDS), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WORDS)])
    )
    return (
        F.when(count >= WORDS, shingles)
        .when(count > 0, F.array(F.xxhash64(hashes, count)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def _bin(value: Column) -> Column:
    return F.shiftright(value, 64 - _BIN_BITS) + BINS // 2


def bin_minima(ordered: Column) -> Column:
    """From sorted hashes the smallest of every bin that has one, by bin."""
    return F.filter(
        ordered, lambda v, i: (i == 0) | (F.shiftright(v, 64 - _BIN_BITS) != F.shiftright(F.get(ordered, i - 1), 64 - _BIN_BITS))
    )


def _spread(minima: Column) -> Column:
    """One element per bin, null where the bin is empty."""
    none = F.lit(None).cast("bigint")
    placed = F.transform(
        minima,
        lambda v, i: F.concat(
            F.array_repeat(none, (_bin(v) - F.coalesce(_bin(F.get(minima, i - 1)), F.lit(-1)) - 1).cast("int")), F.array(v)
        ),
    )
    rest = F.array_repeat(none, (BINS - 1 - _bin(F.get(minima, F.size(minima) - 1))).cast("int"))
    return F.concat(F.flatten(placed), rest)


def _probe_table() -> list[list[int]]:
    """For every try the bin that each bin looks at: a fixed pseudorandom choice."""
    draw = random.Random(20_240_917)
    return [[draw.randrange(BINS) for _ in range(BINS)] for _ in range(TRIES)]


def _filled(bins: Column, minima: Column) -> Column:
    """`bins` with a value in every place. Empty places try others in their own order, and last rank the filled ones."""
    tables = [F.array(*[F.lit(b) for b in row]) for row in _probe_table()]

    def fill(value: Column, place: Column) -> Column:
        tries = [F.get(bins, F.get(table, place)) for table in tables]
        ranked = F.array_min(F.transform(minima, lambda v: F.struct(F.xxhash64(place, _bin(v)).alias("rank"), v.alias("v"))))["v"]
        return F.coalesce(value, *tries, ranked)

    return F.transform(bins, fill)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """`df` with `out`: the low bits of every bin as an array of BINS bytes, empty for a text without a word."""
    words, shingles, minima, bins = (F.col(f"__fp_{k}") for k in ("words", "shingles", "minima", "bins"))
    # A column of its own for whatever a later step looks up element by element: it is computed once a row.
    step = df.withColumn("__fp_words", F.transform(word_list(F.coalesce(F.col(text), F.lit(""))), lambda w: F.xxhash64(w)))
    step = step.withColumn("__fp_shingles", F.sort_array(shingle_hashes(words))).drop("__fp_words")
    step = step.withColumn("__fp_minima", bin_minima(shingles)).drop("__fp_shingles")
    step = step.withColumn("__fp_bins", _spread(minima))
    low = F.transform(_filled(bins, minima), lambda v: (v.bitwiseAND((1 << BITS) - 1) - (1 << (BITS - 1))).cast("tinyint"))
    empty = F.array().cast(FINGERPRINT_TYPE)
    return step.withColumn(out, F.when(F.size(minima) > 0, low).otherwise(empty)).drop("__fp_minima", "__fp_bins")


def packed(fingerprint: Column) -> Column:
    """The fingerprint as hex digits."""
    digits = F.array(*[F.lit(f"{i:02x}") for i in range(1 << BITS)])
    return F.array_join(F.transform(fingerprint, lambda v: F.get(digits, v.cast("int") + (1 << (BITS - 1)))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / BINS
    by_chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (same - by_chance) / (1 - by_chance))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(corrected)
    )


_NO_ID = -(2**63)


def _key(doc_id: Column) -> Column:
    """Null ids count as one id below all others."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(_NO_ID))


def next_in_order(docs: DataFrame) -> DataFrame:
    """For every different id: key, before (the id whose next one it is), reach (half the longest text of `before`).

    Order: descending id, null last, then again from the first. Only ids and lengths are shuffled: they
    are dealt by range, each range is a window of its own, and what crosses a border comes from one row
    per range (as many rows as there are shuffle partitions).
    """
    ids = docs.groupBy(_key(F.col("doc_id")).alias("key")).agg(F.max(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    dealt = stage(ids.repartitionByRange(F.col("key").desc()).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    borders = dealt.groupBy("part").agg(F.min_by(F.struct("key", "chars"), "key").alias("last")).orderBy("part").collect()
    ends = [(r["part"], r["last"]["key"], r["last"]["chars"]) for r in borders]
    around = [(part, *ends[i - 1][1:]) for i, (part, _, _) in enumerate(ends)]
    edge = docs.sparkSession.createDataFrame(around, "part int, edge_key bigint, edge_chars int")
    order = Window.partitionBy("part").orderBy(F.col("key").desc())
    inside = dealt.withColumns({"before": F.lag("key").over(order), "before_chars": F.lag("chars").over(order)})
    # One row per shuffle partition, hence the hint.
    joined = inside.join(F.broadcast(edge), "part")
    return joined.select(
        "key", F.coalesce("before", "edge_key").alias("before"),
        F.floor(F.coalesce("before_chars", "edge_chars") / 2).cast("int").alias("reach"),
    )


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are to each other and to the next one.

    The edited text has its last floor(n/2) code points replaced by the first as many of the next
    document. Several rows may share an id: all have the same next document, and as a next document the
    smallest of their texts stands for them. A text moves once whole and once by its first half.
    """
    texts = docs.select(_key(F.col("doc_id")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    # Both uses below need the same three columns, so that Spark deals them out once.
    printed = with_fingerprint(texts, "text", "print")
    given = (
        printed.join(next_in_order(docs).hint("shuffle_merge"), "key")
        .groupBy(F.col("before").alias("key"))
        .agg(F.min(F.struct(F.substring(F.col("text"), F.lit(1), F.col("reach")).alias("tail"), F.col("print").alias("print"))).alias("next"))
    )
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    both = printed.hint("shuffle_merge").join(given, "key").select(
        "key", chars.cast("bigint").alias("n_chars"), "print", F.col("next.print").alias("next_print"),
        F.concat(F.substring(F.col("text"), F.lit(1), chars - half), F.substring(F.col("next.tail"), F.lit(1), half)).alias("edited"),
    )
    done = with_fingerprint(both, "edited", "edited_print")
    return done.select(
        F.nullif(F.col("key"), F.lit(_NO_ID)).alias("doc_id"), "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("print")).alias("fingerprint"), packed(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
