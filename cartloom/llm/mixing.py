"""Mixing sources to target weights by blocks, slots and permutations.

The words of each source, its documents in a pseudorandom order, are one long stream that is cut into
blocks of fixed length. The output is a row of shards with a fixed number of slots. Every shard draws
its number of blocks per source from a multinomial distribution, on condition that all shards together use up the
sources' targets exactly; the draws come from splitting the totals along a binary tree, so each
shard finds its own draw and its sources' first slot numbers without the others. A source's slot number is mapped through
a pseudorandom permutation of its blocks, a new one for each pass over the source. Joining the slots
to the blocks by index says how often each document's words are taken.

Cases: a null text has no words and is never taken; a null source is a source of its own, last in
order. Repeated rows are documents of their own. Only doc_id, text and source are read by `mix`; other columns pass
through `mixed_documents` untouched. An empty table gives an empty result.

One row per source goes to the driver; sources are few compared with documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.session import stage


@dataclass(frozen=True)
class Mix:
    """weights repeat over the sources in order; no source is used more than `most` times.

    block: words per block (less in a source with fewer than 2048 blocks of that length);
    slots: blocks per output shard; bucket_rows: documents of one source that one task puts in order.
    """

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    most: int = 3
    block: int = 256
    slots: int = 4096
    bucket_rows: int = 4_000
    seed: int = 11


WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """Words to take per source: shares by weight, held to `most` times the size, the rest shared again."""
    total, found = float(sum(sizes)), [0.0] * len(sizes)
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    free, rest = {i for i, n in enumerate(sizes) if n > 0}, total
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if rest * weights[i] / weight > mix.most * sizes[i]}
        if not over:
            for i in free:
                found[i] = rest * weights[i] / weight
            break
        for i in over:
            found[i] = float(mix.most * sizes[i])
        rest -= sum(found[i] for i in over)
        free -= over
    return found


@dataclass(frozen=True)
class Plan:
    """Per source: block length, number of blocks, number of slots."""

    length: np.ndarray
    blocks: np.ndarray
    slots: np.ndarray


def plan(sizes: list[int], wanted: list[float], mix: Mix) -> Plan:
    size = np.array(sizes, dtype=np.int64)
    length = np.clip(size // 2048, 1, mix.block)
    blocks = -(-size // length)
    slots = np.minimum(np.rint(np.array(wanted) / length).astype(np.int64), mix.most * (size // length))
    return Plan(length, blocks, slots)


def _draw(rng: np.random.Generator, colors: np.ndarray, taken: int) -> np.ndarray:
    """`taken` of the slots at random without putting back: how many of each source."""
    if colors.sum() < 10**9:
        return rng.multivariate_hypergeometric(colors, taken, method="marginals")
    # Beyond the library's range: normal approximation, source after source, held to what is possible.
    out, left, rest = np.zeros_like(colors), int(taken), int(colors.sum())
    for i, n in enumerate(colors.tolist()):
        rest -= n
        share = n / max(1, n + rest)
        spread = (left * share * (1 - share) * max(0.0, 1 - left / max(1, n + rest))) ** 0.5
        own = int(min(max(round(rng.normal(left * share, spread)), left - rest, 0), n, left))
        out[i], left = own, left - own
    return out


def shard_draw(shard: int, shards: int, counts: np.ndarray, mix: Mix) -> tuple[np.ndarray, np.ndarray]:
    """How many slots of each source a shard has, and how many the shards before it have."""
    low, high, inside, before = 0, shards, counts.copy(), np.zeros_like(counts)
    while high - low > 1:
        middle = (low + high) // 2
        left = _draw(np.random.default_rng([mix.seed, low, high]), inside, min((middle - low) * mix.slots, int(inside.sum())))
        if shard < middle:
            high, inside = middle, left
        else:
            low, before, inside = middle, before + left, inside - left
    return inside, before


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1: four Feistel rounds on the next even number of bits, walked until inside."""
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & low
        for turn in range(4):
            f = (right + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 4 + turn + 1) * 0xD1B54A32D192ED03 % 2**64)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & low)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _slots(shards: int, how: Plan, mix: Mix):
    """For each shard number its slots: shard, slot, rank, block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                own, before = shard_draw(shard, shards, how.slots, mix)
                order = np.random.default_rng([mix.seed, 1, shard]).permutation(int(own.sum()))
                ranks, blocks = [], []
                for rank in np.flatnonzero(own).tolist():
                    number, size = before[rank] + np.arange(own[rank]), int(how.blocks[rank])
                    passes, index = np.divmod(number, size)
                    for turn in np.unique(passes).tolist():
                        blocks.append(permuted(index[passes == turn], size, (mix.seed * 1_000_003 + rank) * 64 + turn))
                    ranks.append(np.full(len(number), rank, dtype=np.int64))
                if ranks:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(order), shard, dtype=np.int64)), pa.array(order), pa.array(np.concatenate(ranks)), pa.array(np.concatenate(blocks))],
                        names=["shard", "slot", "rank", "block"],
                    )

    return run


def _placed(docs: DataFrame, mix: Mix, keep: list[str]) -> tuple[DataFrame, Plan]:
    """Rows with their place in the source's stream: rank, source_size, target, at, size, and the columns `keep`."""
    sized = docs.withColumns({
        "__mix_size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"),
        "__mix_hash": F.xxhash64("doc_id", "text"),
    })
    stats = sized.groupBy("source").agg(F.sum("__mix_size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    # Python compares strings by code point.
    stats = sorted(stats, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in stats]
    wanted = targets(sizes, mix)
    table = [
        (r["source"], i, n, t, max(1, -(-int(r["rows"]) // mix.bucket_rows)))
        for i, (r, n, t) in enumerate(zip(stats, sizes, wanted, strict=True))
    ]
    ranks = docs.sparkSession.createDataFrame(
        table, "__mix_source string, __mix_rank bigint, __mix_total bigint, __mix_target double, __mix_buckets bigint"
    )
    ranked = sized.join(ranks, F.col("source").eqNullSafe(F.col("__mix_source"))).withColumn(
        "__mix_bucket", F.pmod("__mix_hash", "__mix_buckets")
    )
    slim = ranked.select("__mix_rank", "__mix_bucket", "__mix_size")
    totals = slim.groupBy("__mix_rank", "__mix_bucket").agg(F.sum("__mix_size").alias("n"))
    earlier = Window.partitionBy("__mix_rank").orderBy("__mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__mix_rank", "__mix_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__mix_start"))
    inside = Window.partitionBy("__mix_rank", "__mix_bucket").orderBy("__mix_hash", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    running = ranked.withColumn("__mix_inside", F.coalesce(F.sum("__mix_size").over(inside), F.lit(0)))
    placed = running.join(starts.hint("shuffle_merge"), ["__mix_rank", "__mix_bucket"]).select(
        *[F.col(f"`{c}`") for c in keep], "__mix_rank", "__mix_total", "__mix_target",
        (F.col("__mix_start") + F.col("__mix_inside")).alias("__mix_at"), "__mix_size",
    )
    return placed, plan(sizes, wanted, mix)


def slots(spark, how: Plan, mix: Mix) -> DataFrame:
    """The mix as a table: shard, slot, rank (of the source), block."""
    shards = max(1, -(-int(how.slots.sum()) // mix.slots))
    parts = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4))
    return spark.range(0, shards, 1, parts).mapInArrow(_slots(shards, how, mix), "shard bigint, slot bigint, rank bigint, block bigint")


def _times(placed: DataFrame, how: Plan, mix: Mix) -> DataFrame:
    """For each document with words, by (rank, at): words taken and the blocks it lies in, with how often each is used."""
    spark = placed.sparkSession
    used = slots(spark, how, mix).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    lengths = spark.createDataFrame([(i, int(n)) for i, n in enumerate(how.length)], "rank bigint, length bigint")
    spans = placed.filter(F.col("__mix_size") > 0).select(F.col("__mix_rank").alias("rank"), F.col("__mix_at").alias("at"), F.col("__mix_size").alias("size"))
    last = F.floor((F.col("at") + F.col("size") - 1) / F.col("length"))
    cut = spans.join(lengths, "rank").select(
        "rank", "at", "size", "length", F.explode(F.sequence(F.floor(F.col("at") / F.col("length")), last)).alias("block")
    )
    start = F.greatest(F.col("block") * F.col("length"), F.col("at"))
    end = F.least((F.col("block") + 1) * F.col("length"), F.col("at") + F.col("size"))
    parts = cut.select("rank", "at", "block", (start - F.col("at")).alias("from"), (end - start).alias("words"))
    joined = parts.join(used.hint("shuffle_merge"), ["rank", "block"])
    return joined.groupBy(F.col("rank").alias("__mix_rank"), F.col("at").alias("__mix_at")).agg(
        F.sum(F.col("words") * F.col("times")).alias("__mix_taken"),
        F.sort_array(F.collect_list(F.struct("from", "words", "times"))).alias("__mix_parts"),
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken."""
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    placed, how = _placed(slim, mix, ["doc_id"])
    placed = stage(placed, "mixing-placed")
    taken = _times(placed, how, mix).drop("__mix_parts")
    return placed.join(taken.hint("shuffle_merge"), ["__mix_rank", "__mix_at"], "left").select(
        "doc_id", F.col("__mix_size").alias("size"), F.col("__mix_total").alias("source_size"), F.col("__mix_target").alias("target"),
        F.when(F.col("__mix_size") > 0, F.coalesce("__mix_taken", F.lit(0))).otherwise(0).cast("bigint").alias("taken"),
    )


_SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def _copies(text: bytes, parts: list[dict]) -> list[bytes]:
    """The texts that a document gives to the mix: copy c has the words of all blocks used at least c times."""
    places = [m.span() for m in _SPLIT.finditer(text)]
    out = []
    for copy in range(1, max((p["times"] for p in parts), default=0) + 1):
        chosen = [(p["from"], p["from"] + p["words"]) for p in parts if p["times"] >= copy]
        if sum(b - a for a, b in chosen) == len(places):
            out.append(text)
            continue
        runs: list[list[int]] = []
        for a, b in chosen:
            if runs and runs[-1][1] == a:
                runs[-1][1] = b
            else:
                runs.append([a, b])
        out.append(b"\n".join(text[places[a][0] : places[b - 1][1]] for a, b in runs))
    return out


def _written(text_at: int, parts_at: int, chars_at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows, texts = [], []
                for i, (text, parts) in enumerate(zip(batch.column(text_at), batch.column(parts_at).to_pylist(), strict=True)):
                    for copy in _copies(text.as_py().encode(), parts):
                        rows.append(i)
                        texts.append(copy.decode())
                out = pa.Table.from_batches([batch]).take(pa.array(rows, pa.int64()))
                out = out.set_column(text_at, batch.schema.names[text_at], pa.array(texts, pa.string()))
                if chars_at is not None:
                    out = out.set_column(chars_at, batch.schema.names[chars_at], pa.array([len(t) for t in texts], pa.int64()))
                yield from out.drop_columns([batch.schema.names[parts_at]]).combine_chunks().to_batches()

    return run


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: up to three rows per document, with the words the mix takes and all columns of `docs`.

    A document whose blocks are all used equally often keeps its whole text.
    """
    placed, how = _placed(docs, mix, docs.columns)
    placed = stage(placed, "mixing-placed")
    times = _times(placed.select("__mix_rank", "__mix_at", "__mix_size"), how, mix).select("__mix_rank", "__mix_at", "__mix_parts")
    rows = placed.filter(F.col("__mix_size") > 0).join(times.hint("shuffle_merge"), ["__mix_rank", "__mix_at"])
    chars = "n_chars" if dict(docs.dtypes).get("n_chars") == "bigint" else None
    out = rows.select(*[F.col(f"`{c}`") for c in docs.columns], "__mix_parts")
    at = docs.columns.index
    return out.mapInArrow(_written(at("text"), len(docs.columns), at(chars) if chars else None), docs.schema)
