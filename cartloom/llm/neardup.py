"""Near-duplicate documents: universal-hash minima, banding, exact confirmation, star-based components.

Steps, each a Spark job over the whole input:

1. Every text becomes its set of shingle hashes; universal hash functions give their minima.
   Texts with equal sets form a class, which goes on as one. Its number is a hash of the set.
2. Minima are cut into BANDS bands; classes that share a band's values share a bucket.
3. In every bucket all members are paired with a few hubs (members that come first in some hash
   order), never with each other. Pairs whose minima rule the similarity out are dropped; the others are
   confirmed on their full sets. Confirmed links are joined to components. Rounds with other hubs go on
   as long as many pairs in one bucket still lie in different components and rounds still find links.
4. What is left are pairs of a bucket in different components. In buckets of few members they are
   confirmed pair by pair. Larger buckets are cut into blocks; a task takes two blocks, counts the common shingles of all
   their pairs by matrix products and returns a spanning forest of the links, not the pairs. So no row stands for
   a pair within a large group, and yet no bucket or pair is left out.
5. Components come from alternating large-star and small-star steps over the links.

Cases: a null or empty text has an empty set and is linked with nothing; texts with fewer words than a
shingle are one shingle. Rows with a null id are linked with nothing and kept. Every row is a document of
its own, also where ids are repeated, and every row is returned. Only doc_id and text are read, so other columns of any name do no harm. An empty
table gives an empty result. Two sets are equal if 128 bits of their hash are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm import wordhash
from cartloom.llm.batches import small_batches
from cartloom.session import stage


@dataclass(frozen=True)
class Settings:
    """words per shingle; a link needs 100 * common >= percent * all; bands of `rows` minima each.

    With 32 bands of 4 a pair at similarity 0.8 shares no band with probability 5e-8. `slack` is how far the
    share of equal minima may lie below the wanted similarity: 4.5 standard deviations at 128 minima.
    hubs: hubs per bucket and round. pairs_per_class: rounds go on while more pairs than that per class are open.
    few: members of a bucket that is confirmed pair by pair; block, block_shingles: bounds of a block of a larger one.
    """

    words: int = 2
    percent: int = 80
    bands: int = 32
    rows: int = 4
    slack: float = 0.16
    hubs: int = 3
    pairs_per_class: float = 1.0
    few: int = 32
    block: int = 1024
    block_shingles: int = 1 << 20
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


#: What stages on word shingles take, so that texts with a few scattered edits are no copies. Only op4's contract has two words.
FIVE_WORDS = Settings(words=5)


def _shingles(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one text after another, and where each text starts."""
    sets, counts = [], np.zeros(len(firsts), dtype=np.int64)
    for i in range(len(firsts) - 1):
        own = words[firsts[i] : firsts[i + 1]]
        if not len(own):
            continue
        width = min(size, len(own))
        acc = np.full(len(own) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            acc = wordhash.mix(acc * np.uint64(0xA0761D6478BD642F) + own[k : k + len(acc)])
        distinct = np.unique(acc)
        sets.append(distinct)
        counts[i + 1] = len(distinct)
    return (np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)), np.cumsum(counts)


def text_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of a column of texts."""
    data, starts = wordhash.text_bytes(column)
    (words,), firsts = wordhash.word_hashes(data, starts, wordhash.plain_words())
    return _shingles(words, firsts, size)


def minima(values: np.ndarray, starts: np.ndarray, hashes: int, seed: int) -> np.ndarray:
    """For every non-empty set the minima of `hashes` universal (multiply-shift) functions, as 32-bit numbers."""
    draw = np.random.default_rng(seed)
    factor = draw.integers(1, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = draw.integers(0, 2**63, hashes, dtype=np.uint64)
    low = values & np.uint64(0xFFFFFFFF)
    out = np.empty((len(starts), hashes), dtype=np.uint32)
    for k in range(hashes):
        out[:, k] = np.minimum.reduceat((low * factor[k] + shift[k]) >> np.uint64(32), starts)
    return out


def set_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every set, which don't depend on the order of its members; 0 for an empty one."""
    full = np.flatnonzero(np.diff(bounds))
    keys = np.zeros((2, len(bounds) - 1), dtype=np.uint64)
    if len(full):
        keys[0, full] = wordhash.mix(np.add.reduceat(wordhash.mix(values + np.uint64(1)), bounds[:-1][full]))
        keys[1, full] = np.bitwise_xor.reduceat(wordhash.mix(values * np.uint64(3) + np.uint64(5)), bounds[:-1][full])
    return keys[0].view(np.int64), keys[1].view(np.int64)


_SIGNED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, minima binary"


def _sign(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                values, bounds = text_sets(batch.column(1), settings.words)
                counts = np.diff(bounds)
                full = np.flatnonzero(counts)
                signed = minima(values, bounds[:-1][full], settings.hashes, settings.seed) if len(full) else None
                keys = set_keys(values, bounds)
                blobs: list[bytes | None] = [None] * len(counts)
                for row, i in enumerate(full):
                    blobs[i] = signed[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts), pa.array(keys[0]), pa.array(keys[1]), pa.array(blobs, pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "minima"],
                )

    return run


def signed(docs: DataFrame, settings: Settings) -> DataFrame:
    """Every row with the size, the hash and the minima of its set."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(slim.mapInArrow(_sign(settings), _SIGNED), "neardup-signed")


def _banded(settings: Settings):
    """Explode classes into buckets: a band's number and its minima, hashed to 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            table = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(rows, settings.bands, settings.rows)
            acc = np.broadcast_to(np.arange(settings.bands, dtype=np.uint64), (rows, settings.bands)).copy()
            for k in range(settings.rows):
                acc = wordhash.mix(acc * np.uint64(0xA0761D6478BD642F) + table[:, :, k])
            ids = np.repeat(np.asarray(batch.column(0)), settings.bands)
            yield pa.RecordBatch.from_arrays([pa.array(acc.ravel().view(np.int64)), pa.array(ids)], names=["bucket", "id"])

    return run


def _likely(settings: Settings):
    """Pairs whose share of equal minima leaves the wanted similarity possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint32).reshape(batch.num_rows, -1) for k in (2, 3)
            )
            near = (left == right).mean(axis=1) >= settings.percent / 100 - settings.slack
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near))

    return run


def _set_rows(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                values, bounds = text_sets(batch.column(0), settings.words)
                ids = set_keys(values, bounds)[0]
                blobs = [values[bounds[i] : bounds[i + 1]].tobytes() for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(blobs, pa.binary())], names=["id", "members"])

    return run


def _confirm(settings: Settings):
    """Pairs that are links on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(left.as_buffer(), dtype=np.uint64), np.frombuffer(right.as_buffer(), dtype=np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= settings.percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(needed: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """The full sets of the classes `needed` (id), made again from their texts: (id, members)."""
    wanted = classes.join(needed, "id", "left_semi").select("doc_id")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = texts.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(_set_rows(settings), "id bigint, members binary")
    return stage(sets.join(needed, "id", "left_semi").dropDuplicates(["id"]), "neardup-sets")


def _forest(linked: np.ndarray) -> np.ndarray:
    """For every row of a symmetric yes/no matrix the smallest row it is connected with."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Common members of every two sets, by products of slabs of the incidence matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    keep = times[column] > 1
    owner, column = owner[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total, width = np.zeros((len(sets), len(sets)), dtype=np.float32), 2048
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [low, low + width]))
        slab = np.zeros((len(sets), width), dtype=np.float32)
        slab[owner[part], column[part] - low] = 1
        total += slab @ slab.T
    return total


def _block(settings: Settings):
    """Links between different components among the members of two blocks, as a spanning forest."""

    def run(rows: pa.Table) -> pa.Table:
        ids, component = np.asarray(rows.column("id")), np.asarray(rows.column("component"))
        sets = [np.frombuffer(m, dtype=np.uint64) for m in rows.column("members").to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        common = _common(sets).astype(np.float64)
        linked = 100 * common >= settings.percent * (sizes[:, None] + sizes[None, :] - common)
        linked &= component[:, None] != component[None, :]
        root = _forest(linked)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(ids[moved]), "b": pa.array(ids[root[moved]])})

    return run


def _block_links(members: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Links within large buckets. Members: (bucket, id, component)."""
    sets = _sets(members.select("id").distinct(), classes, docs, settings)
    held = members.join(sets, "id")
    load = held.groupBy("bucket").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / settings.block), F.ceil(F.sum(F.octet_length("members")) / (8 * settings.block_shingles))
        ).cast("bigint").alias("blocks")
    )
    # One more partition key for each block that a block meets; a bucket of one block is sent once.
    placed = held.join(load, "bucket").withColumn("own", F.pmod(F.xxhash64("id", F.lit(97)), "blocks"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "component", "members"
    )
    return pairs.groupBy("bucket", "i", "j").applyInArrow(_block(settings), "a bigint, b bigint")


def _links(pairs: DataFrame, minima_of: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of classes that are links."""
    left = minima_of.select(F.col("id").alias("a"), F.col("minima").alias("left"))
    right = minima_of.select(F.col("id").alias("b"), F.col("minima").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    likely = stage(both.mapInArrow(_likely(settings), "a bigint, b bigint"), "neardup-likely")
    needed = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _sets(needed, classes, docs, settings)
    full = (
        likely.join(sets.select(F.col("id").alias("a"), F.col("members").alias("left")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("members").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return full.mapInArrow(_confirm(settings), "a bigint, b bigint")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (a, b) with a < b.

    Each names `edges` twice only: the driver plans, describes and logs every mention of a step's input anew.
    """
    if large:
        least = _ends(edges).groupBy(F.col("id").alias("a")).agg(F.least(F.min("other"), F.col("a")).alias("m"))
        moved = edges.join(least, "a").select(F.col("m").alias("a"), "b")
    else:
        # Only smaller neighbours count, and all of them go to the least one, as does b itself.
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        moved = edges.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
    return moved.filter(F.col("a") < F.col("b")).distinct()


def _ends(edges: DataFrame) -> DataFrame:
    """Both ends of every edge (a, b): id, the id at the other end, and whether it lies below that (1 or 0)."""
    ways = [("a", "b", 0), ("b", "a", 1)]
    both = F.array(*[F.struct(F.col(x).alias("id"), F.col(y).alias("other"), F.lit(below).alias("below")) for x, y, below in ways])
    return edges.select(F.explode(both).alias("end")).select("end.*")


def _settled(edges: DataFrame) -> bool:
    """Whether every id lies below one other at most, and then above none: every edge leads to the smallest id."""
    each = _ends(edges).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("below").alias("below"))
    return each.filter((F.col("below") > 0) & (F.col("n") > 1)).agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """For every id in a link (a, b): (id, component), the smallest id it is connected with.

    Alternates large-star and small-star until every edge leads to the smallest id.
    """
    edges = stage(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(F.col("a") < F.col("b")).distinct(), "neardup-edges"
    )
    while not _settled(edges):
        edges = stage(_star(_star(edges, True), False), "neardup-edges")
    return edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))


def _with_components(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return members.withColumn("component", F.col("id"))
    return members.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _hub(number: int) -> Column:
    """The member of a bucket that comes first in an order of its own for each number."""
    first = F.min(F.struct(F.xxhash64("id", F.lit(number)).alias("rank"), "id", "component"))
    return F.struct(first["id"].alias("hub"), first["component"].alias("hub_component"))


def _hub_pairs(members: DataFrame, first: int, settings: Settings) -> DataFrame:
    """Every member paired with the hubs of its bucket, as far as they lie in different components."""
    # Dealt by bucket alone; the three hubs of a bucket ride along as one array.
    hubs = members.groupBy("bucket").agg(F.array_distinct(F.array(*[_hub(first + k) for k in range(settings.hubs)])).alias("hubs"))
    spread = members.join(hubs, "bucket").select("id", "component", F.explode("hubs").alias("h"))
    apart = spread.filter(F.col("component") != F.col("h.hub_component"))
    return apart.select(F.least("id", "h.hub").alias("a"), F.greatest("id", "h.hub").alias("b")).distinct()


def _open_pairs(members: DataFrame) -> int:
    """How many pairs share a bucket but no component (counted once per bucket)."""
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    per = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    return per.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()[0] or 0


def _still_open(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    mixed = members.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return members.join(mixed.filter(F.col("least") != F.col("most")).select("bucket"), "bucket", "left_semi")


def near_duplicates(docs: DataFrame, settings: Settings = FIVE_WORDS) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, kept."""
    # Minima and sets are large rows, and all jobs that hand them to Python run in here.
    with small_batches(docs.sparkSession):
        rows, final = _resolved(docs, settings)
    same = ["set_a", "set_b", "n_shingles"]
    least = final.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = rows.join(final.join(least, "component").select(*same, "component_id"), same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return known.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _resolved(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Rows with their set, and classes with their component."""
    rows = signed(docs, settings)
    usable = rows.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same = ["set_a", "set_b", "n_shingles"]
    classes = usable.groupBy(*same).agg(F.min("doc_id").alias("doc_id"))
    classes = stage(classes.withColumn("id", F.col("set_a")), "neardup-classes")
    first = usable.join(classes.select("doc_id", *same), ["doc_id", *same], "left_semi")
    minima_of = stage(first.select(F.col("set_a").alias("id"), "minima").dropDuplicates(["id"]), "neardup-minima")
    buckets = minima_of.mapInArrow(_banded(settings), "bucket bigint, id bigint")
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("bucket")
    members = stage(buckets.join(shared, "bucket", "left_semi"), "neardup-buckets").withColumn("component", F.col("id"))

    links: DataFrame | None = None
    comps: DataFrame | None = None
    most = settings.pairs_per_class * minima_of.count()
    turn, open_pairs = 0, _open_pairs(members)
    while open_pairs > most:
        pairs = stage(_hub_pairs(members, settings.hubs * turn, settings), "neardup-pairs")
        comps, links = _grow(comps, links, _links(pairs, minima_of, classes, docs, settings))
        members = stage(_still_open(_with_components(members.select("bucket", "id"), comps)), "neardup-open")
        turn, last, open_pairs = turn + 1, open_pairs, _open_pairs(members)
        # Another round costs as many jobs as this one; it pays only if this one settled nearly all.
        if open_pairs > 0.2 * last:
            break
    if open_pairs:
        size = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        sized = stage(members.join(size, "bucket"), "neardup-sized")
        large = sized.filter(F.col("n") > settings.few).select("bucket", "id", "component")
        few = sized.filter(F.col("n") <= settings.few)
        other = few.select("bucket", F.col("id").alias("b"), F.col("component").alias("other"))
        pairs = (
            few.withColumnRenamed("id", "a").join(other, "bucket")
            .filter((F.col("a") < F.col("b")) & (F.col("component") != F.col("other"))).select("a", "b").distinct()
        )
        new = _links(pairs, minima_of, classes, docs, settings)
        if not large.isEmpty():
            new = new.unionByName(_block_links(large, classes, docs, settings))
        comps, links = _grow(comps, links, new)
    return rows, stage(_with_components(classes, comps), "neardup-final")


def _grow(comps: DataFrame | None, links: DataFrame | None, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of the links so far (as edges to the smallest id) and the new ones."""
    edges = new if links is None else links.unionByName(new)
    comps = stage(components(edges), "neardup-components")
    return comps, comps.select(F.col("component").alias("a"), F.col("id").alias("b"))


def without_copies(docs: DataFrame, settings: Settings = FIVE_WORDS) -> DataFrame:
    """`docs` with one document of each group of near copies, the one with the smallest id.

    Rows go by id: if ids are repeated, all rows of an id stay that has a row to be kept.
    """
    rows = near_duplicates(docs, settings).filter(F.col("doc_id").isNotNull())
    dropped = rows.groupBy("doc_id").agg(F.max("kept").alias("stays")).filter(~F.col("stays")).select(F.col("doc_id").alias("__dropped_id"))
    return docs.join(dropped, docs["doc_id"] == F.col("__dropped_id"), "left_anti")
