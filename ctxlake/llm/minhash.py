"""MinHash near-duplicate detection with tensored banding, links confirmed on whole shingle sets.

Two collections of ``side`` half keys are computed, each of ``width`` least hash values. Every pair of
one half key of each collection is the key of a table, so ``side`` squared tables cost
``2 * side * width`` hash values. Two documents of similarity s stay apart with a chance of about
``2 * (1 - s ** width) ** side``: 8e-5 at 0.8 by default, 2e-9 at 0.9.

Equal sets are one class from the start. Half keys that only one class has cannot make a shared table key and are
dropped before pairing. In a bucket all members are compared with one member: first with the one that shares most
table keys with others, which is most often what the others are copies of, then with others. Links that go past these members are
found among the documents of buckets that still hold several components: documents of a similarity share one of their
rarest shingles, as many as may be missing, so these are joined, and pairs from different components compared.
A bucket of many copies costs its size, and no candidate is capped.

Documents without words, null or empty, link with nothing. A null doc_id takes part with nothing. Rows that share a doc_id
are one document with several texts: it is linked where one of them is, and all its rows have its component, those without
words as well. Very long texts are read whole, a task holds one at a time. Repeated rows change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import staged
from .common import Powers, Words, chunks, freed, mix, texts
from .components import components

ROUNDS = 1
SALT_ROWS = 500
SIGNATURES = "doc_id bigint, n_shingles bigint, lo bigint, hi bigint, a array<bigint>, b array<bigint>"


class Shingles:
    """Distinct hashed shingles of texts; a text with fewer words than ``size`` is one shingle."""

    def __init__(self, size: int):
        self.size, self.words, self.powers = size, Words(lower=True), Powers(0x6C8E9CF570932BD5)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        hashes, _, _, of = self.words.of(data, offsets)
        at = np.arange(max(0, len(hashes) - self.size + 1))
        every = self.powers.spans(hashes, at, at + self.size)
        out = []
        for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
            if b - a >= self.size:
                out.append(np.unique(every[a : b - self.size + 1]))
            elif b > a:
                out.append(self.powers.spans(hashes, np.array([a]), np.array([b])))
            else:
                out.append(hashes[:0])
        return out


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(docs: DataFrame, size: int, side: int, width: int) -> DataFrame:
    """Set size, a 128-bit digest of the set, and both collections of half keys; no half keys for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, factors, n = Shingles(size), _seeds(2 * side * width), 2 * side
        for batch in batches:
            count, lo, hi, keys = [], [], [], []
            for _, _, data, offsets in chunks(*texts(batch.column(1))):
                sets = shingles.sets(data, offsets)
                sizes = np.array([len(x) for x in sets])
                full = np.flatnonzero(sizes)
                own = np.zeros((len(sets), n), np.uint64)
                sums = np.zeros((2, len(sets)), np.uint64)
                if len(full):
                    every = np.concatenate(sets)
                    at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                    sums[0, full] = np.add.reduceat(mix(every), at)
                    sums[1, full] = np.add.reduceat(mix(every + np.uint64(0xA0761D6478BD642F)), at)
                    for k in range(n):
                        key = np.full(len(full), k, np.uint64)
                        for factor in factors[k * width : (k + 1) * width]:
                            least = np.minimum.reduceat(every * factor, at)
                            key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ least)
                        own[full, k] = key
                count.append(sizes)
                lo.append(sums[0])
                hi.append(sums[1])
                keys.append(own)
            if not count:
                continue
            count, keys = np.concatenate(count), np.concatenate(keys).view(np.int64)
            full = count > 0

            def lists(half):
                sizes = np.where(full, side, 0)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array(half[full].ravel()))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(count.astype(np.int64)),
                    pa.array(np.concatenate(lo).view(np.int64)),
                    pa.array(np.concatenate(hi).view(np.int64)),
                    lists(keys[:, :side]),
                    lists(keys[:, side:]),
                ],
                ["doc_id", "n_shingles", "lo", "hi", "a", "b"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(freed(run), SIGNATURES)


def _shared(classes: DataFrame, half: str) -> DataFrame:
    """Half keys that two classes or more have, by class: leader and one half of the digest tell classes apart."""
    rows = classes.select("doc_id", "lo", F.posexplode(half).alias(f"i_{half}", f"k_{half}"))
    keys = [f"i_{half}", f"k_{half}"]
    often = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(often, keys).select("doc_id", "lo", F.xxhash64(*keys).alias(f"h_{half}"))


def _confirmed(docs: DataFrame, pairs: DataFrame, several: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of documents with a text each whose whole shingle sets have the wanted similarity.

    The texts of ``a`` meet those of its partners in one sorted run; an ``a`` with many partners is repeated for every
    ``SALT_ROWS`` of them. The texts of an id with very many different ones (``several(doc_id, texts)``) are dealt to
    blocks of about as many, and each block meets all partners.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts"))
    blocks = several.select(F.col("doc_id").alias("a"), F.ceil(F.col("texts") / SALT_ROWS).cast("int").alias("blocks"))
    many = many.join(blocks, "a", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = pairs.join(many, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "blocks",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("b").alias("doc_id"),
    )
    groups = ["a", "salt", "blocks", "block"]
    heads = dealt.select(*groups).distinct().select(*groups, F.col("a").alias("doc_id"))
    wanted = dealt.select("*", F.lit(1).alias("part")).unionByName(heads.select("*", F.lit(0).alias("part")))
    rows = docs.join(wanted, "doc_id").where("part = 1 OR pmod(xxhash64(text), blocks) = block")
    rows = rows.repartition("a", "salt", "block").sortWithinPartitions("a", "salt", "block", "part", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, heads, group = Shingles(size), [], None
        for batch in batches:
            a, salt, block, part, doc = (batch.column(i).to_pylist() for i in range(5))
            out, i = [], 0
            for _, _, data, offsets in chunks(*texts(batch.column(5))):
                for own in shingles.sets(data, offsets):
                    if group != (a[i], salt[i], block[i]):
                        heads, group = [], (a[i], salt[i], block[i])
                    if part[i] == 0:
                        if not any(np.array_equal(own, head) for head in heads):
                            heads.append(own)
                    elif any(_alike(own, head, percent) for head in heads):
                        out.append((a[i], doc[i]))
                    i += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])

    return rows.select("a", "salt", "block", "part", "doc_id", "text").mapInArrow(freed(run), "a bigint, b bigint")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the wanted similarity."""
    short, long = (x, y) if len(x) < len(y) else (y, x)
    if not len(short) or 100 * len(short) < percent * len(long):
        return False
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    both = int((long[at] == short).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _rarest(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The rarest shingles of each document and their places in the order from rare to frequent, so many that two sets of the wanted similarity share one of them.

    Sets of sizes n and m with ``100 * both >= percent * union`` have ``both >= percent / 100 * n``, so the rarest
    ``n - ceil(percent / 100 * n) + 1`` of each, in one order for all, meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            row = 0
            for _, _, data, offsets in chunks(*texts(batch.column(2))):
                sets = shingles.sets(data, offsets)
                sizes = np.array([len(x) for x in sets], np.int64)
                of = np.repeat(np.arange(len(sets)), sizes)
                digests = np.array([mix(x).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
                spots = np.concatenate(sets).view(np.int64)
                for a in range(0, len(spots), 100_000):
                    at = of[a : a + 100_000]
                    ids = [batch.column(i).take(pa.array(at + row)) for i in range(2)]
                    own = [pa.array(x) for x in (sizes[at], digests[at], spots[a : a + 100_000])]
                    yield pa.RecordBatch.from_arrays([*ids, *own], ["doc_id", "component", "n_shingles", "digest", "spot"])
                row += len(sets)

    schema = "doc_id bigint, component bigint, n_shingles bigint, digest bigint, spot bigint"
    every = docs.select("doc_id", "component", "text").mapInArrow(freed(run), schema)
    every = staged(every, "minhash-spots")
    counts = every.groupBy("spot").agg(F.count("*").alias("often"))
    # Shingles of one document alone join nothing, but they fill places among the rarest.
    shared = every.join(counts.where("often > 1"), "spot")
    alone = F.col("n_shingles") - F.size("spots")
    room = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1 - alone
    # Texts of one id are told apart by their digests; a row that is there twice gives its shingles once.
    rows = shared.groupBy("doc_id", "component", "n_shingles", "digest").agg(F.array_sort(F.collect_set(F.struct("often", "spot"))).alias("spots"))
    rows = rows.withColumn("room", room.cast("int")).where("room > 0")
    placed = rows.select("doc_id", "component", "n_shingles", alone.alias("alone"), F.posexplode(F.expr("slice(spots, 1, room)")))
    return placed.select("doc_id", "component", "n_shingles", F.col("col.spot").alias("spot"), F.expr("alone + pos + 1").alias("place"))


def _labelled(classes: DataFrame, edges: DataFrame) -> DataFrame:
    found = components(edges)
    return classes.join(found, classes["doc_id"] == found["node"], "left").select(
        classes["*"], F.coalesce("component", "doc_id").alias("component")
    )


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, side: int = 10, width: int = 2) -> DataFrame:
    """Components of documents linked by ``100 * intersection >= percent * union`` of their shingle sets.

    ``docs(doc_id bigint, text)`` gives ``doc_id, n_shingles, component_id, kept``, one row per input row;
    ``kept`` is true where ``doc_id`` is the smallest of its component. A null ``doc_id`` is kept, with no component.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = staged(signatures(docs, shingle, side, width), "minhash-signatures")
    known = signed.where("doc_id IS NOT NULL")
    full = known.where("n_shingles > 0")
    whole = ["lo", "hi", "n_shingles"]
    classes = full.groupBy(*whole).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("members"))
    leaders = staged(
        full.join(classes.select(*whole, "doc_id"), [*whole, "doc_id"]).dropDuplicates([*whole, "doc_id"]).select("doc_id", "n_shingles", "lo", "a", "b"),
        "minhash-classes",
    )
    shared = staged(_shared(leaders, "a"), "minhash-half").join(staged(_shared(leaders, "b"), "minhash-half"), ["doc_id", "lo"])
    entries = shared.select("doc_id", "lo", F.xxhash64("h_a", "h_b").alias("key"))
    often = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    entries = staged(entries.join(often, "key"), "minhash-shared")
    met = entries.groupBy("doc_id", "lo").agg(F.sum("n").alias("met")).join(leaders.select("doc_id", "lo", "n_shingles"), ["doc_id", "lo"])
    entries = staged(entries.drop("n").join(met, ["doc_id", "lo"]).drop("lo"), "minhash-entries")
    first_in = [F.struct(-F.col("met"), F.col("doc_id")), F.col("doc_id"), F.xxhash64("doc_id")]
    unique = docs.where("doc_id IS NOT NULL").join(leaders.select("doc_id"), "doc_id", "left_semi")  # whole ids, with all their texts

    # Ids with several sets: a document of several texts, so its classes belong together.
    sets = F.struct(*whole)
    several = known.groupBy("doc_id").agg(F.min(sets).alias("low"), F.max(sets).alias("high")).where("low <> high").select("doc_id")
    several = staged(known.join(several, "doc_id", "left_semi").select("doc_id", *whole).distinct(), "minhash-several")
    belongs = several.join(classes.select(*whole, F.col("doc_id").alias("leader")), whole).select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))
    several = several.groupBy("doc_id").agg(F.count("*").alias("texts"))

    tested = edges = None
    nodes = leaders.select("doc_id").distinct()
    labels = nodes.withColumn("component", F.col("doc_id"))
    for turn in range(ROUNDS + 1):
        marked = entries.join(labels, "doc_id")
        mixed = marked.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min_by(F.struct("doc_id", "component", "n_shingles"), first_in[min(turn, 2)]).alias("pivot"),
        ).where("low < high")
        if turn < ROUNDS:
            found = marked.join(mixed, "key").where("component <> pivot.component").select(
                F.col("pivot.doc_id").alias("x"), F.col("pivot.n_shingles").alias("n_x"), F.col("doc_id").alias("y"), F.col("n_shingles").alias("n_y")
            )
        else:
            open_ = staged(marked.join(mixed.select("key"), "key").select("doc_id", "component").distinct(), "minhash-open")
            rare = staged(_rarest(unique.join(open_, "doc_id"), shingle, percent), "minhash-rarest")
            # The longer set of a pair probes; of the shorter one fewer shingles are needed. If this is the first shingle
            # in common, no more than those behind it in both sets can follow.
            probe = rare.select("spot", *[F.col(c).alias(f"{c}_x") for c in ("doc_id", "component", "n_shingles", "place")])
            index = rare.where(f"place <= n_shingles - ceil({2 * percent} * n_shingles / {100 + percent}) + 1")
            found = probe.join(index, "spot").where(
                f"component <> component_x AND (n_shingles < n_shingles_x OR n_shingles = n_shingles_x AND doc_id < doc_id_x) AND "
                f"{100 + percent} * (1 + least(n_shingles - place, n_shingles_x - place_x)) >= {percent} * (n_shingles + n_shingles_x)"
            ).select(F.col("doc_id_x").alias("x"), F.col("n_shingles_x").alias("n_x"), F.col("doc_id").alias("y"), F.col("n_shingles").alias("n_y"))
        found = found.where(f"100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y)")
        found = found.select(F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q")).distinct()
        if tested is not None:
            found = found.join(tested, ["p", "q"], "left_anti")
        found = staged(found, "minhash-pairs")
        if found.isEmpty():
            if turn == ROUNDS:
                break
            continue
        tested = found if tested is None else tested.unionByName(found)
        confirmed = staged(_confirmed(unique, found.select(F.col("p").alias("a"), F.col("q").alias("b")), several, shingle, percent), "minhash-links")
        edges = confirmed if edges is None else edges.unionByName(confirmed)
        labels = staged(_labelled(nodes, edges), "minhash-labels")
    # Rows of one id, and rows of one set, are one document.
    if not belongs.isEmpty():
        labels = staged(components(belongs if edges is None else edges.unionByName(belongs)), "minhash-belongs").withColumnRenamed("node", "doc_id")
    found = known.join(classes.select(*whole, F.col("doc_id").alias("leader")), whole, "left")
    found = found.withColumn("node", F.coalesce("leader", "doc_id")).drop("leader")
    found = found.join(labels.select(F.col("doc_id").alias("node"), "component"), "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    lost = signed.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    found = found.unionByName(lost)
    return found.withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)))
