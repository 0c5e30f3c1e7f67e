"""SpotSigs fingerprints: chains of content words that follow common words, compared by Jaccard similarity.

A signature is an anchor (a common word) with the ``chain`` content words found at every ``distance``-th
content word after it. A content word more than ``GAP`` words behind the last common word is an anchor too, so
stretches without common words count as well. A signature found again counts as another one, so a passage that is said many times
weighs as much as it takes up. Beside the chains, whose number grows with the text, every text has the ``LEAST`` least hashes of its
distinct byte trigrams: they tell texts of a few words, which hold no chain, apart, and weigh little in long ones. A fingerprint is the sorted set of 32-bit signature hashes in hexadecimal; equal texts
have equal fingerprints. Two empty sets have likeness 1, an empty and a full one 0.

Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased in A-Z. Null counts as the empty text. A very long
text is read whole, in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged
from .common import Words, mix, texts

# Common words of English, German, Spanish and French.
ANCHORS = (
    "a an and are as at be by for from has he in is it its of on or that the they this to was were which will with "
    "auf das dem den der des die ein eine für im ist mit nicht sich sie und von zu "
    "con de del el en es la las lo los no para por que se su un una y "
    "au aux dans des du est et il le les pas pour que qui sur une"
).split()
CHAIN, DISTANCE, GAP, LEAST = 3, 1, 8, 24
ROWS_A_BUCKET = 2000


class Spots:
    def __init__(self, chain: int = CHAIN, distance: int = DISTANCE):
        self.chain, self.distance, self.words = chain, distance, Words(lower=True)
        codes = np.arange(256)
        digit, upper, lower = ((codes >= a) & (codes <= b) for a, b in ((48, 57), (65, 90), (97, 122)))
        self.words.inside = digit | upper | lower | (codes >= 128)
        data = np.frombuffer(" ".join(ANCHORS).encode(), np.uint8)
        self.anchors = np.unique(self.words.of(data, np.array([0, len(data)]))[0])

    def _chains(self, hashes: np.ndarray, heads: np.ndarray, content: np.ndarray) -> np.ndarray:
        """Signatures of the anchors at ``heads`` whose chain ends inside the text."""
        first = np.searchsorted(content, heads, "right")
        good = first + (self.chain - 1) * self.distance < len(content)
        first, out = first[good], hashes[heads[good]]
        for k in range(self.chain):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) ^ hashes[content[first + k * self.distance]])
        return out

    def of(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        if not len(data):
            return np.zeros(0, np.uint32)
        hashes = self.words.of(data, np.array([0, len(data)]))[0]
        common = np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.anchors, hashes), len(self.anchors) - 1)
        common = self.anchors[at] == hashes
        content = np.flatnonzero(~common)
        place = np.arange(len(hashes))
        before = np.maximum.accumulate(np.where(common, place, -GAP - 1)) if len(hashes) else place
        found = [self._chains(hashes, np.flatnonzero(common | (place - before > GAP)), content)]
        padded = np.concatenate((data, np.zeros(2, np.uint8))).astype(np.uint32)
        grams = np.unique(padded[:-2] | padded[1:-1] << np.uint32(8) | padded[2:] << np.uint32(16))
        found.append(np.sort(mix(grams.astype(np.uint64) | np.uint64(1 << 24)))[:LEAST])
        every = np.sort(np.concatenate(found))
        if len(every):
            at = np.arange(len(every), dtype=np.uint64)
            new = np.concatenate(([True], every[1:] != every[:-1]))
            every = mix(every + (at - np.maximum.accumulate(np.where(new, at, np.uint64(0)))) * np.uint64(0xD6E8FEB86659FD93))
        return np.unique((every >> np.uint64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, spots``: the sorted signature hashes of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = Spots(chain, distance)
        for batch in batches:
            data, offsets = texts(batch.column(1))
            body = data.tobytes()
            found = [spots.of(body[a:b]).astype(np.int64) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "spots"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, spots array<bigint>")


def similar(docs: DataFrame, threshold: float = 0.8, chain: int = CHAIN, distance: int = DISTANCE) -> tuple[DataFrame, DataFrame]:
    """Classes of equal signature sets, and all pairs of class representatives with that Jaccard similarity.

    Sets are partitioned by length so that only neighbouring partitions can match, a pair is a candidate where it
    shares one of its rarest signatures (as many as the threshold leaves room to miss), and lengths prune it before sets are
    compared. Returns ``(doc_id, representative)`` and ``(a, b, likeness)``. Empty sets and null ids are left out.
    """
    sets = staged(fingerprints(docs, chain, distance).where("doc_id IS NOT NULL AND size(spots) > 0"), "spotsigs-sets")
    members = sets.withColumn("digest", F.md5(F.array_join("spots", ",")))
    heads = members.groupBy("digest").agg(F.min("doc_id").alias("representative"))
    classes = members.select("doc_id", "digest").join(heads, "digest").select("doc_id", "representative")
    unique = members.join(heads, "digest").where("doc_id = representative").dropDuplicates(["doc_id"]).select("doc_id", "spots", F.size("spots").alias("n"))
    unique = staged(unique, "spotsigs-unique")
    spots = unique.select("doc_id", "n", F.explode("spots").alias("spot"))
    often = spots.groupBy("spot").agg(F.count("*").alias("often"))
    ranked = spots.join(often, "spot").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("often", "spot"))).alias("spots"))
    rare = ranked.select("doc_id", "n", F.expr(f"explode(slice(spots, 1, n - CAST(ceil({threshold} * n - 1e-9) AS INT) + 1))").alias("spot"))
    part = f"CAST(floor(ln(n) / ln({1 / threshold}) + 1e-9) AS INT)"
    rare = staged(rare.select("doc_id", "n", F.col("spot.spot").alias("spot"), F.expr(part).alias("part")), "spotsigs-rare")
    left = rare.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), "spot", F.explode(F.expr("array(part, part + 1)")).alias("part"))
    right = rare.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), "spot", "part")
    pairs = left.join(right, ["spot", "part"]).where(f"(n_a < n_b OR n_a = n_b AND a < b) AND n_a >= {threshold} * n_b - 1e-9")
    pairs = staged(pairs.select("a", "b").distinct(), "spotsigs-pairs")
    both = pairs.join(unique.select(F.col("doc_id").alias("a"), F.col("spots").alias("s")), "a").join(unique.select(F.col("doc_id").alias("b"), F.col("spots").alias("t")), "b")
    both = both.withColumn("common", F.size(F.array_intersect("s", "t")))
    both = both.select("a", "b", (F.col("common") / (F.size("s") + F.size("t") - F.col("common"))).alias("likeness"))
    return classes, both.where(f"likeness >= {threshold} - 1e-12")


def _bounds(docs: DataFrame) -> list[int]:
    """Bounds of ranges of ``place`` with about equally many rows, at most as many as there are shuffle partitions."""
    count = docs.count()
    parts = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), count // ROWS_A_BUCKET))
    steps = [k / parts for k in range(1, parts)]
    found = docs.agg(F.percentile_approx("place", steps, 20 * parts)).first()[0] if steps else []
    return sorted(set(found or []))


def _literals(values: list) -> Column:
    """A constant array, one literal in the plan however long it is."""
    return F.expr(f"CAST(split('{','.join('' if v is None else str(v) for v in values)}', ',') AS ARRAY<BIGINT>)")


def _at_most(bounds: list[int], value: str) -> Column:
    """How many of the ascending bounds are at most the value, by halving."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda pos, step: F.when(F.coalesce(F.get(_literals(bounds), pos + step - 1) <= F.col(value), F.lit(False)), pos + step).otherwise(pos),
    )


def edited_likeness(docs: DataFrame, share: int = 3) -> DataFrame:
    """Fingerprints beside those of an edited text and of the next document, in descending order of doc_id.

    The edited text has its last ``1/share`` of code points replaced by as many from the start of the next document; after
    the last document comes the first. Rows are dealt by ranges of ids, as many as there are shuffle partitions, and each range also
    gets the first row of the next one. A task reads its rows in order and holds one of them, so long texts, long ranges and
    ids with very many rows need no more memory. Rows with one doc_id follow each other by text; a null doc_id
    counts as the smallest. A single row is its own next.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63))))
    bounds = _bounds(docs.select("place"))
    docs = docs.withColumn("bucket", (F.lit(len(bounds)) - _at_most(bounds, "place")).cast("int"))
    tops = dict(docs.groupBy("bucket").agg(F.max("place")).collect())  # one row for each range
    order = sorted(tops)
    # The first rows of a range close the one before it; those of the first range close the last.
    ahead = {b: order[i - 1] for i, b in enumerate(order)}
    spots = range(len(bounds) + 1)
    first = F.get(_literals([tops.get(b) for b in spots]), F.col("bucket")) == F.col("place")
    docs = docs.withColumn("before", F.when(first, F.get(_literals([ahead.get(b) for b in spots]), F.col("bucket")).cast("int")))
    dealt = docs.select("doc_id", "text", "place", F.explode(F.array(F.struct("bucket", F.lit(0).alias("closing")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("closing")))).alias("to"))
    dealt = dealt.select("doc_id", "text", "place", "to.*").where("bucket IS NOT NULL")
    dealt = dealt.repartition(max(1, len(order)), "bucket").sortWithinPartitions("bucket", "closing", F.desc("place"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots, hold, closed = Spots(), None, None

        def row(held, text, found):
            doc, own, print_ = held
            n = len(own)
            cut = n // share
            edited = own[: n - cut] + text[:cut] if cut else own
            other = spots.of(edited.encode())
            return (
                doc, n, hashlib.sha256(edited.encode()).hexdigest(), print_.astype(">u4").tobytes().hex(),
                other.astype(">u4").tobytes().hex(), likeness(print_, other), likeness(print_, found),
            )

        for batch in batches:
            out = []
            for doc, text, b, closing in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if closed == b:
                    continue  # only the first closing row counts
                found = spots.of(text.encode())
                if hold is not None:
                    out.append(row(hold, text, found))
                hold, closed = (None, b) if closing else ((doc, text, found), None)
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("doc_id", "text", "bucket", "closing").mapInArrow(run, schema)
