"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of every window of ``words`` words the least hash of its
``seed`` consecutive words, so equal windows have equal seeds. Seeds that occur twice
anywhere are extended both ways to the windows they stand for; all extensions of a seed
meet in one sorted comparison, because comparing occurrences pair by pair would grow with
the square of a common passage. Overlapping windows found twice merge into maximal repeats.

Null or empty texts have no words; rows that repeat a whole text, with the same id or
not, repeat each other. Window keys have 63 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import staged
from .common import Powers, Words, chosen, chunks, mix, parts_for, sliding_min, texts, window_rows
from .seeds import ANSWER, PACK, member, pack_batch, packs, repeated, union

SEED_WORDS = 8
GROUP_BYTES = 6 << 20
PART_BYTES = 96 << 20
FLUSH = 2_000_000


class Windows:
    def __init__(self, words: int, seed: int):
        self.words, self.seed = words, min(seed, words)
        self.split = Words(lower=False)
        self.of_seed, self.of_window = Powers(0x2545F4914F6CDD1D), Powers(0xDA942042E4DD58B5)

    def keys(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows and their keys."""
        n = len(hashes)
        starts = np.flatnonzero(window_rows(offsets, self.words, n))
        return starts, self.of_window.spans(hashes, starts, starts + self.words)

    def grams(self, hashes: np.ndarray) -> np.ndarray:
        at = np.arange(max(0, len(hashes) - self.seed + 1))
        return self.of_seed.spans(hashes, at, at + self.seed)

    def seeds(self, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The seed of each window, in the order of ``keys``: least hashes mixed again, since they are all small."""
        least = sliding_min(self.grams(hashes), self.words - self.seed + 1)
        return mix(least[window_rows(offsets, self.words, len(hashes))])

    def places(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all seeds and their hashes."""
        grams, width = self.grams(hashes), self.words - self.seed + 1
        least = sliding_min(grams, width)
        if not len(least):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = chosen(grams, np.where(window_rows(offsets, self.words, len(hashes)), least, np.uint64(0)), width)
        return at, mix(grams[at])


def _grouped(docs: DataFrame, groups: int) -> DataFrame:
    return docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("grp"))


def _sent(docs: DataFrame, words: int, seed: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, held, size = Windows(words, seed), [], 0

        def flush():
            h, g = (np.concatenate(x) for x in zip(*held))
            return pack_batch(list(packs(h, g, None, parts)))

        for batch in batches:
            groups = batch.column(1).to_numpy(zero_copy_only=False)
            for row, _, data, offsets in chunks(*texts(batch.column(0))):
                hashes, _, _, of = windows.split.of(data, offsets)
                at, seeds = windows.places(hashes, of)
                held.append((seeds, groups[row + np.searchsorted(of, at, "right") - 1]))
                size += len(at)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return docs.select("text", "grp").mapInArrow(run, PACK)


def _extended(docs: DataFrame, seeds: DataFrame, words: int, seed: int, parts: int) -> DataFrame:
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        windows, known, keys = Windows(words, seed), union(answers["pack"].to_pylist()), []
        if len(known) and group.num_rows:
            for _, _, data, offsets in chunks(*texts(group["text"])):
                hashes, _, _, of = windows.split.of(data, offsets)
                _, found = windows.keys(hashes, of)
                keys.append(found[member(windows.seeds(hashes, of), known)])
        every = np.concatenate(keys or [np.zeros(0, np.uint64)])
        grp = group["grp"][0].as_py() if group.num_rows else 0
        rows = list(packs(every, np.full(len(every), grp, np.int32), None, parts))
        return pa.Table.from_batches([pack_batch(rows)] if rows else [], pack_batch([(0, 0, b"")]).schema)

    return docs.groupBy("grp").cogroup(seeds.groupBy("grp")).applyInArrow(run, PACK)


def _without(data, inside, gone, first, last, offsets, of) -> tuple[memoryview, np.ndarray]:
    """Bytes of the kept words of each row joined by one space, and the rows' edges in them."""
    kept = np.flatnonzero(~gone)
    flags = np.zeros(len(data), bool)
    flags[inside] = np.repeat(~gone, last - first)
    row = np.searchsorted(of, kept, "right")
    flags[last[kept[:-1][row[1:] == row[:-1]]]] = True
    edges = np.concatenate(([0], np.cumsum(flags)))[offsets]
    return memoryview(np.where(inside, data, np.uint8(32))[flags].tobytes()), edges


def repeated_words(docs: DataFrame, words: int = 50, seed: int = SEED_WORDS) -> DataFrame:
    """Maximal repeats of at least ``words`` words in ``docs(doc_id, text)``, one row per document row.

    Returns ``doc_id, n_words, n_removed, starts, ends, kept_sha256``: word positions of the
    maximal repeats (end exclusive) and the digest of the words outside them joined by spaces.
    Every copy of a repeat is reported, the first as well.
    """
    groups, parts = parts_for(docs, "text", GROUP_BYTES), parts_for(docs, "text", PART_BYTES)
    docs = _grouped(docs, groups)
    seeds = staged(repeated(_sent(docs, words, seed, parts)), "substring-seeds")
    found = staged(repeated(_extended(docs, seeds, words, seed, 4 * parts)), "substring-windows")

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        windows, known = Windows(words, seed), union(answers["pack"].to_pylist())
        out = {name: [] for name in ("n_words", "n_removed", "starts", "ends", "kept_sha256")}
        for _, _, data, offsets in chunks(*texts(group["text"])):
            hashes, first, last, of = windows.split.of(data, offsets)
            at, keys = windows.keys(hashes, of)
            change = np.zeros(len(hashes) + 1, np.int32)
            hit = at[member(keys, known)]
            change[hit] += 1
            change[hit + words] -= 1
            gone = np.cumsum(change[:-1]) > 0
            body, edges = _without(data, windows.split.inside[data], gone, first, last, offsets, of)
            for i, (a, b) in enumerate(zip(of[:-1], of[1:])):
                own = gone[a:b]
                edge = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
                out["n_words"].append(b - a)
                out["n_removed"].append(int(own.sum()))
                out["starts"].append(edge[::2])
                out["ends"].append(edge[1::2])
                out["kept_sha256"].append(hashlib.sha256(body[edges[i] : edges[i + 1]]).hexdigest())
        return pa.table(
            {
                "doc_id": group["doc_id"].combine_chunks() if group.num_rows else pa.array([], pa.int64()),
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "starts": pa.array(out["starts"], pa.list_(pa.int64())),
                "ends": pa.array(out["ends"], pa.list_(pa.int64())),
                "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
            }
        )

    schema = "doc_id bigint, n_words bigint, n_removed bigint, starts array<bigint>, ends array<bigint>, kept_sha256 string"
    return docs.groupBy("grp").cogroup(found.groupBy("grp")).applyInArrow(run, schema)
