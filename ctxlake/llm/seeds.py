"""Which of very many hashes occur twice: an exchange of sorted packs instead of single rows.

Tasks sort their hashes and send one pack for each pair of hash range and document
group. A range's task sees all packs of its hashes, finds those that occur twice, and
answers each document group. A hash that a third of all documents hold is one entry for
each pack, since packs hold distinct hashes; the lowest bit says that it already occurs
twice inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PACK = "part int, grp int, pack binary"
ANSWER = "grp int, pack binary"
_ONE = np.uint64(1)


def packs(hashes: np.ndarray, groups: np.ndarray, owners: np.ndarray | None, parts: int) -> Iterator[tuple]:
    """Distinct hashes by (range, group). A hash counts as twice there if it has two owners,
    or, where ``owners`` is None, two entries."""
    if not len(hashes):
        return
    key = hashes >> _ONE
    order = np.lexsort((key, groups))
    key, groups = key[order], groups[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (groups[1:] != groups[:-1])
    at = np.flatnonzero(new)
    if owners is None:
        twice = np.diff(np.append(at, len(key))) > 1
    else:
        owners = owners[order]
        twice = np.minimum.reduceat(owners, at) != np.maximum.reduceat(owners, at)
    key, groups = key[at], groups[at]
    part = ((key >> np.uint64(31)) * np.uint64(parts)) >> np.uint64(32)
    edge = np.ones(len(key), bool)
    edge[1:] = (part[1:] != part[:-1]) | (groups[1:] != groups[:-1])
    cut = np.append(np.flatnonzero(edge), len(key))
    packed = (key << _ONE) | twice.astype(np.uint64)
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(part[a]), int(groups[a]), packed[a:b].tobytes()


def pack_batch(rows: list[tuple]) -> pa.RecordBatch:
    part, grp, pack = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(grp, pa.int32()), pa.array(pack, pa.binary())], ["part", "grp", "pack"]
    )


def repeated(sent: DataFrame) -> DataFrame:
    """``PACK`` rows in, ``ANSWER`` rows out: the hashes of each pack that occur twice anywhere."""

    def meet(group: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, np.uint64) for x in group["pack"].to_pylist()]
        every = np.concatenate(blobs)
        key = every >> _ONE
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(key)))
        twice = (size > 1) | (np.maximum.reduceat(every[order] & _ONE, at) > 0)
        flag = np.zeros(len(key), bool)
        flag[order] = np.repeat(twice, size)
        out, start = [], 0
        for grp, blob in zip(group["grp"].to_pylist(), blobs):
            kept = blob[flag[start : start + len(blob)]] >> _ONE
            start += len(blob)
            if len(kept):
                out.append((grp, kept.tobytes()))
        return pa.table({"grp": pa.array([g for g, _ in out], pa.int32()), "pack": pa.array([p for _, p in out], pa.binary())})

    return sent.groupBy("part").applyInArrow(meet, ANSWER)


def union(packs_of_group: list[bytes]) -> np.ndarray:
    """Sorted distinct keys of a group's answers."""
    return np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in packs_of_group] or [np.zeros(0, np.uint64)]))


def member(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are among the sorted keys ``known``."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    key = hashes >> _ONE
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    return known[at] == key
