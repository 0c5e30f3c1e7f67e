"""Removal of repeated byte strings with suffix arrays sorted externally.

Only text that can repeat is sorted. Every window of ``length`` bytes is keyed by the least hash of
its ``SEED``-byte grams, so equal windows have equal keys; keys that occur in one document only
are set aside by an exact exchange (``seeds``). The windows of a remaining key are one run
of bytes (a snippet). Each group of rows sends its distinct snippets, with the least and greatest document id that has
them, so a passage is one entry a group however many rows hold it; all snippets of a key go to one shard. A shard sets
aside snippets that share no window with another one (``_akin``) and sorts the
suffixes of the others by external induced sorting (``suffix``); neighbours whose common prefix reaches ``length``
are equal strings, and the least document id of each goes back to the groups that sent them, which
find their occurrences again. Whole copies of a text are found by digest first and sent nowhere.

Null or empty texts have no bytes. Rows with the same doc_id count as one document, so they do
not remove each other's bytes; their texts may differ. A null doc_id takes no part: its row comes back whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import staged
from .common import chosen, chunks, mix, parts_for, sliding_min, texts, window_rows
from .seeds import ANSWER, PACK, member, pack_batch, packs, repeated, union
from .suffix import suffixes

SEED = 16
GROUP_BYTES = 6 << 20
PART_BYTES = 8 << 20
FLUSH = 1_000_000
SNIPPETS = "part int, grp int, least binary, most binary, sizes binary, body binary"
COVERED = "grp int, part int, at binary, begins binary, ends binary, owners binary"


class Windows:
    def __init__(self, length: int):
        self.length, self.seed = length, min(SEED, length)

    def grams(self, data: np.ndarray) -> np.ndarray:
        n = len(data) - self.seed + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        words = np.ndarray((len(data) + 1,), np.uint64, padded, strides=(1,))
        out = np.zeros(n, np.uint64)
        for at in range(0, self.seed, 8):
            word = words[at : at + n]
            if self.seed - at < 8:
                word = word & np.uint64((1 << 8 * (self.seed - at)) - 1)
            out = (out ^ word) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return mix(out) | np.uint64(1)  # least values are mixed again before they are dealt out, since they are all small

    def least(self, data: np.ndarray, offsets: np.ndarray):
        """Grams, and the least gram of each window; 0 for windows that leave their row."""
        grams = self.grams(data)
        least = sliding_min(grams, self.length - self.seed + 1)
        return grams, np.where(window_rows(offsets, self.length, len(data)), least, np.uint64(0))


def _sent(docs: DataFrame, length: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, held, size = Windows(length), [], 0

        def flush():
            h, g, d = (np.concatenate(x) for x in zip(*held))
            return pack_batch(list(packs(h, g, d, parts)))

        for batch in batches:
            ids, groups = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for row, _, data, offsets in chunks(*texts(batch.column(1))):
                grams, least = windows.least(data, offsets)
                if not len(least):
                    continue
                at = chosen(grams, least, length - windows.seed + 1)
                own = row + np.searchsorted(offsets, at, "right") - 1
                held.append((mix(grams[at]), groups[own], ids[own]))
                size += len(at)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return docs.select("doc_id", "text", "grp").mapInArrow(run, PACK)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``start .. start + size``, one range after the other."""
    edges = np.cumsum(sizes)
    return np.arange(int(edges[-1]) if len(edges) else 0) + np.repeat(starts - edges + sizes, sizes)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _own(group: pa.Table, answers: pa.Table, length: int, parts: int):
    """Snippets of repeated seeds in the rows of a group, whole copies left out.

    Returns the rows in an order of their own, which of them are copies, row, start and count of each snippet, its number among
    the distinct ones, these by number, and the part of each. Both steps that call this get the same numbers.
    """
    windows, known = Windows(length), union([x for x in answers["pack"].to_pylist() if x is not None])
    group = group.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    ids = group["doc_id"].to_pylist()
    listed = {(d, x) for d, x in zip(answers["copy"].to_pylist(), answers["digest"].to_pylist()) if d is not None}
    often = {d for d, _ in listed}
    copy = np.zeros(len(ids), bool)
    for row in [k for k, d in enumerate(ids) if d in often]:
        copy[row] = (ids[row], hashlib.md5((group["text"][row].as_py() or "").encode()).hexdigest()) in listed
    rows = np.flatnonzero(~copy & np.array([d is not None for d in ids], bool))
    found, distinct, seeds = [], {}, []
    for row, _, data, offsets in chunks(*texts(group["text"].take(pa.array(rows)))) if len(known) else ():
        _, least = windows.least(data, offsets)
        if not len(least):
            continue
        # A run of one seed within one row; windows of two rows never touch in ``least``.
        change = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        count = np.diff(np.append(change, len(least)))
        seed = least[change]
        good = seed > 0
        change, count, seed = change[good], count[good], mix(seed[good])
        good = member(seed, known)
        starts, count, seed = change[good], count[good], seed[good]
        body, before = data.tobytes(), len(distinct)
        ends = (starts + count + (length - 1)).tolist()
        kind = np.fromiter((distinct.setdefault(body[a:b], len(distinct)) for a, b in zip(starts.tolist(), ends)), np.int64, len(ends))
        new, at = np.unique(kind, return_index=True)
        seeds.append(seed[at[new >= before]])
        own = np.searchsorted(offsets, starts, "right") - 1
        found.append((rows[row + own], starts - offsets[own], count, kind))
    row, starts, count, kind = (np.concatenate(x).astype(np.int64) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
    seed = np.concatenate(seeds or [np.zeros(0, np.uint64)])
    part = (((seed >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
    return group, copy, row, starts, count, kind, list(distinct), part


def _snippets(docs: DataFrame, side: DataFrame, length: int, parts: int) -> DataFrame:
    """Distinct snippets of each group, with the least and greatest document of the group that has them."""

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _table([], _arrow(SNIPPETS))
        group, _, row, _, _, kind, distinct, part = _own(group, answers, length, parts)
        if not len(distinct):
            return _table([], _arrow(SNIPPETS))
        doc = np.array(group["doc_id"].to_pylist(), object)[row].astype(np.int64)
        least, most = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(least, kind, doc)
        np.maximum.at(most, kind, doc)
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.concatenate(([True], np.diff(part[order]) > 0)))
        out = []
        for a, b in zip(cut, np.append(cut[1:], len(order))):
            pick = order[a:b]
            body = [distinct[k] for k in pick.tolist()]
            sizes = np.fromiter(map(len, body), np.int64, len(body))
            out.append((int(part[pick[0]]), group["grp"][0].as_py(), least[pick].tobytes(), most[pick].tobytes(), sizes.tobytes(), b"".join(body)))
        return _table(out, _arrow(SNIPPETS))

    return docs.groupBy("grp").cogroup(side.groupBy("grp")).applyInArrow(run, SNIPPETS)


def _akin(data: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Which of the joined distinct snippets can share a window with another one.

    Equal windows have the same seed gram at the same place, and the gram leaves at least half of the rest of a window on one
    side of it. So they also share the gram together with the bytes that far to its left, or to its right. A snippet none
    of whose two-sided grams occurs again shares no window; equal hashes of unlike grams only bring one more into the sort.
    """
    windows = Windows(length)
    reach = min(windows.seed, (length - windows.seed + 1) // 2)
    grams, head = windows.grams(data), np.concatenate(([0], np.cumsum(size)))
    own = size - windows.seed + 1
    at, of = ranges(head[:-1], own), np.repeat(np.arange(len(size)), own)
    least = np.minimum.reduceat(grams[at], np.cumsum(own) - own)
    seed = grams[at] == least[of]
    at, of = at[seed], of[seed]
    left, right = at - reach >= head[of], at + reach + windows.seed <= head[of + 1]
    join = lambda a, b, side: mix(mix(grams[a]) * np.uint64(0x9E3779B97F4A7C15) + grams[b] * np.uint64(side))
    keys = np.concatenate((join(at[left] - reach, at[left], 3), join(at[right], at[right] + reach, 5)))
    of = np.concatenate((of[left], of[right]))
    _, kind, n = np.unique(keys, return_inverse=True, return_counts=True)
    out = np.zeros(len(size), bool)
    out[of[n[kind] > 1]] = True
    return out


def _covered(snippets: DataFrame, length: int, limit: int) -> DataFrame:
    """Runs of windows that also start in a smaller document than the greatest of a pack's snippet, and the least such document."""

    def run(group: pa.Table) -> pa.Table:
        column = lambda name: np.concatenate([np.frombuffer(x, np.int64) for x in group[name].to_pylist()])
        least, most, sizes = column("least"), column("most"), column("sizes")
        known: dict[bytes, int] = {}
        kinds = []
        for body, own in zip(group["body"], group["sizes"]):
            body, edges = body.as_py(), np.concatenate(([0], np.cumsum(np.frombuffer(own.as_py(), np.int64)))).tolist()
            kinds += [known.setdefault(body[a:b], len(known)) for a, b in zip(edges[:-1], edges[1:])]
        kind = np.array(kinds, np.int64)
        size = np.fromiter(map(len, known), np.int64, len(known))
        akin = _akin(np.frombuffer(b"".join(known), np.uint8), size, length)
        distinct = b"".join(compress(known, akin.tolist()))
        del known, kinds, body
        low, high = np.full(len(size), np.iinfo(np.int64).max), np.full(len(size), np.iinfo(np.int64).min)
        np.minimum.at(low, kind, least)
        np.maximum.at(high, kind, most)
        # Window starts in the joined snippets that are sorted, and the least document of each. Only the last, still open group
        # of equal strings is kept from one block of the order to the next.
        put = np.flatnonzero(akin)
        head = np.concatenate(([0], np.cumsum(size[put])))
        valid = np.zeros(len(distinct), bool)
        valid[ranges(head[:-1], size[put] - length + 1)] = True
        first = np.zeros(len(distinct), np.int64)

        def settle(members, apart):
            if len(members):
                at = np.flatnonzero(apart)
                owner = np.minimum.reduceat(low[put[np.searchsorted(head, members, "right") - 1]], at)
                first[members] = np.repeat(owner, np.diff(np.append(at, len(members))))

        held = [np.zeros(0, np.int64)]
        for positions, common in suffixes(np.frombuffer(distinct, np.uint8), length, limit):
            # A group that starts at a suffix which is no window start begins at its first window start.
            own = valid[positions]
            groups, members = np.cumsum(common < length)[own], positions[own].astype(np.int64)
            closed = int((common < length).sum())
            mine = np.searchsorted(groups, [1, closed])  # before: of the open group; after: open again
            held.append(members[: mine[0]])
            if not closed:
                continue
            whole = np.concatenate(held)
            settle(whole, np.arange(len(whole)) == 0)
            done, label = members[mine[0] : mine[1]], groups[mine[0] : mine[1]]
            settle(done, np.diff(label, prepend=0) > 0)
            held = [members[mine[1] :]]
        whole = np.concatenate(held)
        settle(whole, np.arange(len(whole)) == 0)
        del valid, held
        n = size[put] - length + 1
        place, own = ranges(np.zeros(len(n), np.int64), n), np.repeat(np.arange(len(n)), n)
        owner = first[place + head[own]]
        del first
        new = (place == 0) | (np.diff(owner, prepend=0) != 0)
        a = np.flatnonzero(new)
        own, begin, end, owner = put[own[a]], place[a], place[np.append(a[1:], len(place))[: len(a)] - 1] + 1, owner[a]
        # All windows of a snippet that is not sorted belong to its own documents alone.
        rest = np.flatnonzero(~akin)
        own, owner = np.append(own, rest), np.append(owner, low[rest])
        begin, end = np.append(begin, np.zeros(len(rest), np.int64)), np.append(end, size[rest] - length + 1)
        by = np.argsort(own, kind="stable")
        own, begin, end, owner = own[by], begin[by], end[by], owner[by]
        good = owner < high[own]
        own, begin, end, owner = own[good], begin[good], end[good], owner[good]
        edge = np.searchsorted(own, np.arange(len(size) + 1))
        out, at = [], 0
        for grp, part, mine in zip(group["grp"].to_pylist(), group["part"].to_pylist(), group["sizes"].to_pylist()):
            mine = np.arange(at, at + len(mine) // 8)
            at += len(mine)
            runs = edge[kind[mine] + 1] - edge[kind[mine]]
            spot, entry = ranges(edge[kind[mine]], runs), np.repeat(mine, runs)
            good = owner[spot] < most[entry]
            spot, entry = spot[good], entry[good]
            if len(spot):
                out.append((grp, part, (entry - mine[0]).tobytes(), begin[spot].tobytes(), end[spot].tobytes(), owner[spot].tobytes()))
        return _table(out, _arrow(COVERED))

    return snippets.groupBy("part").applyInArrow(run, COVERED)


def repeated_bytes(docs: DataFrame, length: int = 50, limit: int = 256 << 20) -> DataFrame:
    """Bytes covered by a string of ``length`` bytes that also starts in a document with a smaller id.

    ``docs(doc_id bigint, text)``. Returns one row per input row: ``doc_id, n_bytes, n_removed, starts,
    ends, kept_sha256``; starts and ends (exclusive) are the maximal removed byte ranges.
    """
    groups, parts = parts_for(docs, "text", GROUP_BYTES), parts_for(docs, "text", PART_BYTES)
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("grp")
    )
    known = docs.where("doc_id IS NOT NULL")
    digests = known.select("doc_id", "grp", F.md5("text").alias("digest"), F.octet_length("text").alias("size")).where(f"size >= {length}")
    owners = digests.groupBy("digest", "size").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    copies = staged(
        digests.join(owners, ["digest", "size"]).where("doc_id > least").select("grp", F.col("doc_id").alias("copy"), "digest").distinct(),
        "suffix-copies",
    )
    seeds = staged(repeated(_sent(known, length, parts)), "suffix-seeds")
    side = seeds.unionByName(copies, allowMissingColumns=True)
    covered = staged(_covered(_snippets(known, side, length, parts), length, limit), "suffix-covered")
    side = side.unionByName(covered, allowMissingColumns=True)

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept_sha256", pa.string())]
        )
        if not group.num_rows:
            return _table([], schema)
        group, copy, row, starts, count, kind, distinct, part = _own(group, answers, length, parts)
        ids = group["doc_id"].to_pylist()
        told = [x for x in answers.select(["part", "at", "begins", "ends", "owners"]).to_pylist() if x["part"] is not None]
        column = lambda name: np.concatenate([np.frombuffer(x[name], np.int64) for x in told] or [np.zeros(0, np.int64)])
        begin, end, owner = column("begins"), column("ends"), column("owners")
        order = np.argsort(part, kind="stable")
        base = np.searchsorted(part[order], np.array([x["part"] for x in told], np.int64))
        of = order[np.repeat(base, [len(x["at"]) // 8 for x in told]) + column("at")] if told else column("at")
        by = np.argsort(of, kind="stable")
        begin, end, owner = begin[by], end[by], owner[by]
        edge = np.searchsorted(of[by], np.arange(len(distinct) + 1))
        # Each occurrence of a snippet: runs of windows whose string starts in a smaller document.
        runs = edge[kind + 1] - edge[kind]
        spot, at = ranges(edge[kind], runs), np.repeat(np.arange(len(kind)), runs)
        doc = np.array([0 if x is None else x for x in ids], np.int64)
        good = owner[spot] < doc[row[at]]
        spot, at = spot[good], at[good]
        row, starts, ends = row[at], starts[at] + begin[spot], starts[at] + end[spot] - 1 + length
        edge = np.searchsorted(row, np.arange(len(ids) + 1))
        out = []
        for k, (own, text) in enumerate(zip(ids, group["text"].to_pylist())):
            body = np.frombuffer((text or "").encode(), np.uint8)
            gone = np.zeros(len(body) + 1, np.int32)
            if copy[k]:
                gone[0] = 1
            else:
                np.add.at(gone, starts[edge[k] : edge[k + 1]], 1)
                np.add.at(gone, ends[edge[k] : edge[k + 1]], -1)
            gone = np.cumsum(gone[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            kept = hashlib.sha256(body[~gone].tobytes()).hexdigest()
            out.append((own, len(body), int(gone.sum()), edges[::2], edges[1::2], kept))
        return _table(out, schema)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, starts array<bigint>, ends array<bigint>, kept_sha256 string"
    return docs.groupBy("grp").cogroup(side.groupBy("grp")).applyInArrow(run, schema)
