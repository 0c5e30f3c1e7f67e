"""Suffix order with common prefixes of one shard by external induced sorting.

Suffixes that start a rising run after a falling one (stars) are sorted first: an induced
pass orders their substrings, equal substrings get equal names, and the string of names is
sorted by the same routine, or by prefix doubling where it fits into memory. From the
sorted stars two passes induce all others: falling suffixes upwards, then rising ones
downwards. A pass takes suffixes from a priority queue by first symbol, and puts the suffix one
position to the left back with its common prefix: one more than the least value met since the last
suffix that was put under that symbol. The queue keeps its tuples in blocks and moves
them to a file beyond its memory limit.

Common prefixes are cut at ``depth`` (at most 250), and order is only settled to that depth,
which is all that a repeat threshold needs.
"""

from __future__ import annotations

import heapq
import tempfile
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 18
LIMIT = 256 << 20


class Queue:
    """Tuples (symbol, position, common prefix) by symbol; equal symbols keep their order of arrival."""

    def __init__(self, limit: int, upwards: bool):
        self.limit, self.sign, self.held = limit, 1 if upwards else -1, 0
        self.blocks: dict[int, list] = {}
        self.heap: list[int] = []
        self.file = None

    def push(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        if symbol not in self.blocks:
            self.blocks[symbol] = []
            heapq.heappush(self.heap, self.sign * symbol)
        self.blocks[symbol].append((positions, prefixes))
        self.held += positions.nbytes + prefixes.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        end = self.file.seek(0, 2)
        for own in self.blocks.values():
            for i, block in enumerate(own):
                if len(block) == 2:
                    own[i] = (end, len(block[0]), block[0].dtype)
                    end += self.file.write(block[0].tobytes()) + self.file.write(block[1].tobytes())
        self.held = 0

    def first(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def take(self, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples of the first symbol in joined blocks; ``backwards`` gives the last block first."""
        blocks = self.blocks.pop(self.sign * heapq.heappop(self.heap))
        joined, size = [], 0
        for block in reversed(blocks) if backwards else blocks:
            joined.append(self._load(block))
            size += len(joined[-1][0])
            if size >= BLOCK:
                yield self._join(joined, backwards)
                joined, size = [], 0
        if joined:
            yield self._join(joined, backwards)

    @staticmethod
    def _join(blocks: list, backwards: bool):
        blocks = blocks[::-1] if backwards else blocks
        return blocks[0] if len(blocks) == 1 else tuple(map(np.concatenate, zip(*blocks)))

    def _load(self, block):
        if len(block) == 2:
            self.held -= block[0].nbytes + block[1].nbytes
            return block
        at, n, kind = block
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * kind.itemsize), kind), np.frombuffer(self.file.read(n), np.uint8)

    def close(self) -> None:
        if self.file:
            self.file.close()


def range_min(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least of ``values[start:end]`` for many ranges, none empty."""
    out = np.empty(len(starts), values.dtype)
    level = np.frexp((ends - starts).astype(np.float64))[1] - 1
    step, top = 0, int(level.max(initial=0))
    while True:
        own = np.flatnonzero(level == step)
        if len(own):
            out[own] = np.minimum(values[starts[own]], values[ends[own] - (1 << step)])
        if step == top:
            return out
        half = 1 << step
        values = np.minimum(values[:-half], values[half:])
        step += 1


class Carry:
    """Common prefixes of the suffixes put under a symbol, from the values of those that put them."""

    def __init__(self, depth: int):
        self.depth, self.now = depth, 0
        self.last: dict[int, tuple[int, int]] = {}  # symbol: batch of its last suffix, least value after it there
        self.times, self.least = [], []  # batches whose least value no later batch undercuts

    def _since(self, symbol: int) -> int:
        if symbol not in self.last:
            return -1
        time, value = self.last[symbol]
        at = bisect_right(self.times, time)
        return min(value, self.least[at]) if at < len(self.times) else value

    def pass_by(self, values: np.ndarray) -> None:
        """A batch ends."""
        least = int(values.min())
        while self.least and self.least[-1] >= least:
            self.least.pop()
            self.times.pop()
        self.times.append(self.now)
        self.least.append(least)
        self.now += 1

    def put(self, place: np.ndarray, cut: np.ndarray, symbols: np.ndarray, values: np.ndarray) -> np.ndarray:
        """``place``: batch places of those that put something, by symbol, ascending; ``cut``: first of each symbol."""
        before = np.empty(len(place), np.int64)
        before[1:] = place[:-1] + 1
        before[cut] = 0
        out = range_min(values, before, place + 1).astype(np.int16)
        tail = np.append(np.minimum.accumulate(values[::-1])[::-1], np.uint8(255))
        last = place[np.append(cut[1:], len(place)) - 1] + 1
        for a, symbol, rest in zip(cut, symbols.tolist(), tail[last].tolist()):
            out[a] = min(int(out[a]), self._since(symbol))
            self.last[symbol] = (self.now, rest)
        return np.minimum(out + 1, self.depth).astype(np.uint8)


class Text:
    def __init__(self, symbols: np.ndarray):
        self.symbols, self.n = symbols, len(symbols)
        self.kind = np.int32 if self.n < 1 << 31 else np.int64
        self.words = None
        if symbols.dtype == np.uint8:
            padded = np.concatenate((symbols, np.zeros(16, np.uint8)))
            self.words = np.ndarray((self.n + 8,), np.uint64, padded, strides=(1,))

    def prefixes(self, a: np.ndarray, b: np.ndarray, cap: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes ``a[i]`` and ``b[i]``, at most ``cap[i]``."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        cap = np.minimum(cap, self.n - np.maximum(a, b))
        out, live, done = cap.astype(np.int64), np.arange(len(a)), 0
        view, step = (self.symbols, 1) if self.words is None else (self.words, 8)
        while len(live):
            live = live[cap[live] > done]
            x, y = view[a[live] + done], view[b[live] + done]
            off = np.flatnonzero(x != y)
            found = np.full(len(off), done, np.int64)
            if step == 8 and len(off):
                low = x[off] ^ y[off]
                low &= ~low + np.uint64(1)
                found += np.frexp(low.astype(np.float64))[1].astype(np.int64) - 1 >> 3
            out[live[off]] = np.minimum(cap[live[off]], found)
            live = live[x == y]
            done += step
        return out

    def stars(self) -> np.ndarray:
        """Starts of rising runs after falling symbols; the end of the text is least, so its last suffix falls."""
        t = self.symbols
        turn = np.flatnonzero(t[1:] != t[:-1])  # last symbol of each run of equal ones but the last
        up = np.concatenate((t[turn + 1] > t[turn], [False]))
        return (turn[:-1] + 1)[up[1:-1] & ~up[:-2]].astype(self.kind) if len(turn) > 1 else np.zeros(0, self.kind)


def induce(text: Text, stars: np.ndarray, values: np.ndarray | None, depth: int, limit: int) -> Iterator[tuple]:
    """All suffixes from sorted stars, in descending order: blocks of positions, and of common prefixes with the
    suffix before. ``values``: common prefixes of the stars with the star before, None to leave them out."""
    t = text.symbols
    kept = Queue(limit, upwards=False)

    def run(queue, carry, symbol, positions, common, good):
        """Put the suffixes left of a block where ``good(left symbol)`` holds."""
        here = np.flatnonzero(positions > 0)
        heads = t[positions[here] - 1]
        own = good(heads)
        here, heads = here[own], heads[own]
        if len(here):
            order = np.argsort(heads, kind="stable")
            heads, here = heads[order], here[order]
            cut = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
            moved = positions[here] - 1
            symbols = heads[cut]
            new = carry.put(here, cut, symbols, common) if carry else np.zeros(len(here), np.uint8)
            for key, a, b in zip(symbols.tolist(), cut.tolist(), np.append(cut[1:], len(here)).tolist()):
                queue.push(key, moved[a:b], new[a:b])
        if carry and len(common):
            carry.pass_by(common)

    queue, carry = Queue(limit, upwards=True), None if values is None else Carry(depth)
    last = int(t[-1])
    queue.push(last, np.array([text.n - 1], text.kind), np.zeros(1, np.uint8))
    if carry:
        carry.last[last] = (-1, 0)
    heads = t[stars]
    cut = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1]))) if len(stars) else []
    waiting = [(int(heads[a]), a, b) for a, b in zip(cut, np.append(cut[1:], len(stars)))][::-1] if len(stars) else []
    highest = -1  # the largest falling suffix so far
    while queue.heap or waiting:
        symbol = queue.first()
        if symbol is not None and (not waiting or symbol <= waiting[-1][0]):
            for positions, common in queue.take():
                kept.push(symbol, positions, common)
                highest = int(positions[-1])
                run(queue, carry, symbol, positions, common, lambda left: left >= symbol)
        else:
            symbol, a, b = waiting.pop()
            for i in range(a, b, BLOCK):
                own = stars[i : min(b, i + BLOCK)]
                common = np.zeros(len(own), np.uint8) if values is None else values[i : i + len(own)].copy()
                if i == a and values is not None:
                    common[0] = 0
                    if highest >= 0 and t[highest] == symbol:
                        common[0] = text.prefixes(own[:1], np.array([highest]), np.array([depth]))[0]
                run(queue, carry, symbol, own, common, lambda left: left > symbol)
    queue.close()

    queue, carry, smallest, edge = Queue(limit, upwards=False), None if values is None else Carry(depth), -1, 0
    while queue.heap or kept.heap:
        symbol = queue.first()
        if symbol is not None and (not kept.heap or symbol >= kept.first()):
            for positions, common in queue.take():
                smallest = int(positions[-1])
                yield positions, common
                run(queue, carry, symbol, positions, common, lambda left: left <= symbol)
        else:
            symbol = kept.first()
            for positions, common in kept.take(backwards=True):
                # Values turn from the suffix below to the one above; ``edge`` is that of the block above.
                turned = np.empty(len(common), np.uint8)
                turned[1:] = common[:0:-1]
                turned[0] = edge
                if smallest >= 0:
                    turned[0] = 0
                    if values is not None and t[smallest] == symbol:
                        turned[0] = text.prefixes(positions[-1:], np.array([smallest]), np.array([depth]))[0]
                    smallest = -1
                edge = int(common[0])
                positions = positions[::-1]
                yield positions, turned
                run(queue, carry, symbol, positions, turned, lambda left: left < symbol)
            edge = 0
    queue.close()
    kept.close()


def _doubled(order: np.ndarray, name: np.ndarray, reach: int) -> np.ndarray:
    """Order of the suffixes of a string of names, settled to ``reach`` names, by prefix doubling in memory.

    ``order`` has them by first name, ``name`` those names. Only groups of equals are sorted again.
    """
    n, have = len(order), 1
    order, rank = order.copy(), np.empty(n, np.int64)
    new = np.concatenate(([True], name[1:] != name[:-1]))
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    while have < reach:
        alone = new & np.append(new[1:], True)
        slots = slots[~alone]
        if not len(slots):
            break
        items = order[slots]
        key = rank[items] * (n + 2)
        inside = items + have < n
        key[inside] += rank[items[inside] + have] + 1
        again = np.argsort(key, kind="stable")
        key, items = key[again], items[again]
        order[slots] = items
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[items] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        have *= 2
    return order


def sorted_stars(text: Text, depth: int, limit: int) -> np.ndarray:
    """Starred suffixes in order, settled to ``depth`` symbols."""
    stars = text.stars()
    if len(stars) < 2:
        return stars
    first = stars[np.argsort(text.symbols[stars], kind="stable")]
    starred = np.zeros(text.n, bool)
    starred[stars] = True
    order = np.concatenate([p[starred[p]] for p, _ in induce(text, first, None, depth, limit)])[::-1]
    index = np.cumsum(starred, dtype=text.kind)
    at = index[order].astype(np.int64) - 1
    length = np.append(np.diff(stars.astype(np.int64)) + 1, 0)[at]  # 0: runs to the end, equal to none
    a, b, cap = order[:-1], order[1:], length[:-1]
    same = (cap == length[1:]) & (cap > 0)
    same[same] = text.prefixes(a[same], b[same], cap[same]) >= cap[same]
    name = np.concatenate(([0], np.cumsum(~same)))
    if not same.any():
        return order
    reach = -(-depth // 2) + 1  # a starred substring has two symbols before the next one at least
    if len(stars) * 40 <= limit:
        return stars[_doubled(at, name, reach)]
    names = np.empty(len(stars), np.int64)
    names[at] = name
    inner = Text(names)
    found = sorted_stars(inner, reach, limit)
    return stars[np.concatenate([p for p, _ in induce(inner, found, None, reach, limit)])[::-1]]


def suffixes(symbols: np.ndarray, depth: int, limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of a byte string in descending order: blocks of positions, and of common prefixes with the
    suffix before (the next larger one), cut at ``depth``. Order is settled to ``depth`` bytes."""
    if not 0 < depth <= 250:
        raise ValueError("depth must be from 1 to 250")
    if not len(symbols):
        return
    text = Text(symbols)
    stars = sorted_stars(text, depth, limit)
    values = np.zeros(len(stars), np.uint8)
    if len(stars) > 1:
        values[1:] = text.prefixes(stars[1:], stars[:-1], np.full(len(stars) - 1, depth))
    yield from induce(text, stars, values, depth, limit)
