"""Shared helpers: bytes of Arrow text columns, word hashing, windows, frames of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.arrow import freed as freed  # this module also ships the code by value

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def parts_for(df: DataFrame, text: str, part_bytes: int) -> int:
    """How many parts of about ``part_bytes`` the text of a frame makes; follows the input, has no upper limit."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return 1 + int(size) // part_bytes


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return data[first : int(offsets[-1])], offsets - first


def chunks(data: np.ndarray, offsets: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``size`` bytes (``CHUNK_BYTES``): first row, row after the last, bytes, offsets."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + (size or CHUNK_BYTES), "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, value in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, value, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``values[start:end]``, equal for equal runs wherever they stand."""
        n = len(values)
        self.need(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=total[1:])
        found = (total[ends] - total[starts]) * self.down[starts]
        return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Splits texts at ASCII white space and hashes every word, without making Python strings."""

    def __init__(self, lower: bool):
        codes = np.arange(256)
        self.inside = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
        if lower:
            codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
        self.values = mix((codes + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        self.powers = Powers(0x5851F42D4C957F2D)

    def of(self, data: np.ndarray, offsets: np.ndarray):
        """Word hashes, byte start and end of each word, and each row's offsets in the words."""
        inside = self.inside[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes = self.powers.spans(self.values[data], starts, ends)
        return hashes, starts, ends, np.searchsorted(starts, offsets)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``; shorter input gives nothing."""
    if len(values) < width:
        return values[:0]
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def window_rows(offsets: np.ndarray, size: int, n: int) -> np.ndarray:
    """For each start of a run of ``size`` among ``n`` items: does it stay inside its row?"""
    ok = np.ones(max(0, n - size + 1), bool)
    for end in offsets[1:-1]:
        ok[max(0, end - size + 1) : end] = False
    return ok


def chosen(grams: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Positions whose gram is the least of any window; ``least`` is 0 for windows that do not count.

    A gram is never below the least of a window that holds it, so it is chosen exactly where the
    greatest of these equals it.
    """
    pad = np.zeros(width - 1, np.uint64)
    every = ~np.concatenate((pad, least, pad))
    return np.flatnonzero((grams == ~sliding_min(every, width)) & (grams > 0))
