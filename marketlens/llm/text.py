"""Text as flat byte arrays: word spans, hashes and windows for whole Arrow batches.

All separators used by the operators are ASCII, so UTF-8 can be cut at bytes. A null text
is an empty text. Work is done in slices of about ``SLICE_BYTES`` of text (a longer text is
a slice of its own), so the memory of a task depends on its longest text, not on its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1_000_000

# ASCII space and \t \n \v \f \r separate words; every other byte is part of a word.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

# Two independent polynomial hashes: an odd base each, and a random code for each byte.
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_BYTE_CODES = np.random.default_rng(20240115).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def remainder_of(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as remainder 0."""
    return F.coalesce(F.expr(f"crc32(cast({key} as string)) % {modulus}"), F.lit(0))


def text_and_key(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Only key and text, under fixed names, so that other columns can't clash."""
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece has about ``SLICE_BYTES`` of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = byte_column(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its texts."""
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=2)
def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    with np.errstate(over="ignore"):
        up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can be used alone."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


class Texts:
    """The texts of one slice as one byte array, each followed by a newline byte."""

    def __init__(self, column: pa.Array, lower: bool = False):
        data, offsets = byte_column(column)
        self.n = len(offsets) - 1
        self.data = np.insert(LOWER[data] if lower else data, offsets[1:], 10)
        self.starts = offsets[:-1] + np.arange(self.n)
        self.ends = offsets[1:] + np.arange(self.n)
        self._sums: dict[int, np.ndarray] = {}

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes that are ``inside``: starts, ends, and first run of each text."""
        mask = np.zeros(len(self.data) + 2, np.int8)
        mask[1:-1] = inside[self.data]
        mask[self.ends + 1] = 0
        step = np.diff(mask)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        return starts, ends, np.append(np.searchsorted(starts, self.starts), len(starts))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines cut at newline bytes, as ``spans``; an empty text has one empty line."""
        ends = np.flatnonzero(self.data == 10)
        starts = np.append(0, ends[:-1] + 1)
        return starts, ends, np.append(np.searchsorted(starts, self.starts), len(starts))

    def hashes(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """64-bit hash of each span's bytes; ``which`` selects one of two independent hashes."""
        up, down = _powers(1 << max(20, int(len(self.data)).bit_length()), which)
        with np.errstate(over="ignore"):
            if which not in self._sums:
                sums = np.zeros(len(self.data) + 1, np.uint64)
                np.cumsum(_BYTE_CODES[which][self.data] * up[: len(self.data)], out=sums[1:])
                self._sums[which] = sums
            return mixed((self._sums[which][ends] - self._sums[which][starts]) * down[starts])


def rows_of(firsts: np.ndarray) -> np.ndarray:
    """Text number of each element, from the first element of each text."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def windows(hashes: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width`` consecutive elements of one text: (hash, first element)."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.repeat(firsts[1:], np.diff(firsts))
    at = np.flatnonzero(np.arange(len(hashes)) + width <= last)
    found = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            found = found * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[at + k]
    return mixed(found), at


def per_text(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of the elements of each text."""
    sums = np.append(0, np.cumsum(values))
    return sums[firsts[1:]] - sums[firsts[:-1]]
