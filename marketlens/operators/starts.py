"""Listed strings found at any place of whole texts.

The list is a trie whose steps are eight bytes: every depth has a sorted table of the steps that
are taken there, and all places of a piece of text are looked up together. Strings that share a
start are not met one by one, so the cost of a place grows slowly with the list. UTF-8 is searched
as bytes: a string stands in a text where its bytes stand.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

STEP = 8
WINDOW = 1 << 18         # places looked at together
SLICE_BYTES = 1_000_000  # bytes of text whose finds leave together; a longer text is a slice of its own
MASKS = np.array([(1 << 8 * n) - 1 for n in range(STEP + 1)], np.uint64)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its texts; a null text is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece has about ``SLICE_BYTES`` of text."""
    for batch in batches:
        ends, start = byte_column(batch.column(column))[1], 0
        while start < batch.num_rows:
            stop = max(int(np.searchsorted(ends, ends[start] + SLICE_BYTES, "right")) - 1, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


class Sieve:
    """Tells most values that are not of a set apart, one byte read for each."""

    def __init__(self, values: np.ndarray):
        bits = min(max(16 * len(values), 1 << 16).bit_length(), 24)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self._cells(values)] = True

    def _cells(self, values: np.ndarray) -> np.ndarray:
        return ((values * SPREAD) >> self.shift).view(np.int64)

    def passed(self, values: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.table[self._cells(values)])


class Steps(NamedTuple):
    """Steps of one length at one depth; ``pairs`` are node * len(values) + place in ``values``."""

    values: np.ndarray
    pairs: np.ndarray
    listed: np.ndarray  # the string that ends with the step, or -1
    child: np.ndarray   # the node that the step leads to, or -1

    def taken(self, node: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the given (node, value) are steps, and which steps they are."""
        place = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
        known = np.flatnonzero(self.values[place] == value)
        pair = node[known] * len(self.values) + place[known]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        same = self.pairs[at] == pair
        return known[same], at[same]


class Starts:
    """Different strings that are not empty."""

    def __init__(self, listed: pa.Array):
        self.listed = listed
        data, offsets = byte_column(listed)
        first, self.length = offsets[:-1], np.diff(offsets)
        padded = np.append(data, np.zeros(STEP, np.uint8))
        node, live = np.zeros(len(listed), np.int64), np.flatnonzero(self.length > 0)
        self.depths: list[dict[int, Steps]] = []
        while len(live):
            left = self.length[live] - STEP * len(self.depths)
            size = np.minimum(left, STEP)
            value = _eight(padded, first[live] + STEP * len(self.depths)) & MASKS[size]
            self.depths.append({})
            for n in np.unique(size).tolist():
                own = np.flatnonzero(size == n)
                values, place = np.unique(value[own], return_inverse=True)
                pairs, place = np.unique(node[live[own]] * len(values) + place, return_inverse=True)
                ends, child = np.full(len(pairs), -1), np.full(len(pairs), -1)
                ends[place[left[own] == n]] = live[own[left[own] == n]]
                further = np.unique(place[left[own] > n])
                child[further] = np.arange(len(further))
                node[live[own]] = child[place]
                self.depths[-1][n] = Steps(values, pairs, ends, child)
            live = live[left > STEP]
        if self.depths:
            top = self.depths[0]
            self.least = min(top)
            self.front = Sieve(np.unique(np.concatenate([s.values for s in top.values()]) & MASKS[self.least]))
            self.sieves = {n: Sieve(s.values) for n, s in top.items()}

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of texts and of listed strings that stand in them, each pair once."""
        found, reach = [np.zeros(0, np.int64)], STEP * (len(self.depths) + 1)
        for a in range(0, len(data) if self.depths else 0, WINDOW):
            n = min(WINDOW, len(data) - a)
            piece = data[a : a + n + reach]
            piece = np.append(piece, np.zeros(n + reach - len(piece), np.uint8))
            for places, listed in self._hits(piece, n):
                row = np.searchsorted(offsets, places + a, "right") - 1
                whole = places + a + self.length[listed] <= offsets[row + 1]
                found.append(np.unique(row[whole] * len(self.length) + listed[whole]))
        pairs = np.unique(np.concatenate(found))
        return np.divmod(pairs, max(1, len(self.length)))

    def _hits(self, piece: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places among the first n, and strings whose bytes stand there."""
        value = np.ndarray(n, "<u8", piece, strides=(1,)).copy()
        places = self.front.passed(value & MASKS[self.least])
        value, node = value[places], np.zeros(len(places), np.int64)
        for depth, steps in enumerate(self.depths):
            further = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for n, own in steps.items():
                short = value & MASKS[n]
                likely = np.arange(len(short)) if depth else self.sieves[n].passed(short)
                taken, at = own.taken(node[likely], short[likely])
                taken = likely[taken]
                ends, child = own.listed[at], own.child[at]
                yield places[taken[ends >= 0]], ends[ends >= 0]
                if n == STEP:
                    further = places[taken[child >= 0]], child[child >= 0]
            places, node = further
            if not len(places):
                return
            value = _eight(piece, places + STEP * (depth + 1))


def _eight(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number."""
    return data[places[:, None] + np.arange(STEP)].view("<u8").ravel()
