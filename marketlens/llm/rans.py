"""Static range asymmetric numeral system over numpy arrays.

Symbols 0, 1, 2, ... have whole frequencies that add up to a power of two. A block's symbols are
dealt to its lanes in turn; each lane is a coder of its own, and the lanes share one stream of
32-bit words. All lanes of all blocks take a step at the same time. A block needs nothing but its
words, the lanes' last states and the table.
"""

from __future__ import annotations

import numpy as np

LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63)
WORD = np.uint64(32)


def frequencies(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies of at least 1 near the counts (each at least 1), and the bits of their sum."""
    bits = max(16, int(len(counts)).bit_length() + 4)
    if bits > 30:
        raise ValueError("too many symbols")
    room, total = (1 << bits) - len(counts), int(counts.sum())
    found = np.array([1 + int(c) * room // total for c in counts.tolist()], np.uint64)
    if len(found):
        found[np.argmax(counts)] += np.uint64((1 << bits) - int(found.sum()))
    return found, bits


class Coder:
    def __init__(self, freqs: np.ndarray, bits: int, lanes: int):
        self.freqs, self.bits, self.lanes = freqs.astype(np.uint64), np.uint64(bits), lanes
        self.lower = np.append(0, np.cumsum(self.freqs))[:-1].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freqs), dtype=np.int32), freqs.astype(np.int64))  # of each slot

    def encode(self, symbols: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of all blocks one after another, the number of words of each, and all states.

        The number of symbols must be a multiple of blocks x lanes.
        """
        table = symbols.reshape(blocks, -1, self.lanes).transpose(1, 0, 2)
        words, full = np.zeros(table.shape, np.uint32), np.zeros(table.shape, bool)
        state = np.full(table.shape[1:], LOW)
        top = self.freqs << (np.uint64(63) - self.bits)
        for n in range(len(table) - 1, -1, -1):
            step = table[n]
            f = self.freqs[step]
            full[n], words[n] = state >= top[step], state
            state = np.where(full[n], state >> WORD, state)
            turns = state // f
            state = (turns << self.bits) + (state - turns * f) + self.lower[step]
        full = full.transpose(1, 0, 2)
        return words.transpose(1, 0, 2)[full], full.sum((1, 2)), state

    def decode(self, words: np.ndarray, sizes: np.ndarray, state: np.ndarray, steps: int) -> np.ndarray:
        """Symbols of all blocks, from what ``encode`` gave."""
        out = np.zeros((steps, *state.shape), np.int32)
        at = np.append(0, np.cumsum(sizes))[:-1]
        words, slots = np.append(words, np.uint32(0)).astype(np.uint64), (np.uint64(1) << self.bits) - np.uint64(1)
        for n in range(steps):
            slot = state & slots
            step = self.symbol[slot]
            out[n] = step
            state = self.freqs[step] * (state >> self.bits) + slot - self.lower[step]
            short = state < LOW
            place = np.cumsum(short, axis=1)
            near = words[np.minimum((at[:, None] + place - 1).clip(0), len(words) - 1)]
            state = np.where(short, state << WORD | near, state)
            at = at + place[:, -1]
        return out.transpose(1, 0, 2).reshape(-1)
