"""Periodic runs of words, found with a dictionary of basic factors.

For every power of two the factors (word sequences) of that length get names, the same name for
the same words of one text; a factor's name comes from the names of its halves. Where a factor
begins again no further away than its own length, its occurrences form an arithmetic progression,
and the step to the next one proposes a period. A period p is proposed at the least length that
is not below it only, so no run is found under two lengths. There, a factor that begins again
after p words and not before says that p is the least period, and neighbours that say the same
belong to one run: joining them extends the run as far as it goes, to both sides.

Every run of three turns or more holds such a factor, so the result is exact, but for words with
equal 64-bit hashes. Factors that a text holds once are dropped from the longer lengths: they are
part of no run of a longer period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlens.llm.text import SPACES, Texts, mixed, rows_of, slices, text_and_key

MIN_WORDS = 24
MIN_TURNS = 3

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _joined(at: np.ndarray, step: np.ndarray, length: int) -> np.ndarray:
    """Runs (start, length, period) of neighbouring factors that begin again after ``step``."""
    order = np.lexsort((at, step))
    at, step = at[order], step[order]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (step[1:] != step[:-1]))[: len(at)])
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return np.stack([at[first], at[last] - at[first] + length + step[first], step[first]], axis=1)


def runs_of(hashes: np.ndarray, firsts: np.ndarray, min_words: int = MIN_WORDS, min_turns: int = MIN_TURNS) -> np.ndarray:
    """Maximal runs of all texts: rows (start, length, period), by start and period.

    ``hashes`` are the words of all texts, ``firsts`` the first word of each; starts are places
    in ``hashes``. A run's period is its least, its length at least ``min_words`` and
    ``min_turns`` periods; ``min_turns`` must be 3 or more.
    """
    if min_turns < 3:
        raise ValueError("min_turns must be 3 or more")
    ends = np.repeat(firsts[1:], np.diff(firsts))
    name, at, length, found = np.full(len(hashes), -1), np.arange(len(hashes)), 1, [np.zeros((0, 3), np.int64)]
    longest = int(np.diff(firsts).max(initial=0))
    with np.errstate(over="ignore"):
        keys = mixed(hashes + rows_of(firsts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    while len(at) and min_turns * (length // 2 + 1) <= longest:
        order = np.argsort(keys, kind="stable")
        place = at[order]
        same = keys[order[1:]] == keys[order[:-1]]
        step = np.diff(place)
        near = same & (step <= length) & (2 * step > length)
        found.append(_joined(place[:-1][near], step[near], length))
        again = np.append(same, False) | np.append(False, same)
        name[at] = -1
        name[place[again]] = np.append(0, np.cumsum(~same))[again]
        at = np.sort(place[again])
        at = at[at + 2 * length <= ends[at]]
        at = at[name[at + length] >= 0]
        keys = name[at].astype(np.uint64) << np.uint64(32) | name[at + length].astype(np.uint64)
        length *= 2
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= np.maximum(min_words, min_turns * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """False for the words that any run repeats, which are those after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """The words of each text, joined by one space."""
    last = np.zeros(len(starts), bool)
    last[firsts[1:][np.diff(firsts) > 0] - 1] = True
    sizes = ends - starts + ~last  # with the byte after the word, where a space will be
    total = np.append(0, np.cumsum(sizes))
    out = data[np.repeat(starts - total[:-1], sizes) + np.arange(total[-1])]
    out[total[1:][~last] - 1] = 0x20
    return pa.Array.from_buffers(pa.large_string(), len(firsts) - 1, [None, pa.py_buffer(total[firsts]), pa.py_buffer(out)]).cast(pa.string())


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, min_turns: int = MIN_TURNS) -> DataFrame:
    """Runs of every text and the text without their repeats: (key, n_words, runs, collapsed).

    ``runs`` are (start, length, period) in words, by start and period; words are separated by
    ASCII white space. ``collapsed`` keeps the first period of each run and all words outside
    runs, joined by one space. One row for each input row, repeated and null keys included; a
    null text is an empty one, without words and runs. Other columns are not read. A text is
    worked on by itself, so a task's memory depends on its longest text.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            starts, ends, firsts = texts.spans(~SPACES)
            runs = runs_of(texts.hashes(starts, ends), firsts, min_words, min_turns)
            keep = np.flatnonzero(kept_words(len(starts), runs))
            places = np.searchsorted(runs[:, 0], firsts)
            own = runs[:, 0] - firsts[np.searchsorted(firsts, runs[:, 0], "right") - 1] if len(runs) else runs[:, 0]
            listed = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (own, runs[:, 1], runs[:, 2])], RUN.names)
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), pa.array(np.diff(firsts), pa.int64()), pa.ListArray.from_arrays(pa.array(places, pa.int32()), listed),
                _spelled(texts.data, starts[keep], ends[keep], np.searchsorted(keep, firsts))], names=schema.names)

    return text_and_key(docs, key, text).mapInArrow(run, schema)
