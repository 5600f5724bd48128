"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Words are maximal runs of letters, of digits, or of other signs. Each text gives four
groups of features, hashed into one weight table: words, word pairs, and pairs and triples
of word shapes (lower case, capitals, number, sign, the same word again). A feature's value
is its share of the text's words, so the score of a text is a sparse dot product of its
hashed counts, whatever its length.

Training is spread over shards of a bounded sample: each task runs the updates over its own
shard, and the weights are averaged by shard size in Spark. Only the mean, whose size is fixed,
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.fitting import sigmoid
from marketlens.llm.text import Texts, per_text, slices, text_and_key, windows

BITS = 18
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.002, 0.01
EPOCHS = 6
ROWS_PER_SHARD = 1_000
MAX_ROWS = 16_000  # labelled rows that training reads at most

_ROWS = (1 << BITS) + 1  # in place of a cell: the number of rows learned from
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[0, 0x20, *range(9, 14)]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of each text: table cells, first cell of each text, words of each text."""
    raw, low = Texts(column), Texts(column, lower=True)
    kind = _KIND[low.data]
    change = np.flatnonzero(np.diff(kind, prepend=_SPACE, append=_SPACE))
    starts, ends = change[:-1], change[1:]
    if len(starts):
        inside = kind[starts] != _SPACE
        starts, ends = starts[inside], ends[inside]
    firsts = np.append(np.searchsorted(starts, low.starts), len(starts))
    words = low.hashes(starts, ends)
    # Capital letters: A-Z, and the two-byte capitals of Latin-1.
    capital = (raw.data >= 0x41) & (raw.data <= 0x5A)
    capital[1:] |= (raw.data[:-1] == 0xC3) & (raw.data[1:] >= 0x80) & (raw.data[1:] <= 0x9E)
    shape = np.zeros(len(starts), np.uint64)
    if len(starts):
        sums = np.append(0, np.cumsum(capital))
        n_capital = sums[ends] - sums[starts]
        letters = np.append(0, np.cumsum((low.data & 0xC0) != 0x80))
        n_letters = letters[ends] - letters[starts]
        of = kind[starts]
        shape = np.where(of == _SIGN, words, of.astype(np.uint64))
        shape[(of == _LETTER) & (n_capital > 0)] = 11
        shape[(of == _LETTER) & (n_capital == n_letters) & (n_letters > 1)] = 12
        same = np.zeros(len(starts), bool)
        same[1:] = words[1:] == words[:-1]
        same[2:] |= words[2:] == words[:-2]
        same[firsts[:-1][firsts[:-1] < len(starts)]] = False
        shape[same & (of == _LETTER)] += np.uint64(20)
    found = []
    for n, (values, width) in enumerate(((words, 1), (words, 2), (shape, 2), (shape, 3))):
        hashed, at = windows(values + np.uint64(1000 * n), firsts, width)
        found.append((hashed >> np.uint64(64 - BITS), np.searchsorted(firsts, at, "right") - 1))
    cells, rows = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(rows, kind="stable")
    return cells[order].astype(np.int32), np.append(0, np.cumsum(np.bincount(rows, minlength=low.n))), np.diff(firsts)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over sparse rows (cells, values); the last cell is the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for (cells, values), y in zip(rows, labels, strict=True):
            w = weights(cells)
            g = (sigmoid(w @ values) - y) * values
            sigma = (np.sqrt(n[cells] + g * g) - np.sqrt(n[cells])) / ALPHA
            z[cells] += g - sigma * w
            n[cells] += g * g
    return weights(np.arange(len(z))).astype(np.float32)


def fit(sample: DataFrame) -> np.ndarray:
    """Weight table from (key, text, label); without rows, all weights are 0."""
    shards = max(1, -(-sample.select(F.count("*")).first()[0] // ROWS_PER_SHARD))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in slices(batches):
            cells, firsts, words = features(batch.column("text"))
            for k in range(batch.num_rows):
                own, counts = np.unique(cells[firsts[k] : firsts[k + 1]], return_counts=True)
                rows.append((np.append(own, 1 << BITS).astype(np.int32), np.append(counts / max(1, words[k]), 1.0).astype(np.float32)))
            labels += batch.column("label").to_pylist()
        if rows:
            found = ftrl(rows, np.array(labels))
            cells = np.append(np.flatnonzero(found), _ROWS)
            values = np.append(found, len(rows))[np.append(cells[:-1], len(found))]
            values[:-1] *= len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(values.astype(np.float64))], names=["cell", "value"])

    spread = sample.repartition(shards, F.xxhash64("key")).sortWithinPartitions(F.xxhash64("key", "text"))
    # Spark adds up the shards; one row for each cell that is not 0 reaches the driver.
    sums = spread.mapInArrow(train, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros((1 << BITS) + 2)
    total[sums.column("cell").to_numpy()] = sums.column("value").to_numpy()
    return (total[:-1] / max(1.0, total[_ROWS])).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): the probability of label 1 for every row.

    One row for each input row, repeated and null keys included. A null or empty text has no
    features and gets the score of the bias alone. Other columns are not read.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cells, firsts, words = features(batch.column("text"))
            found = sigmoid(per_text(weights[cells].astype(np.float64), firsts) / np.maximum(1, words) + float(weights[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found)], names=[key, "score"])

    return text_and_key(docs, key, text).mapInArrow(run, schema)
