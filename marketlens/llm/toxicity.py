"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (with word borders), held
in a hashed table, so a misspelling nobody has seen shares most vectors with the word meant.
A bag is the set of ``WINDOW`` consecutive words; its vector is the mean of their vectors (a
repeated or missing word counts as a zero vector) and goes into a softmax of two classes. A text is as toxic as its most toxic bag, so length does not
dilute a few words. Embeddings and softmax are trained together in numpy: first every bag
learns its text's label, then only the highest bag of each text does. A final logistic step
maps the highest bag to a probability; it is fitted on texts that the model at hand has not
learned from, as each half of the sample is scored by a model of the other half.

For scoring, the softmax of two classes needs only the difference of its two rows, so each
table row is folded into one number and a text's score is a sum of table look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.fitting import labelled_sample, sigmoid
from marketlens.llm.text import Texts, mixed, slices, text_and_key

BITS, WIDTH = 16, 8
GRAMS = (3, 4, 5)
WINDOW = 3
EPOCHS, LAST_EPOCHS, RATE = 4, 12, 0.1
BATCH_WORDS = 20_000
MAX_ROWS = 2_000  # labelled rows of each class that training reads at most
MAX_BYTES = 30_000_000  # of all their texts together

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)]] = True


def bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words and subwords of all texts.

    Returns the cells of the distinct words, the first cell of each distinct word, the distinct
    word at each place, and the first place of each text. The whole word is no subword of its own,
    so what is learned about it is learned by its parts.
    """
    texts = Texts(column, lower=True)
    starts, ends, firsts = texts.spans(_IN_WORD)
    _, place, word = np.unique(texts.hashes(starts, ends), return_index=True, return_inverse=True)
    starts, ends = starts[place], ends[place]
    # N-grams over the word with one border byte (0) before and after it: byte b is at b + 1.
    padded = np.concatenate(([0], np.where(_IN_WORD[texts.data], texts.data, 0))).astype(np.uint64)
    cells, owners = [], []
    for n in GRAMS:
        counts = np.maximum(0, ends - starts + 3 - n)
        sums = np.append(0, np.cumsum(counts))
        at = np.repeat(starts - sums[:-1], counts) + np.arange(sums[-1])
        gram = np.full(len(at), n, np.uint64)
        for k in range(n):
            gram = gram << np.uint64(8) | padded[at + k]
        cells.append(mixed(gram))
        owners.append(np.repeat(np.arange(len(starts)), counts))
    owner, cell = np.concatenate(owners), np.concatenate(cells) >> np.uint64(64 - BITS)
    order = np.argsort(owner, kind="stable")
    return cell[order].astype(np.int32), np.append(0, np.cumsum(np.bincount(owner, minlength=len(starts)))), word, firsts


def dealt(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deal the places of each text to bags of ``WINDOW`` in a row; a bag has each word once.

    Returns the words of all bags, the first word of each bag, and the first bag of each text.
    """
    counts = -(-np.diff(firsts) // WINDOW)
    text_bags = np.append(0, np.cumsum(counts))
    at = np.arange(len(words)) - np.repeat(firsts[:-1], np.diff(firsts))
    bag = np.repeat(text_bags[:-1], np.diff(firsts)) + at // WINDOW
    size = int(words.max()) + 1 if len(words) else 1
    pairs = np.unique(bag * size + words)
    return pairs % size, np.searchsorted(pairs, np.arange(text_bags[-1] + 1) * size), text_bags


def sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of each segment of rows; an empty segment has sum 0."""
    found = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
    return found[firsts[1:]] - found[firsts[:-1]]


def means(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Mean of each segment of rows; an empty segment has mean 0."""
    return sums(values, firsts) / np.maximum(1, np.diff(firsts)).reshape(-1, *[1] * (values.ndim - 1))


def highest(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Index of the largest value of each segment; -1 for an empty one."""
    order = np.lexsort((values, np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))))
    return np.where(np.diff(firsts) > 0, order[np.maximum(firsts[1:] - 1, 0)] if len(order) else 0, -1)


class Model:
    """Subword table (cells x WIDTH) and softmax (2 x WIDTH, 2 biases), learned by Adagrad."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.3, (1 << BITS, WIDTH))
        self.out = rng.normal(0, 0.3, (2, WIDTH))
        self.bias = np.zeros(2)
        self.seen = [np.full(x.shape, 1e-4) for x in (self.table, self.out, self.bias)]

    def folded(self) -> tuple[np.ndarray, float]:
        """Log-odds added by each cell, and the bias."""
        return self.table @ (self.out[1] - self.out[0]), float(self.bias[1] - self.bias[0])

    def step(self, cells: np.ndarray, cell_firsts: np.ndarray, words: np.ndarray, bag_firsts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """One update from bags; ``words`` are the places' words, cells those of all words."""
        seen, words = np.unique(words, return_inverse=True)
        cells, cell_firsts = _rows(cells, cell_firsts, seen)
        hidden = sums(means(self.table[cells], cell_firsts)[words], bag_firsts) / WINDOW
        logits = hidden @ self.out.T + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(labels)), labels] -= 1
        p *= weights[:, None]
        to_out, to_bias = p.T @ hidden, p.sum(0)
        sizes = np.diff(bag_firsts)
        to_places = np.repeat(p @ self.out / WINDOW, sizes, axis=0)
        to_words = summed(words, to_places, len(seen)) / np.maximum(1, np.diff(cell_firsts))[:, None]
        own, where = np.unique(cells, return_inverse=True)
        to_table = summed(where, np.repeat(to_words, np.diff(cell_firsts), axis=0), len(own))
        self.seen[0][own] += to_table**2
        self.table[own] -= RATE * to_table / np.sqrt(self.seen[0][own])
        for k, (at, to) in enumerate(((self.out, to_out), (self.bias, to_bias)), 1):
            self.seen[k] += to**2
            at -= RATE * to / np.sqrt(self.seen[k])


def summed(groups: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each group."""
    return np.stack([np.bincount(groups, rows[:, d], n) for d in range(rows.shape[1])], axis=1)


def _rows(cells: np.ndarray, firsts: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The picked segments one after another: values and their new firsts."""
    lengths = firsts[picked + 1] - firsts[picked]
    ends = np.append(0, np.cumsum(lengths))
    return cells[np.repeat(firsts[picked] - ends[:-1], lengths) + np.arange(ends[-1])], ends


def embed(bagged: tuple, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Folded table and bias, learned from the bags of all texts."""
    cells, cell_firsts, words, bag_firsts, text_bags = bagged
    model, rng = Model(), np.random.default_rng(11)
    bag_labels = np.repeat(labels, np.diff(text_bags))
    balance = 0.5 / np.maximum(1e-9, np.bincount(labels, minlength=2) / len(labels))

    def learn(picked: np.ndarray, passes: int, steps: int) -> None:
        """Go over the bags ``passes`` times, more often if that would be under ``steps`` updates."""
        batches = max(8, len(picked) * WINDOW // BATCH_WORDS)
        for _ in range(max(passes, steps // batches)):
            for part in np.array_split(rng.permutation(picked), batches):
                if len(part):
                    own, own_firsts = _rows(words, bag_firsts, part)
                    model.step(cells, cell_firsts, own, own_firsts, bag_labels[part], balance[bag_labels[part]])

    learn(np.arange(len(bag_labels)), EPOCHS, 200)
    for _ in range(LAST_EPOCHS):
        picked = highest(bag_scores(bagged, *model.folded()), text_bags)
        learn(picked[picked >= 0], 1, 40)
    return model.folded()


def bag_scores(bagged: tuple, table: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds of every bag."""
    cells, cell_firsts, words, bag_firsts, _ = bagged
    return sums(means(table[cells], cell_firsts)[words], bag_firsts) / WINDOW + bias


def bagged_texts(column: pa.Array) -> tuple:
    cells, cell_firsts, words, firsts = bags(column)
    return cells, cell_firsts, *dealt(words, firsts)


def highest_scores(bagged: tuple, table: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds of each text's highest bag; 0 for a text without words."""
    found, text_bags = bag_scores(bagged, table, bias), bagged[-1]
    best, full = np.zeros(len(text_bags) - 1), np.diff(text_bags) > 0
    if full.any():
        best[full] = np.maximum.reduceat(found, text_bags[:-1][full])
    return best


def train(column: pa.Array, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """Folded table and bias, slope and intercept of the last logistic step.

    ``weights`` restore the natural shares of the classes in the last step.
    """
    half = np.zeros(len(labels), bool)
    for label in (0, 1):
        half[np.flatnonzero(labels == label)[::2]] = True
    x = np.zeros(len(labels))
    for own in (half, ~half):
        if len(set(labels[~own])) == 2:
            x[own] = highest_scores(bagged_texts(column.filter(pa.array(own))), *embed(bagged_texts(column.filter(pa.array(~own))), labels[~own]))
    bagged = bagged_texts(column)
    table, bias = embed(bagged, labels)
    if not x.any():  # too few rows of a label for halves
        x = highest_scores(bagged, table, bias)
    # Newton steps of a logistic regression on (score, 1), slightly held back.
    basis, fitted = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(30):
        p = sigmoid(basis @ fitted)
        slopes = basis.T @ (weights * (p - labels)) + 1e-2 * fitted
        fitted -= np.linalg.solve((basis * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ basis + 1e-2 * np.eye(2), slopes)
    return table.astype(np.float32), bias, float(fitted[0]), float(fitted[1])


def training_rows(docs: DataFrame, labels: DataFrame, keep: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """At most ``MAX_ROWS`` labelled texts of each class, of ``MAX_BYTES`` / 2 together: (key, text, label, weight).

    The weight is the class's natural number of labelled rows over its number here.
    """
    classes = labels.where(keep & F.col(label).isin(0, 1))
    shares = {r[0]: r[1] / min(r[1], MAX_ROWS) for r in classes.groupBy(F.col(label).cast("int")).count().collect()}  # two rows at most
    parts = [
        labelled_sample(docs, classes.where(F.col(label) == of), label, F.lit(True), MAX_ROWS, key, text, MAX_BYTES // 2).withColumn("weight", F.lit(float(share)))
        for of, share in sorted(shares.items())]
    if not parts:
        return labelled_sample(docs, classes, label, F.lit(False), 1, key, text).withColumn("weight", F.lit(1.0))
    return reduce(DataFrame.unionByName, parts)


def fit(sample: DataFrame) -> tuple[np.ndarray, float, float, float]:
    """Model of (key, text, label, weight); ``sample`` is bounded in rows and bytes.

    The sample meets in one task, whose memory ``MAX_ROWS`` and ``MAX_BYTES`` bound; the driver
    gets the folded table, which has a fixed size. Without both labels, every score is the
    share of label 1.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        labels, weights = (rows.column(c).to_numpy().astype(t) for c, t in (("label", np.int64), ("weight", np.float64)))
        if len(set(labels)) < 2:
            share = (labels.sum() + 0.5) / (len(labels) + 1)
            table, bias, slope, cut = np.zeros(1 << BITS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share)))
        else:
            table, bias, slope, cut = train(pa.chunked_array(rows.column("text")).combine_chunks(), labels, weights)
        yield pa.RecordBatch.from_pydict({"table": pa.array([table.tobytes()], pa.binary()), "bias": [bias], "slope": [slope], "cut": [cut]})

    rows = sample.repartition(1).sortWithinPartitions(F.xxhash64("key", "text")).mapInArrow(run, "table binary, bias double, slope double, cut double").collect()
    if not rows:
        return np.zeros(1 << BITS, np.float32), 0.0, 1.0, 0.0
    return np.frombuffer(rows[0].table, np.float32), rows[0].bias, rows[0].slope, rows[0].cut


def score(docs: DataFrame, model: tuple[np.ndarray, float, float, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): the probability of label 1 for every row.

    One row for each input row, repeated and null keys included. A text without words, null
    included, has the score of a bag with log-odds 0. Other columns are not read.
    """
    table, bias, slope, cut = model
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            best = highest_scores(bagged_texts(batch.column("text")), table, bias)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sigmoid(slope * best + cut))], names=[key, "score"])

    return text_and_key(docs, key, text).mapInArrow(run, schema)
