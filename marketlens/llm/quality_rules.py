"""Quality rules: gradient-boosted trees over document statistics.

Statistics of whole texts are computed on flat byte arrays. The trees are grown in numpy on
histograms of a bounded sample of labelled rows, with second-order steps of the logistic loss.
Features listed in ``MONOTONE`` may only lower (-1) or raise (+1) the score: a split that
would break this is not taken, and the values on either side of a split are kept apart by
bounds that its descendants inherit. The trees are flattened into node arrays, and a batch of
rows walks all trees at once, one level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlens.llm.fitting import sigmoid
from marketlens.llm.text import SPACES, Texts, mixed, per_text, rows_of, slices, text_and_key, windows

TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.2
L2, MIN_HESSIAN = 1.0, 1.0
MAX_ROWS = 20_000  # labelled rows that training reads at most
MIN_WORDS, MAX_REPEATED = 50, 50  # words; percent of words in repeated windows
MIN_SCORE = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "capital_share", "sign_share", "digit_share", "distinct_share", "words_per_line")
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "capital_share": -1}

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_WORD = ~SPACES
_CAPITAL, _SIGN, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_CAPITAL[0x41:0x5B] = True
_DIGIT[0x30:0x3A] = True
_SIGN[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def grouped(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How often each hash occurs in its text."""
    with np.errstate(over="ignore"):
        both = mixed(hashes + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, where, counts = np.unique(both, return_inverse=True, return_counts=True)
    return counts[where]


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text, and its features (texts x FEATURES)."""
    texts = Texts(column)
    starts, ends, firsts = texts.spans(_WORD)
    data, n_words = texts.data, np.diff(firsts)

    def within(flags: np.ndarray) -> np.ndarray:
        """Flagged bytes of each text."""
        sums = np.append(0, np.cumsum(flags))
        return sums[texts.ends] - sums[texts.starts]

    points = (data & 0xC0) != 0x80
    hashes = texts.hashes(starts, ends)
    line_starts, line_ends, line_firsts = texts.lines()
    word_sums = np.append(0, np.cumsum(np.bincount(starts, minlength=len(data) + 1)))
    worded = word_sums[line_ends] > word_sums[line_starts]
    line_text = rows_of(line_firsts)[worded]
    n_lines = np.bincount(line_text, minlength=texts.n)
    copies = 1.0 / grouped(line_text, texts.hashes(line_starts[worded], line_ends[worded]))
    distinct_lines = np.rint(np.bincount(line_text, copies, minlength=texts.n)).astype(np.int64)
    triples, at = windows(hashes, firsts, 3)
    text_of = rows_of(firsts)
    again = at[grouped(text_of[at], triples) > 1]
    repeated = np.zeros(len(hashes) + 3, bool)
    for k in range(3):
        repeated[again + k] = True
    word_copies = 1.0 / grouped(text_of, hashes)
    counts = dict(zip(COUNTS, (
        n_words, within(points & _WORD[data]), within(SYMBOLS[data]), n_lines - distinct_lines,
        per_text(repeated[: len(hashes)].astype(np.int64), firsts)), strict=True))
    words, chars = np.maximum(1, n_words), np.maximum(1, counts["word_chars"])
    values = np.stack([
        np.log1p(n_words), counts["word_chars"] / words, counts["n_symbols"] / chars, counts["n_dup_lines"] / np.maximum(1, n_lines),
        counts["n_repeat_words"] / words, within(_CAPITAL[data]) / chars, within(_SIGN[data]) / chars, within(_DIGIT[data]) / chars,
        np.bincount(text_of, word_copies, minlength=texts.n) / words, n_words / np.maximum(1, n_lines)], axis=1)
    return counts, np.round(values, 9)


class Trees(NamedTuple):
    """Node arrays (trees x nodes): a node's children are 2n + 1 and 2n + 2, its own value a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        tree = np.arange(len(self.feature))
        at = np.zeros((len(rows), len(tree)), np.int64)
        while True:
            feature = self.feature[tree, at]
            inner = feature >= 0
            if not inner.any():
                return self.base + self.value[tree, at].sum(1)
            right = np.take_along_axis(rows, np.maximum(feature, 0), 1) > self.threshold[tree, at]
            at = np.where(inner, 2 * at + 1 + right, at)


def grow(rows: np.ndarray, labels: np.ndarray, monotone: np.ndarray) -> Trees:
    """Trees fitted to the rows; monotone has -1, 0 or +1 for each feature."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base, n_nodes = float(np.log(share / (1 - share))), 2 ** (DEPTH + 1) - 1
    feature = np.full((TREES, n_nodes), -1)
    threshold, value = np.zeros((TREES, n_nodes)), np.zeros((TREES, n_nodes))
    if not len(labels):
        return Trees(feature, threshold, value, base)
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], axis=1)
    odds = np.full(len(labels), base)

    def leaf(g: float | np.ndarray, h: float | np.ndarray, low: float, high: float) -> np.ndarray:
        return np.clip(-g / (h + L2), low, high)

    def gain(g, h, w):
        return -(g * w + 0.5 * (h + L2) * w * w)

    for tree in range(TREES):
        p = sigmoid(odds)
        grad, hess = p - labels, np.maximum(p * (1 - p), 1e-6)
        queue = [(0, np.arange(len(labels)), -np.inf, np.inf)]
        while queue:
            node, own, low, high = queue.pop()
            g, h = grad[own].sum(), hess[own].sum()
            w = float(leaf(g, h, low, high))
            value[tree, node] = RATE * w
            best = (1e-6, -1, 0, 0.0, 0.0)
            if 2 * node + 2 < n_nodes:
                for f, cut in enumerate(edges):
                    gs = np.cumsum(np.bincount(bins[own, f], grad[own], len(cut) + 1))[:-1]
                    hs = np.cumsum(np.bincount(bins[own, f], hess[own], len(cut) + 1))[:-1]
                    left, right = leaf(gs, hs, low, high), leaf(g - gs, h - hs, low, high)
                    better = gain(gs, hs, left) + gain(g - gs, h - hs, right) - gain(g, h, w)
                    allowed = (hs >= MIN_HESSIAN) & (h - hs >= MIN_HESSIAN) & (monotone[f] * (right - left) >= 0)
                    better = np.where(allowed, better, 0)
                    if len(cut) and better.max() > best[0]:
                        k = int(better.argmax())
                        best = (better[k], f, k, float(left[k]), float(right[k]))
            if best[1] < 0:
                odds[own] += value[tree, node]
                continue
            _, f, k, left, right = best
            feature[tree, node], threshold[tree, node] = f, edges[f][k]
            below, middle = bins[own, f] <= k, (left + right) / 2
            bounds = {-1: ((middle, high), (low, middle)), 0: ((low, high),) * 2, 1: ((low, middle), (middle, high))}[int(monotone[f])]
            queue += [(2 * node + 1, own[below], *bounds[0]), (2 * node + 2, own[~below], *bounds[1])]
    return Trees(feature, threshold, value, base)


def fit(sample: DataFrame) -> Trees:
    """Trees from (key, text, label); the statistics of the bounded sample reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = statistics(batch.column("text"))[1]
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "row": pa.array(list(values), pa.list_(pa.float64()))})

    found = sorted(sample.mapInArrow(run, "label int, row array<double>").collect())
    rows = np.array([r.row for r in found]).reshape(-1, len(FEATURES))
    return grow(rows, np.array([r.label for r in found], np.float64), np.array([MONOTONE.get(f, 0) for f in FEATURES]))


def judge(docs: DataFrame, trees: Trees, key: str = "doc_id", text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(key, the counts, base_failed, score, kept) of every row.

    ``base_failed`` marks texts with under ``MIN_WORDS`` words or with over ``MAX_REPEATED``
    percent of their words in repeated windows; others are kept if the trees' probability is
    ``min_score`` or more. One row for each input row, repeated and null keys included; a null
    text has no words and fails. Other columns are not read.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in COUNTS),
        T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, rows = statistics(batch.column("text"))
            failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"])
            score = sigmoid(trees.log_odds(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(failed), pa.array(score), pa.array(~failed & (score >= min_score))],
                names=schema.names)

    return text_and_key(docs, key, text).mapInArrow(run, schema)
