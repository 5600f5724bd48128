"""Language ID: a byte convolutional network over fixed-length windows.

A text is cut into windows of ``LENGTH`` bytes (the last one padded). Filters of several
widths slide over the one-hot bytes, each filter's largest response in a window passes a
rectifier into a softmax over the languages. Responses to one-hot bytes are sums of table
rows, so a filter of width 3 costs two look-ups: one table by byte pair, one by byte. A
text's probabilities are the means over its windows, weighted by their letters.

The network is trained in numpy on windows of a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.fitting import enough, hash_share
from marketlens.llm.text import byte_column, slices, text_and_key

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
EPOCHS, BATCH, RATE = 12, 64, 0.01
MAX_ROWS = 3_000  # labelled texts that training reads at most, besides
PER_LANGUAGE = 100  # so many of each language, or all if it has fewer
WINDOWS_PER_TEXT = 4  # windows of each of them, spread over the whole text
UNKNOWN = "und"
_CHUNK = 256  # windows that are scored at once

# What is no letter is one sign; A-Z are lower-cased. 0 is padding.
_CODES = np.full(256, 0x20, np.uint8)
_CODES[0x61:0x7B] = np.arange(0x61, 0x7B)
_CODES[0x41:0x5B] = np.arange(0x61, 0x7B)
_CODES[0x80:] = np.arange(0x80, 256)
_PAD = max(WIDTHS) - 1


def text_windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts (n x (LENGTH + padding)) and the first window of each text."""
    data, offsets = byte_column(column)
    counts = -(-np.diff(offsets) // LENGTH)
    firsts = np.append(0, np.cumsum(counts))
    starts = np.repeat(offsets[:-1], counts) + (np.arange(firsts[-1]) - np.repeat(firsts[:-1], counts)) * LENGTH
    ends = np.minimum(starts + LENGTH, np.repeat(offsets[1:], counts))
    at = starts[:, None] + np.arange(LENGTH + _PAD)
    inside = at < ends[:, None]
    coded = _CODES[data] if len(data) else np.zeros(1, np.uint8)
    return np.where(inside, coded[np.minimum(at, len(coded) - 1)], 0).astype(np.uint8), firsts


class Network:
    """Tap tables (256 x FILTERS for each position of each width), biases and the softmax."""

    def __init__(self, classes: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.taps = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def pair_tables(self) -> dict[int, list[np.ndarray]]:
        """For each width, tables by byte pair that are added at offsets 0, 2, ..."""
        def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            return (first[:, None, :] + second[None]).reshape(-1, FILTERS)

        return {w: [pair(taps[k], taps[k + 1]) if k + 1 < w else taps[k] for k in range(0, w, 2)] for w, taps in self.taps.items()}

    def responses(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]], places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter in each window, and with ``places`` where it is."""
        pairs = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        best, where = [], []
        for w in WIDTHS:
            total = None
            for k, table in enumerate(tables[w]):
                at = pairs if len(table) == 65536 else windows
                rows = table.take(at[:, 2 * k : 2 * k + LENGTH], axis=0)
                total = rows if total is None else np.add(total, rows, out=total)
            best.append(total.max(1) + self.bias[w])
            if places:
                where.append(total.argmax(1))
        return np.concatenate(best, 1), where

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled, 0) @ self.out + self.out_bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def fit(self, windows: np.ndarray, labels: np.ndarray) -> None:
        """Adam over batches; only the bytes under a filter's largest response learn."""
        rng = np.random.default_rng(3)
        state = {}
        step = 0

        def adam(name, value, grad):
            m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

        for _ in range(EPOCHS):
            order = rng.permutation(len(labels))
            for start in range(0, len(order), BATCH):
                step += 1
                own = order[start : start + BATCH]
                batch = windows[own]
                pooled, where = self.responses(batch, self.pair_tables(), places=True)
                p = self.probabilities(pooled)
                p[np.arange(len(own)), labels[own]] -= 1
                p /= len(own)
                to_pooled = (p @ self.out.T) * (pooled > 0)
                adam("out", self.out, np.maximum(pooled, 0).T @ p)
                adam("out_bias", self.out_bias, p.sum(0))
                for n, w in enumerate(WIDTHS):
                    grad = to_pooled[:, n * FILTERS : (n + 1) * FILTERS]
                    adam(("bias", w), self.bias[w], grad.sum(0))
                    taps = np.zeros_like(self.taps[w])
                    for k in range(w):
                        np.add.at(taps[k], (np.take_along_axis(batch, where[n] + k, 1), np.arange(FILTERS)), grad)
                    adam(("taps", w), self.taps[w], taps)

    def score(self, windows: np.ndarray) -> np.ndarray:
        tables = self.pair_tables()
        parts = [self.probabilities(self.responses(windows[k : k + _CHUNK], tables)[0]) for k in range(0, len(windows), _CHUNK)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.classes)))


def fit(docs: DataFrame, keep, max_rows: int = MAX_ROWS, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network for the languages among the learnable rows; None if there are none.

    Every language is learned, however rare: the sample is the ``max_rows`` texts with the
    smallest hash of key and text, and of each language those with a hash under its own bound,
    which lets about ``PER_LANGUAGE`` through. Each gives at most ``WINDOWS_PER_TEXT`` windows, so
    what reaches the driver is bounded by the number of languages. Repeated rows count once. Rows
    whose text has no letter, or whose text or language is null, are left out.
    """
    rows = docs.where(keep).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    chosen = rows.dropna(subset=["text", "lang"]).where(F.col("text").rlike(r"\p{L}")).select("text", "lang", F.xxhash64("key", "text").alias("rank"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            windows, firsts = text_windows(batch.column("text"))
            picked = [windows[np.unique(np.linspace(a, b - 1, WINDOWS_PER_TEXT).astype(int))].tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), pa.array(picked, pa.binary())], names=["lang", "rank", "windows"])

    # The limits are taken on the hash alone, before any text is moved.
    ranks = chosen.select("lang", "rank").distinct()
    sizes = ranks.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))  # one row for each language
    own = ranks.join(F.broadcast(sizes), "lang").where(hash_share(F.col("rank")) <= PER_LANGUAGE / F.col("size")).drop("size")
    # Only ranks that can be among the smallest go to the one task that orders them.
    total = sizes.agg(F.sum("size")).first()[0] or 0
    low = ranks.where(hash_share(F.col("rank")) <= enough(max_rows, total))
    picked = low.orderBy("rank", "lang").limit(max_rows).unionByName(own).distinct()
    sample = chosen.join(F.broadcast(picked), ["lang", "rank"]).select("text", "lang", "rank").groupBy("lang", "rank").agg(F.min("text").alias("text"))
    found = sorted(sample.mapInArrow(cut, "lang string, rank long, windows binary").collect())
    if not found:
        return None
    classes = sorted({r.lang for r in found})
    cuts = [np.frombuffer(r.windows, np.uint8).reshape(-1, LENGTH + _PAD) for r in found]
    network = Network(classes)
    network.fit(np.concatenate(cuts), np.repeat([classes.index(r.lang) for r in found], [len(c) for c in cuts]))
    return network


def predict(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score): the likeliest language of every row and its probability.

    One row for each input row, repeated and null keys included. A text that is null or has no
    letter is ``und`` with score 0, as is every text if nothing was learned. Other columns are
    not read.
    """
    rows = text_and_key(docs, key, text).withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
            if network is not None:
                windows, firsts = text_windows(batch.column("text"))
                letters = ((windows[:, :LENGTH] != 0x20) & (windows[:, :LENGTH] != 0)).sum(1) + 1e-9
                sums = np.concatenate((np.zeros((1, len(network.classes))), np.cumsum(network.score(windows) * letters[:, None], axis=0)))
                totals = sums[firsts[1:]] - sums[firsts[:-1]]
                shares = totals / np.maximum(1e-12, totals.sum(1, keepdims=True))
                known = batch.column("letters").to_numpy(zero_copy_only=False)
                lang = np.where(known, np.array(network.classes, object)[shares.argmax(1)], UNKNOWN)
                score = np.where(known, shares.max(1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1))], names=[key, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
