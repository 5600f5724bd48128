"""Ranked lexical search over documents, best first, with range-maximum tables on posting lists.

A first pass keeps each document's size and its occurrences of the terms that items hold; from it
come the counts over the whole corpus. Documents are then searched in segments: a segment has a
posting list for each term, by document number, and one table of range maxima over all lists
(the place of the largest impact in each stretch of 2^k postings).

An item starts with the interval of all documents of the segment. The largest impacts of its
terms within an interval add up to a bound of every score in it. Of an item's intervals those with
the highest bounds are opened first: the interval is split at the document with the largest single
impact, that document is scored, and the stretches before and after it become intervals of their
own with bounds of their own. An interval goes when its bound is below the item's ``k``-th score so
far, or equal to it with no document left that would come before it. All that stays is the exact
ranking; no document is left out for any other reason.

Items are taken in blocks of a bounded number of bytes; a block's terms go to every task. Tasks
keep at most ``k`` documents of an item, and these meet in one rank per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.storage import Scratch
from marketlens.llm.text import Texts, rows_of, slices, text_and_key

BLOCK_BYTES = 8_000_000  # of item texts that are searched at once, on average
SEGMENT_POSTINGS = 1_000_000
WIDTH = 32  # intervals of an item that are opened at the same time

IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)]] = True


class Items:
    """Items of one block: ids, and for each its terms (numbers of ``terms``) with their counts."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        found = Texts(texts, lower=True)
        starts, ends, firsts = found.spans(IN_TERM)
        self.ids = ids
        self.terms, which = np.unique(found.hashes(starts, ends), return_inverse=True)
        pairs, times = np.unique(rows_of(firsts) * max(1, len(self.terms)) + which.reshape(-1), return_counts=True)
        self.item, self.term, self.times = pairs // max(1, len(self.terms)), pairs % max(1, len(self.terms)), times


def postings(docs: DataFrame, terms: np.ndarray, key: str, text: str) -> DataFrame:
    """(key, n, terms, counts): a document's number of terms, and which of ``terms`` it holds how often."""
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType(), False)), T.StructField("counts", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"), lower=True)
            starts, ends, firsts = texts.spans(IN_TERM)
            hashes = texts.hashes(starts, ends)
            place = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
            own = np.flatnonzero(terms[place] == hashes) if len(terms) else np.zeros(0, np.int64)
            pairs, times = np.unique(rows_of(firsts)[own] * max(1, len(terms)) + place[own], return_counts=True)
            ends_of = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * max(1, len(terms))), pa.int32())
            listed = [pa.ListArray.from_arrays(ends_of, pa.array(v, pa.int32())) for v in (pairs % max(1, len(terms)), times)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(firsts), pa.int64()), *listed], names=schema.names)

    return text_and_key(docs, key, text).mapInArrow(run, schema)


def weights(found: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of every term's document count."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in found.tolist()], np.int64)


def impacts(times: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) with m = 25 + (75 n N) div L; ``sizes`` are the documents' n."""
    values, which = np.unique(sizes, return_inverse=True)
    norm = np.array([25 + 75 * int(n) * n_docs // n_terms for n in values.tolist()], np.int64)[which.reshape(-1)]
    return 1_000_000_000 * times // (1000 * times + 8 * norm)


def _firsts(groups: np.ndarray) -> np.ndarray:
    """Place of the first element of each group; equal numbers stand together."""
    return np.flatnonzero(np.append(True, groups[1:] != groups[:-1])[: len(groups)])


class Segment:
    """Posting lists of some documents, in the order of their places, with range maxima."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, values: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((docs, terms))
        self.n_docs, self.doc, self.value = n_docs, docs[order], values[order]
        self.code = terms[order] * n_docs + self.doc
        self.ends = np.searchsorted(terms[order], np.arange(n_terms + 1))
        # best[k][i]: the place of the largest value of places i to i + 2^k - 1, the first of several.
        self.best = [np.arange(len(docs), dtype=np.int32)]
        longest = int(np.diff(self.ends).max(initial=1))
        while 2 << (len(self.best) - 1) <= longest:
            half, step = self.best[-1], 1 << (len(self.best) - 1)
            a, b = half[:-step], half[step:]
            self.best.append(np.where(self.value[a] >= self.value[b], a, b))
        self.width = max(1, len(docs))
        self.flat = np.concatenate([np.pad(x, (0, self.width - len(x))) for x in self.best]) if len(docs) else np.zeros(1, np.int32)

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the largest value in [low, high), which must not be empty."""
        level = np.frexp((high - low).astype(np.float64))[1].astype(np.int64) - 1
        a = self.flat[level * self.width + low]
        b = self.flat[level * self.width + high - (1 << level)]
        return np.where(self.value[a] >= self.value[b], a, b)


class Search:
    """The items' intervals of one segment."""

    def __init__(self, segment: Segment, items: Items, weight: np.ndarray, least: np.ndarray, k: int):
        self.segment, self.k, self.least = segment, k, least
        n = len(least)
        self.top = np.zeros((0, 3), np.int64)  # item, score, place of the document
        self.kth, self.kth_place = np.zeros(n, np.int64), np.full(n, -1)
        worth = weight[items.term] * items.times
        own = (worth > 0) & (np.diff(segment.ends)[items.term] > 0)
        item, term = items.item[own], items.term[own]
        self.intervals = self._bounded(item, segment.ends[term], segment.ends[term + 1], term, worth[own], np.zeros(n, np.int64), np.arange(n))

    def _bounded(self, group, low, high, term, worth, start, item) -> dict[str, np.ndarray]:
        """Intervals with their bounds. ``group`` numbers the interval of each stretch of a posting
        list, in rising order; ``start`` and ``item`` belong to the group."""
        full = low < high
        group, low, high, term, worth = group[full], low[full], high[full], term[full], worth[full]
        if not len(group):
            return {c: np.zeros(0, np.int64) for c in ("item", "start", "bound", "split", "size", "low", "high", "term", "worth")}
        firsts = _firsts(group)
        held, sizes = group[firsts], np.diff(np.append(firsts, len(group)))
        place = self.segment.largest(low, high)
        gain = self.segment.value[place] * worth
        bound, most = np.add.reduceat(gain, firsts), np.maximum.reduceat(gain, firsts)
        # The document of the largest single gain, or one of them.
        peaks = np.flatnonzero(gain == np.repeat(most, sizes))
        split = self.segment.doc[place[peaks[_firsts(group[peaks])]]]
        out = {"item": item[held], "start": start[held], "bound": bound, "split": split, "size": sizes,
               "low": low, "high": high, "term": term, "worth": worth}
        return self._kept(out, self._alive(out))

    def _alive(self, x: dict[str, np.ndarray]) -> np.ndarray:
        kth, before = self.kth[x["item"]], x["start"] < self.kth_place[x["item"]]
        return (x["bound"] >= self.least[x["item"]]) & ((x["bound"] > kth) | (x["bound"] == kth) & before)

    @staticmethod
    def _kept(x: dict[str, np.ndarray], keep: np.ndarray) -> dict[str, np.ndarray]:
        inner = np.repeat(keep, x["size"])
        return {c: v[inner if c in ("low", "high", "term", "worth") else keep] for c, v in x.items()}

    def _rank(self, found: np.ndarray) -> None:
        """Take scored documents into the best ``k`` of their items."""
        both = np.concatenate([self.top, found[found[:, 1] > 0]])
        both = both[np.lexsort((both[:, 2], -both[:, 1], both[:, 0]))]
        firsts = _firsts(both[:, 0])
        rank = np.arange(len(both)) - np.repeat(firsts, np.diff(np.append(firsts, len(both))))
        self.top = both[rank < self.k]
        last = both[rank == self.k - 1]
        self.kth[last[:, 0]], self.kth_place[last[:, 0]] = last[:, 1], last[:, 2]

    def _open(self, x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Split intervals: score the documents they are split at, and bound both sides."""
        seg, n = self.segment, len(x["item"])
        group = np.repeat(np.arange(n), x["size"])
        wanted = x["term"] * seg.n_docs + x["split"][group]
        middle = np.clip(np.searchsorted(seg.code, wanted), x["low"], x["high"])
        hit = (middle < x["high"]) & (seg.code[np.minimum(middle, len(seg.code) - 1)] == wanted)
        gain = np.where(hit, seg.value[np.minimum(middle, len(seg.code) - 1)] * x["worth"], 0)
        self._rank(np.stack([x["item"], np.add.reduceat(gain, _firsts(group)), x["split"]], axis=1))
        both = np.concatenate([group, group + n])
        return self._bounded(
            both, np.concatenate([x["low"], middle + hit]), np.concatenate([middle, x["high"]]), np.tile(x["term"], 2),
            np.tile(x["worth"], 2), np.concatenate([x["start"], x["split"] + 1]), np.tile(x["item"], 2))

    def run(self) -> np.ndarray:
        """(item, score, place) of the best ``k`` documents of each item."""
        waiting = [self.intervals]
        while waiting:
            x = {c: np.concatenate([w[c] for w in waiting]) for c in waiting[0]} if len(waiting) > 1 else waiting[0]
            x = self._kept(x, self._alive(x))
            if not len(x["item"]):
                break
            order = np.lexsort((x["start"], -x["bound"], x["item"]))
            firsts = _firsts(x["item"][order])
            rank = np.zeros(len(order), np.int64)
            rank[order] = np.arange(len(order)) - np.repeat(firsts, np.diff(np.append(firsts, len(order))))
            now = rank < WIDTH
            waiting = [self._open(self._kept(x, now))]
            if not now.all():
                waiting.append(self._kept(x, ~now))
        return self.top


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of ``postings`` in pieces of about ``SEGMENT_POSTINGS`` postings."""
    held, size = [], 0
    for batch in batches:
        n = len(batch.column("terms").flatten())
        if held and size + n > SEGMENT_POSTINGS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _best(found: DataFrame, items: Items, block: int, weight: np.ndarray, n_docs: int, n_terms: int, k: int, schema: T.StructType) -> DataFrame:
    """The best ``k`` documents of each item in every segment, but those that another segment of
    the same task already rules out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.ones(len(items.ids), np.int64)  # of an item's scores that can still matter
        for part in _segments(batches):
            part = part.take(pc.sort_indices(part, [("key", "ascending")], null_placement="at_start"))
            lists, times = part.column("terms").combine_chunks(), part.column("counts").combine_chunks().flatten()
            docs, terms = rows_of(np.asarray(lists.offsets, np.int64)), np.asarray(lists.flatten(), np.int64)
            values = impacts(np.asarray(times, np.int64), part.column("n").to_numpy()[docs], n_docs, n_terms)
            search = Search(Segment(docs, terms, values, part.num_rows, len(weight)), items, weight, least, k)
            top = search.run()
            least = np.maximum(least, search.kth)
            keys = part.column("key").combine_chunks().take(pa.array(top[:, 2]))
            yield pa.RecordBatch.from_arrays([
                pa.array((block << 32) + top[:, 0]), items.ids.take(pa.array(top[:, 0])), keys, pa.array(top[:, 1])], names=schema.names)

    return found.mapInArrow(run, schema)


def _blocks(items: DataFrame, item: str, text: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Different items of one block after another; only one block is at the driver at once."""
    rows = items.select(F.col(item).alias("item"), F.col(text).alias("text")).where("text is not null").distinct()
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for n in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == n).toArrow().combine_chunks()
        yield tuple(own.column(c).combine_chunks() if isinstance(own.column(c), pa.ChunkedArray) else own.column(c) for c in ("item", "text"))


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """The ``k`` best documents of every item with a score above 0: (item, rank, key, score).

    Terms are the runs of ASCII letters and digits and non-ASCII characters of whole texts, A-Z
    lower-cased; a null text has none. Equal scores go by ascending key, null keys first; rows
    of one key are documents of their own. Items of equal id and text are one item; items that
    share an id only have a ranking each. Items without terms, or of which no document holds a
    term, have no rows. Other columns are not read. Terms with equal 64-bit hashes are equal.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "search")
    schema = T.StructType([
        T.StructField("number", T.LongType()), T.StructField("item", items.schema[item].dataType),
        T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.LongType())])
    results = spark.createDataFrame([], schema)
    for n, (ids, texts) in enumerate(_blocks(items, item, item_text)):
        block = Items(ids, texts)
        found = scratch.save(postings(docs, block.terms, key, text), f"postings{n}")
        n_docs, n_terms = found.select(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = found.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(len(block.terms), np.int64)
        df[held.column("term").to_numpy()] = held.column("count").to_numpy()
        results = results.unionByName(_best(found, block, n, weights(df, n_docs), n_docs, max(1, n_terms), k, schema))
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc("key"))
    return results.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
