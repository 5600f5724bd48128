"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and texts are normalised alike (A-Z lower-cased; a word is a run of ASCII letters,
digits and non-ASCII bytes). The automaton holds every run of words of every item. A text's
words are streamed through it; after each word it knows the longest run that ends there and
occurs in an item. A run of ``window`` words is a match, and so is a whole item that is
shorter.

Only stretches in which each pair of neighbours is a pair of neighbours in some item can
hold a match, so the stream skips the rest by array look-ups. Items are taken in blocks of a
bounded number of words: a block's automaton goes to every worker, and the texts pass through
the blocks one after another without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.text import Texts, rows_of, slices, text_and_key

WINDOW = 10
BLOCK_WORDS = 200_000  # item words of one automaton, on average

IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 256)]] = True


class SuffixAutomaton:
    """Generalised suffix automaton of sequences of integers."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word: int, old: int) -> int:
        """Give the runs of ``old`` that extend ``state`` a state of their own."""
        clone = self._state(self.length[state] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = clone
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def extend(self, last: int, word: int) -> int:
        """State of the run of ``last`` with one more word."""
        old = self.next[last].get(word)
        if old is not None:
            return old if self.length[old] == self.length[last] + 1 else self._split(last, word, old)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            old = self.next[state][word]
            self.link[new] = old if self.length[old] == self.length[state] + 1 else self._split(state, word, old)
        return new

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """State and length of the longest matching run after one more word."""
        while word not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            matched = self.length[state]
        return self.next[state][word], matched + 1


class Block:
    """Automaton and look-up tables of one block of items, built from (item, word hashes)."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        every = [words for _, words in items]
        self.words = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        coded = [np.searchsorted(self.words, words) for words in every]
        self.pairs = np.unique(np.concatenate([c[:-1] * len(self.words) + c[1:] for c in coded])) if every else np.zeros(0, np.int64)
        self.shortest = min([window, *map(len, coded)])
        self.automaton = machine = SuffixAutomaton()
        for codes in coded:
            last = 0
            for code in codes.tolist():
                last = machine.extend(last, code)
        whole: dict[int, list[int]] = {}  # state of a short item's whole run -> items
        self.holds: dict[int, set[str]] = {}  # state of a run of ``window`` words -> items
        for n, codes in enumerate(coded):
            state = matched = 0
            for code in codes.tolist():
                state, matched = machine.step(state, matched, code)
                if matched >= window:
                    self.holds.setdefault(self.run_state(state), set()).add(items[n][0])
            if len(codes) < window:
                whole.setdefault(state, []).append(n)
        self.short = {s: (len(coded[ns[0]]), {items[n][0] for n in ns}) for s, ns in whole.items()}

    def run_state(self, state: int) -> int:
        """State of the last ``window`` words of a longer match."""
        link, length = self.automaton.link, self.automaton.length
        while length[link[state]] >= self.window:
            state = link[state]
        return state

    def match(self, codes: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Matched spans (start, end) and items of a stretch of words."""
        spans, found, state, matched = [], set(), 0, 0
        for at, code in enumerate(codes, 1):
            state, matched = self.automaton.step(state, matched, code)
            if matched >= self.window:
                found |= self.holds[self.run_state(state)]
                spans.append((at - self.window, at))
            if self.short:
                above = state
                while above > 0:
                    size, items = self.short.get(above, (0, ()))
                    if 0 < size <= matched:
                        found |= items
                        spans.append((at - size, at))
                    above = self.automaton.link[above]
        return spans, found

    def search(self, hashes: np.ndarray, firsts: np.ndarray) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """Spans (word numbers in the text) and items of each text that has a match."""
        out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        if not len(self.words) or not len(hashes):
            return out
        codes = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[codes] == hashes
        text = rows_of(firsts)
        joined = known[:-1] & known[1:] & (text[:-1] == text[1:])
        at = np.flatnonzero(joined)
        pair = codes[at] * len(self.words) + codes[at + 1]
        if len(self.pairs):
            joined[at] = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
        else:
            joined[:] = False
        breaks = np.flatnonzero(~joined) + 1
        starts, ends = np.append(0, breaks), np.append(breaks, len(hashes))
        worth = (ends - starts >= self.shortest) & known[starts]
        for a, b in zip(starts[worth].tolist(), ends[worth].tolist(), strict=True):
            spans, items = self.match(codes[a:b].tolist())
            if spans:
                n, first = int(text[a]), int(firsts[text[a]])
                own, held = out.setdefault(n, ([], set()))
                own += [(a - first + x, a - first + y) for x, y in spans]
                held |= items
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(items: DataFrame, item: str, text: str, window: int) -> Iterator[Block]:
    """Blocks of items; only one block's words, a bounded number, are at the driver at once."""
    rows = items.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("item is not null")
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (BLOCK_WORDS * 6)))  # a word takes six bytes or so
    for n in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n).distinct().collect()
        texts = Texts(pa.array([r.text for r in own], pa.string()), lower=True)
        starts, ends, firsts = texts.spans(IN_WORD)
        hashes = texts.hashes(starts, ends)
        words = [hashes[a:b] for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
        yield Block([(r.item, w) for r, w in zip(own, words, strict=True) if len(w)], window)


def matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Matches of every row: (key, text, n_words, spans, items).

    ``spans`` are word numbers (start, end exclusive) that don't touch; ``items`` are the ids, as
    sorted strings, of the items matched. One row for each input row, repeated and null keys
    included; a null text has no words and no matches, nor do items without words or id. Items
    that share an id are one item with several texts. Other columns are not read.
    """
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("spans", span), T.StructField("items", T.ArrayType(T.StringType()))])
    found = text_and_key(docs, key, text).select(
        F.col("key").alias(key), "text", F.lit(0).cast("long").alias("n_words"),
        F.array().cast(span).alias("spans"), F.array().cast("array<string>").alias("items"))
    context = docs.sparkSession.sparkContext
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for block in item_blocks(items, item, item_text, window):
        shared = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                texts = Texts(batch.column("text"), lower=True)
                starts, ends, firsts = texts.spans(IN_WORD)
                spans, held = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                for n, (own, ids) in shared.value.search(texts.hashes(starts, ends), firsts).items():
                    spans[n] = [{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in spans[n]] + own)]
                    held[n] = sorted(ids.union(held[n]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column("text"), pa.array(np.diff(firsts), pa.int64()), pa.array(spans, arrow_spans), pa.array(held, pa.list_(pa.string()))],
                    names=[key, "text", "n_words", "spans", "items"])

        found = found.mapInArrow(run, schema)
    return found


def hit_words(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def without_spans(found: DataFrame, min_words: int = WINDOW, min_share: float = 0.1) -> DataFrame:
    """Texts of ``matches`` without the spans over the limits: its columns and ``cleaned``.

    A span goes if it has ``min_words`` words or more; all spans go if together they cover
    ``min_share`` of the text's words or more. A cut reaches from the first word of a span to
    the end of its last word. A null text stays null.
    """
    schema = T.StructType([*found.schema.fields, T.StructField("cleaned", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"), lower=True)
            starts, ends, firsts = texts.spans(IN_WORD)
            out = batch.column("text").to_pylist()
            for n, spans in enumerate(batch.column("spans").to_pylist()):
                share = sum(s["end"] - s["start"] for s in spans) / max(1, firsts[n + 1] - firsts[n])
                gone = [s for s in spans if share >= min_share or s["end"] - s["start"] >= min_words]
                if gone:
                    data, base = out[n].encode(), texts.starts[n]
                    cuts = [(int(starts[firsts[n] + s["start"]] - base), int(ends[firsts[n] + s["end"] - 1] - base)) for s in gone]
                    edges = zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(data)], strict=True)
                    out[n] = b"".join(data[a:b] for a, b in edges).decode()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=schema.names)

    return found.mapInArrow(run, schema)
