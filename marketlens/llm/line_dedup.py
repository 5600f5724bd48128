"""Line dedup: repeated runs of lines, found with a suffix array over line ids.

A text is its sequence of lines that have a word; two lines are the same if they are equal
without white space at their ends. A run is a sequence of neighbouring lines of one text. Every
line of a run that has ``min_words`` words or more and also occurs earlier (in an earlier text,
by id, or before it in the same text) is deleted; the first copy stays.

Prefix doubling ranks all suffixes: the rank of a line becomes the rank of the 2, 4, 8, ...
lines that start at it, by joining each rank with that of the line so much further on and
sorting the distinct pairs. Suffixes of one rank at depth n form an interval of the suffix array
whose longest common prefix is n or more. Ranks that occur once can't be part of a repeat and
leave at once, so only repeated text is doubled. Two overlapping ranks of a power of two name
a run of any length.

A maximal repeated run of enough words is the union of two kinds of small runs inside it: the
shortest run from each line on that has enough words, and the shortest run up to its last line.
Both are fixed by their content, so each occurs earlier exactly if it is not the first of its
interval. Doubling therefore stops at ``min_words`` lines, and yet runs of any length go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.storage import Scratch
from marketlens.llm.text import SPACES, Texts, rows_of, slices

MIN_WORDS = 10
_WORD = ~SPACES
_DOC = ("id", "body")  # a document: its id and a hash of its text


def worded_lines(texts: Texts) -> tuple[np.ndarray, ...]:
    """Lines with a word: text, number among all lines of the text, words, and the bytes from
    the first word to the last."""
    starts, ends, _ = texts.spans(_WORD)
    line_starts, line_ends, firsts = texts.lines()
    first, after = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    has = np.flatnonzero(after > first)
    text = rows_of(firsts)[has]
    return text, has - firsts[:-1][text], (after - first)[has], starts[first[has]], ends[after[has] - 1]


def shortest_runs(text: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest run from each line on, and up to each line, that has ``min_words``
    words; 0 where the text has too few."""
    before = np.append(0, np.cumsum(words))
    changes = np.flatnonzero(np.diff(text, prepend=-1, append=-1))
    last = np.repeat(changes[1:], np.diff(changes))
    first = np.repeat(changes[:-1], np.diff(changes))
    at = np.arange(len(words))
    end = np.searchsorted(before, before[:-1] + min_words, "left")
    begin = np.searchsorted(before, before[1:] - min_words, "right") - 1
    return np.where(end <= last, end - at, 0), np.where((begin >= first) & (before[1:] >= min_words), at + 1 - begin, 0)


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """One row for each line with a word: document, n (its number among such lines), two hashes,
    and the lengths of the shortest runs from it on (ahead) and up to it (back)."""
    schema = T.StructType([
        *(docs.schema[c] for c in _DOC), T.StructField("n", T.IntegerType()), T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()), T.StructField("ahead", T.IntegerType()), T.StructField("back", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            text, _, words, starts, ends = worded_lines(texts)
            n = np.arange(len(text)) - np.searchsorted(text, text)
            ahead, back = shortest_runs(text, words, min_words)
            hashes = [texts.hashes(starts, ends, which).view(np.int64) for which in (0, 1)]
            own = [batch.column(c).take(pa.array(text)) for c in _DOC]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(x.astype(t)) for x, t in (
                (n, np.int32), (hashes[0], np.int64), (hashes[1], np.int64), (ahead, np.int32), (back, np.int32)))], names=schema.names)

    return docs.select(*_DOC, "text").mapInArrow(run, schema)


def _ranks(scratch: Scratch, rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct keys that occur twice or more, with a ``new`` rank that grows in the keys' order."""
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    return scratch.save(repeated.orderBy(*keys).withColumn("new", F.monotonically_increasing_id()), name)


def _shifted(ranks: DataFrame, by: int, name: str) -> DataFrame:
    """Ranks by the line ``by`` lines before them."""
    return ranks.select(F.col("id"), "body", (F.col("n") - by).alias("n"), F.col("rank").alias(name))


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on document and line; null ids are equal."""
    right = right.withColumnsRenamed({c: f"of_{c}" for c in ("id", "body", "n")})
    on = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("body") == F.col("of_body")) & (F.col("n") == F.col("of_n"))
    return left.join(right, on).drop("of_id", "of_body", "of_n")


def repeated_runs(docs: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs that occur earlier: (id, body, n, length), n being the first line of the run."""
    lines = scratch.save(_lines(docs, min_words), "lines")
    ids = _ranks(scratch, lines, ["a", "b"], "rank0")
    ranks = scratch.save(lines.join(ids, ["a", "b"]).select("id", "body", "n", F.col("new").alias("rank"), "ahead", "back"), "level0")
    runs = ranks.select("id", "body", "n", F.col("ahead").alias("length")).unionByName(
        ranks.select("id", "body", (F.col("n") - F.col("back") + 1).alias("n"), F.col("back").alias("length"))).where("length > 0").distinct()
    levels, depth, named = [ranks.select("id", "body", "n", "rank")], 1, []
    while True:
        # Runs of depth .. 2 * depth - 1 lines: the ranks of their first and their last lines.
        own = runs.where(F.col("length").between(depth, 2 * depth - 1))
        found = _joined(own, levels[-1].withColumnRenamed("rank", "x"))
        if depth > 1:
            end = found.withColumn("start", F.col("n")).withColumn("n", F.col("n") + F.col("length") - depth)
            found = _joined(end, levels[-1].withColumnRenamed("rank", "y")).drop("n").withColumnRenamed("start", "n")
        else:
            found = found.withColumn("y", F.col("x"))
        named.append(found.select("id", "body", "n", "length", "x", "y"))
        if 2 * depth > min_words:
            break
        pairs = scratch.save(_joined(levels[-1], _shifted(levels[-1], depth, "next")), f"pairs{2 * depth}")
        ids = _ranks(scratch, pairs, ["rank", "next"], f"rank{2 * depth}")
        doubled = pairs.join(ids, ["rank", "next"]).select("id", "body", "n", F.col("new").alias("rank"))
        levels.append(scratch.save(doubled, f"level{2 * depth}"))
        scratch.drop(f"pairs{2 * depth}")
        depth *= 2
    named_runs = scratch.save(reduce(DataFrame.unionByName, named), "runs")
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "body", "n")
    firsts = named_runs.groupBy("length", "x", "y").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    later = named_runs.join(firsts, ["length", "x", "y"]).where(place > F.col("first"))
    return later.select("id", "body", "n", "length")


def _without(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the runs' lines, and how many lines went. A line without words goes
    with the line before it."""
    gone = np.zeros(max(a + n for a, n in runs) + 1, np.int64)
    for a, n in runs:
        gone[a] += 1
        gone[a + n] -= 1
    gone = np.cumsum(gone) > 0
    kept, n, go = [], -1, False
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            n += 1
            go = n < len(gone) and bool(gone[n])
        if not go:
            kept.append(line)
    return "\n".join(kept), int(gone.sum())


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with later copies of repeated runs cut from the text, and the
    columns ``n_lines`` (lines with a word) and ``n_deleted``.

    One row for each input row. Rows with the same id and text are one document and get the
    same result; null ids come first in the order, and documents that share an id are ordered
    by a hash of their text. Null and empty texts have no lines and stay as they are. Other columns
    are carried along; the two new ones take the place of columns of their names.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    docs = docs.drop("n_lines", "n_deleted")
    own = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    runs = repeated_runs(own, scratch, min_words)
    cuts = runs.groupBy("id", "body").agg(F.collect_list(F.struct("n", "length")).alias("__cuts"))  # at most two for each line
    cuts = scratch.save(cuts, "cuts")
    scratch.drop("lines", "runs", "level0", "rank0")
    cuts = cuts.withColumnsRenamed({"id": "__id", "body": "__body"})
    rows = docs.join(cuts, F.col(key).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__body")), "left").drop("__id", "__body")
    names, schema = docs.columns, T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_deleted", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            column = batch.column(text)
            lines = np.bincount(worded_lines(Texts(column))[0], minlength=batch.num_rows)
            values, deleted = column.to_pylist(), np.zeros(batch.num_rows, np.int64)
            for n, found in enumerate(batch.column("__cuts").to_pylist()):
                if found:
                    values[n], deleted[n] = _without(values[n], [(c["n"], c["length"]) for c in found])
            carried = [pa.array(values, pa.string()) if name == text else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(lines, pa.int64()), pa.array(deleted)], names=schema.names)

    return rows.mapInArrow(run, schema)
