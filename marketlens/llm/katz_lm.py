"""LM scoring: a Katz backoff model of word pairs.

Tokens are words and one end for each text; a text's first word follows a start. The vocabulary
is every training word that is seen at least twice, however large the corpus; all other words
are one class, the unknown words, which is counted like a word. Its probability is shared equally
by its members: the training words outside the vocabulary, and one for all words that training
does not have. So the probabilities of all words add up to one after every history. Counts of pairs are discounted by
Good-Turing: with n_r the number of pairs seen r times, small counts are lowered by the ratio
(r + 1) n_(r+1) / (r n_r), put right for the counts over ``CUTOFF``. The mass that a history
loses goes to the words never seen after it, in proportion to their share of all tokens:

    p(w | h) = d(c) * c(h, w) / c(h)        if the pair was seen
             = backoff(h) * p(w)            if not

and backoff(h) makes the probabilities after h sum to one exactly.

Words are numbered by falling count, so a word's count follows from its number and the list of
the different counts with the numbers they begin at. N tokens have at most sqrt(2 N) different
counts; that list is all that driver and workers hold of the vocabulary.

The text is read twice: for the words, and for chunks of a bounded number of tokens. A chunk asks
each partition of the word table for the numbers of its words, and then each partition of the
pair table for the counts of its pairs; pair partitions add up what the chunks have seen in
training texts and answer with the totals. So a pair costs a few bytes for each chunk that has
it, however often it occurs, and no partition meets more than one entry of a pair from a chunk.
Last, the chunk asks for the backoff weights of its histories in the same way. Chunks, tables and
answers are kept in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.storage import Scratch
from marketlens.llm.text import SPACES, Texts, mixed, slices

SHARE: int | None = None  # for a smaller model: a vocabulary word is one in so many training tokens, or more frequent
CUTOFF = 5  # counts up to here are discounted by Good-Turing
CHUNK_TOKENS = 2_500_000
PART_TOKENS = 4_000_000  # tokens for each partition of the pair table
END = np.uint64(0x0EBD0EBD0EBD0EBD)  # in place of a word's hash
_WORD = ~SPACES


def shrunk(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes; high bytes, mostly zero, cost next to nothing."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def grown(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).ravel()


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, an end after each text, and the first of each text."""
    texts = Texts(column, lower=True)
    starts, ends, firsts = texts.spans(_WORD)
    return np.insert(texts.hashes(starts, ends), firsts[1:], END), firsts + np.arange(len(firsts))


def _rows(docs: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): how often each training token, by its hash, occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, firsts = tokens(batch.column("text"))
            train = np.repeat(batch.column("train").to_numpy(zero_copy_only=False).astype(bool), np.diff(firsts))
            words, counts = np.unique(hashes[train], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])

    return rows.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Numbers of words by falling count; 0 is a word that training does not have.

    In pairs, 0 is the unknown word, 1 .. known the vocabulary, then end and start.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, ends: int):
        order = np.argsort(-counts)
        counts, sizes = counts[order], sizes[order]
        self.ends, self.total, self.distinct = ends, int((counts * sizes).sum()) + ends, int(sizes.sum()) + (ends > 0)
        own = (counts >= 2) & (counts * SHARE >= self.total if SHARE else True)
        self.known = int(sizes[own].sum())
        self.end, self.start, self.size = self.known + 1, self.known + 2, self.known + 3
        if self.size >= 1 << 32:
            raise ValueError("a pair of words has to fit 64 bits")
        self.counts, self.firsts = np.append(0, counts), np.append(0, 1 + np.cumsum(sizes) - sizes)
        self.unknown = self.total - ends - int((counts * sizes)[own].sum())
        self.members = int(sizes.sum()) - self.known + 1  # of the class of unknown words
        # The unknown word and the end are never impossible, even if training has none.
        self.mass = max(1, self.unknown) + max(1, ends) + int((counts * sizes)[own].sum())

    def first(self, counts: np.ndarray) -> np.ndarray:
        """The number that the words of each of these counts begin at."""
        return self.firsts[len(self.counts) - 1 - np.searchsorted(self.counts[:0:-1], counts)]

    def occurrences(self, numbers: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.firsts, numbers, "right") - 1]

    def seen(self, ids: np.ndarray) -> np.ndarray:
        found = self.occurrences(np.minimum(ids, self.known))
        return np.where(ids == 0, self.unknown, np.where(ids > self.known, self.ends, found))

    def share(self, ids: np.ndarray) -> np.ndarray:
        return np.maximum(1, self.seen(ids)) / self.mass

    def ids(self, numbers: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Ids of a chunk's tokens, given by place among its words (0 is an end)."""
        return np.append(self.end, np.where(numbers <= self.known, numbers, 0))[which]

    def pairs(self, ids: np.ndarray) -> np.ndarray:
        """History and word of each token as one number."""
        found = np.empty(len(ids), np.uint64)
        found[:1], found[1:] = self.start, ids[:-1]
        found[found == self.end] = self.start
        found *= np.uint64(self.size)
        found += ids.view(np.uint64)
        return found

    def split(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (pairs // np.uint64(self.size)).astype(np.int64), (pairs % np.uint64(self.size)).astype(np.int64)


def vocabulary(counts: DataFrame) -> Vocabulary:
    end = F.col("word") == int(END.view(np.int64))
    ends = counts.where(end).first()
    found = counts.where(~end).groupBy("n").agg(F.count(F.lit(1)).alias("size")).toArrow()  # at most sqrt(2 tokens) rows
    return Vocabulary(found.column("n").to_numpy(), found.column("size").to_numpy(), ends.n if ends else 0)


def discounts(counts: dict[int, int]) -> np.ndarray:
    """Factor for the counts 0 .. CUTOFF, and last the amount taken off larger counts.

    ``counts`` has the number of pairs seen 1 .. CUTOFF + 1 times. Where they give no factor
    between 0 and 1, as in small corpora, half a count is taken off. Larger counts lose a
    twentieth of a count, so that every history has something left for unseen words.
    """
    n = [0, *(counts.get(r, 0) for r in range(1, CUTOFF + 2))]
    factors = [1.0]
    over = (CUTOFF + 1) * n[CUTOFF + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUTOFF + 1):
        ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        factor = (ratio - over) / (1 - over) if over < 1 else 0.0
        factors.append(factor if 0 < factor < 1 else (r - 0.5) / r)
    return np.array([*factors, 0.05])


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    small = np.minimum(counts, CUTOFF)
    return np.where(counts <= CUTOFF, factors[small] * counts, counts - factors[-1])


def _parts(values: np.ndarray, n: int) -> np.ndarray:
    return (mixed(values) % np.uint64(n)).astype(np.int32)


def _dealt(values: np.ndarray, n: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of sorted 64-bit values by partition, and (partition, start, end) in that order."""
    part = _parts(values, n)
    order = np.argsort(part, kind="stable")
    names, starts = np.unique(part[order], return_index=True)
    return order, list(zip(names.tolist(), starts.tolist(), np.append(starts, len(order))[1:].tolist(), strict=True))


def _asked(kind: str, values: np.ndarray, dealt: list[tuple[int, int, int]]) -> list[tuple[str, int, bytes]]:
    return [(kind, p, shrunk(np.diff(values[a:b], prepend=np.uint64(0)))) for p, a, b in dealt]


def _answered(blobs: dict[int, bytes], order: np.ndarray, kind: type) -> np.ndarray:
    """What the partitions answered, in the order of the values before they were dealt."""
    found = np.zeros(len(order), kind)
    if len(order):
        found[order] = np.concatenate([grown(blobs[p], kind) for p in sorted(blobs)])
    return found


_CHUNK_FIELDS = [("kind", "string"), ("chunk", "long"), ("part", "int"), ("payload", "binary")]
_CHUNK_ROW = ", ".join(f"{c} {t}" for c, t in _CHUNK_FIELDS)


def _chunk_table(chunk: int, made: list[tuple[str, int, bytes]]) -> pa.Table:
    kinds, parts, payloads = zip(*made, strict=True) if made else ((), (), ())
    return pa.table({"kind": pa.array(kinds, pa.string()), "chunk": pa.array([chunk] * len(made), pa.int64()), "part": pa.array(parts, pa.int32()), "payload": pa.array(payloads, pa.binary())})


def _blobs(group: pa.Table, kind: str) -> dict[int, bytes]:
    own = group.filter(pa.array([k == kind for k in group.column("kind").to_pylist()], pa.bool_()))
    return dict(zip(own.column("part").to_pylist(), own.column("payload").to_pylist(), strict=True))


def _chunks(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of four kinds: the tokens of a chunk (by place among its words, which are ordered by
    partition and hash; 0 is an end), which of its texts are learned from, its texts (one row
    each, with key), and the words it asks each partition for."""
    schema = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("chunk", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("payload", T.BinaryType()), T.StructField("key", rows.schema["key"].dataType), T.StructField("tokens", T.LongType())])

    def emitted(chunk: int, held: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([h for h, *_ in held])
        sizes = np.concatenate([np.diff(f) for _, f, *_ in held])
        train = np.concatenate([t for *_, t, _ in held])
        inner = hashes != END
        words, where = np.unique(hashes[inner], return_inverse=True)
        order, dealt = _dealt(words, parts)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(1, len(order) + 1, dtype=np.int32)
        which = np.zeros(len(hashes), np.int32)
        which[inner] = place[where]
        made = [("tokens", 0, shrunk(which)), ("train", 0, shrunk(train.astype(np.uint8))), *_asked("words", words[order], dealt)]
        table = _chunk_table(chunk, made)
        key_type = held[0][3].type
        yield pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in table.columns), pa.nulls(len(made), key_type), pa.nulls(len(made), pa.int64())], names=schema.names)
        n = len(sizes)
        keys = pa.chunked_array([k for *_, k in held]).combine_chunks()
        yield pa.RecordBatch.from_arrays([pa.array(["texts"] * n), pa.array([chunk] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.nulls(n, pa.binary()), keys, pa.array(sizes, pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in slices(batches):
            hashes, firsts = tokens(batch.column("text"))
            if held and size + len(hashes) > CHUNK_TOKENS:
                yield from emitted(chunk, held)
                chunk, held, size = chunk + 1, [], 0
            held.append((hashes, firsts, batch.column("train").to_numpy(zero_copy_only=False).astype(bool), batch.column("key")))
            size += len(hashes)
        if held:
            yield from emitted(chunk, held)

    return rows.mapInArrow(run, schema)


def _numbers(asked: DataFrame, counts: DataFrame, vocab, parts: int) -> DataFrame:
    """Numbers of the words that the chunks ask for, in the order they ask. Words of one count are
    numbered by partition and hash; outside the vocabulary they share their count's first number."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("part", pa.array(_parts(batch.column("word").to_numpy().view(np.uint64), parts)))

    def run(asking: pa.Table, table: pa.Table) -> pa.Table:
        words, n, before = (table.column(c) for c in ("word", "n", "before"))
        own, sums = table.filter(words.is_valid()), table.filter(words.is_null()).sort_by("n")
        words, n = own.column("word").to_numpy().view(np.uint64), own.column("n").to_numpy()
        order = np.lexsort((words, n))
        words, n = words[order], n[order]
        rank = np.arange(len(n)) - np.searchsorted(n, n)
        first = vocab.value.first(n)
        number = first
        if len(n):
            before = sums.column("before").to_numpy()[np.searchsorted(sums.column("n").to_numpy(), n)]
            number = np.where(first <= vocab.value.known, first + before + rank, first)
        order = np.argsort(words)
        words, number = np.append(words[order], END), np.append(number[order], 0)
        out = []
        for chunk, part, payload in zip(*(asking.column(c).to_pylist() for c in ("chunk", "part", "payload")), strict=True):
            wanted = np.cumsum(grown(payload, np.uint64), dtype=np.uint64)
            at = np.minimum(np.searchsorted(words[:-1], wanted), len(words) - 1)
            out.append(_chunk_table(chunk, [("numbers", part, shrunk(np.where(words[at] == wanted, number[at], 0).astype(np.int64)))]))
        return pa.concat_tables(out) if out else _chunk_table(0, [])

    placed = counts.where(F.col("word") != int(END.view(np.int64))).mapInArrow(place, "word long, n long, part int")
    earlier = F.sum("size").over(Window.partitionBy("n").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = placed.groupBy("n", "part").agg(F.count(F.lit(1)).alias("size")).select("n", "part", F.coalesce(earlier, F.lit(0)).alias("before"))
    table = placed.withColumn("before", F.lit(None).cast("long")).unionByName(sums.withColumn("word", F.lit(None).cast("long")))
    return asked.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(run, _CHUNK_ROW)


def _questions(met: DataFrame, vocab, parts: int) -> DataFrame:
    """The pairs a chunk asks each partition for, how often it has seen them in training texts, and
    the histories whose backoff weights it asks for."""
    def run(group: pa.Table) -> pa.Table:
        words = vocab.value
        which = grown(_blobs(group, "tokens")[0], np.int32)
        train = grown(_blobs(group, "train")[0], np.uint8)
        sizes = np.diff(np.flatnonzero(which == 0), prepend=-1)
        ids = words.ids(_joined(_blobs(group, "numbers")), which)
        pairs, where = np.unique(words.pairs(ids), return_inverse=True)
        seen = np.bincount(where, np.repeat(train, sizes), len(pairs)).astype(np.uint32)
        order, dealt = _dealt(pairs, parts)
        made = _asked("pairs", pairs[order], dealt)
        made += [("seen", p, shrunk(seen[order[a:b]])) for p, a, b in dealt]
        histories = np.unique(words.split(pairs)[0]).astype(np.uint64)
        order, dealt = _dealt(histories, parts)
        return _chunk_table(group.column("chunk")[0].as_py(), made + _asked("histories", histories[order], dealt))

    return met.groupBy("chunk").applyInArrow(run, _CHUNK_ROW)


def _joined(blobs: dict[int, bytes]) -> np.ndarray:
    """Numbers of a chunk's words, in its own order of them."""
    return np.concatenate([np.zeros(0, np.int64), *(grown(blobs[p], np.int64) for p in sorted(blobs))])


def _pair_table(asked: DataFrame) -> DataFrame:
    """Totals of all pairs, by partition: answers to the chunks, the seen pairs and their counts,
    and how many pairs were seen r times (chunk = r, payload empty, n)."""
    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("kind", T.StringType()), ("chunk", T.LongType()), ("part", T.IntegerType()), ("payload", T.BinaryType()), ("n", T.LongType()))])

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("chunk", "kind", "payload")), strict=True))
        part = group.column("part")[0].as_py()
        chunks = sorted({r[0] for r in rows})
        pairs = [np.cumsum(grown(p, np.uint64), dtype=np.uint64) for _, kind, p in rows if kind == "pairs"]
        seen = np.concatenate([grown(p, np.uint32) for _, kind, p in rows if kind == "seen"])
        keys, where = np.unique(np.concatenate(pairs), return_inverse=True)
        totals = np.bincount(where, seen, len(keys)).astype(np.int64)
        ends = np.cumsum([0, *map(len, pairs)])
        out = [("answers", c, part, shrunk(totals[where[a:b]]), None) for c, a, b in zip(chunks, ends[:-1], ends[1:], strict=True)]
        known = totals > 0
        out += [("keys", 0, part, shrunk(np.diff(keys[known], prepend=np.uint64(0))), None), ("counts", 0, part, shrunk(totals[known]), None)]
        out += [("ranks", r, part, None, int((totals == r).sum())) for r in range(1, CUTOFF + 2)]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64()), strict=True)], names=schema.names)

    return asked.groupBy("part").applyInArrow(run, schema)


def _backoff(asked: DataFrame, seen: DataFrame, vocab, factors: np.ndarray, parts: int) -> DataFrame:
    """For each history that a chunk asks for: the factors for unseen words, then those for seen
    words (1, unless every word was seen after it)."""
    def add(group: pa.Table) -> pa.Table:
        words = vocab.value
        by_kind = dict(zip(group.column("kind").to_pylist(), group.column("payload").to_pylist(), strict=True))
        keys, counts = np.cumsum(grown(by_kind["keys"], np.uint64), dtype=np.uint64), grown(by_kind["counts"], np.int64)
        history, word = words.split(keys)
        own, where = np.unique(history, return_inverse=True)
        taken = np.bincount(where, discounted(counts, factors) / words.seen(history), len(own))
        lower = np.bincount(where, words.share(word), len(own))
        return pa.table({"history": own, "taken": taken.astype(np.float64), "lower": lower.astype(np.float64)})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("part", pa.array(_parts(batch.column("history").to_numpy().view(np.uint64), parts)))

    def run(asking: pa.Table, table: pa.Table) -> pa.Table:
        table = table.sort_by("history")
        known, taken, lower = (table.column(c).to_numpy() for c in ("history", "taken", "lower"))
        every = 1 - lower < 1e-9
        # Last, a history that was never seen.
        known = np.append(known.view(np.uint64), END)
        unseen = np.append(np.where(every, 0.0, (1 - taken) / np.where(every, 1.0, 1 - lower)), 1.0)
        scale = np.append(np.where(every, 1 / taken, 1.0), 1.0)
        out = []
        for chunk, part, payload in zip(*(asking.column(c).to_pylist() for c in ("chunk", "part", "payload")), strict=True):
            wanted = np.cumsum(grown(payload, np.uint64), dtype=np.uint64)
            at = np.searchsorted(known[:-1], wanted)
            at = np.where(known[at] == wanted, at, len(known) - 1)
            out.append(_chunk_table(chunk, [("unseen", part, shrunk(unseen[at])), ("scale", part, shrunk(scale[at]))]))
        return pa.concat_tables(out) if out else _chunk_table(0, [])

    sums = seen.groupBy("part").applyInArrow(add, "history long, taken double, lower double").groupBy("history").agg(F.sum("taken").alias("taken"), F.sum("lower").alias("lower"))
    placed = sums.mapInArrow(place, "history long, taken double, lower double, part int")
    return asked.groupBy("part").cogroup(placed.groupBy("part")).applyInArrow(run, _CHUNK_ROW)


def katz_scores(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``train`` selects the rows that are learned from (null: no). ``n_known`` counts tokens seen in
    training, ``base_score`` adds up log10((c + 0.1) / (N + 0.1 (V + 1))), ``score`` is the model's
    log10 probability of the text. One row for each input row, repeated and null keys included; a
    null or empty text is one end. Without training rows every token is unknown. Other columns
    are not read.
    """
    spark = docs.sparkSession
    scratch, rows = Scratch(spark, "katz"), _rows(docs, train, key, text)
    counts = scratch.save(word_counts(rows), "words")
    words = vocabulary(counts)
    vocab, parts = spark.sparkContext.broadcast(words), max(1, words.total // PART_TOKENS)
    fields = [c for c, _ in _CHUNK_FIELDS]
    chunks = scratch.save(_chunks(rows, parts), "chunks", "kind")
    numbers = scratch.save(_numbers(chunks.where("kind = 'words'").select(*fields), counts, vocab, parts), "numbers")
    asked = scratch.save(_questions(chunks.where("kind in ('tokens', 'train')").select(*fields).unionByName(numbers), vocab, parts), "asked", "kind")
    table = scratch.save(_pair_table(asked.where("kind in ('pairs', 'seen')")), "pairs", "kind")
    ranks = {r.chunk: r.n for r in table.where("kind = 'ranks'").groupBy("chunk").agg(F.sum("n").alias("n")).collect()}
    factors = discounts(ranks)
    weights = scratch.save(_backoff(asked.where("kind = 'histories'"), table.where("kind in ('keys', 'counts')").select("kind", "part", "payload"), vocab, factors, parts), "weights")
    scratch.drop("words", "asked")
    own = chunks.where("kind in ('tokens', 'texts')").select(*fields, "key", "tokens")
    met = own.unionByName(numbers, True).unionByName(table.where("kind = 'answers'").select(*fields), True).unionByName(weights, True)
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(group: pa.Table) -> pa.Table:
        words = vocab.value
        texts = group.filter(pa.array([k == "texts" for k in group.column("kind").to_pylist()], pa.bool_())).sort_by("part")
        which, known = grown(_blobs(group, "tokens")[0], np.int32), _joined(_blobs(group, "numbers"))
        firsts = np.append(0, np.cumsum(texts.column("tokens").to_numpy()))
        pairs, where = np.unique(words.pairs(words.ids(known, which)), return_inverse=True)
        totals = _answered(_blobs(group, "answers"), _dealt(pairs, parts)[0], np.int64)
        history, word = words.split(pairs)
        histories, after = np.unique(history, return_inverse=True)
        order = _dealt(histories.astype(np.uint64), parts)[0]
        unseen, scale = (_answered(_blobs(group, kind), order, np.float64)[after] for kind in ("unseen", "scale"))
        # By distinct pair and word: of the arrays as long as the chunk, few live at a time.
        p_seen = scale * discounted(totals, factors) / np.maximum(1, words.seen(history))
        p = np.where(totals > 0, p_seen, unseen * words.share(word))
        p = np.log10(np.where(word == 0, p / words.members, p))
        del pairs, totals, history, word, histories, after, order, unseen, scale, p_seen
        seen = np.append(words.ends, words.occurrences(known))
        base = np.log10((seen + 0.1) / (words.total + 0.1 * (words.distinct + 1)))
        n, starts = len(texts), firsts[:-1]
        return pa.Table.from_arrays([
            texts.column("key"), texts.column("tokens"), pa.array(np.add.reduceat((seen > 0)[which], starts, dtype=np.int64)),
            pa.array(np.full(n, words.total, np.int64)), pa.array(np.add.reduceat(base[which], starts)), pa.array(np.add.reduceat(p[where], starts))], names=schema.names)

    return met.groupBy("chunk").applyInArrow(run, schema)
