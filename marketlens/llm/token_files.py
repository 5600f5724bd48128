"""Token ids of a corpus in binary files, coded with a static range asymmetric numeral system.

``write`` tokenises all texts, counts every id, makes one frequency table from the counts, and
writes the ids in key order to a folder:

* ``table``: one record, the ids that occur and their frequencies;
* ``blocks``: a file for each shard, a record for about ``RECORD_IDS`` ids of whole documents;
* ``checkpoints``: where each shard starts (Parquet).

A record of ``blocks`` has, little-endian: a mask byte; a header (format mark, version, lanes,
shard, number in the shard, ids before it in the shard, ids, blocks, steps of a lane, bytes of the index);
the index, an Arrow stream of (key, n); for each block its words, the CRC-32 of its ids and the
last states of its lanes; the words; the CRC-32 of all after the mask. Blocks are independent: any
can be decoded with the table and its own states and words. All bytes after the mask are combined
with it (exclusive or); it is chosen so that the mark that ends each record occurs nowhere else.
Spark's text reader therefore splits a file at records, and tasks decode parts of one file.

Files are written by Spark's own writer, so a lost or repeated task leaves no partial file.
"""

from __future__ import annotations

import json
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from marketlens.llm.byte_bpe import gathered
from marketlens.llm.rans import Coder, frequencies
from marketlens.llm.storage import Scratch
from marketlens.llm.text import SPACES, Texts, slices, text_and_key

LANES = 32
BLOCK_IDS = 16_384
RECORD_IDS = 1 << 20
SHARD_IDS = 1 << 24
CACHED_PIECES = 1_500_000  # pieces of text whose ids a worker keeps, about 40 bytes each

END_OF_RECORD = "\x01\x1eTKN\x1f\x02\x03"
HEADER = struct.Struct("<4sHHIIqqIII")
MARK, VERSION = b"TKNR", 1


JOINED_PIECES = 300  # pieces that are encoded as one text

# Kinds of bytes; a byte of a character that is not ASCII is OTHER, but in the letters of LETTER_LEADS.
OTHER, SPACE, BREAK, LETTER, DIGIT, SIGN, APOSTROPHE = range(7)
KINDS = np.full(256, OTHER, np.int8)
KINDS[:128] = SIGN
KINDS[np.flatnonzero(SPACES)] = BREAK
KINDS[0x20], KINDS[0x27] = SPACE, APOSTROPHE
KINDS[0x30:0x3A] = DIGIT
KINDS[0x41:0x5B] = KINDS[0x61:0x7B] = LETTER
PLAIN = np.isin(np.arange(7), (LETTER, DIGIT, SIGN, APOSTROPHE))
# First bytes of U+00C0 to U+027F and U+0400 to U+047F, which are letters but for U+00D7 and U+00F7.
LETTER_LEADS = np.zeros(256, bool)
LETTER_LEADS[[*range(0xC3, 0xCA), 0xD0, 0xD1]] = True
# Pairs of kinds between which a pre-token always ends.
CUTS = np.zeros((7, 7), bool)
for _kind in (LETTER, DIGIT, SIGN, APOSTROPHE):
    CUTS[_kind, [SPACE, BREAK]] = True
for _kind in (LETTER, DIGIT, SIGN):
    CUTS[_kind, [k for k in (LETTER, DIGIT) if k != _kind]] = True
    CUTS[_kind, [SIGN, APOSTROPHE]] = _kind != SIGN


def kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of a UTF-8 text."""
    kinds = KINDS[data]
    lead = np.flatnonzero(LETTER_LEADS[data[:-1]])
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
    kinds[lead] = kinds[lead + 1] = LETTER
    return kinds


class BrokenRecord(ValueError):
    """A record or block whose checksum does not fit."""


class IdCoder:
    """Ids of whole texts by the tokenizers library.

    A plain byte-level pre-tokenizer always starts a new pre-token at certain pairs of ASCII
    characters (``_bounds``), so texts may be cut there; each different piece is encoded once and
    kept. Pieces are told apart by two 64-bit hashes. New pieces are encoded as one text, joined so
    that they stay apart; the lengths of the ids' strings say which ids belong to which piece.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        before = parts.get("pre_tokenizer") or {}
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                     and not parts.get("normalizer") and all(t["special"] for t in parts.get("added_tokens", ())))
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(t) for t in vocabulary]  # byte-level strings have a character for each byte
        self._forget()

    def _forget(self) -> None:
        """``one`` (sorted) and ``two`` are the hashes of known pieces, ``segment`` their places in ``flat``."""
        self.one, self.two, self.segment = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.ends = array("I"), array("q", [0])

    def _bounds(self, texts: Texts, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of pieces; a text without bytes has none.

        Between characters of known kinds, a pre-token ends before white space that follows
        something else, at each change between letters, digits and signs (but after an
        apostrophe, which may begin a contraction), and after a single white space other than a
        space.
        """
        flag = np.zeros(len(texts.data), bool)
        if self.cuts and len(flag) > 1:
            here, before = kinds[1:], kinds[:-1]
            flag[1:] = CUTS.reshape(-1)[before * np.int8(7) + here]
            # A break that is white space by itself: what stands before it is none, or nothing.
            flag[texts.starts] = True
            alone = np.flatnonzero(flag[:-1] & (before == BREAK))
            flag[alone[PLAIN[kinds[alone + 1]]] + 1] = True
        flag[texts.starts] = flag[texts.ends] = True
        bounds = np.append(np.flatnonzero(flag), len(texts.data))
        separator = np.zeros(len(texts.data) + 1, bool)
        separator[texts.ends] = True
        own = ~separator[bounds[:-1]]
        return bounds[:-1][own], bounds[1:][own]

    def _new(self, data: np.ndarray, kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Ids of each piece."""
        first, last = kinds[starts], kinds[ends - 1]
        # Joined are pieces that end in a plain character; one that begins so too gets a line break before it.
        plain = (first != OTHER) & PLAIN[last] & self.cuts
        found: list[np.ndarray | None] = [None] * len(starts)
        own = np.flatnonzero(plain)
        if len(own):
            apart = PLAIN[first[own]]
            sizes = ends[own] - starts[own]
            old, new = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(sizes + apart))
            joined = np.full(new[-1], 10, np.uint8)
            within = np.arange(old[-1])
            joined[within + np.repeat(new[:-1] + apart - old[:-1], sizes)] = data[within + np.repeat(starts[own] - old[:-1], sizes)]
            edges = [*new[:-1:JOINED_PIECES].tolist(), len(joined)]
            texts = [joined[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            upto = np.append(0, np.cumsum(self.bytes_of[ids]))
            low, high = np.searchsorted(upto, new[:-1] + apart), np.searchsorted(upto, new[1:])
            if (upto[low] == new[:-1] + apart).all() and (upto[high] == new[1:]).all():
                for n, a, b in zip(own.tolist(), low.tolist(), high.tolist(), strict=True):
                    found[n] = ids[a:b]
        rest = [n for n, ids in enumerate(found) if ids is None]
        for n, encoding in zip(rest, self.tokenizer.encode_batch_fast([data[starts[n] : ends[n]].tobytes().decode() for n in rest], add_special_tokens=False), strict=True):
            found[n] = np.array(encoding.ids, np.uint32)
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n + 1 offsets of each text's ids."""
        texts = Texts(column)
        kinds = kinds_of(texts.data)
        starts, ends = self._bounds(texts, kinds)
        one, two = (texts.hashes(starts, ends, k) for k in (0, 1))
        _, first, which = np.unique(one, return_index=True, return_inverse=True)
        if (two != two[first][which]).any():  # pieces that only the second hash tells apart
            _, first, which = np.unique(np.stack([one, two], axis=1), axis=0, return_index=True, return_inverse=True)
        one, two = one[first], two[first]
        if len(self.one) > CACHED_PIECES:
            self._forget()
        place = np.searchsorted(self.one, one)
        hit = place < len(self.one)
        hit[hit] = (self.one[place[hit]] == one[hit]) & (self.two[place[hit]] == two[hit])
        segment, new = np.zeros(len(one), np.int64), np.flatnonzero(~hit)
        segment[hit] = self.segment[place[hit]]
        if len(new):
            found = self._new(texts.data, kinds, starts[first[new]], ends[first[new]])
            segment[new] = len(self.ends) - 1 + np.arange(len(new))
            self.ends.frombytes((self.ends[-1] + np.cumsum([len(x) for x in found])).astype(np.int64).tobytes())
            self.flat.frombytes(np.concatenate(found).tobytes())
            self.one, self.two, self.segment = (
                np.insert(a, place[new], b[new]) for a, b in ((self.one, one), (self.two, two), (self.segment, segment)))
        ids, per_piece = gathered(np.frombuffer(self.flat, np.uint32), np.frombuffer(self.ends, np.int64), segment[which.reshape(-1)])
        sums = np.append(0, np.cumsum(per_piece))
        return ids, sums[np.append(np.searchsorted(starts, texts.starts), len(starts))]


@lru_cache(maxsize=2)
def id_coder(path: str) -> IdCoder:
    """One for each worker process."""
    return IdCoder(path)


def tokenized(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, ids): each text's ids and the end id, as 32-bit numbers compressed by zstandard."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, pack = id_coder(path), zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches):
            ids, offsets = coder.encode(batch.column("text"))
            ids = np.insert(ids, offsets[1:], end_id).astype(np.uint32)
            offsets = offsets + np.arange(len(offsets))
            # The two bytes that nearly all ids fit into stand together; the others are zeros.
            packed = [pack(ids[a:b].view(np.uint16).reshape(-1, 2).T.tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(offsets)), pa.array(packed, pa.binary())], names=schema.names)

    return text_and_key(docs, key, text).mapInArrow(run, schema)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Keys, lengths and ids of pieces of about ``RECORD_IDS`` ids; a longer text is a piece of its own."""
    unpack = zstandard.ZstdDecompressor().decompress

    def piece(keys: list[pa.Array], parts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        return pa.concat_arrays(keys), np.array([len(p) for p in parts]), np.concatenate(parts)

    keys: list[pa.Array] = []
    parts: list[np.ndarray] = []
    held = 0
    for batch in batches:
        start, column = 0, batch.column("key")
        for n, packed in enumerate(batch.column("ids")):
            ids = np.frombuffer(unpack(packed.as_buffer()), np.uint16).reshape(2, -1).T.copy().view(np.uint32).reshape(-1)
            if held and held + len(ids) > RECORD_IDS:
                yield piece([*keys, column.slice(start, n - start)], parts)
                keys, parts, held, start = [], [], 0, n
            parts.append(ids)
            held += len(ids)
        keys.append(column.slice(start))
    if parts:
        yield piece(keys, parts)


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, count) of all ids of ``tokenized`` rows; a row for each different id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, np.int64)
        for _, _, ids in _unpacked(batches):
            own = np.bincount(ids, minlength=len(counts))
            own[: len(counts)] += counts
            counts = own
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "count"])

    return tokens.select("key", "ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


class Table:
    """The shared frequency table: ids that occur, by id, and their frequencies."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray, bits: int):
        self.ids, self.freqs, self.bits = ids.astype(np.uint32), freqs.astype(np.uint32), bits
        self.symbols = np.zeros(int(ids[-1]) + 1 if len(ids) else 0, np.int32)  # of each id
        self.symbols[self.ids] = np.arange(len(ids))

    def to_bytes(self) -> bytes:
        body = struct.pack("<4sHHI", MARK, VERSION, self.bits, len(self.ids)) + self.ids.tobytes() + self.freqs.tobytes()
        return sealed(body)

    @classmethod
    def from_bytes(cls, record: bytes) -> Table:
        body = opened(record)
        mark, version, bits, n = struct.unpack_from("<4sHHI", body)
        if (mark, version) != (MARK, VERSION):
            raise BrokenRecord("not a table of this format")
        both = np.frombuffer(body, np.uint32, 2 * n, struct.calcsize("<4sHHI"))
        return cls(both[:n], both[n:], bits)


@lru_cache(maxsize=2)
def _coder(table: bytes, lanes: int) -> tuple[Table, Coder]:
    found = Table.from_bytes(table)
    return found, Coder(found.freqs, found.bits, lanes)


def sealed(body: bytes) -> bytes:
    """A record: mask byte, then the body and its CRC-32 under the mask."""
    plain = np.frombuffer(body + struct.pack("<I", zlib.crc32(body)), np.uint8)
    for mask in range(256):
        record = bytes([mask]) + (plain ^ np.uint8(mask)).tobytes()
        if END_OF_RECORD.encode() not in record + END_OF_RECORD.encode()[:-1]:
            return record
    raise ValueError("no mask fits")  # each mask needs 8 bytes of its own kind, so a record of 2 KB or more


def opened(record: bytes) -> bytes:
    plain = (np.frombuffer(record, np.uint8)[1:] ^ np.uint8(record[0])).tobytes() if record else b""
    if len(plain) < 4 or zlib.crc32(plain[:-4]) != struct.unpack("<I", plain[-4:])[0]:
        raise BrokenRecord("a record's checksum does not fit")
    return plain[:-4]


def record_of(table: bytes, shard: int, number: int, before: int, keys: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One record of whole documents."""
    held, coder = _coder(table, LANES)
    blocks = -(-len(ids) // BLOCK_IDS)
    steps = -(-len(ids) // (blocks * LANES))
    symbols = np.full(blocks * steps * LANES, np.argmax(held.freqs))
    symbols[: len(ids)] = held.symbols[ids]
    words, sizes, states = coder.encode(symbols, blocks)
    checks = [zlib.crc32(ids[k : k + steps * LANES]) for k in range(0, blocks * steps * LANES, steps * LANES)]
    sink = pa.BufferOutputStream()
    index = pa.RecordBatch.from_arrays([keys, pa.array(lengths, pa.int64())], names=["key", "n"])
    with pa.ipc.new_stream(sink, index.schema) as stream:
        stream.write_batch(index)
    listed = sink.getvalue().to_pybytes()
    header = HEADER.pack(MARK, VERSION, LANES, shard, number, before, len(ids), blocks, steps, len(listed))
    return sealed(b"".join((header, listed, sizes.astype(np.uint32).tobytes(), np.array(checks, np.uint32).tobytes(), states.tobytes(), words.tobytes())))


def header_of(record: bytes) -> tuple[int, int, int, int]:
    """Shard, number, ids before it in the shard, and ids of a record; its first bytes suffice."""
    plain = (np.frombuffer(record, np.uint8, HEADER.size, 1) ^ np.uint8(record[0])).tobytes()
    return HEADER.unpack(plain)[3:7]


def documents_of(table: bytes, record: bytes) -> tuple[int, int, pa.Array, np.ndarray, np.ndarray]:
    """Shard, ids before it in the shard, keys, lengths and ids of a record; checks each block."""
    body = opened(record)
    mark, version, lanes, shard, _, before, n, blocks, steps, size = HEADER.unpack_from(body)
    if (mark, version) != (MARK, VERSION):
        raise BrokenRecord("not a record of this format")
    held, coder = _coder(table, lanes)
    index = pa.ipc.open_stream(body[HEADER.size : HEADER.size + size]).read_all().combine_chunks()
    at = HEADER.size + size
    sizes, checks = np.frombuffer(body, np.uint32, 2 * blocks, at).astype(np.int64).reshape(2, -1)
    states = np.frombuffer(body[at + 8 * blocks : at + 8 * blocks + 8 * blocks * lanes], np.uint64).reshape(blocks, lanes)
    words = np.frombuffer(body[at + 8 * blocks * (1 + lanes) :], np.uint32)
    ids = held.ids[coder.decode(words, sizes, states, steps)][:n]
    for block, check in enumerate(checks.tolist()):
        if zlib.crc32(ids[block * steps * lanes : (block + 1) * steps * lanes]) != check:
            raise BrokenRecord(f"block {block} of shard {shard} does not have its checksum")
    key = index.column("key")
    return shard, before, key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key, index.column("n").to_numpy(), ids


def _records(frame: DataFrame, folder: str) -> None:
    frame.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END_OF_RECORD).text(folder)


def _read_records(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("lineSep", END_OF_RECORD).text(folder).select(F.col("value").cast("binary").alias("record"))


def write(docs: DataFrame, folder: str, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write all documents' ids to ``folder``, by ascending key.

    ``path`` is a tokenizers file that the executors reach too; special tokens' strings in a text
    are ordinary text. Every text ends with ``end_id``; a null text is an empty one. Null keys come
    first; documents of one key are ordered by their ids, so repeated rows are interchangeable.
    Other columns are not read. A key that is repeated very often is spread over several shards.
    The folder must not exist. The table's size is bounded by the vocabulary.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    tokens = scratch.save(tokenized(docs, path, end_id, key, text).withColumns({
        "digest": F.xxhash64("ids"), "row": F.monotonically_increasing_id()}), "ids")
    counts = count_ids(tokens).orderBy("id").toArrow()
    freqs, bits = frequencies(counts.column("count").to_numpy())
    table = Table(counts.column("id").to_numpy(), freqs, bits).to_bytes()
    shards = max(1, -(-int(counts.column("count").to_numpy().sum()) // shard_ids))
    order = ["key", "digest", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        for number, (keys, lengths, ids) in enumerate(_unpacked(batches)):
            yield pa.RecordBatch.from_arrays([pa.array([record_of(table, shard, number, before, keys, lengths, ids)], pa.binary())], names=["record"])
            before += len(ids)

    _records(spark.createDataFrame([(bytearray(table),)], "record binary"), f"{folder}/table")
    ordered = tokens.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    _records(ordered.select("key", "ids").mapInArrow(run, "record binary"), f"{folder}/blocks")
    scratch.drop("ids")
    sizes = headers(spark, folder).groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    sizes.select("shard", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)).alias("first")).write.parquet(f"{folder}/checkpoints")


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, number, before, n_ids) of every record; Python gets only the records' first bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [header_of(r.as_py()) for r in batch.column("record")]
            columns = zip(*found, strict=True) if found else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shard", "number", "before", "n_ids"])

    return _read_records(spark, f"{folder}/blocks").select(F.substring("record", 1, HEADER.size + 1).alias("record")).mapInArrow(
        run, "shard long, number long, before long, n_ids long")


def read(spark: SparkSession, folder: str, key_type: T.DataType | str = "long", key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """(key, start, n, crc32, ids) of every document in the files of ``write``.

    ``start`` counts the ids of all documents before it, end ids included; ``crc32`` is of the ids
    as little-endian unsigned 32-bit numbers. Each block's checksum is compared; a difference
    raises. Without ``with_ids``, ``ids`` is null.
    """
    key_type = T._parse_datatype_string(key_type) if isinstance(key_type, str) else key_type
    table = bytes(_read_records(spark, f"{folder}/table").first().record)
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("before", T.LongType()), T.StructField("key", key_type),
        T.StructField("n", T.LongType()), T.StructField("crc32", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.column("record"):
                shard, before, keys, lengths, ids = documents_of(table, record.as_py())
                ends = np.append(0, np.cumsum(lengths))
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int64())) if with_ids else pa.nulls(len(keys), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(keys), shard)), pa.array(before + ends[:-1]), keys, pa.array(lengths), pa.array(sums, pa.int64()), listed], names=schema.names)

    found = _read_records(spark, f"{folder}/blocks").mapInArrow(run, schema)
    return found.join(spark.read.parquet(f"{folder}/checkpoints"), "shard").select(
        F.col("key").alias(key), (F.col("first") + F.col("before")).alias("start"), "n", "crc32", "ids")
