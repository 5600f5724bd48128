"""Byte-level BPE with a sentencepiece model that is written from a rank table.

A rank file lists byte strings and their merge ranks. Every byte is mapped to one
character, so a byte string becomes a piece; its score is the negative rank, and the
normaliser is the identity. Merging the pair with the highest score then equals merging
the pair with the lowest rank. Texts are cut into pre-tokens by a pattern first; each is
encoded by itself, and ids are decoded by the inverse map.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlens.llm.text import slices, text_and_key

CACHED_PIECES = 200_000  # pre-tokens kept by a worker between slices
CHUNK_PIECES = 100_000  # pre-tokens of one text that are handled at once

# Piece kinds of the sentencepiece model format (fixed values).
NORMAL, UNKNOWN = 1, 2
_CHARACTERS = {b: chr(0x100 + b) for b in range(256)}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def mapped(piece: bytes) -> str:
    """One character for each byte."""
    return piece.decode("latin-1").translate(_CHARACTERS)


def model_bytes(pieces: list[bytes]) -> bytes:
    """A sentencepiece BPE model of these pieces in rank order; id = rank + 1, 0 is unknown.

    Field numbers are those of the public model format: 1 pieces (1 text, 2 score, 3 kind),
    2 trainer (3 model type, 4 size, 40-43 special ids), 3 normaliser (1 name, 3-5 white space).
    """
    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    bpe, none = 2, -1
    trainer = _number(3, bpe) + _number(4, len(pieces) + 1) + _number(40, 0) + b"".join(_number(f, none) for f in (41, 42, 43))
    normaliser = _block(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))
    return b"".join((
        piece("<unk>", 0.0, UNKNOWN), *(piece(mapped(p), -float(r), NORMAL) for r, p in enumerate(pieces)),
        _block(2, trainer), _block(3, normaliser)))


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in rank order; the ranks of the file must be 0, 1, 2, ..."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks have gaps")
    return [ranks[r] for r in range(len(ranks))]


def gathered(flat: np.ndarray, ends: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the picked segments of a flat array; segment k is flat[ends[k]:ends[k + 1]].

    Returns the values and the length of each picked segment.
    """
    lengths = ends[picked + 1] - ends[picked]
    total = np.append(0, np.cumsum(lengths))
    return flat[np.repeat(ends[picked] - total[:-1], lengths) + np.arange(total[-1])], lengths


class ByteBpe:
    """Encoder and decoder of one rank file and pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        pieces = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(pieces))
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_ends = np.append(0, np.cumsum([len(p) for p in pieces]))
        # A pre-token that is a piece is that piece, even if no merges lead to it.
        found = self.model.encode([mapped(p) for p in pieces], out_type=int, num_threads=1)
        self.unreached = {mapped(p): [r + 1] for r, p in enumerate(pieces) if found[r] != [r + 1]}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # pre-token -> its segment in flat
        self.flat, self.ends = array("i"), array("q", [0])

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, and how many each has."""
        if len(self.known) > CACHED_PIECES:
            self._forget()
        if new := list(set(parts).difference(self.known)):
            spelled = [mapped(p.encode()) for p in new]
            self.known |= zip(new, range(len(self.known), len(self.known) + len(new)), strict=True)
            for text, ids in zip(spelled, self.model.encode(spelled, out_type=int, num_threads=1), strict=True):
                self.flat.extend(self.unreached.get(text, ids))
                self.ends.append(len(self.flat))
        picked = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        ids, lengths = gathered(np.frombuffer(self.flat, np.int32), np.frombuffer(self.ends, np.int64), picked)
        return ids - np.int32(1), lengths

    def _long(self, text: str) -> np.ndarray:
        parts = (m[0] for m in self.pattern.finditer(text))
        return np.concatenate([self._ids(chunk)[0] for chunk in iter(lambda: list(islice(parts, CHUNK_PIECES)), [])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n + 1 offsets of each text's ids."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for long, group in groupby(texts, lambda t: len(t) > CHUNK_PIECES * 10):
            if long:
                out += [(ids, np.array([len(ids)])) for ids in map(self._long, group)]
                continue
            found = list(map(self.pattern.findall, group))
            firsts = np.append(0, np.cumsum([len(x) for x in found]))
            ids, lengths = self._ids(list(chain.from_iterable(found)))
            sums = np.append(0, np.cumsum(lengths))
            out.append((ids, sums[firsts[1:]] - sums[firsts[:-1]]))
        if not out:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        return np.concatenate([x[0] for x in out]), np.append(0, np.cumsum(np.concatenate([x[1] for x in out])))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and the n + 1 offsets of each text's bytes."""
        data, lengths = gathered(self.bytes, self.byte_ends, ids.astype(np.int64))
        return data, np.append(0, np.cumsum(lengths))[offsets]


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> ByteBpe:
    """One tokenizer for each worker process."""
    return ByteBpe(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every text and the bytes they decode to: (key, ids, decoded).

    One row for each input row, repeated and null keys included; a null or empty text has no
    ids and no bytes. Other columns are not read. The rank file must exist on the executors.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        for batch in slices(batches):
            ids, offsets = bpe.encode([t or "" for t in batch.column("text").to_pylist()])
            data, ends = bpe.decode(ids, offsets)
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            spelled = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("key"), listed, spelled], names=[key, "ids", "decoded"])

    return text_and_key(docs, key, text).mapInArrow(run, schema)
