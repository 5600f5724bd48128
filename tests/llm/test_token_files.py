import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlens.llm import rans, token_files
from marketlens.llm.queries import QUERIES
from tests.llm import edges

PATH = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def judge():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_symbols_come_back():
    rng = np.random.default_rng(3)
    for size, blocks, lanes, steps in ((1, 1, 1, 1), (1, 2, 32, 9), (5, 3, 4, 100), (70_000, 4, 32, 50), (300, 1, 1, 2000)):
        weight = 1 / np.arange(1, size + 1)
        symbols = rng.choice(size, blocks * lanes * steps, p=weight / weight.sum())
        freqs, bits = rans.frequencies(np.bincount(symbols, minlength=size) + 1)
        assert freqs.min() >= 1 and freqs.sum() == 1 << bits
        coder = rans.Coder(freqs, bits, lanes)
        words, sizes, states = coder.encode(symbols, blocks)
        assert (coder.decode(words, sizes, states, steps) == symbols).all()
        first = sizes[0]  # a block needs nothing of the others
        assert (coder.decode(words[:first], sizes[:1], states[:1], steps) == symbols[: lanes * steps]).all()


def test_the_size_is_near_the_entropy():
    rng = np.random.default_rng(4)
    symbols = rng.choice(4, 64_000, p=[0.7, 0.2, 0.09, 0.01])
    words, _, _ = rans.Coder(*rans.frequencies(np.bincount(symbols)), 32).encode(symbols, 4)
    share = np.bincount(symbols) / len(symbols)
    assert len(words) * 32 < -(share * np.log2(share)).sum() * len(symbols) * 1.02 + 4 * 32 * 64


def test_pieces_give_the_ids_of_whole_texts(judge, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_PIECES", 50)
    coder = token_files.IdCoder(PATH)
    assert coder.cuts
    odd = ["", " ", "a", "  two  spaces ", "tab\t\tx\n\n y", "x  y　  z \u0085 ", "café au lait", "it's 'll  's", "\x1c \x1c", "日本 語",
           "<|endoftext|> a<|endoftext|>", " \n \n", "a \n", "\n", "1 2  3", "!? ...  --- é é"]
    texts = odd + ["".join(p) for p in itertools.product(["a", " ", "\n", " ", "'s", "1"], repeat=4)] + [edges.prose(5, 900)]
    ids, offsets = coder.encode(pa.array(texts))
    for n, text in enumerate(texts):
        assert ids[offsets[n] : offsets[n + 1]].tolist() == judge(text), repr(text)


def test_files_hold_every_row_in_key_order(spark, judge, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RECORD_IDS", 700)
    rows = [*edges.rows(), *[(20, edges.prose(8, 40))] * 30, (-5, "first"), (12, edges.prose(3, 120_000))]
    token_files.write(edges.frame(spark, rows).repartition(5), str(tmp_path / "f"), PATH, shard_ids=3000)
    found = token_files.read(spark, str(tmp_path / "f")).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in found:
        assert r.start == start and r.n == len(r.ids) and r.ids[-1] == 0
        assert r.crc32 == zlib.crc32(np.array(r.ids, np.uint32).tobytes())
        start += r.n
    assert sorted((r.doc_id or -1, r.ids[:-1]) for r in found) == sorted((i or -1, judge(t)) for i, t in rows)
    shards = token_files.headers(spark, str(tmp_path / "f")).select("shard").distinct().count()
    assert shards > 5  # the repeated key's rows are in several


def test_no_rows_and_text_keys(spark, judge, tmp_path):
    token_files.write(edges.frame(spark, []), str(tmp_path / "none"), PATH)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0
    docs = spark.createDataFrame([("b", "x y"), ("a", None), (None, "z")], "name string, body string")
    token_files.write(docs, str(tmp_path / "text"), PATH, end_id=7, key="name", text="body")
    found = token_files.read(spark, str(tmp_path / "text"), "string", "name").orderBy("start").collect()
    assert [(r.name, r.ids) for r in found] == [(None, [*judge("z"), 7]), ("a", [7]), ("b", [*judge("x y"), 7])]


def test_a_changed_byte_is_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 40
    table = token_files.Table(np.arange(40), *rans.frequencies(np.full(40, 125))).to_bytes()
    record = token_files.record_of(table, 2, 0, 9, pa.array([1, 2]), np.array([3000, 2000]), ids)
    assert token_files.header_of(record) == (2, 0, 9, 5000)
    shard, before, keys, lengths, back = token_files.documents_of(table, record)
    assert (shard, before, keys.to_pylist(), lengths.tolist(), back.tolist()) == (2, 9, [1, 2], [3000, 2000], ids.tolist())
    for at in (1, 60, len(record) // 2, len(record) - 1):
        broken = record[:at] + bytes([record[at] ^ 4]) + record[at + 1 :]
        with pytest.raises(token_files.BrokenRecord):
            token_files.documents_of(table, broken)
    other = token_files.Table(np.arange(40), *rans.frequencies(np.arange(1, 41))).to_bytes()
    with pytest.raises(token_files.BrokenRecord, match="block"):
        token_files.documents_of(other, record)


def test_the_mark_never_occurs_in_a_record():
    end = token_files.END_OF_RECORD.encode()
    for body in (b"", end, b"x" + end + bytes(b ^ 1 for b in end), end[:4], b"\x01" * 50):
        record = token_files.sealed(body)
        assert (record + end).index(end) == len(record) and token_files.opened(record) == body


def test_query_equals_the_library(spark, judge):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op11_rans_token_files"](spark, FOLDER).collect()}
    start = 0
    for doc_id, text in docs:
        ids = [*judge(text), 0]
        assert (found[doc_id].start, found[doc_id].n_tokens, found[doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, np.uint32).tobytes()))
        start += len(ids)
    assert len(found) == len(docs)
