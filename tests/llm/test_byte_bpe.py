import base64
import random

import public_tokenizers
import pytest
import tiktoken

from marketlens.llm import byte_bpe
from tests.llm import edges

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def judge():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_reference_library(judge):
    bpe, rng = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN), random.Random(4)
    texts = ["", "a" * 5000, " " * 99 + "x", "don't  stop\n\n 123", "▁Ġ<unk>"]
    texts += ["".join(chr(rng.choice((rng.randint(0, 600), rng.randint(0x4E00, 0x4F00), rng.randint(0x1F600, 0x1F640)))) for _ in range(40)) for _ in range(300)]
    ids, offsets = bpe.encode(texts)
    data, ends = bpe.decode(ids, offsets)
    for n, text in enumerate(texts):
        assert ids[offsets[n] : offsets[n + 1]].tolist() == judge.encode_ordinary(text)
        assert data[ends[n] : ends[n + 1]].tobytes() == text.encode()


def test_long_texts_and_forgetting(judge, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK_PIECES", 7)
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 3)
    bpe, text = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN), edges.prose(5, 500)
    assert bpe.encode(["a b", text, ""])[0].tolist() == judge.encode_ordinary("a b") + judge.encode_ordinary(text)


def test_every_row_comes_back(spark, judge):
    docs = edges.frame(spark, edges.rows())
    found = byte_bpe.encode_decode(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or -1, tuple(r.ids), bytes(r.decoded)) for r in found) == sorted(
        (i or -1, tuple(judge.encode_ordinary(t or "")), (t or "").encode()) for i, t in edges.rows())
    assert byte_bpe.encode_decode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
