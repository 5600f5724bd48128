import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marketlens.llm import lexical_search
from marketlens.llm.queries import QUERIES
from tests.llm import edges

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = "".join(chr(c + 32) if 65 <= c <= 90 else chr(c) for c in range(128))


def terms(text):
    return TERM.findall("".join(SMALL[ord(c)] if ord(c) < 128 else c for c in text or ""))


def plain_search(docs, items, k=10):
    """Every document against every different item: (item, rank, document, score)."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, counts in held:
            n, score = sum(counts.values()), 0
            for term in terms(text):
                if tf := counts.get(term):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * (1000000000 * tf // (1000 * tf + 8 * (25 + 75 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_range_maxima():
    rng = np.random.default_rng(2)
    docs, words = np.divmod(np.sort(rng.choice(4000, 900, replace=False)), 10)
    segment = lexical_search.Segment(docs, words, rng.integers(0, 50, 900), 400, 10)
    for word in range(10):
        low, high = segment.ends[word], segment.ends[word + 1]
        for a, b in ((a, b) for a in range(low, high, 7) for b in range(a + 1, high + 1, 5)):
            assert segment.largest(np.array([a]), np.array([b]))[0] == a + np.argmax(segment.value[a:b])


@pytest.mark.parametrize("width,postings", [(1, 10**6), (3, 200), (32, 40)])
def test_equals_brute_force(spark, monkeypatch, width, postings):
    monkeypatch.setattr(lexical_search, "WIDTH", width)
    monkeypatch.setattr(lexical_search, "SEGMENT_POSTINGS", postings)
    rng = random.Random(width)
    vocabulary = [f"w{n}" for n in range(40)]
    def text(n):
        return " ".join(vocabulary[min(39, int(rng.expovariate(0.12)))] for _ in range(n))
    docs = [(rng.randrange(10**6), text(rng.randrange(1, 60))) for _ in range(300)]
    docs += [(k, docs[0][1]) for k in range(50)] + edges.rows()  # many equal scores
    items = [(n, text(rng.randrange(1, 20))) for n in range(20)] + [(50, docs[0][1]), (51, "nowhere"), (52, "W1, w1; w1")]
    ours = lexical_search.search(edges.frame(spark, docs), edges.frame(spark, items).withColumnRenamed("doc_id", "item_id"))
    assert found(ours) == plain_search(docs, items)


def test_blocks_and_odd_items(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 30)
    docs = [(n, f"red fox {n % 3}") for n in range(30)] + [(None, "Red owl"), (None, "red owl"), (7, ""), (8, None)]
    items = [(1, "red owl"), (1, "red owl"), (1, "fox 2"), (None, "owl"), (2, None), (3, "--"), (4, "RED fox red fox")]
    ours = lexical_search.search(edges.frame(spark, docs), edges.frame(spark, items).withColumnRenamed("doc_id", "item_id"), k=4)
    assert found(ours) == plain_search(docs, [i for i in items if i[1]], 4)
    empty = edges.frame(spark, [])
    assert lexical_search.search(empty, edges.frame(spark, items).withColumnRenamed("doc_id", "item_id")).count() == 0
    assert lexical_search.search(edges.frame(spark, docs), empty.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_query_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "benchmark"))
    expected = plain_search([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(QUERIES["op12_lexical_search"](spark, FOLDER)) == expected and len(expected) > 10
