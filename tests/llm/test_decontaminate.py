import random
import re

import pytest

from marketlens.llm import decontaminate
from tests.llm import edges

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        other = words(other)
        size = min(window, len(other))
        grams = {tuple(other[k : k + size]) for k in range(len(other) - size + 1)} if other else set()
        for k in range(len(own) - size + 1):
            if grams and tuple(own[k : k + size]) in grams:
                hit |= set(range(k, k + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize(("letters", "block"), [(2, 200_000), (5, 40)])
def test_same_hits_as_a_plain_search(spark, monkeypatch, letters, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = random.Random(letters)
    text = lambda n: " ".join(rng.choice("abcdeÉ"[:letters]) for _ in range(n)) + rng.choice(["", ".", " -"])
    items = [(k, text(rng.choice((0, 1, 3, 6, 9, 15)) if letters > 2 else rng.choice((0, 7, 9, 20)))) for k in range(30)] + [(None, "a b c"), (31, None), (2, text(12))]
    docs = [(k, text(rng.randint(0, 60))) for k in range(80)] + [(99, None), (99, ""), (None, text(30))]
    found = decontaminate.matches(edges.frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), window=6).withColumn("n_hit", decontaminate.hit_words()).collect()
    known = [(i, t) for i, t in items if i is not None]
    expected = sorted((i or -1, *plain(t, known, 6)) for i, t in docs)
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r["items"]) for r in found) == expected


def test_edges_and_cut_spans(spark):
    passage = "Seven quiet lamps glow under the north river stone, and walks of 42 more words"
    items = spark.createDataFrame([(1, passage), (2, "")], "item_id long, text string")
    docs = edges.frame(spark, [*edges.rows(), (50, "Before it. " + passage.upper() + "! After it.")])
    found = decontaminate.without_spans(decontaminate.matches(docs, items))
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[50].cleaned == "Before it. ! After it." and rows[50]["items"] == ["1"]
    assert rows[1].cleaned is None and rows[5].cleaned == rows[5].text
    assert found.count() == docs.count()
    none = decontaminate.matches(docs, items.limit(0))
    assert none.where("size(spans) > 0").count() == 0 and none.count() == docs.count()
