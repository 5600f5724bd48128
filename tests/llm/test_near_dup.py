import random
import re
from itertools import combinations

import numpy as np
import pytest

from marketlens.llm import near_dup
from marketlens.llm.components import connected
from marketlens.llm.storage import Scratch
from tests.llm import edges


def shingles(text, width):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(own) < width:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[k : k + width]) for k in range(len(own) - width + 1))


def plain(rows, width, percent):
    sets, parent = {k: shingles(t, width) for k, t in rows}, {k: k for k, _ in rows}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {k: (len(sets[k]), top(k), top(k) == k) for k in sets}


def changed(rng, text, n):
    own = text.split(" ")
    for _ in range(n):
        own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
    return " ".join(own)


@pytest.mark.parametrize("width", [4, 5])
def test_same_components_as_all_pairs(spark, width):
    rng, texts = random.Random(width), []
    for family in range(12):
        base = " ".join(f"t{rng.randrange(400)}" for _ in range(rng.choice((3, 6, 60, 200))))
        texts += [changed(rng, base, rng.choice((0, 0, 1, 2, 4, 8))) for _ in range(rng.choice((1, 3, 30 if family == 5 else 8)))]
    texts += ["", None, "A b c d e f", "a B c d e f", "a b", "a b"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(edges.frame(spark, rows), width=width).collect()}
    assert found == plain(rows, width, 80)


def test_large_group_whose_members_meet_only_through_others(spark):
    rng = random.Random(2)
    base = [f"t{k}" for k in range(120)]
    rows = [(k, " ".join(base[k // 3 : 90 + k // 3])) for k in range(80)] + [(k, changed(rng, " ".join(base[:90]), 3)) for k in range(80, 160)]
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(edges.frame(spark, rows)).collect()}
    assert found == plain(rows, 5, 80)


def test_edges(spark):
    docs = edges.frame(spark, edges.rows())
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5} and all(not r.kept for r in rows if r.doc_id == 6)
    assert all(r.kept for r in rows if r.doc_id in (1, 2, 3, 4, None)) and all(r.component_id is None for r in rows if r.doc_id is None)
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    # The row without id whose text is that of 5 goes too.
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 8, 9]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_misses_at_the_limit_are_rare():
    rng, missed = np.random.default_rng(1), 0
    for _ in range(300):
        both, rest = rng.integers(0, 1 << 62, 80, dtype=np.uint64), rng.integers(0, 1 << 62, 20, dtype=np.uint64)
        one, two = np.sort(np.append(both, rest[:10])), np.sort(np.append(both, rest[10:]))
        values = near_dup.signatures(np.append(one, two), np.array([0, 90, 180]))
        same = values[0] == values[1]
        missed += not (same[: near_dup.SIDE].any() and same[near_dup.SIDE :].any())
    assert missed <= 1


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(300, 200), (7, 7)], "x long, y long")
    found = {r.node: r.label for r in connected(links, Scratch(spark, "test"), "path").collect()}
    assert found == {**{k: 0 for k in range(101)}, 200: 200, 300: 200}
