import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import katz_lm
from tests.llm import edges


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})), None]


def plain(docs, train, share):
    own = [tokens(t) for t in docs]
    seen = Counter(w for ws, t in zip(own, train, strict=True) if t for w in ws)
    total, distinct = sum(seen.values()), len(seen)
    vocabulary = {w for w, n in seen.items() if n >= 2 and n * share >= total} | {None}
    pairs, history, single = Counter(), Counter(), Counter()
    for ws, t in zip(own, train, strict=True):
        before = "<s>"
        for w in ws if t else ():
            w = w if w in vocabulary else "<unk>"
            pairs[before, w] += 1
            history[before] += 1
            single[w] += 1
            before = w
    single["<unk>"], single[None] = max(1, single["<unk>"]), max(1, single[None])
    mass = sum(single.values())
    ranks = Counter(pairs.values())
    factors = katz_lm.discounts({r: ranks[r] for r in range(1, katz_lm.CUTOFF + 2)})

    def count(n):
        return n * factors[n] if n <= katz_lm.CUTOFF else n - factors[-1]

    taken, lower = defaultdict(float), defaultdict(float)
    for (h, w), n in pairs.items():
        taken[h] += count(n) / history[h]
        lower[h] += single[w] / mass

    def p(h, w):
        every = 1 - lower[h] < 1e-9
        if pairs[h, w]:
            return count(pairs[h, w]) / history[h] / (taken[h] if every else 1)
        return (1 - taken[h]) / (1 - lower[h]) * single[w] / mass

    members = len(set(seen) - vocabulary) + 1  # the last one for all words that training does not have
    for h in [*history, "<s>"]:
        assert sum(p(h, w) for w in single) == pytest.approx(1)
        every = [w for w in seen if w in vocabulary] + ["<unk>"] * members + [None] * (None not in seen)
        assert sum(p(h, w) / (members if w == "<unk>" else 1) for w in every) == pytest.approx(1)
    out = []
    for ws in own:
        before, score = "<s>", 0.0
        for w in ws:
            known = w if w in vocabulary else "<unk>"
            score += math.log10(p(before, known) / (members if known == "<unk>" else 1))
            before = known
        out.append((len(ws), sum(seen[w] > 0 for w in ws), total, sum(math.log10((seen[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws), score))
    return out


@pytest.mark.parametrize("share", [1 << 22, 60])
def test_same_scores_as_a_plain_model(spark, monkeypatch, share):
    monkeypatch.setattr(katz_lm, "SHARE", share)
    monkeypatch.setattr(katz_lm, "PART_TOKENS", 500)
    texts = [edges.prose(k, 40) + (f" only{k} twice{k // 2}" if k % 3 else "") for k in range(60)] + [None, "", "nothing known here"]
    docs = edges.frame(spark, list(enumerate(texts))).repartition(3)
    found = {r.doc_id: r[1:] for r in katz_lm.katz_scores(docs, F.col("doc_id") % 10 != 0).collect()}
    for k, expected in enumerate(plain(texts, [k % 10 != 0 for k in range(len(texts))], share)):
        assert found[k] == pytest.approx(expected)


def test_rare_words_stay_in_a_large_corpus(spark):
    common = spark.range(0, 90, 1, 4).select(F.col("id").alias("doc_id"), F.expr("repeat('the ', 100000)").alias("text"))
    rare = spark.createDataFrame([(100 + k, "pale lamp" if k < 2 else "far moon") for k in range(4)] + [(200, "pale lamp"), (201, "pale moon")], "doc_id long, text string")
    found = {r.doc_id: r.score for r in katz_lm.katz_scores(common.unionByName(rare), F.col("doc_id") < 200).where("doc_id >= 200").collect()}
    assert found[200] > found[201] + 1


def test_edges(spark):
    docs = edges.frame(spark, edges.rows())
    found = katz_lm.katz_scores(docs, F.col("doc_id") > 4)
    rows = found.collect()
    assert len(rows) == docs.count() and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    untrained = katz_lm.katz_scores(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in untrained)
    assert katz_lm.katz_scores(docs.limit(0), F.lit(True)).count() == 0


def test_integers_survive_packing():
    values = np.array([0, 1, 1 << 40, 3], np.uint64)
    assert katz_lm.grown(katz_lm.shrunk(values), np.uint64).tolist() == values.tolist()
    assert len(katz_lm.grown(katz_lm.shrunk(values[:0]), np.uint64)) == 0


def test_numbering_pairs_holds_two_arrays_of_a_chunk():
    words = katz_lm.Vocabulary(np.array([5, 2, 1]), np.array([2, 3, 4]), 6)
    ids = np.resize(np.array([1, 2, 0, words.end, 3]), 200_000)
    tracemalloc.start()
    try:
        pairs = words.pairs(ids)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.5 * ids.nbytes  # the result, and a mark for each token
    history, word = words.split(pairs)
    assert word.tolist() == ids.tolist()
    assert history[:6].tolist() == [words.start, 1, 2, 0, words.start, 3]
