import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from marketlens.llm import periodic_runs
from marketlens.llm.queries import QUERIES
from marketlens.llm.text import mixed
from tests.llm import edges

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, min_words=24, min_turns=3):
    """For each period, stretches that agree with themselves one period on; the least period counts."""
    found = {}
    for p in range(1, len(words) // min_turns + 1):
        same = [words[i] == words[i + p] for i in range(len(words) - p)] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            if not s and start is not None:
                run, start = (start, i - start + p), None
                if run[1] >= max(min_words, min_turns * p):
                    found.setdefault(run, p)
    # A stretch of a multiple of the least period is the same stretch.
    return sorted((s, n, p) for (s, n), p in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(120))]
    out = []
    while len(out) < rng.randrange(1, 200):
        unit = [rng.choice("abcdefgh"[: rng.randrange(1, 9)]) for _ in range(rng.randrange(1, 14))]
        out += (unit * rng.randrange(1, 9))[: rng.randrange(1, 90)] + [rng.choice("xyz") for _ in range(rng.randrange(3))]
    return out


@pytest.mark.parametrize("limits", [(24, 3), (1, 3), (5, 4)])
def test_runs_equal_brute_force(limits):
    rng = random.Random(7)
    texts = [random_words(rng) for _ in range(400)] + [[], ["a"], ["a"] * 300, list("ab") * 40 + list("abc") * 40]
    words = np.array([zlib.crc32(w.encode()) for t in texts for w in t], np.uint64)
    firsts = np.append(0, np.cumsum([len(t) for t in texts]))
    found = periodic_runs.runs_of(mixed(words), firsts, *limits).tolist()
    for n, text in enumerate(texts):
        own = [(s - firsts[n], length, p) for s, length, p in found if firsts[n] <= s < firsts[n + 1]]
        assert own == plain_runs(text, *limits)


def test_all_kinds_of_rows(spark):
    turned = " ".join(["alpha", "beta", "gamma\n"] * 30) + " tail"
    rows = [*edges.rows(), (11, turned), (11, turned), (None, "x " * 40), (12, edges.prose(3, 200_000) + " end" * 50)]
    found = periodic_runs.find_runs(edges.frame(spark, rows)).collect()
    expected = []
    for i, text in rows:
        words = WORD.findall(text or "")
        runs = plain_runs(words) if len(words) < 1000 else [(len(words) - 50, 50, 1)] * text.endswith(" end end")
        expected.append((i or -1, len(words), runs, plain_collapsed(words, runs)))
    assert sorted((r.doc_id or -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found) == sorted(expected)
    assert periodic_runs.find_runs(edges.frame(spark, [])).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    held = 0
    for doc_id, text in docs:
        words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
        if len(words) > 3000:
            continue  # plain_runs is quadratic
        runs, own = plain_runs(words), found[doc_id]
        held += bool(runs)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        assert (own.n_runs, own.start, own.length, own.period) == (len(runs), *best)
        assert own.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert own.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert own.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert held > 5
