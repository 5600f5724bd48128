import random
import re

from pyspark.sql import functions as F

from marketlens.llm import pii
from tests.llm import edges


def luhn(digits):
    values = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def plain(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def test_reported_kinds_equal_the_plain_patterns(spark):
    rng = random.Random(3)
    texts = ["a@b.c_d@e.f", "..@a.b", "a@b..c", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.1", "0001.002.3.255", "4539 1488 0343 6467 4539-1488-0343-6467",
             "+1 (555) 123-4567.", "\U0001f600a@b.co +1 555 123 4567", "\x1a1 2\x1a a\x1a@b.c", "@" * 50 + "a@b.c", "1 " * 3000, "x@" + "a." * 2000, "1.2.3.4 " * 500]
    texts += ["".join(rng.choice("ab01 2.3-@+()5_%\x1aé4") for _ in range(rng.randint(1, 60))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find(docs, pii.fit(docs)).select("doc_id", pii.spelled(F.filter("spans", lambda s: s["rank"] < 4)).alias("s")).collect()
    assert {r.doc_id: r.s for r in found} == {k: plain(t) for k, t in enumerate(texts)}


def test_running_sums_over_many_blocks(spark):
    row = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda x: x.cast("long")).alias("v")).select(pii.running_sums(F.col("v")).alias("s")).first()
    assert row.s == [k * (k + 1) // 2 for k in range(1, 1001)]


def test_votes_find_secrets_and_leave_the_rest(spark):
    rng = random.Random(1)
    hexes = [f"{rng.randrange(16**39, 16**40):040x}" for _ in range(40)]
    texts = [f'it says token = "{h}" here' for h in hexes] + ["version 1234567890123456 of a page", "commit aaaaaaaaaaaaaaaaaaaaaaaa1"] * 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(docs, pii.fit(docs)).collect()}
    assert all(found[k] == ["secret"] for k in range(40)) and not any("secret" in found[k] for k in range(41, 60, 2))


def test_edges(spark):
    docs = edges.frame(spark, edges.rows())
    found = pii.find(docs, pii.fit(docs))
    assert found.count() == docs.count() and found.where("doc_id = 1").first().spans == []
    assert pii.fit(docs.limit(0)) == [0.0] * (len(pii.FEATURES) + 1)


def test_estimates_follow_the_labelers():
    likely, rates = pii.reliabilities({"++": 80, "--": 100, "+-": 10, "00": 10})
    assert likely["++"] > 0.9 > 0.1 > likely["--"] and rates[0]["+"][1] > rates[0]["+"][0]
